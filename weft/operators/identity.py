"""Identity keys, leakage, suspicion, reference pairing and the group split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weft.functions.keys import identity_key
from weft.functions.text import hash_order
from weft.operators.graph import connected_components
from weft.operators.sampling import top_k
from weft.session import materialise


def memberships(rows: DataFrame) -> DataFrame:
    """``id, kind, key``: audio, origin, verified speaker and (source, session) of each row."""
    session = identity_key(F.col("session"))
    kinds = F.array(
        F.struct(F.lit("audio").alias("kind"), F.col("audio").alias("key")),
        F.struct(F.lit("origin").alias("kind"), F.coalesce("origin_audio", "audio").alias("key")),
        F.struct(F.lit("speaker").alias("kind"), F.when(F.coalesce("speaker_verified", F.lit(False)), identity_key(F.col("speaker"))).alias("key")),
        F.struct(F.lit("session").alias("kind"), F.when(F.col("source_id").isNotNull() & session.isNotNull(), F.concat_ws("|", "source_id", session)).alias("key")),
    )
    return rows.select(F.col("clip_id").alias("id"), F.explode(kinds).alias("k")).select("id", "k.kind", "k.key").where("key is not null")


def split_leaks(rows: DataFrame) -> DataFrame:
    """Keys that occur in train and in another split, by kind."""
    m = memberships(rows).join(rows.select(F.col("clip_id").alias("id"), "split"), "id").where("split is not null")
    per = m.groupBy("kind", "key").agg(F.max(F.col("split") == "train").alias("t"), F.max(F.col("split") != "train").alias("h"))
    return per.where("t and h").groupBy("kind").agg(F.count("*").alias("keys"))


def propagate(rows: DataFrame, flagged: DataFrame) -> DataFrame:
    """Rows that share an audio or origin with a flagged row, and how."""
    m = memberships(rows).where("kind in ('audio', 'origin')")
    bad = m.join(flagged.select("id").distinct(), "id", "left_semi").select("kind", "key").distinct()
    return m.join(bad, ["kind", "key"]).groupBy("id").agg(F.sort_array(F.collect_set("kind")).alias("through"))


def reference_pairs(rows: DataFrame, low: float = 3.0, high: float = 10.0) -> DataFrame:
    """One reference for each verified clip: same speaker, other origin.

    Preferred: another language that is zh or en, then any other language, then
    the same. Instead of joining all clips of a speaker with each other, each
    speaker keeps its two best references (of different origins) per language,
    at most a dozen rows, and targets choose among these.
    """
    base = rows.where("speaker_verified and lang is not null").select("clip_id", identity_key(F.col("speaker")).alias("who"), "lang", F.coalesce("origin_audio", "audio").alias("origin"), "duration").where("who is not null")
    ok = base.where(F.col("duration").between(low, high) & ~F.isnan("duration"))
    order = F.struct(hash_order("ref", F.col("clip_id")).alias("h"), F.col("clip_id").alias("ref_id"))
    per_origin = ok.groupBy("who", "lang", "origin").agg(F.min(order).alias("o"))
    best = per_origin.withColumn("n", F.row_number().over(W.partitionBy("who", "lang").orderBy("o"))).where("n <= 2")
    refs = best.select("who", F.col("lang").alias("ref_lang"), F.col("origin").alias("ref_origin"), "o")
    tier = F.when(F.col("ref_lang") == F.col("lang"), 2).when(F.col("ref_lang").isin("zh", "en"), 0).otherwise(1)
    chosen = base.join(refs, "who").where("origin <> ref_origin").groupBy("clip_id").agg(F.min(F.struct(tier.alias("tier"), F.col("o.h").alias("h"), F.col("o.ref_id").alias("ref_id"), F.col("ref_lang"))).alias("c"))
    return chosen.select("clip_id", "c.ref_id", "c.ref_lang", "c.tier")


def quota_split(groups: DataFrame, ratio: float = 0.02, most: int = 200, least: int = 16) -> DataFrame:
    """``group_id, split`` for groups ``group_id, lang, n, pinned``.

    A language's quota is ``min(most, max(1, min(least, total div 5),
    round(total · ratio)))``; pinned groups are val and count; unpinned groups
    go to val in hash order while the quota is not reached (exclusive of the
    group itself), but the last group of a language in that order stays in
    train. Groups are never cut.
    """
    lang = W.partitionBy("lang")
    g = groups.withColumn("total", F.sum("n").over(lang))
    quota = F.least(F.lit(most), F.greatest(F.lit(1), F.least(F.lit(least), F.floor(F.col("total") / 5)), F.round(F.col("total") * ratio)))
    g = g.withColumn("quota", quota).withColumn("held", F.coalesce(F.sum(F.when(F.col("pinned"), F.col("n"))).over(lang), F.lit(0))).withColumn("h", hash_order("split", F.col("group_id")))
    free = g.where("not pinned")
    w = W.partitionBy("lang").orderBy("h", "group_id")
    free = free.withColumn("before", F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("after", F.lead("group_id").over(w))
    val = (F.col("held") + F.col("before") < F.col("quota")) & F.col("after").isNotNull()
    return free.select("group_id", F.when(val, "val").otherwise("train").alias("split")).unionByName(g.where("pinned").select("group_id", F.lit("val").alias("split")))


def components(rows: DataFrame) -> DataFrame:
    """``id, group_id`` of every row: rows that share an origin, a verified speaker or a session of a source, carried on.

    ``group_id`` is the smallest id of the group. Keys are first reduced to the
    smallest id that has them, so a hot key is one hub of an edge table.
    """
    m = memberships(rows).where("kind <> 'audio'")
    first = m.groupBy("kind", "key").agg(F.min("id").alias("first"))
    linked = connected_components(m.join(first, ["kind", "key"]).select(F.col("id").alias("a"), F.col("first").alias("b")))
    ids = rows.select(F.col("clip_id").alias("id"))
    return ids.join(linked, ids["id"] == linked["node"], "left").select("id", F.coalesce("root", "id").alias("group_id"))


def split_records(rows: DataFrame, hold: tuple[str, ...] = (), ratio: float = 0.02, most: int = 200, least: int = 16) -> DataFrame:
    """``clip_id, group_id, lang, split``: train and val without a group in both.

    Groups as in ``components``; a group's language is that of most of its rows,
    the smaller name on a tie. Groups with a session in ``hold`` are val. Each
    language has a quota of rows, as in ``quota_split``; other groups go to val in hash
    order while it is not reached, but the last one of a language stays in train.
    Rows that are only references fill no quota and have no say in the language; groups of only such rows
    are train. Null languages count as ``""``. With one group at most, or a ratio of zero, all is train; then, and
    where nothing else is left for train, held groups are an error. At most ``most`` groups a language are ordered.
    """
    tied = materialise(components(rows).join(rows.select(F.col("clip_id").alias("id"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("reference_only", F.lit(False)).alias("ref"), F.coalesce(F.col("session").isin(*hold), F.lit(False)).alias("pin")), "id"), "split-rows")
    per = tied.groupBy("group_id", "lang").agg(F.count_if(~F.col("ref")).alias("k"), F.max("pin").alias("pin"))
    names = F.min_by(F.when(F.col("k") > 0, F.col("lang")), F.when(F.col("k") > 0, F.struct((-F.col("k")).alias("k"), F.col("lang").alias("l"))))
    groups = materialise(per.groupBy("group_id").agg(F.coalesce(names, F.lit("")).alias("lang"), F.sum("k").alias("n"), F.max("pin").alias("pinned")), "split-groups")
    total = tied.groupBy("lang").agg(F.count_if(~F.col("ref")).alias("total"))
    quota = F.least(F.lit(most), F.greatest(F.lit(1), F.least(F.lit(least), F.floor(F.col("total") / 5)), F.round(F.col("total") * ratio)))
    state = groups.agg(F.count("*").alias("all"), F.count_if("pinned").alias("pins"), F.count_if(~F.col("pinned")).alias("free")).first()
    if ratio <= 0 or state["all"] < 2 or not state["free"]:
        if state["pins"]:
            raise ValueError("held sessions leave no group to train on, or nothing may be held out")
        return tied.select(F.col("id").alias("clip_id"), "group_id", "lang", F.lit("train").alias("split"))
    langs = groups.groupBy("lang").agg(F.sum(F.when(F.col("pinned"), F.col("n")).otherwise(0)).alias("held"), F.count_if(~F.col("pinned") & (F.col("n") > 0)).alias("groups")).join(total.select("lang", quota.alias("quota")), "lang", "left")
    free = groups.where("not pinned and n > 0").select("group_id", "lang", "n", hash_order("split", F.col("group_id")).alias("h"))
    w = W.partitionBy("lang").orderBy("h", "group_id")  # over `most` groups a language
    ranked = top_k(free, ["lang"], [F.col("h"), F.col("group_id")], most).withColumn("rank", F.row_number().over(w)).withColumn("before", F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    val = ranked.join(langs, "lang").where((F.col("held") + F.col("before") < F.coalesce("quota", F.lit(0))) & (F.col("rank") < F.col("groups"))).select("group_id")
    val = val.unionByName(groups.where("pinned").select("group_id")).withColumn("split", F.lit("val"))
    return tied.join(val, "group_id", "left").select(F.col("id").alias("clip_id"), "group_id", "lang", F.coalesce("split", F.lit("train")).alias("split"))

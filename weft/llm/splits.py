"""Splits that keep related records together: components, bundles, flow."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.functions.keys import identity_key
from weft.operators.graph import connected_components
from weft.operators.selection import radix_cutoffs
from weft.session import materialise

SPLITS = ("train", "val", "test")
#: Most distinct (size, label) profiles that the driver solves for.
MAX_BUNDLES = 2_000_000


def _keyed(clips: DataFrame) -> DataFrame:
    session = identity_key(F.col("session"))
    return clips.select(
        F.col("clip_id").cast("bigint").alias("clip_id"),
        F.col("source_id"),
        F.when(F.coalesce(F.col("speaker_verified"), F.lit(False)), identity_key(F.col("speaker"))).alias("sk"),
        F.when(F.col("source_id").isNotNull() & session.isNotNull(), F.concat_ws("\x1f", "source_id", session)).alias("ek"),
    )


def _groups_of_pairs(keyed: DataFrame) -> DataFrame:
    """``sk, ek, group_id`` for each pair of keys that occurs.

    A key stands for the smallest clip id that has it, so that nodes are ids
    and a component's root is its smallest clip. Clips shrink to distinct key
    pairs before anything is joined.
    """
    pairs = materialise(
        keyed.where("sk is not null or ek is not null").groupBy("sk", "ek").agg(F.min("clip_id").alias("m")), "split-pairs"
    )
    by_sk = pairs.where("sk is not null").groupBy("sk").agg(F.min("m").alias("a"))
    by_ek = pairs.where("ek is not null").groupBy("ek").agg(F.min("m").alias("b"))
    nodes = materialise(pairs.join(by_sk, "sk", "left").join(by_ek, "ek", "left").select("sk", "ek", "a", "b"), "split-nodes")
    labels = connected_components(nodes.where("a is not null and b is not null"), "a", "b")
    node = F.coalesce("a", "b")
    return (
        nodes.withColumn("node", node)
        .join(labels, "node", "left")
        .select("sk", "ek", F.coalesce("root", "node").alias("group_id"))
    )


def _attach(keyed: DataFrame, pairs: DataFrame) -> DataFrame:
    """Clips with keys and their group; both keys are compared null-safe."""
    k = lambda c: F.coalesce(F.col(c), F.lit(""))  # noqa: E731  keys are never blank
    left = keyed.where("sk is not null or ek is not null").select("clip_id", "source_id", k("sk").alias("sk"), k("ek").alias("ek"))
    right = pairs.select(k("sk").alias("sk"), k("ek").alias("ek"), "group_id")
    return left.join(right, ["sk", "ek"]).select("clip_id", "source_id", "group_id")


def related_groups(clips: DataFrame) -> DataFrame:
    """``clip_id, group_id`` of each clip tied to another one.

    Ties: the same non-missing speaker with both verified, or the same source
    and non-missing session; ties carry on. ``group_id`` is the smallest
    ``clip_id`` of the group. Null ``speaker_verified`` counts as false, a null
    source ties nothing, repeated ids count once each. Empty in, empty out.
    """
    grouped = materialise(_attach(_keyed(clips), _groups_of_pairs(_keyed(clips))), "split-groups")
    big = grouped.groupBy("group_id").count().where("count > 1").select("group_id")
    return grouped.join(big, "group_id").select("clip_id", "group_id")


def solve_bundles(sizes: list[int], counts: list[int], quotas: list[float]) -> list[list[int]]:
    """Components of each bundle to put into each split, by min-cost flow.

    A bundle holds ``counts[i]`` components of ``sizes[i]`` records. Records
    flow from bundles through splits to a sink; a split takes its quota at no
    cost and any more at a deviation cost of 1 a record, and putting a component
    into a split costs ``(size / quota)**2``, so that components larger than a
    small split stay out of it. Successive shortest paths over the residual
    graph of splits solve it; flows are then rounded to whole components,
    largest sizes first, always to the split with the most room left, and then
    exchanged while that lessens the deviation: with components of one record in
    each split, every split ends within a record of its quota.
    """
    k = len(quotas)
    size, cnt = np.asarray(sizes, float), np.asarray(counts, float)
    q = np.maximum(np.asarray(quotas, float), 1e-9)
    supply = size * cnt
    unit = np.minimum((size[:, None] / q[None, :]) ** 2, 1e6)
    flow = np.zeros((len(size), k))
    room = q.copy()
    for b in np.argsort(-size, kind="stable"):
        left = supply[b]
        while left > 1e-9:
            # cheapest way for one more record of b: into split j, perhaps moving records of an earlier bundle from j on to h
            cost = unit[b] + np.where(room > 1e-9, 0.0, 1.0)
            path = [(int(j), None, None) for j in range(k)]
            for j in range(k):
                have = flow[:, j] > 1e-9
                if not have.any():
                    continue
                for h in range(k):
                    if h == j or room[h] <= 1e-9:
                        continue
                    delta = np.where(have, unit[:, h] - unit[:, j], np.inf)
                    m = int(delta.argmin())
                    if unit[b, j] + delta[m] < cost[j] - 1e-12:
                        cost[j], path[j] = unit[b, j] + delta[m], (j, m, h)
            j, m, h = path[int(cost.argmin())]
            if m is None:
                amount = min(left, room[j]) if room[j] > 1e-9 else left
                room[j] -= amount
            else:
                amount = min(left, flow[m, j], room[h])
                flow[m, j] -= amount
                flow[m, h] += amount
                room[h] -= amount
            flow[b, j] += amount
            left -= amount
    out = np.zeros((len(size), k), dtype=np.int64)
    filled = np.zeros(k)
    for b in np.argsort(-size, kind="stable"):
        whole = np.floor(flow[b] / size[b] + 1e-9).astype(np.int64)
        out[b] = whole
        filled += whole * size[b]
        for _ in range(int(cnt[b]) - int(whole.sum())):
            j = int((q - filled).argmax())
            out[b, j] += 1
            filled[j] += size[b]
    # whole components then change splits as long as that brings the splits nearer to their quotas
    while True:
        best, move = 1e-9, None
        for i in range(k):
            for j in range(k):
                if i == j or filled[i] <= q[i] or filled[j] >= q[j]:
                    continue
                many = np.clip(np.floor(min(filled[i] - q[i], q[j] - filled[j]) / size), 1, None)
                many = np.minimum(many, out[:, i])
                gain = filled[i] - q[i] + q[j] - filled[j] - np.abs(filled[i] - many * size - q[i]) - np.abs(filled[j] + many * size - q[j])
                b = int(gain.argmax())
                if gain[b] > best:
                    best, move = float(gain[b]), (b, i, j, int(many[b]))
        if move is None:
            return out.tolist()
        b, i, j, n = move
        out[b, i] -= n
        out[b, j] += n
        filled[i] -= n * size[b]
        filled[j] += n * size[b]


def split_components(clips: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """``clip_id, group_id, lang, split``: an assignment that cuts no group.

    Components are bundled by equal size and label profile (the language of
    their clips' source). Components of several languages go first, to the
    split that then deviates least; all others are solved a language at a time
    by ``solve_bundles``. Members of a bundle are dealt out by hash: the first
    so many by radix selection. Clips of a source without language, or with one
    that has no target, follow the mean of the targets. A clip without ties is
    a component by itself.
    """
    spark = clips.sparkSession
    keyed = _keyed(clips)
    tied = _attach(keyed, _groups_of_pairs(keyed))
    alone = keyed.where("sk is null and ek is null").select("clip_id", "source_id", F.col("clip_id").alias("group_id"))
    langs = sources.select(F.col("id").alias("source_id"), F.coalesce(F.nullif(F.trim("lang"), F.lit("")), F.lit("?")).alias("lang")).dropDuplicates(["source_id"])
    members = materialise(
        tied.unionByName(alone).join(langs, "source_id", "left").select("clip_id", "group_id", F.coalesce("lang", F.lit("?")).alias("lang")),
        "split-members",
    )
    per = members.groupBy("group_id", "lang").count()
    profile = F.concat_ws("|", F.sort_array(F.collect_list(F.concat_ws(":", "lang", F.col("count").cast("string")))))
    comps = materialise(per.groupBy("group_id").agg(profile.alias("profile")), "split-comps")  # a list holds at most one entry a language
    bundles = comps.groupBy("profile").count().limit(MAX_BUNDLES + 1).collect()
    if len(bundles) > MAX_BUNDLES:
        raise ValueError(f"more than {MAX_BUNDLES} distinct component profiles")
    plan = _plan([(r[0], r[1]) for r in bundles], [(r["lang"], r["split"], float(r["share"])) for r in targets.collect()])
    schema = T.StructType([T.StructField("profile", T.StringType()), T.StructField("n0", T.LongType()), T.StructField("n1", T.LongType()), T.StructField("n2", T.LongType())])
    plan_df = spark.createDataFrame(plan, schema)
    dealt = comps.join(plan_df, "profile").withColumn("h", F.xxhash64(F.lit("split"), "group_id"))
    cuts = []
    for name, quota in (("c0", F.col("n0")), ("c1", F.col("n0") + F.col("n1"))):
        mixed = dealt.withColumn("q", quota).where("q > 0 and q < n0 + n1 + n2")
        cut = radix_cutoffs(mixed, ["profile"], "q", "h", "group_id")
        cuts.append(cut.select("profile", F.struct(F.col("cut_hi").alias("h"), F.col("cut_lo").alias("g")).alias(name)))
    key = F.struct(F.col("h"), F.col("group_id").alias("g"))
    total = F.col("n0") + F.col("n1") + F.col("n2")

    def within(quota: Column, cut: str) -> Column:
        return F.when(quota >= total, F.lit(True)).when(quota <= 0, F.lit(False)).otherwise(key <= F.col(cut))

    which = (
        dealt.join(cuts[0], "profile", "left")
        .join(cuts[1], "profile", "left")
        .select(
            "group_id",
            F.when(within(F.col("n0"), "c0"), SPLITS[0]).when(within(F.col("n0") + F.col("n1"), "c1"), SPLITS[1]).otherwise(SPLITS[2]).alias("split"),
        )
    )
    return members.join(which, "group_id").select("clip_id", "group_id", "lang", "split")


def _plan(bundles: list[tuple[str, int]], targets: list[tuple[str, str, float]]) -> list[tuple[str, int, int, int]]:
    share: dict[str, list[float]] = {}
    for lang, split, value in targets:
        if lang is not None and split in SPLITS and value is not None:
            share.setdefault(lang, [0.0] * 3)[SPLITS.index(split)] = value
    mean = np.mean(list(share.values()), axis=0).tolist() if share else [1.0, 0.0, 0.0]
    parsed = []
    totals: dict[str, int] = {}
    for text, count in bundles:
        parts = [(p.rpartition(":")[0], int(p.rpartition(":")[2])) for p in text.split("|")]
        parsed.append((text, count, parts))
        for lang, n in parts:
            totals[lang] = totals.get(lang, 0) + n * count
    left = {lang: np.asarray(share.get(lang, mean)) * n for lang, n in totals.items()}
    out = []
    for text, count, parts in sorted((b for b in parsed if len(b[2]) > 1), key=lambda b: (-sum(n for _, n in b[2]), b[0])):
        deal = [0, 0, 0]
        for _ in range(count):
            cost = [sum(max(0.0, n - left[lang][j]) for lang, n in parts) for j in range(3)]
            j = int(np.argmin([c - 1e-9 * sum(left[lang][i] for lang, _ in parts) for i, c in enumerate(cost)]))
            deal[j] += 1
            for lang, n in parts:
                left[lang][j] -= n
        out.append((text, *deal))
    for lang in totals:
        own = [(text, count, parts[0][1]) for text, count, parts in parsed if len(parts) == 1 and parts[0][0] == lang]
        if own:
            dealt = solve_bundles([o[2] for o in own], [o[1] for o in own], np.maximum(left[lang], 0).tolist())
            out += [(o[0], *d) for o, d in zip(own, dealt)]
    return out


def split_report(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """``lang, split, clips, share, target``: the shares as they came out."""
    total = assigned.groupBy("lang").agg(F.count("*").alias("total"))
    got = assigned.groupBy("lang", "split").agg(F.count("*").alias("clips"))
    want = targets.select("lang", "split", F.col("share").alias("target"))
    return (
        got.join(total, "lang")
        .join(want, ["lang", "split"], "left")
        .select("lang", "split", "clips", F.round(F.col("clips") / F.col("total"), 6).alias("share"), "target")
    )

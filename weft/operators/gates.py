"""Guards and decisions on reports: merging, strict pairs, gates, sign tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions.text import normal_text
from weft.operators.reports import metric
from weft.operators.sequential import sign_test

KEYS = ["case_id", "seed"]


def merge_reports(shards: DataFrame, settings: list[str]) -> DataFrame:
    """The items of one report's shards; a repeated case and seed, or shards that differ in a setting, are errors.

    ``shards`` has a column ``shard``. The errors come when the rows are read.
    """
    if not settings:
        checked = shards
    else:
        spread = shards.agg(*[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\0"))).alias(c) for c in settings])
        bad = F.concat_ws(", ", *[F.when(F.col(c) > 1, c) for c in settings])
        ok = spread.select(F.when(bad == "", True).otherwise(F.raise_error(F.concat(F.lit("shards differ in "), bad))).alias("_ok"))  # one row
        checked = shards.join(F.broadcast(ok)).where("_ok").drop("_ok")
    rest = [c for c in checked.columns if c not in KEYS]
    once = checked.groupBy(*KEYS).agg(F.count("*").alias("_n"), F.first(F.struct(*rest)).alias("_x"))
    twice = F.raise_error(F.concat(F.lit("repeated item "), F.col("case_id"), F.lit("/"), F.col("seed")))
    return once.withColumn("_x", F.when(F.col("_n") == 1, F.col("_x")).otherwise(twice)).select(*KEYS, "_x.*")


def strict_pairs(a: DataFrame, b: DataFrame, same: list[str]) -> DataFrame:
    """Every case and seed of both reports; a missing or repeated one, or one under other conditions, is an error when read."""

    def once(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in KEYS]
        return df.groupBy(*KEYS).agg(F.count("*").alias(f"n_{name}"), F.first(F.struct(*rest)).alias(name))

    both = once(a, "a").join(once(b, "b"), KEYS, "full_outer")
    equal = F.lit(True)
    for c in same:
        equal = equal & (F.coalesce(F.col(f"a.{c}").cast("string"), F.lit("")) == F.coalesce(F.col(f"b.{c}").cast("string"), F.lit("")))
    fail = lambda why: F.raise_error(F.concat(F.lit(why + " "), F.col("case_id"), F.lit("/"), F.col("seed")))
    state = F.when(F.col("n_a").isNull() | F.col("n_b").isNull(), fail("only in one report:")).when((F.col("n_a") > 1) | (F.col("n_b") > 1), fail("repeated:")).when(~equal, fail("other conditions:")).otherwise(True)
    return both.withColumn("_ok", state).where("_ok").select(*KEYS, "a", "b")


def severe(items: DataFrame) -> Column:
    """CER over 0.2, over-read, or nothing said."""
    empty = F.coalesce(F.length(normal_text(F.col("hyp"))), F.lit(0)) == 0
    return F.coalesce(metric("cer") > 0.2, F.lit(False)) | F.coalesce("over_read", F.lit(False)) | empty


def against_first(items: DataFrame, columns: list[str]) -> DataFrame:
    """Each report's items beside those of the report of smallest id, as structs ``c`` and ``b``, on case and seed."""
    first = F.broadcast(items.agg(F.min("report_id").alias("_first")))  # one row
    x = items.join(first)
    c = x.where("report_id > _first").select("report_id", *KEYS, F.struct(*columns).alias("c"))
    return c.join(x.where("report_id = _first").select(*KEYS, F.struct(*columns).alias("b")), KEYS)


def severe_compare(items: DataFrame, margin: float = 0.01) -> DataFrame:
    """Severe failures new and mended against the first report, by language, with one-sided sign tests.

    Worse: the test says so at 0.1 or the mean CER (missing as 0) rose by more
    than ``margin``. Better: the test says so at 0.05. ``items`` has one row a report, case and seed.
    """
    x = against_first(items.withColumn("severe", severe(items)).withColumn("cer0", F.coalesce(metric("cer"), F.lit(0.0))), ["lang", "severe", "cer0"])
    g = x.groupBy("report_id", F.col("b.lang").alias("lang")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("c.severe") & ~F.col("b.severe")).alias("new"),
        F.count_if(F.col("b.severe") & ~F.col("c.severe")).alias("mended"),
        (F.avg("c.cer0") - F.avg("b.cer0")).alias("d"),
    )
    g = g.withColumn("p_worse", sign_test("new", F.col("new") + F.col("mended"))).withColumn("p_better", sign_test("mended", F.col("new") + F.col("mended")))
    return g.select("report_id", "lang", "n", "new", "mended", F.round("p_worse", 4).alias("p_worse"), F.round("p_better", 4).alias("p_better"), ((F.col("p_worse") < 0.1) | (F.round("d", 12) > margin)).alias("worse"), (F.col("p_better") < 0.05).alias("better"))


def duration_gates(items: DataFrame, ratio: float = 0.10, tolerance: float = 0.01) -> DataFrame:
    """Reports whose sound grew by more than ``ratio`` while the CER stayed within ``tolerance``, overall and by language.

    Both means leave numeric cases out; a scope without either is not judged.
    """
    plain = ~F.coalesce("numeric", F.lit(False))
    means = items.where(plain).groupingSets([["report_id"], ["report_id", "lang"]], "report_id", "lang").agg(F.grouping("lang").alias("g"), F.avg(metric("audio_sec")).alias("sec"), F.avg(metric("cer")).alias("cer"))
    means = means.select("report_id", F.when(F.col("g") == 1, "overall").otherwise(F.col("lang")).alias("scope"), "sec", "cer").where("scope is not null")
    first = F.broadcast(items.agg(F.min("report_id").alias("_first")))  # one row
    x = means.join(first)
    b = x.where("report_id = _first").select("scope", F.col("sec").alias("sec0"), F.col("cer").alias("cer0"))
    y = x.where("report_id > _first").join(b, "scope")
    grew = F.round(F.col("sec") / F.nullif(F.col("sec0"), F.lit(0.0)) - 1, 12)
    return y.select("report_id", "scope", F.round(grew, 6).alias("growth"), F.coalesce((grew > ratio) & (F.abs(F.round(F.col("cer") - F.col("cer0"), 12)) <= tolerance), F.lit(False)).alias("inflated"))


def significant_drop(point: Column, high: Column, least: float) -> Column:
    """A mean difference of at least ``-least`` whose interval ends below zero; missing is no drop."""
    return F.coalesce((point <= -least) & (high < 0), F.lit(False))

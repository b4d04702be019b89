"""Report aggregates, paired comparison, gates and confidence intervals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions.text import hash_integer, normal_text


def metric(c: str) -> Column:
    """A metric with NaN as missing."""
    return F.when(~F.isnan(c), F.col(c))


def nearest_rank(values: Column, q: float) -> Column:
    """``sorted[min(n - 1, floor(q n))]`` of an array of values."""
    n = F.size(values)
    return F.when(n > 0, F.get(F.sort_array(values), F.least(n - 1, F.floor(F.lit(q) * n).cast("int"))))


def report_aggregate(items: DataFrame, by: list[str]) -> DataFrame:
    """Null-skipping means, rates and nearest-rank tail of reports, per group."""
    return items.groupBy(*by).agg(
        F.count("*").alias("items"),
        F.round(F.avg(metric("cer")), 4).alias("cer"),
        F.round(F.avg(F.when(~F.coalesce(F.col("numeric"), F.lit(False)), metric("cer"))), 4).alias("cer_plain"),
        F.round(F.avg(metric("wer")), 4).alias("wer"),
        F.round(F.avg(F.col("over_read").cast("int")), 4).alias("over_read_rate"),
        F.round(F.avg(F.col("suspected_truncation").cast("int")), 4).alias("truncation_rate"),
        nearest_rank(F.collect_list(metric("len_ratio")), 0.9).alias("len_ratio_p90"),
    )


def by_language(items: DataFrame) -> DataFrame:
    """Overall and per language in one pass: grouping sets."""
    return items.select("report_id", F.coalesce("lang", F.lit("?")).alias("lang"), metric("cer").alias("cer")).groupingSets([["report_id"], ["report_id", "lang"]], "report_id", "lang").agg(
        F.count("*").alias("items"), F.round(F.avg("cer"), 6).alias("cer")
    )


def unique_items(items: DataFrame) -> DataFrame:
    """One item a ``(report, case, seed)``: the latest scored, then the smallest hypothesis."""
    keys = ["report_id", "case_id", "seed"]
    rest = [c for c in items.columns if c not in keys]
    best = items.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("scored_at", F.coalesce("hyp", F.lit("")))).alias("_b"))
    return best.select(*keys, "_b.*")


def paired(candidate: DataFrame, base: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Inner pairs on case and seed where both have the metric; conditions must agree.

    ``keep`` names further columns of the candidate, such as its report.
    """
    a = candidate.select(*keep, "case_id", "seed", "lang", "text", metric(name).alias("a"))
    b = base.select("case_id", "seed", F.col("text").alias("text_b"), metric(name).alias("b"))
    return a.join(b, ["case_id", "seed"]).where("a is not null and b is not null and text <=> text_b").withColumn("delta", F.round(F.col("a") - F.col("b"), 12))


def paired_reports(items: DataFrame, name: str) -> DataFrame:
    """Every report against the one of smallest id, on case and seed; ``report_id`` is the candidate's."""
    cols = ["report_id", "case_id", "seed", "lang", "text", "hyp", name, "audio_sec", "scored_at"]
    u = unique_items(items.select(*[c for c in cols if c in items.columns]))
    first = F.broadcast(items.agg(F.min("report_id").alias("_first")))  # one row
    u = u.join(first)
    return paired(u.where("report_id > _first"), u.where("report_id = _first"), name, ("report_id",))


def case_equal_mean(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Mean over cases of the mean over seeds, with sign counts."""
    per = pairs.groupBy(*by, "case_id").agg(F.avg("delta").alias("d"))
    return per.groupBy(*by).agg(
        F.count("*").alias("cases"),
        F.round(F.avg("d"), 6).alias("mean_delta"),
        F.count_if(F.round("d", 12) < 0).alias("better"),
        F.count_if(F.round("d", 12) > 0).alias("worse"),
    )


def seed_stability(items: DataFrame) -> DataFrame:
    """Sample deviation and range over seeds of each case, then unweighted over cases."""
    per = items.groupBy("report_id", "case_id").agg(F.stddev_samp(metric("cer")).alias("s"), (F.max(metric("cer")) - F.min(metric("cer"))).alias("r"), F.count("*").alias("n")).where("n > 1")
    return per.groupBy("report_id").agg(F.count("*").alias("cases"), F.round(F.avg("s"), 6).alias("mean_std"), F.round(F.avg("r"), 6).alias("mean_range"))


def hash_bootstrap(values: DataFrame, group: str | list[str], value: str, rounds: int = 200, seed: int = 7) -> DataFrame:
    """Percentile interval of a group's mean, resampling by hash instead of a generator.

    Draw ``i`` of round ``b`` takes the value of rank ``hash(seed, b, i) mod n``,
    so any engine gives the same interval. ``values`` has one row a case.
    """
    group = [group] if isinstance(group, str) else group
    arrays = values.groupBy(*group).agg(F.transform(F.sort_array(F.collect_list(F.struct("case_id", value))), lambda x: x[value]).alias("v"))
    draws = arrays.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    n = F.size("v")
    picks = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("v", (hash_integer(F.lit(seed), F.col("b"), i) % n).cast("int")))
    means = draws.withColumn("m", F.aggregate(picks, F.lit(0.0), lambda s, x: s + x) / n)
    q = means.groupBy(*group).agg(F.percentile("m", F.array(F.lit(0.025), F.lit(0.975))).alias("q"), F.max(n).alias("cases"))
    return q.select(*group, "cases", F.round(F.col("q")[0], 6).alias("low"), F.round(F.col("q")[1], 6).alias("high"))


def near_silence(items: DataFrame) -> Column:
    """Level under -60 dBFS and hardly any speech; false where the report has no such measures."""
    if "rms_dbfs" not in items.columns:
        return F.lit(False)
    speech = F.coalesce("speech_ratio", F.lit(0.0)) if "speech_ratio" in items.columns else F.lit(0.0)
    return F.coalesce(F.col("rms_dbfs") < -60, F.lit(False)) & (speech < 0.05)


def keep_best(items: DataFrame, seeds: tuple[int, ...] | None = None) -> DataFrame:
    """Best seed of each case: with letters, not near silence, not over-read, lowest CER, smallest seed.

    With ``seeds``, only these count, and a case that lacks one or has one
    twice is an error when its row is read. Missing CER ranks last.
    """
    rank = F.struct(
        (F.coalesce(F.length(normal_text(F.col("hyp"))), F.lit(0)) == 0).alias("e"),
        near_silence(items).alias("q"),
        F.coalesce("over_read", F.lit(False)).alias("o"),
        F.coalesce(metric("cer"), F.lit(1e9)).alias("c"),
        F.col("seed").alias("s"),
    )
    rows = items if seeds is None else items.where(F.col("seed").isin(*seeds))
    best = rows.select("report_id", "case_id", "seed", rank.alias("k")).groupBy("report_id", "case_id").agg(F.min("k").alias("k"), F.count("*").alias("n"), F.count_distinct("seed").alias("d"))
    if seeds is not None:
        wrong = F.raise_error(F.concat(F.lit("repeated or missing seeds of case "), F.col("case_id")))
        best = best.withColumn("k", F.when((F.col("n") == len(set(seeds))) & (F.col("d") == F.col("n")), F.col("k")).otherwise(wrong))
    return best.select("report_id", "case_id", F.col("k.s").alias("seed"), F.when(F.col("k.c") < 1e9, F.round("k.c", 6)).alias("cer"))


def sign_p(k: int, n: int) -> float:
    """P(X >= k) for X ~ Bin(n, 1/2), exact."""
    return sum(math.comb(n, i) for i in range(k, n + 1)) / 2**n if n else 1.0

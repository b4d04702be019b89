"""Budgets, exposure caps, shards, strata and windows in a reproducible hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weft.functions.text import hash_order
from weft.operators.selection import running_total


def _order(namespace: str, key: str) -> Column:
    """The order of ``hash_order`` as a BIGINT that uses its whole range: the first 60 bits."""
    return (F.conv(F.substring(hash_order(namespace, F.col(key)), 1, 15), 16, 10).cast("bigint") - F.lit(1 << 59)) * 16


def within_budget(df: DataFrame, group: list[str], amount: Column, budget: Column, key: str, namespace: str = "budget", bits: int = 10) -> DataFrame:
    """Rows taken in hash order while less than the budget is consumed (the last may overshoot).

    Sums run through ``2**bits`` hash buckets a group, so that no group is
    ordered in one task. Null amounts count as nothing.
    """
    summed = running_total(df.withColumn("_o", _order(namespace, key)), group, "_o", key, F.coalesce(amount, F.lit(0.0)), bits, "_before")
    return summed.where(F.col("_before") < budget).select(*df.columns)


def interleave(df: DataFrame, group: str, key: str, namespace: str = "turn", bits: int = 10) -> DataFrame:
    """Round-robin over groups by hash order: ``turn`` 1 for the first rows of all groups, then 2, bucket by bucket."""
    ranked = running_total(df.withColumn("_o", _order(namespace, key)), [group], "_o", key, F.lit(1).cast("bigint"), bits, "_before")
    return ranked.select(*df.columns, (F.col("_before") + 1).alias("turn"))


def passes(df: DataFrame, k: int) -> DataFrame:
    """``k`` copies of each row, numbered: repeats up to an exposure cap."""
    return df.withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(k))))


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def shard(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """Residue of the row's position in ``order``."""
    return df.withColumn("shard", (F.row_number().over(W.orderBy(*order)) - 1) % n)


def fixed_windows(length: Column, size: float, hop: float) -> Column:
    """Starts of overlapping windows over ``length``, with a forced window at the end."""
    steps = F.floor(F.greatest(length - size, F.lit(0.0)) / hop).cast("int")
    starts = F.transform(F.sequence(F.lit(0), steps), lambda i: F.round(i * F.lit(hop), 6))
    tail = F.round(F.greatest(length - size, F.lit(0.0)), 6)
    return F.when(F.element_at(starts, -1) < tail, F.concat(starts, F.array(tail))).otherwise(starts)

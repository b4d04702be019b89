"""Distributed exact selection: radix cut-offs and running totals.

Neither operator sorts a whole group in one task: a group may hold a third of
all rows. Work per group is bounded by the number of digit values (selection)
or hash buckets (running totals).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weft.session import materialise

SIGN = -0x8000000000000000


def _digit(c: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(c.bitwiseXOR(F.lit(SIGN)), shift).bitwiseAND(F.lit((1 << bits) - 1))


def radix_cutoffs(rows: DataFrame, group: list[str], quota: str, hi: str, lo: str, digit_bits: int = 16) -> DataFrame:
    """The ``quota``-th smallest key ``(hi, lo)`` of each group that has more rows.

    ``hi`` and ``lo`` are BIGINT columns compared as a pair; ``(hi, lo)`` should
    be unique in a group, else ties at the cut are kept together only as far as
    the last digit can tell them apart. ``quota`` is a BIGINT column, constant
    within a group and at least 1. Returns ``group..., cut_hi, cut_lo`` with one
    row for each group of more than ``quota`` rows.

    Each pass counts rows per group and digit, fixes the digit in which the cut
    lies, and goes on with the rows of that digit alone. Digits in which no
    group varies are skipped. Null group keys form a group of their own.
    """
    work = rows.select(*group, F.col(quota).alias("_q"), F.col(hi).alias("_hi"), F.col(lo).alias("_lo"))
    width = 64 // digit_bits
    digits = [(c, 64 - digit_bits * (i + 1)) for c in ("_hi", "_lo") for i in range(width)]
    found: DataFrame | None = None
    first = True
    while digits:
        c, shift = digits.pop(0)
        w = W.partitionBy(*group).orderBy("_d")
        counted = (
            work.groupBy(*group, _digit(F.col(c), shift, digit_bits).alias("_d"))
            .agg(F.count("*").alias("_n"), F.max("_q").alias("_q"), F.max(F.struct("_hi", "_lo")).alias("_mx"))
            .withColumn("_cum", F.sum("_n").over(w))
            .withColumn("_total", F.sum("_n").over(W.partitionBy(*group)))
            .where("_cum >= _q and _cum - _n < _q")
            .withColumn("_left", F.col("_q") - (F.col("_cum") - F.col("_n")))
        )
        if first:
            counted = counted.where("_total > _q")
        counted = materialise(counted.select(*group, "_d", "_n", "_left", "_mx"), "radix-cut")
        final = counted if not digits else counted.where("_left = _n")
        done = final.select(*group, F.col("_mx._hi").alias("cut_hi"), F.col("_mx._lo").alias("cut_lo"))
        found = done if found is None else found.unionByName(done)
        going = counted.where("_left < _n")
        if not digits or going.isEmpty():
            break
        renamed = going.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_d").alias("_gd"), F.col("_left"))
        cond = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
        cond.append(_digit(F.col(c), shift, digit_bits) == F.col("_gd"))
        work = materialise(work.join(renamed, cond, "inner").select(*group, F.col("_left").alias("_q"), "_hi", "_lo"), "radix-rows")
        first = False
        mask = (
            work.groupBy(*group)
            .agg(*[F.bit_or(x).bitwiseXOR(F.bit_and(x)).alias(x) for x in ("_hi", "_lo")])
            .agg(*[F.bit_or(x).alias(x) for x in ("_hi", "_lo")])
            .first()
        )
        full = (1 << 64) - 1
        digits = [(x, s) for x, s in digits if ((mask[x] & full) >> s) & ((1 << digit_bits) - 1)]
        if not digits:  # equal keys: the cut is that key
            rest = work.groupBy(*group).agg(F.max(F.struct("_hi", "_lo")).alias("_mx"))
            found = found.unionByName(rest.select(*group, F.col("_mx._hi").alias("cut_hi"), F.col("_mx._lo").alias("cut_lo")))
    return found


def bucket_bits(rows: int, per_bucket: int = 4096) -> int:
    """Bits of hash so that a bucket holds about ``per_bucket`` rows."""
    return max(2, min(20, math.ceil(math.log2(max(1, rows) / per_bucket + 1))))


def running_total(df: DataFrame, group: list[str], hash_col: str, tie: str, value: Column, bits: int, out: str = "before") -> DataFrame:
    """Sum of ``value`` over the rows before each row, in order of ``(hash, tie)``.

    Rows are cut into ``2**bits`` hash buckets a group. Bucket sums are made with
    map-side combine; only those are ordered within a whole group, and rows are
    ordered within their bucket.
    """
    b = F.shiftrightunsigned(F.col(hash_col).bitwiseXOR(F.lit(SIGN)), 64 - bits)
    df = df.withColumn("_b", b).withColumn("_v", value)
    before = W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    sums = df.groupBy(*group, "_b").agg(F.sum("_v").alias("_s"))
    base = sums.withColumn("_base", F.coalesce(F.sum("_s").over(before), F.expr("0"))).drop("_s")
    inner = W.partitionBy(*group, "_b").orderBy(hash_col, tie).rowsBetween(W.unboundedPreceding, -1)
    joined = df.join(base, [*group, "_b"])
    return joined.withColumn(out, F.col("_base") + F.coalesce(F.sum("_v").over(inner), F.expr("0"))).drop("_b", "_v", "_base")


def ordered_positions(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """Every row with its place, from 1, in the whole order.

    Rows are range-partitioned and sorted; only one row count a partition is
    summed up in one task. Rows equal in ``order`` follow each other in any order.
    """
    # the number of a row is its partition above bit 33 and its place within
    rows = materialise(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "positions")
    rows = rows.withColumn("_p", F.shiftright("_id", 33))
    before = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    base = rows.groupBy("_p").agg(F.count("*").alias("_n")).select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(base), "_p").withColumn(out, F.col("_base") + within + 1).drop("_id", "_p", "_base")

"""Sinks: checked, immutable, merging and partitioned writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.operators.dedupe import keep_first


def finite(df: DataFrame) -> DataFrame:
    """Fails on NaN or infinite doubles; drops transient ``_`` columns."""
    keep = [c for c in df.columns if not c.startswith("_")]
    kinds = dict(df.dtypes)

    def check(c: str):
        bad = F.isnan(c) | (F.abs(c) == float("inf"))
        return F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(f"{c} is not finite")).cast("double")).otherwise(F.col(c)).alias(c)

    return df.select(*[check(c) if kinds[c] == "double" else F.col(c) for c in keep])


def publish(df: DataFrame, path: str) -> None:
    """Write once; an existing target is an error."""
    finite(df).write.mode("errorifexists").parquet(path)


def merge_append(old: DataFrame, new: DataFrame, batch: str, path_col: str = "audio") -> DataFrame:
    """A new batch replaces its earlier rows; then the first row of each path stays."""
    kept = old.join(new.select(batch).distinct(), batch, "left_anti").withColumn("_o", F.lit(0))
    both = kept.unionByName(new.withColumn("_o", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, [path_col], ["_o", batch]).select(*old.columns, *[c for c in new.columns if c not in old.columns])


def write_batches(df: DataFrame, path: str, by: str) -> None:
    """One folder a batch; only the batches in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)

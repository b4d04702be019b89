"""Declarative row filters, multi-label reasons and rejection accounting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_filter(conditions: list[tuple[str, str, object]]) -> Column:
    """Conjunction of ``(column, in | not_in | >= | <=, value)``; null or non-numeric values fail."""
    parts = []
    for name, op, value in conditions:
        c = F.col(name)
        if op == "in":
            p = c.isin(*value)
        elif op == "not_in":
            p = ~c.isin(*value)
        elif op in (">=", "<="):
            n = c.try_cast("double")
            p = ~F.isnan(n) & ((n >= value) if op == ">=" else (n <= value))
        else:
            raise ValueError(f"unknown operator {op}")
        parts.append(F.coalesce(p, F.lit(False)))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def reasons(rules: list[tuple[str, Column]]) -> Column:
    """All rules that a row breaks, as a sorted array."""
    return F.sort_array(F.array_compact(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules])))


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    return F.coalesce(*[F.when(F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules])


def reason_counts(df: DataFrame, reasons_col: str = "reasons") -> DataFrame:
    return df.select(F.explode(reasons_col).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def clip_rules() -> list[tuple[str, Column]]:
    """The quality rules of a delivered clip."""
    text, dur = F.col("text"), F.col("duration")
    return [
        ("text_missing", text.isNull() | (F.trim(text) == "")),
        ("text_encoding", text.contains("�")),
        ("duration_invalid", dur.isNull() | F.isnan(dur) | (dur <= 0)),
        ("duration_range", ~F.isnan(dur) & (dur > 0) & ((dur < 3) | (dur > 30))),
        ("identity_unverified", ~F.coalesce(F.col("speaker_verified"), F.lit(False))),
        ("split_missing", F.col("split").isNull()),
    ]

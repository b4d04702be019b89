"""Exact and near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key: the first in ``order``. Aggregates instead of sorting a key's rows."""
    rest = [c for c in df.columns if c not in keys]
    lead = order + [c for c in rest if c not in order]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*lead), F.struct(*order)).alias("_f"))
    return best.select(*keys, *[F.col("_f")[c].alias(c) for c in lead]).select(*df.columns)


def trigrams(c):
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substring(c, i, 3))


def near_text(rows: DataFrame, protected: DataFrame, min_chars: int = 40, edits: int = 2) -> DataFrame:
    """``id, item, distance``: rows equal to a protected text, or within two edits of one.

    Both sides have ``id/item, lang, norm``. Equality counts at any length; near
    matches need ``min_chars`` characters, a length difference of at most
    ``edits`` and the shared trigrams that so many edits must leave, which are
    counted by an equi-join before any distance is computed.
    """
    exact = rows.join(protected, ["lang", "norm"]).select("id", "item", F.lit(0).alias("distance"))
    b = protected.where(F.length("norm") >= min_chars)
    lengths = b.select("lang", F.explode(F.sequence(F.length("norm") - edits, F.length("norm") + edits)).alias("_n")).distinct()
    a = rows.where(F.length("norm") >= min_chars).withColumn("_n", F.length("norm")).join(lengths, ["lang", "_n"], "left_semi").drop("_n")
    ga = a.select("id", "lang", F.length("norm").alias("la"), F.explode(trigrams(F.col("norm"))).alias("g")).groupBy("id", "lang", "la", "g").agg(F.count("*").alias("na"))
    gb = b.select("item", "lang", F.length("norm").alias("lb"), F.explode(trigrams(F.col("norm"))).alias("g")).groupBy("item", "lang", "lb", "g").agg(F.count("*").alias("nb"))
    pairs = (
        ga.join(gb, ["lang", "g"])
        .where(F.abs(F.col("la") - F.col("lb")) <= edits)
        .groupBy("id", "item", "la", "lb")
        .agg(F.sum(F.least("na", "nb")).alias("common"))
        .where(F.col("common") >= F.greatest("la", "lb") - 2 - 3 * edits)
    )
    near = (
        pairs.join(a.select("id", F.col("norm").alias("x")), "id")
        .join(b.select("item", F.col("norm").alias("y")), "item")
        .withColumn("distance", F.levenshtein("x", "y", edits))
        .where("distance between 1 and " + str(edits))
    )
    return exact.unionByName(near.select("id", "item", "distance"))


"""Operators whose result depends on order within a group, as Arrow functions.

Each group is handled in one task, which is what their semantics ask for; the
groups (a language of a bounded replay set, a recording, a case) are bounded by
their nature, and callers say so by choosing the key.
"""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trim_to_budget(df: DataFrame, group: str, key: str, amount: str, budget: float) -> DataFrame:
    """Rows taken in key order as long as they fit; one that does not fit is skipped, so the budget is never passed.

    Null, NaN and negative amounts are never taken. The rows of a group must fit
    one task.
    """

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key, kind="stable")
        used, keep = 0.0, []
        for v in pdf[amount].tolist():
            fits = v is not None and v >= 0 and used + v <= budget
            used += v if fits else 0.0
            keep.append(fits)
        return pdf[np.array(keep, dtype=bool)]

    return df.groupBy(group).applyInPandas(take, df.schema)


def leader_clusters(df: DataFrame, group: str, key: str, vector: str, threshold: float = 0.6, most: int = 2000) -> DataFrame:
    """Clusters in key order: a row joins the nearest centroid within the cosine threshold, else it starts a new one.

    The mean of the group's vectors is taken off first, and a centroid moves with each row that joins.
    Beyond ``most`` clusters, and without a vector, a row gets no cluster. The
    order decides, so the rows of a group must fit one task.
    """

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key, kind="stable")
        has = [v is not None for v in pdf[vector]]
        out: list[int | None] = [None] * len(pdf)
        if any(has):
            x = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[vector] if v is not None])
            x = x - x.mean(axis=0)
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-8)
            centre, size, n = np.zeros((most, x.shape[1])), np.zeros(most), 0
            for at, v in zip(np.flatnonzero(has), x):
                near = centre[:n] @ v
                best = int(near.argmax()) if n else -1
                if n and near[best] >= threshold:
                    moved = (centre[best] * size[best] + v) / (size[best] + 1)
                    norm = float(np.linalg.norm(moved))
                    centre[best] = moved / norm if norm > 1e-8 else moved
                    size[best] += 1
                    out[at] = best
                elif n < most:
                    centre[n], size[n], out[at] = v, 1, n
                    n += 1
        return pd.DataFrame({group: pdf[group], key: pdf[key], "cluster": pd.array(out, dtype="Int64")})

    fields = {f.name: f for f in df.schema.fields}
    return df.select(group, key, vector).groupBy(group).applyInPandas(cluster, T.StructType([fields[group], fields[key], T.StructField("cluster", T.LongType())]))


def merge_regions(regions: Column, total: Column, gap: float = 0.7, longest: float = 30.0, shortest: float = 3.0, pad: float = 0.15) -> Column:
    """Regions ``struct<start,end>`` padded within ``total`` seconds and joined while the gap and the joined span allow it.

    A longer one is cut, without the sound at 0.65 of ``longest`` again and again;
    what is shorter than ``shortest`` falls out.
    """
    empty = F.array().cast("array<struct<start:double,end:double>>")
    padded = F.transform(F.array_sort(regions), lambda r: F.struct(F.greatest(r["start"] - pad, F.lit(0.0)).alias("start"), F.least(r["end"] + pad, total).alias("end")))

    def step(acc: Column, r: Column) -> Column:
        tail = F.try_element_at(acc, F.lit(-1))  # null before the first region
        fits = F.coalesce((r["start"] - tail["end"] <= gap) & (r["end"] - tail["start"] <= longest), F.lit(False))
        joined = F.struct(tail["start"].alias("start"), r["end"].alias("end"))
        return F.when(fits, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(r)))

    cut = 0.65 * longest

    def parts(r: Column) -> Column:
        span = r["end"] - r["start"]
        n = F.greatest(F.ceil((span - longest) / cut), F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), n), lambda i: F.struct((r["start"] + i * cut).alias("start"), F.when(i == n, r["end"]).otherwise(r["start"] + (i + 1) * cut).alias("end")))

    return F.filter(F.flatten(F.transform(F.aggregate(padded, empty, step), parts)), lambda r: r["end"] - r["start"] >= shortest)


@F.pandas_udf(T.BooleanType())
def is_truncated(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    """Whether a normalised text has under 0.6 of the reference's letters or another end; null if one is null, false without reference."""

    def cut(h: str | None, r: str | None) -> bool | None:
        if h is None or r is None:
            return None
        return bool(r) and (len(h) < 0.6 * len(r) or difflib.SequenceMatcher(None, h[-8:], r[-8:]).ratio() < 0.5)

    return pd.Series([cut(h, r) for h, r in zip(hyp, ref)], dtype="object")


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two texts; null if one is null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def word_error_rate(hyp: pd.Series, ref: pd.Series) -> pd.Series:
    """Edit distance of word lists over the words of the reference; null if one is null."""

    def rate(h: str | None, r: str | None) -> float | None:
        if h is None or r is None:
            return None
        a, b = h.split(), r.split()
        row = np.arange(len(b) + 1)
        for i, x in enumerate(a, 1):
            new = np.minimum(row[1:] + 1, row[:-1] + np.array([x != y for y in b], dtype=int))
            full = np.r_[i, new] - np.arange(len(b) + 1)
            row = np.minimum.accumulate(full) + np.arange(len(b) + 1)
        return float(row[-1]) / max(1, len(b))

    return pd.Series([rate(h, r) for h, r in zip(hyp, ref)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def sign_test(better: pd.Series, trials: pd.Series) -> pd.Series:
    """One-sided P(X >= better), X of ``trials`` fair throws, by exact integers."""
    from weft.operators.reports import sign_p

    return pd.Series([sign_p(int(k), int(n)) for k, n in zip(better, trials)], dtype="float64")

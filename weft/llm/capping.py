"""Capping the records of dominant contributors by radix selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.functions.keys import double_order_key, identity_key
from weft.operators.selection import radix_cutoffs


def beyond_cap(
    clips: DataFrame,
    cap: int = 20,
    contributor: str = "speaker",
    label: str = "emotion",
    score: str = "dnsmos_overall",
    record_id: str = "clip_id",
    share: float | None = None,
) -> DataFrame:
    """Ids of the records beyond the cap of their contributor and label.

    With ``share``, the cap is that part of all records (rounded down, but 1 at
    least) or ``cap``, whichever is smaller.

    Higher scores stay first, null and NaN scores last, then smaller ids.
    Records without contributor are never capped; missing labels form one
    group. Score and id are encoded as order-preserving integers, the cut-off
    of each large group is found digit by digit, and one comparison a record
    decides. An empty table gives no rows; other columns are never read, so
    their names do not matter. Equal ids in one group count one by one, and
    stay or go together at the cut.
    """
    rows = clips.select(
        F.col(record_id).cast("bigint").alias("id"),
        identity_key(F.col(contributor)).alias("who"),
        F.coalesce(identity_key(F.col(label)), F.lit("")).alias("what"),
        double_order_key(F.col(score).cast("double"), descending=True).alias("hi"),
    ).where("who is not null")
    if share is not None:
        cap = min(cap, max(1, int(share * clips.count())))
    cuts = radix_cutoffs(rows.withColumn("q", F.lit(cap).cast("bigint")), ["who", "what"], "q", "hi", "id")
    return (
        rows.join(cuts, ["who", "what"])
        .where("hi > cut_hi or (hi = cut_hi and id > cut_lo)")
        .select(F.col("id").alias(record_id))
    )

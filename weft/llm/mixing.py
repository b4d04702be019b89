"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weft.operators.selection import bucket_bits, running_total
from weft.session import materialise

#: Fractional part of the golden ratio.
GOLDEN = 0.6180339887498949
MAX_PARTS = 100_000


def usable_clips(clips: DataFrame) -> DataFrame:
    """Train clips with a duration above 0, each audio of a source once.

    Of repeated deliveries the earliest (then smallest id) stays; a null audio
    is no repeat of another. Null, NaN and infinite durations are unusable.
    """
    ok = clips.where("split = 'train' and duration > 0 and not isnan(duration) and duration < double('infinity') and source_id is not null")
    first = F.struct("ingested_at", "clip_id", "duration")
    return (
        ok.groupBy(F.col("source_id").alias("id"), F.coalesce(F.col("audio"), F.concat(F.lit("\x00"), F.col("clip_id").cast("string"))).alias("audio"))
        .agg(F.min(first).alias("f"))
        .select("id", F.col("f.clip_id").alias("clip_id"), F.col("f.duration").alias("duration"))
    )


def plan_parts(mix_plan: DataFrame, usable_seconds: DataFrame) -> DataFrame:
    """Each part with its share, budget, wanted and available seconds."""
    parts = mix_plan.where("mix_name is not null and id is not null and weight > 0 and not isnan(weight)").join(usable_seconds, "id", "left").fillna(0.0, ["usable_seconds"])
    mix = W.partitionBy("mix_name")
    return (
        parts.withColumn("target_share", F.col("weight") / F.sum("weight").over(mix))
        .withColumn("budget", F.when(F.max("requested_train_hours").over(mix).isNotNull(), F.max("requested_train_hours").over(mix) * 3600.0).otherwise(F.sum("usable_seconds").over(mix)))
        .withColumn("wanted_seconds", F.col("target_share") * F.col("budget"))
        .withColumn("max_repeat", F.greatest(F.coalesce("max_repeat", F.lit(1)), F.lit(1)))
        .select("mix_name", "id", "target_share", "budget", "wanted_seconds", "usable_seconds", "max_repeat")
    )


class Mix:
    """A schedule of blocks for every mix of a plan.

    Clips of a source are put in hash order and cut into blocks of
    ``block_seconds``. Slot ``t`` of a mix gets the point ``frac((t+1)·φ)``,
    which the cumulative weights of the parts map to a source, so that at any
    length each source has its share of the slots but for a few. The r-th slot
    of a source takes block ``r mod blocks`` in pass ``r div blocks``; a slot
    whose pass reaches ``max_repeat`` stays empty and is not given to others.

    Ranks and running sums go through hash or slot buckets (``running_total``),
    so a source with a third of all clips is never ordered in one task. Parts
    with missing name, source or weight are left out; an empty plan or table
    gives an empty mix.
    """

    def __init__(self, clips: DataFrame, mix_plan: DataFrame, block_seconds: float = 20.0):
        spark = clips.sparkSession
        wanted = mix_plan.select("id").distinct()
        usable = usable_clips(clips).join(wanted, "id", "left_semi")
        usable = materialise(usable.withColumn("h", F.xxhash64(F.lit("mix"), "clip_id")), "mix-usable")
        seconds = usable.groupBy("id").agg(F.sum(F.col("duration").cast("decimal(30,9)")).cast("double").alias("usable_seconds"), F.count("*").alias("n"))
        self.plan = materialise(plan_parts(mix_plan, seconds.select("id", "usable_seconds")), "mix-plan")
        bits = bucket_bits(usable.count())
        blocks = running_total(usable, ["id"], "h", "clip_id", F.col("duration"), bits)
        blocks = materialise(blocks.select("id", F.floor(F.col("before") / block_seconds).cast("bigint").alias("block"), "clip_id", "duration"), "mix-blocks")
        # a long clip may start one block and end in a later one: number the blocks that hold a start
        starts = blocks.select("id", "block").distinct()
        chunk = F.shiftright("block", 13)
        per = starts.groupBy("id", chunk.alias("c")).agg(F.count("*").alias("s"))
        per = per.withColumn("base", F.coalesce(F.sum("s").over(W.partitionBy("id").orderBy("c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("s")
        numbered = starts.withColumn("c", chunk).join(per, ["id", "c"])
        numbered = numbered.withColumn("k", F.col("base") + F.row_number().over(W.partitionBy("id", "c").orderBy("block")) - 1)
        self.blocks = blocks.join(numbered.select("id", "block", "k"), ["id", "block"]).select("id", "k", "clip_id", "duration")
        count = starts.groupBy("id").agg(F.count("*").alias("blocks"))
        mean = seconds.join(count, "id").select("id", "blocks", (F.col("usable_seconds") / F.col("blocks")).alias("block_mean"))
        # slots follow the wanted seconds: weights in slots are seconds wanted over the mean seconds of a block
        parts = self.plan.join(mean, "id").withColumn("slots", F.col("wanted_seconds") / F.col("block_mean"))
        rows = parts.orderBy("mix_name", "id").limit(MAX_PARTS + 1).collect()
        if len(rows) > MAX_PARTS:
            raise ValueError(f"more than {MAX_PARTS} parts")
        mixes: dict[str, list] = {}
        for r in rows:
            mixes.setdefault(r["mix_name"], []).append(r)
        base, lookup = 0, []
        for name, own in mixes.items():
            total = sum(r["slots"] for r in own)
            acc, cum = 0.0, []
            for r in own:
                acc += r["slots"] / total if total else 0.0
                cum.append(acc)
            n = round(total)
            lookup.append((name, base, n, cum, [r["id"] for r in own], [int(r["blocks"]) for r in own], [int(r["max_repeat"]) for r in own]))
            base += n
        table = spark.createDataFrame(lookup, "mix_name string, base long, n long, cum array<double>, ids array<string>, blocks array<long>, repeats array<int>")
        starts_at = [x[1] for x in lookup] or [0]
        slots = spark.range(base).withColumn("m", F.size(F.filter(F.array(*[F.lit(x).cast("bigint") for x in starts_at]), lambda x: x <= F.col("id"))) - 1) if base else spark.range(0).withColumn("m", F.lit(0))
        indexed = table.withColumn("m", F.array_position(F.array(*[F.lit(x).cast("bigint") for x in starts_at]), F.col("base")).cast("int") - 1).where("n > 0")
        slots = slots.withColumnRenamed("id", "g").join(F.broadcast(indexed), "m")  # as many rows as mixes, at most MAX_PARTS
        t = F.col("g") - F.col("base")
        u = ((t + 1) * F.lit(GOLDEN)) % 1.0
        slots = slots.withColumn("t", t).withColumn("i", F.least(F.size(F.filter("cum", lambda c: c <= u)), F.size("ids") - 1))
        slots = slots.select("mix_name", "t", F.col("ids")[F.col("i")].alias("id"), F.col("blocks")[F.col("i")].alias("blocks"), F.col("repeats")[F.col("i")].alias("repeats"))
        # rank of a slot within its source: slots before it, by ranges of slots
        chunk = F.shiftright("t", 13)
        per = slots.groupBy("mix_name", "id", chunk.alias("c")).agg(F.count("*").alias("s"))
        per = per.withColumn("base", F.coalesce(F.sum("s").over(W.partitionBy("mix_name", "id").orderBy("c").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("s")
        ranked = slots.withColumn("c", chunk).join(per, ["mix_name", "id", "c"])
        rank = F.col("base") + F.row_number().over(W.partitionBy("mix_name", "id", "c").orderBy("t")) - 1
        ranked = ranked.withColumn("r", rank)
        self.schedule = ranked.select(
            "mix_name", F.col("t").alias("slot"), "id", (F.col("r") % F.col("blocks")).alias("k"), F.floor(F.col("r") / F.col("blocks")).cast("int").alias("pass"), "repeats"
        )

    def records(self) -> DataFrame:
        """``mix_name, slot, id, clip_id, pass, duration`` of every use of a clip."""
        filled = self.schedule.where("pass < repeats")
        return filled.join(self.blocks, ["id", "k"]).select("mix_name", "slot", "id", "clip_id", "pass", "duration")

    def report(self, sources: DataFrame) -> DataFrame:
        """Target and actual share of each part, with its language and shortfall.

        ``short``: usable seconds times ``max_repeat`` are less than wanted.
        """
        # uses of each block are counted before clips are joined: one row a block and mix
        uses = self.schedule.where("pass < repeats").groupBy("mix_name", "id", "k").agg(F.count("*").alias("uses"))
        sec = self.blocks.groupBy("id", "k").agg(F.sum("duration").alias("sec"), F.count("*").alias("n"))
        got = uses.join(sec, ["id", "k"]).groupBy("mix_name", "id").agg(F.sum(F.col("uses") * F.col("sec")).alias("actual_seconds"), F.sum(F.col("uses") * F.col("n")).alias("clips_used"), F.max("uses").alias("most_uses"))
        langs = sources.select("id", "lang").dropDuplicates(["id"])
        mix = W.partitionBy("mix_name")
        return (
            self.plan.join(got, ["mix_name", "id"], "left")
            .fillna(0.0, ["actual_seconds"])
            .fillna(0, ["clips_used", "most_uses"])
            .join(langs, "id", "left")
            .withColumn("actual_share", F.col("actual_seconds") / F.nullif(F.sum("actual_seconds").over(mix), F.lit(0.0)))
            .withColumn("short", F.col("usable_seconds") * F.col("max_repeat") < F.col("wanted_seconds"))
            .select("mix_name", "id", "lang", "target_share", "actual_share", "wanted_seconds", "usable_seconds", "actual_seconds", "clips_used", "most_uses", "max_repeat", "short")
        )

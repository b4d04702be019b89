"""Filling fixed-capacity containers by minimum bin slack over a histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.operators.selection import bucket_bits, running_total
from weft.session import materialise

#: Largest capacity the planner accepts: its histogram and plan are bounded by it.
MAX_CAPACITY = 1 << 17


def plan_containers(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Patterns that use up a histogram of lengths, and the number of containers.

    Minimum bin slack: the largest length left opens a container; a bitset
    subset-sum over the lengths left, longest first, finds the multiset that
    fills the gap exactly or, failing that, most closely; it is traced back
    through the bitsets and repeated as often as the counts allow. Each pattern
    uses up a length, so there are at most ``capacity`` of them. Returns rows
    ``(length, first rank, last rank + 1, first container, per container)``.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    order = sorted(left, reverse=True)
    rank = dict.fromkeys(left, 0)
    rows, container = [], 0
    while order:
        top = order[0]
        used = {top: 1}
        gap = capacity - top
        if gap:
            reach, steps = 1, []
            mask = (1 << (gap + 1)) - 1
            for n in order:
                if n > gap:
                    continue
                c = min(left[n] - (n == top), gap // n)
                step = 1
                while c > 0:
                    take = min(step, c)
                    steps.append((n, take, reach))
                    reach |= (reach << (n * take)) & mask
                    c -= take
                    step *= 2
                if reach >> gap & 1:
                    break
            at = reach.bit_length() - 1
            for n, take, before in reversed(steps):
                if not before >> at & 1:
                    at -= n * take
                    used[n] = used.get(n, 0) + take
        times = min(left[n] // c for n, c in used.items())
        for n, c in used.items():
            rows.append((n, rank[n], rank[n] + times * c, container, c))
            rank[n] += times * c
            left[n] -= times * c
            if not left[n]:
                del left[n]
        container += times
        order = [n for n in order if n in left] if any(n not in left for n in used) else order
    return rows, container


class Packing:
    """Documents of a token count in containers of each capacity.

    ``sizes``: ``doc_id, tokens``. A document larger than a container is cut
    into full pieces and a rest; no other is cut. Documents of no tokens need
    no container: they come out with piece 0, size 0 and a null container.
    Pieces are only told apart by length, so the plan is made on the driver
    from one histogram a capacity (at most ``capacity`` entries, whatever the
    number of documents) and pieces take the places of their length in hash
    order. The plan is broadcast: its size is bounded by the capacity as well.
    """

    def __init__(self, sizes: DataFrame, capacities: DataFrame):
        spark = sizes.sparkSession
        packs = [(r[0], int(r[1])) for r in capacities.select("pack_name", "capacity").distinct().orderBy("pack_name", "capacity").collect() if r[0] is not None and r[1]]
        for name, cap in packs:
            if not 0 < cap <= MAX_CAPACITY:
                raise ValueError(f"capacity of {name} must be in 1..{MAX_CAPACITY}")
        self.sizes = sizes
        table = F.array(*[F.struct(F.lit(n).alias("pack_name"), F.lit(c).cast("bigint").alias("capacity")) for n, c in packs])
        pieces = sizes.select("doc_id", "tokens", F.explode(table).alias("p")) if packs else sizes.select("doc_id", "tokens", F.lit(None).cast("struct<pack_name:string,capacity:bigint>").alias("p")).where("false")
        cap = F.col("p.capacity")
        full = F.greatest(F.ceil(F.col("tokens") / cap) - 1, F.lit(0)).cast("bigint")
        pieces = pieces.select("doc_id", "tokens", F.col("p.pack_name").alias("pack_name"), cap.alias("capacity"), full.alias("full"))
        # histogram before exploding: full pieces are counted, not listed
        tail = F.col("tokens") - F.col("full") * F.col("capacity")
        hist: dict[str, dict[int, int]] = {n: {} for n, _ in packs}
        for r in pieces.where("tokens > 0").groupBy("pack_name", tail.alias("n")).agg(F.count("*").alias("c"), F.sum("full").alias("f")).collect():
            own = hist[r["pack_name"]]
            own[r["n"]] = own.get(r["n"], 0) + r["c"]
            if r["f"]:
                size = dict(packs)[r["pack_name"]]
                own[size] = own.get(size, 0) + r["f"]
        plan, self.containers, most = [], {}, 1
        for name, size in packs:
            rows, n = plan_containers(hist[name], size)
            self.containers[name] = n
            by: dict[int, list] = {}
            for length, a, b, at, per in rows:
                by.setdefault(length, []).append((a, at, per))
            plan += [(name, length, [x[0] for x in v], [x[1] for x in v], [x[2] for x in v]) for length, v in by.items()]
            most = max([most, *hist[name].values()])
        plan_df = spark.createDataFrame(plan, "pack_name string, size long, starts array<long>, firsts array<long>, per array<int>")
        items = pieces.where("tokens > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full"))))
        items = items.withColumn("size", F.when(F.col("piece") < F.col("full"), F.col("capacity")).otherwise(tail))
        items = items.withColumn("h", F.xxhash64(F.lit("pack"), "doc_id", "piece")).select("pack_name", "doc_id", "piece", "size", "h")
        ranked = running_total(items, ["pack_name", "size"], "h", "doc_id", F.lit(1).cast("bigint"), bucket_bits(most), "rank")
        placed = ranked.join(F.broadcast(plan_df), ["pack_name", "size"])
        i = F.size(F.filter("starts", lambda s: s <= F.col("rank"))) - 1
        placed = placed.withColumn("i", i)
        container = F.col("firsts")[F.col("i")] + F.floor((F.col("rank") - F.col("starts")[F.col("i")]) / F.col("per")[F.col("i")])
        empty = pieces.where("tokens = 0").select("pack_name", "doc_id", F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("size"), F.lit(None).cast("bigint").alias("container_id"))
        self.items = placed.select("pack_name", "doc_id", "piece", "size", container.cast("bigint").alias("container_id")).unionByName(empty)

    def report(self, capacities: DataFrame) -> DataFrame:
        """Containers of each capacity and the share of their room left unused."""
        caps = capacities.select("pack_name", "capacity").distinct()
        used = self.items.where("container_id is not null").groupBy("pack_name", "container_id").agg(F.sum("size").alias("used"), F.count("*").alias("pieces"))
        return (
            used.groupBy("pack_name")
            .agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"), F.sum("pieces").alias("pieces"))
            .join(caps, "pack_name")
            .withColumn("unused_share", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity")), 6))
        )


def pack_documents(docs: DataFrame, capacities: DataFrame, **tokenizer: str) -> Packing:
    """Pack documents by their token counts; counts are made once and kept."""
    from weft.llm.tokens import count_tokens

    return Packing(materialise(count_tokens(docs, **tokenizer), "pack-sizes"), capacities)

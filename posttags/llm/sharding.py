"""Contiguous shards of near-equal size, never splitting a group of equal texts.

Groups stand in the order of their digest. The smallest shard capacity for which a greedy
fill needs no more than the given shards is found by search, and the cuts of that fill are
taken. A group larger than a fair share would force every capacity up to its own size, so
such groups (fewer than the shards) come first in the order, one shard each.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from posttags.llm.common import whole_text
from posttags.session import materialise

# Digest ranges for running sums, and parts of a group for numbering: fixed numbers of cells.
BLOCKS = 4096
CHUNKS = 4096
# Running sums that may be collected to end a search, and capacities tried at once before.
HOLD = 100_000
WIDTH = 64


@dataclass(frozen=True)
class Plan:
    """Where shards begin: ``giants`` by digest, then the rest after each of ``cuts``."""

    giants: list[bytes]
    cuts: list[int]
    capacity: int


def peel(sizes: list[int], total: int, shards: int) -> int:
    """How many of the descending ``sizes`` are at least a fair share of what is left."""
    taken = 0
    while taken < min(len(sizes), shards - 1) and sizes[taken] * (shards - taken) >= total:
        total -= sizes[taken]
        taken += 1
    return taken


def smallest_capacity(
    ends: DataFrame, total: int, largest: int, shards: int, hold: int = HOLD, width: int = WIDTH
) -> tuple[int, list[int]]:
    """The smallest capacity that fills ``shards`` greedily, and the cuts of that fill.

    ``ends`` has ``end_bytes``, the running size at the end of each group. A capacity of the
    mean plus the largest group always suffices. Between two capacities each cut can only lie
    in a band of running sums. While the bands hold more than ``hold`` sums, ``width``
    capacities between the two are tried at once, each step of their fills being one
    aggregate over the sums in reach; then the sums left in the bands are collected and the
    search ends by bisection. Either way the result is exact.
    """
    if not total:
        return 0, []
    end = F.col("end_bytes")
    low = max(largest, -(-total // shards))
    high = low + largest
    bands = [(j * (low - largest), min(j * high, total)) for j in range(1, shards + 1)]
    while True:
        near = end.between(*bands[0])
        for band in bands[1:]:
            near = near | end.between(*band)
        few = ends.where(near).distinct().limit(hold + 1).collect()
        if len(few) <= hold:
            return _bisect(sorted(r.end_bytes for r in few), total, low, high, shards)
        step = max(1, -(-(high - low) // width))
        tries = sorted({*range(low, high, step), high})
        fills = [[0] for _ in tries]
        for _ in range(shards):
            reach = [fill[-1] + size for fill, size in zip(fills, tries)]
            band = ends.where(end.between(min(f[-1] for f in fills) + 1, max(reach)))
            found = band.agg(*[F.max(F.when(end <= r, end)) for r in reach]).first()
            for fill, at in zip(fills, found):
                fill.append(max(fill[-1], at or 0))
        best = next(i for i, fill in enumerate(fills) if fill[-1] == total)
        below = fills[max(best - 1, 0)]
        if best == 0 or tries[best] - tries[best - 1] == 1:
            return tries[best], [cut for cut in fills[best][1:] if cut < total]
        low, high = tries[best - 1] + 1, tries[best]
        bands = list(zip(below[1:], fills[best][1:]))


def _bisect(
    ends: list[int], total: int, low: int, high: int, shards: int
) -> tuple[int, list[int]]:
    def fill(capacity: int) -> list[int]:
        cuts = [0]
        for _ in range(shards):
            place = bisect_right(ends, cuts[-1] + capacity)
            cuts.append(max(cuts[-1], ends[place - 1] if place else 0))
        return cuts[1:]

    while low < high:
        middle = (low + high) // 2
        if fill(middle)[-1] == total:
            high = middle
        else:
            low = middle + 1
    return high, [cut for cut in fill(high) if cut < total]


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Deal all rows into ``shards``, sizes near equal, equal texts together.

    The size of a row is its UTF-8 bytes plus 1. Returns one row per input row: ``doc_id,
    size, text_crc32, law, shard, slot, grown_shard``; ``slot`` numbers the rows of a shard
    from 0, by group and doc_id. ``law`` is "bytes" and ``grown_shard`` null, since adding a
    shard moves rows.

    Null and empty texts are one group. Null doc_ids are numbered like others; rows given
    twice get a slot each. An empty table gives an empty result; with fewer groups than
    shards some shards stay empty. Other columns are not looked at.
    """
    text = whole_text()
    doc_id = F.col("doc_id").cast("long")
    rows = materialise(
        docs.select(
            doc_id.alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.pmod(F.xxhash64(doc_id), F.lit(CHUNKS)).cast("int").alias("chunk"),
        ),
        "shard-rows",
    )
    cells = materialise(
        rows.groupBy("digest", "chunk").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")),
        "shard-cells",
    )
    groups = materialise(cells.groupBy("digest").agg(F.sum("bytes").alias("bytes")), "groups")
    top = groups.orderBy(F.desc("bytes"), "digest").limit(shards).collect()
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    taken = peel([r.bytes for r in top], total, shards)
    giants = [bytes(r.digest) for r in top[:taken]]
    left, rest = total - sum(r.bytes for r in top[:taken]), shards - taken
    placed = materialise(_running_sums(cells, giants), "shard-placed")
    ends = placed.where("block >= 0").select("end_bytes")
    largest = top[taken].bytes if len(top) > taken else 0
    capacity, cuts = smallest_capacity(ends, left, largest, rest)
    plan = Plan(giants, cuts, capacity)
    shard, base = _shard_of(plan), _first_rows(placed, plan)
    within = F.row_number().over(Window.partitionBy("digest", "chunk").orderBy("doc_id"))
    return (
        rows.join(placed, ["digest", "chunk"])
        .withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("first_row") - base + within - 1).cast("long"))
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _running_sums(cells: DataFrame, giants: list[bytes]) -> DataFrame:
    """For each cell the rows before it and the bytes up to the end of its group.

    A cell is a part of a group of equal texts. Sums run within blocks of the digest range;
    block totals (at most BLOCKS rows and the giants) then shift them.
    """
    high = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("long")
    block = F.floor(high * BLOCKS / 65536).cast("int")
    for i, giant in enumerate(giants):
        block = F.when(F.col("digest") == F.lit(giant), F.lit(-1 - i)).otherwise(block)
    order = Window.partitionBy("block").orderBy("digest", "chunk")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cells.withColumn("block", block).select(
        "digest", "chunk", "block",
        (F.sum("n").over(upto) - F.col("n")).alias("_rows"),
        F.col("n").alias("_n"),
        F.sum("bytes").over(upto).alias("_bytes"),
    )
    summed = materialise(
        summed.withColumn("_end", F.max("_bytes").over(Window.partitionBy("block", "digest"))),
        "shard-sums",
    )
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        summed.where("block >= 0")
        .groupBy("block")
        .agg(F.max("_bytes").alias("b"), F.max(F.col("_rows") + F.col("_n")).alias("r"))
        .select(
            "block",
            F.coalesce(F.sum("b").over(before), F.lit(0)).alias("_b"),
            F.coalesce(F.sum("r").over(before), F.lit(0)).alias("_r"),
        )
    )
    zero = F.lit(0)
    return summed.join(F.broadcast(totals), "block", "left").select(
        "digest", "chunk", "block",
        (F.col("_end") + F.coalesce("_b", zero)).alias("end_bytes"),
        (F.col("_rows") + F.coalesce("_r", zero)).alias("first_row"),
        F.col("_n").alias("n"),
    )


def _shard_of(plan: Plan) -> Column:
    passed = F.lit(len(plan.giants))
    for cut in plan.cuts:
        passed = passed + (F.col("end_bytes") > cut).cast("int")
    return F.when(F.col("block") < 0, -1 - F.col("block")).otherwise(passed)


def _first_rows(placed: DataFrame, plan: Plan) -> Column:
    """The number of rows before the row's shard."""
    base = F.lit(0)
    if plan.cuts:
        upto = placed.where("block >= 0").agg(
            *[
                F.max(F.when(F.col("end_bytes") <= cut, F.col("first_row") + F.col("n")))
                for cut in plan.cuts
            ]
        ).first()
        for cut, rows in zip(plan.cuts, upto):
            base = F.when(F.col("end_bytes") > cut, F.lit(rows)).otherwise(base)
    return F.when(F.col("block") < 0, F.lit(0)).otherwise(base)

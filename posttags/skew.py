"""Joins and positions that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from posttags.session import materialise

# A key with this many rows is "hot". At most rows / HOT_ROWS keys can be hot, which
# bounds what lookup() broadcasts: 10^12 rows give at most 10^5 keys.
HOT_ROWS = 10_000_000

MOST_KEYS = 100_000  # keys that ``rows_of_most`` lets through, some 10 MB of them

_SLOT_BITS = 33  # monotonically_increasing_id() keeps the row number in the low 33 bits


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of many ``rows`` with a ``table`` that holds each ``key`` once.

    Keys with at least ``hot_rows`` rows meet their table row through a broadcast and never
    shuffle on the key, so no task receives a whole hot group. All other rows take an
    ordinary equi-join. ``sizes`` (``key, n``) saves the count when it is already known.
    ``rows`` is read up to three times: pass a stage rather than a long plan.
    """
    if sizes is None:
        sizes = rows.groupBy(key).agg(F.count("*").alias("n"))
    hot = sizes.where(F.col("n") >= hot_rows).select(key)
    if hot.isEmpty():
        return rows.join(table, key)
    hot = F.broadcast(materialise(hot, "hot-keys"))
    hot_table = F.broadcast(table.join(hot, key, "left_semi"))
    cold_rows = rows.join(hot, key, "left_anti")
    return rows.join(hot_table, key).unionByName(cold_rows.join(table, key))


def rows_of_most(sizes: DataFrame, most: int = MOST_KEYS) -> int:
    """The least power of two that at most ``most`` keys of ``sizes`` (``key, n``) reach in rows.

    As ``hot_rows`` of ``lookup`` it spares the rows of the most frequent keys their shuffle,
    while what is broadcast stays bounded at any size.
    """
    power = F.floor(F.log2("n")).cast("int").alias("power")
    keys = {r.power: r["count"] for r in sizes.where("n > 0").groupBy(power).count().collect()}
    least = max(keys, default=0) + 1
    while least > 0 and sum(n for power, n in keys.items() if power >= least - 1) <= most:
        least -= 1
    return 1 << least


def zip_with_index(df: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows 0, 1, 2, ... in partition order, as written once to a stage.

    Each partition counts its rows; the running sum of those counts (one row per
    partition) gives the offset added to the place within the partition.
    """
    placed = materialise(df.withColumn("_slot", F.monotonically_increasing_id()), name)
    part = F.shiftright("_slot", _SLOT_BITS)
    within = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + within)
        .drop("_part", "_slot", "_offset")
    )


def with_position(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Number the rows in ``order`` without passing them through one task.

    The sort is range-partitioned, so row numbering stays distributed. ``order`` must be
    total, or the numbering of ties is arbitrary.
    """
    return zip_with_index(df.sort(*order), name)

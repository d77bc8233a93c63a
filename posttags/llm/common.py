"""Column expressions and joins shared by the corpus operators."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# A key holding at least this share of all rows is hot, so there are at most HOT_SHARE of them.
HOT_SHARE = 1000


def whole_text(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Plain ASCII takes the built-in function, which agrees there."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def join_hot(
    rows: DataFrame, table: DataFrame, key: str, size: str, total: int, share: int = HOT_SHARE
) -> DataFrame:
    """Inner join of ``rows`` with a ``table`` holding each key once and its row count ``size``.

    Keys with at least ``total / share`` rows are at most ``share`` in number whatever the
    data, and meet their table row by broadcast; the others take an ordinary join, where no
    key has more than that part of the rows. Both frames are read twice: pass stages.
    """
    hot = table.where(F.col(size) * share >= total)
    cold = table.where(F.col(size) * share < total)
    kept = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(kept.join(cold, key))


def few(column: pa.Array, at_once: int = 256) -> Iterator:
    """The values of an Arrow column as Python objects, not all of them at the same time."""
    for at in range(0, len(column), at_once):
        yield from column.slice(at, at_once).to_pylist()


def lean(
    task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], forget: Callable[[], None] | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task``, giving its memory back when it ends: workers live on and are used by later stages.

    ``forget`` empties what the worker remembers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            if forget:
                forget()
            give_back()

    return run


def give_back() -> None:
    """Return free memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)

"""Unfolding computed lists into rows.

A plain explode of a computed list makes the optimizer filter on the list's size first,
which works the list out again. The outer form plus a check of the unfolded column works
it out once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def unfold(df: DataFrame, items: Column, name: str, *keep: Column | str) -> DataFrame:
    """``keep`` columns and one row per item; lists hold no NULLs."""
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def unfold_numbered(
    df: DataFrame, items: Column, place: str, name: str, *keep: Column | str
) -> DataFrame:
    """Like ``unfold`` with the place of the item, from 0."""
    return df.select(*keep, F.posexplode_outer(items).alias(place, name)).where(
        F.col(place).isNotNull()
    )


def hold(df: DataFrame, value: Column, name: str, *keep: Column | str) -> DataFrame:
    """Adds a computed column that later lambdas can refer to without working it out again."""
    return df.select(*keep, F.explode_outer(F.array(value)).alias(name))

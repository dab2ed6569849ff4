"""Key matching shared by resolution and upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PREFIX = "_match_"


def null_safe_condition(columns: Sequence[str]) -> Column:
    """``left.k <=> right.k`` for every key; the right side carries prefixed names.

    Spark plans ``<=>`` on every key as an equi-join (null becomes its own key value),
    so the match is a hash or sort-merge join, never a nested loop.
    """
    return reduce(lambda a, b: a & b, (F.col(f"`{c}`").eqNullSafe(F.col(f"`{_PREFIX}{c}`")) for c in columns))


def match_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The key columns of ``df`` renamed for :func:`null_safe_condition`."""
    return df.select(*(F.col(f"`{c}`").alias(f"{_PREFIX}{c}") for c in columns))


def semi_join(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key has a null-safe match in ``right``."""
    return left.join(match_keys(right, columns), null_safe_condition(columns), "left_semi")


def anti_join(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key has no null-safe match in ``right``."""
    return left.join(match_keys(right, columns), null_safe_condition(columns), "left_anti")

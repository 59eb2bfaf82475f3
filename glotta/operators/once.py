"""Use a computed column without computing it twice.

Catalyst pushes a filter below the projection that computes its column, and adds
a ``size > 0`` filter below ``explode``. For a cheap column that is right; for a
chain of regexes over whole documents it repeats the work of the chain. These
helpers express the same row selection through a generator, which the optimizer
cannot move below the column's definition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_computed(df: DataFrame, column: str, condition: Callable[[Column], Column]) -> DataFrame:
    """Rows for which ``condition(column)`` is true; the column is evaluated once per row."""
    return df.withColumn(column, F.explode(F.filter(F.array(column), condition)))


def explode_tokens(df: DataFrame, keep: list[str], tokens: str, out: str = "token") -> DataFrame:
    """``keep`` plus one row per element. Elements are never NULL in token arrays."""
    return df.select(*keep, F.explode_outer(tokens).alias(out)).filter(F.col(out).isNotNull())

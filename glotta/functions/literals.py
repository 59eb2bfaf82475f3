"""Constant arrays, maps and tables, built in one call each.

``F.array(*[F.lit(w) ...])`` crosses from Python to the JVM once per word; a few
hundred words cost more than the query. One SQL expression is parsed in one go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_array(words) -> Column:
    return F.expr(f"cast(array({', '.join(map(sql_string, words))}) as array<string>)")


def literal_map(pairs: dict[str, str]) -> Column:
    cells = [f"{sql_string(k)}, {sql_string(v)}" for k, v in pairs.items()]
    return F.expr(f"cast(map({', '.join(cells)}) as map<string, string>)")


def literal_table(spark: SparkSession, columns: list[str], rows) -> DataFrame:
    """A table of strings that the optimizer sees as local rows: reading it needs no job."""
    values = ", ".join("(" + ", ".join(map(sql_string, row)) + ")" for row in rows)
    return spark.sql(f"select * from values {values} as t({', '.join(columns)})")

"""All queries over the supplied tables and the DuckDB SQL that checks them.

Results are rounded to six decimals on both sides, as sums over shuffles differ in the last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import file_queries, matrix_queries, statistic_queries, table_queries

_ALL: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = matrix_queries.QUERIES | statistic_queries.QUERIES | table_queries.QUERIES | file_queries.QUERIES


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f if name in matrix_queries.ROUNDED else (lambda spark, sf_dir, f=f: rounded(f(spark, sf_dir))) for name, (f, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}

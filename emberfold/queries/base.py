"""Registry of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is looked up once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def sql_text(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return repr(value)


def sql_values(rows: Sequence[tuple], alias: str, columns: Sequence[str]) -> str:
    """``(VALUES ...) AS alias(columns)``."""
    body = ", ".join("(" + ", ".join(sql_text(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(columns)})"


def sql_decode(column: str, labels: dict[int, str]) -> str:
    branches = " ".join(f"WHEN {k} THEN {sql_text(v)}" for k, v in labels.items())
    return f"CASE {column} {branches} ELSE CAST({column} AS VARCHAR) END"


def amount(name: str) -> Column:
    """A two-decimal amount in whole cents, so that sums are exact in any order."""
    return F.floor(F.col(name) * 100 + 0.5)


def from_cents(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n) / 100.0 for n in names})


def sql_money(expr: str) -> str:
    return f"CAST(SUM(CAST(floor({expr} * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0"

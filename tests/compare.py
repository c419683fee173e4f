"""Compare a query with its SQL on DuckDB: columns, types, rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}") + 0.0
    return v


def _rows(arrow, names):
    columns = [arrow.column(n).to_pylist() for n in names]
    return Counter(zip(*[[_cell(v) for v in c] for c in columns]))


def differences(spark_arrow, duck_arrow) -> list[str]:
    names = sorted(spark_arrow.column_names)
    if names != sorted(duck_arrow.column_names):
        return [f"columns {names} != {sorted(duck_arrow.column_names)}"]
    found = []
    for n in names:
        a, b = str(spark_arrow.schema.field(n).type), str(duck_arrow.schema.field(n).type)
        norm = lambda t: t.replace("large_string", "string").replace("timestamp[us, tz=UTC]", "timestamp[us]")
        if norm(a) != norm(b):
            found.append(f"type of {n}: {a} != {b}")
    if spark_arrow.num_rows != duck_arrow.num_rows:
        found.append(f"rows {spark_arrow.num_rows} != {duck_arrow.num_rows}")
    left, right = _rows(spark_arrow, names), _rows(duck_arrow, names)
    if left != right:
        found.append(f"{names}: spark only {list((left - right).items())[:4]}; "
                     f"sql only {list((right - left).items())[:4]} "
                     f"({sum((left - right).values())} rows)")
    return found

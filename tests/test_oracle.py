"""Every registered query against its SQL, and what no plan may hold."""

import pytest

import __spark_entry__ as entry
from emberfold.queries import ORACLES, QUERIES
from compare import connect, differences


MODELS = {"m1_regression", "m5_vector_classifier", "a14_csv_training", "m4_stream_scoring"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    if name not in MODELS:
        plan = df._jdf.queryExecution().toString()
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin", "Window ["):
            assert bad not in plan
    rows = df.toArrow()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows.num_rows > 0
    else:
        assert differences(rows, con.sql(sql).to_arrow_table()) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "year", "events", "total"] and df.count() > 0


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)

"""Whitening against exact fractions."""

import math
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from conftest import *  # noqa: F401,F403
from hypothesis import given, settings, strategies as st

from emberfold.llm.queries import QUERIES
from emberfold.llm.whitening import centres, covariances, square_sums, whiten, _packed

SCHEMA = "vec_id bigint, embedding array<double>"


def plain(rows, components=4):
    """Per length of vectors: rows, distinct x, n, S, covariance in fractions."""
    groups = defaultdict(list)
    for name, vector in rows:
        if vector and all(c is not None and math.isfinite(c) for c in vector):
            x = tuple(max(min(math.floor(256 * Fraction(c)), 2 ** 63 - 1), -2 ** 63) for c in vector)
            groups[len(vector)].append((name, x))
    out = {}
    for size, own in groups.items():
        fit = sorted({x for _, x in own})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = [[Fraction(c) - Fraction(s, n) for c, s in zip(x, sums)] for x in fit]
        cov = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(size)] for i in range(size)])
        out[size] = own, n, sums, cov
    return out


def check(got, rows, components=4):
    by = defaultdict(list)
    for r in got:
        by[r["vec_id"]].append(r)
    total = 0
    for size, (own, n, sums, cov) in plain(rows).items():
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        keep = [k for k in range(min(components, size)) if values[k] > values[0] * size * 2.3e-16 and values[0] > 0]
        total += len(own) * len(keep)
        signs = {}
        for name, x in own:
            deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
            deviation = deviation if deviation < 10 ** 38 else None  # more than a decimal holds
            for k in keep:
                want = float(np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)]) @ vectors[:, k]
                             / np.sqrt(values[k]))
                same = [r for r in by[name] if r["component"] == k + 1 and r["n"] == n and r["deviation"] == deviation]
                assert same, (name, k)
                assert min(abs(abs(r["whitened"]) - abs(want)) for r in same) < 1e-6
                if abs(want) > 1e-3 and len(by[name]) == len(keep):
                    assert signs.setdefault(k, np.sign(want * same[0]["whitened"])) == np.sign(want * same[0]["whitened"])
                assert abs(same[0]["explained"] / (values[k] / np.trace(cov)) - 1) < 1e-9
                assert same[0]["identity_error"] < 1e-9
    assert len(got) == total


def test_query_equals_plain_version(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    got = QUERIES["op12_whitening"](spark, sf_dir)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check(got.collect(), [(r[0], r[1]) for r in df.collect()])


def odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 0.5]), (1, [2.0, 1.0, -0.0]), (2, None), (3, []), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]),
            (6, [None, 1.0, 1.0]), (7, [1.0, 2.0, 0.5]), (7, [1.0, 2.0, 0.5]), (8, [-1.0, -2.0, 3.5]), (9, [0.1, 0.2, 0.3]),
            (None, [0.7, 0.9, 1.1]), (10, [1.0, 2.0]), (11, [2.0, 1.5]), (12, [0.0, 0.001]), (13, [4.0]),
            (14, [1.001, 2.001, 0.501])]
    return rows, spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA + ", size int, packed string")


def test_odd_vectors(spark):
    rows, df = odd(spark)
    got = whiten(df.repartition(3)).collect()
    check(got, rows)
    assert not {r["vec_id"] for r in got} & {2, 3, 4, 5, 6, 13}
    assert sum(r["vec_id"] == 7 and r["component"] == 1 for r in got) == 2
    assert whiten(df.limit(0)).collect() == [] and whiten(df.where("vec_id = 7")).collect() == []


@pytest.mark.parametrize("size", [1e6, 1e12, 1e16, 1e300])
def test_large_entries_stay_exact(spark, size):
    rng = np.random.default_rng(3)
    rows = [(k, (rng.standard_normal(5) * size).tolist()) for k in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = whiten(df.repartition(4), components=2)
    if size < 1e300:
        check(got.collect(), rows, 2)
    else:  # entries at the ends of a long; what has over 38 digits is NULL
        assert got.count() == 120 and all(r["deviation"] is None or isinstance(r["deviation"], Decimal) for r in got.collect())


def test_covariance_comes_from_squares_alone(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-300, 300, (500, 6))
    fit = spark.createDataFrame([(k, (v / 256).tolist()) for k, v in enumerate(x)], "id bigint, vector array<double>")
    fit = fit.mapInArrow(lambda b: _packed(b, 256.0), "id bigint, size int, packed binary").select("size", "packed")
    around = centres(fit.repartition(3))
    assert around[6].n == 500 and around[6].sums == tuple(x.sum(axis=0).tolist())
    assert np.allclose(covariances(fit, around)[6], np.cov(x.T, bias=True), rtol=1e-12, atol=0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-2 ** 61, 2 ** 61), min_size=3, max_size=3), min_size=1, max_size=30),
       st.sampled_from([0, 20, 40]))
def test_square_sums(rows, shift):
    v = np.array(rows, np.int64) >> shift
    most = int(np.abs(v).max())
    for axis in (0, 1):
        want = (v.astype(object) ** 2).sum(axis=axis).tolist()
        assert square_sums(v, most, axis).tolist() == want

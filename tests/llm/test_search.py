"""Vector searches and n-gram scores against plain versions."""

import heapq
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from conftest import *  # noqa: F401,F403

from emberfold.llm.multi_index import code_words, nearest, packs_of, traverse
from emberfold.llm.ngrams import score_documents
from emberfold.llm.pivots import highest_products
from emberfold.llm.queries import ORACLES, QUERIES

ASK = "id % 50 = 0"
BIG = "/root/testdata/sf0.1"


def vectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)


def plain_products(ids, ints, asks, k=5):
    out = []
    for q in asks:
        s = ints @ ints[q]
        order = sorted((-int(s[x]), int(ids[x])) for x in range(len(ids)) if ids[x] != ids[q])[:k]
        out += [(int(ids[q]), r + 1, i, -n) for r, (n, i) in enumerate(order)]
    return Counter(out)


@pytest.mark.parametrize("where", [None, BIG])
def test_products_query(spark, sf_dir, where):
    ids, values = vectors(spark, where or sf_dir)
    ints = np.floor(256 * values).astype(np.int64)
    got = Counter(tuple(r) for r in QUERIES["op10_pivot_search"](spark, where or sf_dir).collect())
    assert got == plain_products(ids, ints, np.flatnonzero(ids % 50 == 0))


def test_products_stop_early(spark):
    """Clustered vectors, small annuli: the bounds have something to stop."""
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((6, 8)) * 4
    values = centres[rng.integers(0, 6, 900)] + rng.standard_normal((900, 8)) * 0.05
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(values)], "vec_id bigint, embedding array<double>")
    got = highest_products(df, ASK, k=3, pivots=6, block_rows=16, first_annuli=2).collect()
    ints = np.floor(256 * values).astype(np.int64)
    assert Counter(tuple(r) for r in got) == plain_products(
        np.arange(900), ints, range(0, 900, 50), 3)


def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]),
            (5, [None, 1.0]), (6, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [-1.0, -2.0]), (9, []), (10, [1.0, 2.0, 3.0]),
            (None, [1.0, 2.0]), (100, None), (150, [0.0, 0.0]), (7, [3.0, 1.0])]
    return spark.createDataFrame([(i, v, None, None) for i, v in rows],
                                 "vec_id bigint, embedding array<double>, score string, query_id string")


def test_odd_vectors(spark):
    """Lengths meet their own: 10 has three entries and is no query; 200 and 11 have one."""
    more = spark.createDataFrame([(200, [2.0]), (11, [-3.0]), (12, [1.5])], "vec_id bigint, embedding array<double>")
    df = odd_vectors(spark).unionByName(more, allowMissingColumns=True)
    got = [tuple(r) for r in highest_products(df, ASK, k=50).collect()]
    part = {0: [256, 512], 50: [512, 256], 2: [0, 0], 6: [256, 512], 8: [-256, -512], 150: [0, 0]}
    rows = [*part.items(), (7, [256, 512]), (7, [768, 256])]
    for q in (0, 50, 150):
        want = sorted((-(part[q][0] * v[0] + part[q][1] * v[1]), i) for i, v in rows if i != q)
        assert sorted((r[1], r[2], r[3]) for r in got if r[0] == q) == [
            (n + 1, i, -s) for n, (s, i) in enumerate(want)]
    assert sorted(r[1:] for r in got if r[0] == 200) == [(1, 12, 512 * 384), (2, 11, -512 * 768)]
    assert {r[0] for r in got} == {0, 50, 150, 200}
    near = [tuple(r) for r in nearest(df, ASK, k=50, share=1.0).collect()]
    assert {r[0] for r in near} == {0, 50, 200}
    assert [r[2] for r in sorted(r for r in near if r[0] == 0)] == [6, 7, 50, 7, 8]
    assert [r[2:] for r in sorted(r for r in near if r[0] == 200)] == [(12, 1.0), (11, -1.0)]


@pytest.mark.parametrize("sizes", [[1e7], [1.0, 1e7], [1.0, 1e12], [1e-3, 1.0, 1e17], [1.0, 1e200]])
def test_products_of_any_size_are_exact(spark, sizes):
    """Ordinary vectors and a few large ones, beyond doubles, beyond longs and beyond decimals."""
    rng = np.random.default_rng(len(sizes))
    values = rng.standard_normal((240, 6)) * np.array(sizes)[rng.integers(0, len(sizes), 240)][:, None]
    values[100] = values[101]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(values)], "vec_id bigint, embedding array<double>")
    got = highest_products(df.repartition(3), ASK, k=4, pivots=5, block_rows=16, first_annuli=2, query_rows=3, page_annuli=7)
    whole = [[math.floor(256 * x) for x in v] for v in values.tolist()]
    want = {}
    for q in range(0, 240, 50):
        found = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in enumerate(whole) if i != q)[:4]
        want |= {(q, n + 1): (i, -s if abs(s) < 10 ** 38 else None) for n, (s, i) in enumerate(found)}
    assert {(r[0], r[1]): (r[2], r[3]) for r in got.collect()} == want
    assert dict(got.dtypes)["score"] == ("bigint" if max(sizes) < 1e6 else "decimal(38,0)") or max(sizes) == 1e7


def test_whole_numbers_order_as_bytes():
    from emberfold.llm.pivots import _ordered
    values = [0, 1, -1, 255, 256, -255, -256, -257, 2 ** 70, -2 ** 70, 2 ** 70 + 1, 10 ** 300, -10 ** 300, 65535, -65536]
    assert [v for _, v in sorted((_ordered(v), v) for v in values)] == sorted(values)


def test_bounds_hold():
    from emberfold.llm import pivots
    rng = np.random.default_rng(2)
    x = np.floor(rng.standard_normal((300, 5)) * 256)
    shell = np.frexp(np.linalg.norm(x, axis=1))[1]
    centres = pivots.kmeans(pivots._extended(x, shell), 8)
    far = pivots._away(pivots._extended(x, shell), centres)
    page = {"near": far, "far": far, "shell": shell, "block": np.arange(300)}  # each vector an annulus
    upper, slack = pivots.bounds(x[:40], shell[:40], page, centres)
    assert (x[:40] @ x.T <= upper + slack).all() and (upper < np.linalg.norm(x[:40], axis=1)[:, None] * 2.0 ** shell).any()


def test_copies_have_equal_scores(spark):
    """Four copies of each vector, in any blocks: ties go to the smaller id."""
    rng = np.random.default_rng(7)
    base = rng.standard_normal((300, 16)).astype(np.float32).astype(float)
    rows = [(k, base[k % 300].tolist()) for k in range(1200)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    got = nearest(df, ASK, k=3, share=1.0, pack_rows=37, query_rows=7).collect()
    by = defaultdict(list)
    for r in sorted(got):
        by[r["query_id"]].append(r)
    for q, found in by.items():
        assert [r["id"] for r in found] == [i for i in range(q % 300, 1200, 300) if i != q]
        assert len({r["score"] for r in found}) == 1
    assert len(by) == 24


def test_packs_hold_cells():
    pack, parts = packs_of(np.array([3, 0, 4, 9, 25, 1, 0]), 10)
    assert pack.tolist() == [0, 0, 0, 1, 2, 3, 3] and parts.tolist() == [1, 1, 3, 1]
    assert [code_words(n) for n in (0, 2_000, 51_000, 10 ** 7, 10 ** 10)] == [32, 32, 32, 198, 512]


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<double>")
    assert nearest(none, ASK).count() == 0 and highest_products(none, ASK).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.5]), (1, [0.5, 1.0])], "vec_id bigint, embedding array<double>")
    assert nearest(few, ASK).count() == 1 and highest_products(few, ASK).count() == 1


@pytest.mark.parametrize("where", [None, BIG])
def test_recall(spark, sf_dir, where):
    ids, values = vectors(spark, where or sf_dir)
    unit = values / np.linalg.norm(values, axis=1)[:, None]
    got = defaultdict(list)
    for r in sorted(QUERIES["op8_multi_index"](spark, where or sf_dir).collect()):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[q]
        s[q] = -2
        best = ids[np.argsort(-s, kind="stable")[:5]]
        found = got.pop(int(ids[q]))
        assert len(found) == min(5, len(ids) - 1)
        assert all(abs(v - s[np.flatnonzero(ids == i)[0]]) < 1e-12 for i, v in found)
        assert [v for _, v in found] == sorted([v for _, v in found], reverse=True)
        hits += len(set(best.tolist()) & {i for i, _ in found})
        total += len(best)
    assert not got and hits / total >= 0.9


def test_cells_come_by_summed_distance():
    rng = np.random.default_rng(0)
    left, right = rng.random(6), rng.random(5)
    held = rng.integers(0, 4, 30)
    cells = traverse(left, right, held, 1000)
    cost = [left[c // 5] + right[c % 5] for c in cells]
    assert cost == sorted(cost) and sorted(cells) == np.flatnonzero(held).tolist()


def heap_cells(left, right, held, wanted):
    """Cells by growing sums, one at a time."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, seen, cells, count = [(left[a[0]] + right[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and count < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(right) + int(b[j])
        if held[cell]:
            cells.append(cell)
            count += int(held[cell])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (left[a[x]] + right[b[y]], x, y))
    return cells


def test_cells_come_as_from_a_heap():
    """Also where many sums are equal."""
    rng = np.random.default_rng(3)
    for top in (2, 5, 10 ** 9):
        left, right = rng.integers(0, top, 9) / 4, rng.integers(0, top, 7) / 4
        held = rng.integers(0, 3, 63)
        for wanted in (1, 5, 30, 1000):
            assert list(traverse(left, right, held, wanted)) == heap_cells(left, right, held, wanted)


def odd_copies(same_ids):
    """Ids and vectors: a vector with very many copies, some of them queries, close ones, perhaps ids that come often."""
    rng = np.random.default_rng(11)
    values = rng.standard_normal((700, 12)).astype(np.float32).astype(float)
    values[rng.random(700) < 0.3] = values[0]
    values[300:340] = values[300] + rng.standard_normal((40, 12)) * 1e-9
    values[400:420] = values[0] * 3
    ids = np.arange(700)
    if same_ids:
        ids[ids % 7 == 3] = 50
        ids[600:620] = 100
    return ids, values


@pytest.mark.parametrize("share,sizes", [(0.3, {}), (1.0, {}), (0.3, {"pack_rows": 60, "query_rows": 5}),
                                         (1.0, {"pack_rows": 23, "query_rows": 2})])
def test_nearest_equals_plain(spark, share, sizes, monkeypatch):
    import emberfold.llm.multi_index as mi
    if sizes:
        monkeypatch.setattr(mi, "STEP_ROWS", 9)
        monkeypatch.setattr(mi, "PENDING", 40)
    # the order of rows that share an id, and so the sample, is open; it is of no matter where all cells are visited
    ids, values = odd_copies(same_ids=share == 1)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, values)], "vec_id bigint, embedding array<double>")
    got = nearest(df.repartition(3), ASK, k=4, share=share, sample=700, **sizes).collect()
    drawn = df.selectExpr("*", "xxhash64(vec_id) h").orderBy("h", "vec_id").collect()
    points, unit = mi.unit_rows(np.array([r["embedding"] for r in drawn])), mi.unit_rows(values)
    a, b = mi.kmeans(points[:, :6], 32), mi.kmeans(points[:, 6:], 32)
    left, right = mi.distances(unit[:, :6], a), mi.distances(unit[:, 6:], b)
    cells = left.argmin(axis=1) * len(b) + right.argmin(axis=1)
    held = np.bincount(cells, minlength=len(a) * len(b))
    want = Counter()
    for q in np.flatnonzero(ids % 50 == 0):
        seen = heap_cells(left[q], right[q], held, max(5, math.ceil(share * len(ids))))
        own = np.flatnonzero(np.isin(cells, seen) & (ids != ids[q]))
        score = mi.cosines(values[q][None], values[own])
        best = np.lexsort((ids[own], -score))[:4]
        want.update((int(ids[q]), n + 1, int(ids[own[j]]), score[j]) for n, j in enumerate(best))
    assert Counter(tuple(r) for r in got) == want


def test_visits_are_not_broadcast(spark):
    """What queries send to packs grows with queries times packs, whatever the planner makes of it: never by the driver."""
    df = spark.createDataFrame([(k, [float(k % 7), 1.0]) for k in range(300)], "vec_id bigint, embedding array<double>")
    found = nearest(df, ASK)
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_scores_equal_sql(spark, sf_dir):
    got = QUERIES["op9_backoff_scores"](spark, sf_dir).toArrow()
    assert differences(got, connect(sf_dir).sql(ORACLES["op9_backoff_scores"]).to_arrow_table()) == []


def plain_scores(texts):
    words = [(t or "").encode().split() for t in texts]
    uni = Counter(w for ws in words for w in ws)
    bi = Counter(p for ws in words for p in zip(ws, ws[1:]))
    n = sum(uni.values())
    for ws in words:
        back, total = 0, 0.0
        for k, w in enumerate(ws):
            if k and bi[ws[k - 1], w] >= 2:
                total += math.log(bi[ws[k - 1], w] / uni[ws[k - 1]])
            else:
                back += k > 0
                total += math.log(uni[w] / n) + (math.log(0.4) if k else 0)
        yield len(ws), back, total


@pytest.mark.parametrize("bytes_", [8 << 20, 20_000])
def test_scores_odd_rows(spark, odd, empty, bytes_, monkeypatch):
    import emberfold.llm.ngrams as ngrams
    monkeypatch.setattr(ngrams, "CHUNK_BYTES", bytes_)
    monkeypatch.setattr(ngrams, "RANGE_BYTES", bytes_)
    rows = odd.collect()
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], n, b, round(s, 4))
                  for r, (n, b, s) in zip(rows, plain_scores([r["text"] for r in rows])))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_backoff"], r["logp"])
                 for r in score_documents(odd).collect())
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-3 for g, w in zip(got, want))
    assert score_documents(empty).count() == 0


def test_an_input_that_changes_is_noticed(spark):
    """Rows that differ between the two reads fail the job and give no wrong scores."""
    def change(batches):
        import os
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([os.urandom(4).hex() for _ in range(b.num_rows)])], names=["doc_id", "text"])

    df = spark.range(200).withColumnRenamed("id", "doc_id").mapInArrow(change, "doc_id bigint, text string")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        with pytest.raises(Exception, match="store it first"):
            score_documents(df).collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")

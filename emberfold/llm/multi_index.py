"""Approximate nearest neighbours with an inverted multi-index."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberfold.llm.vectors import lengths_of, matrix, query_groups, rows_of, usable_vectors
from emberfold.llm.worker import small_batches
from emberfold.storage import materialize

# The quantisers are fitted on this many vectors, drawn by a hash of their id.
SAMPLE = 8_192
# Centroids of each half: at least, at most, and the rows a cell should hold.
CENTROIDS, MOST_CENTROIDS, CELL_ROWS = 32, 512, 256
# A pack holds as many rows as there are queries, but so many at least and so many bytes of vectors at most.
PACK_ROWS, PACK_BYTES = 4_096, 80 << 20
# Queries that meet a pack at a time: rows and bytes of vectors at most.
ASK_ROWS, ASK_BYTES = 2_048, 4 << 20
# Rows compared with such queries in one product.
STEP_ROWS = 1_024
# Pairs that wait for their exact cosine, at most.
PENDING = 1 << 20
# Rounding of summed distances to centroids.
_ROUGH = 1e-9


def kmeans(points: np.ndarray, k: int, rounds: int = 15, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(points))
    centres = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        own = distances(points, centres).argmin(axis=1)
        held = np.bincount(own, minlength=k)
        sums = np.stack([np.bincount(own, points[:, d], k) for d in range(points.shape[1])], axis=1)
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return ((points ** 2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(axis=1)[None, :])


def traverse(left: np.ndarray, right: np.ndarray, held: np.ndarray, wanted: int) -> np.ndarray:
    """Cells (``i * len(right) + j``) by growing ``left[i] + right[j]`` until they hold ``wanted`` rows.

    Ties go by the places of ``i`` and ``j`` among the nearest. Sorted at once and not grown by a heap, as a query
    reads a good part of all cells.
    """
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    cells = (a[:, None] * len(right) + b).ravel()
    full = np.flatnonzero(held[cells])
    cells, sums = cells[full], (left[a][:, None] + right[b]).ravel()[full]
    order = np.argsort(sums)
    if (np.diff(sums[order]) == 0).any():
        order = np.argsort(sums, kind="stable")
    cells = cells[order]
    return cells[:np.searchsorted(np.cumsum(held[cells]), wanted) + 1]


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=1))


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines of queries with the vectors beside them, each summed in the same order wherever its vector lies."""
    return (vectors * queries).sum(axis=1) / (_norms(queries) * _norms(vectors))


def packs_of(held: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each cell's pack, and each pack's parts: neighbouring cells share a pack of ``size`` rows at most, and a
    cell with more has a pack for itself that is dealt to parts."""
    pack, parts, filled = np.zeros(len(held), np.int64), [0], 0
    for cell, n in enumerate(held.tolist()):
        if n and filled and filled + n > size:
            parts.append(0)
            filled = 0
        filled += n
        pack[cell] = len(parts) - 1
        parts[-1] = max(1, -(-filled // size))
    return pack, np.maximum(parts, 1)


def code_words(n: int, least: int = CENTROIDS, most: int = MOST_CENTROIDS) -> int:
    """Centroids of each half, so that a cell holds some ``CELL_ROWS`` of ``n`` rows."""
    return int(min(most, max(least, round((n / CELL_ROWS) ** 0.5))))


def nearest(df: DataFrame, queries: str, k: int = 5, share: float = 0.5, id_col: str = "vec_id",
            vector_col: str = "embedding", centroids: int | None = None, sample: int = SAMPLE,
            pack_rows: int | None = None, query_rows: int | None = None) -> DataFrame:
    """``query_id, rank, id, score``: near neighbours by cosine, reranked on the vectors.

    ``queries`` is a condition on ``id``. Each half of the unit vectors is quantised on its own, by as many centroids as the
    counted rows ask for; a cell is a pair of centroids. A query visits cells by growing sum of its distances to both
    centroids until they hold ``share`` of all rows (and more than ``k``), and the rows of these cells are compared
    exactly. Cells lie in packs, and a group of queries meets a pack once. Packs and groups are sized by the counted queries
    unless ``pack_rows`` and ``query_rows`` are given. Nothing is broadcast, and the driver gets a sample and one count per cell.

    Vectors that are NULL, empty or all zero or hold NULL or non-finite values take no part, nor do those without an id.
    Vectors meet those of their own length, each length being indexed for itself. Rows that share an id are separate
    candidates, but no neighbours of each other, and separate queries. Ties go to the smaller id, and equal vectors have
    equal scores. With ``k`` candidates or fewer all are returned; no usable row gives none.
    """
    rows = usable_vectors(small_batches(df), id_col, vector_col).where(F.exists("vector", lambda x: x != 0))
    # single-precision input is packed as it is
    kind = "<f4" if "float" in dict(df.dtypes)[vector_col] else "<f8"
    found = [_nearest_of_length(rows.where(F.size("vector") == n), n, kind, queries, k, share, centroids, sample,
                                pack_rows, query_rows) for n in lengths_of(rows)]
    if not found:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    return reduce(DataFrame.unionByName, found)


def _nearest_of_length(rows: DataFrame, width: int, kind: str, queries: str, k: int, share: float,
                       centroids: int | None, sample: int, pack_rows: int | None, query_rows: int | None) -> DataFrame:
    words = code_words(rows.count()) if centroids is None else centroids
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(max(sample, 32 * words)).select("vector").toArrow()
    points = unit_rows(matrix(drawn["vector"].combine_chunks()))
    cut = max(1, width // 2)
    halves = [kmeans(points[:, :cut], words)]
    halves.append(kmeans(points[:, cut:], words) if width > 1 else np.zeros((1, 0)))
    columns = len(halves[1])

    def assign(batches):
        name = TaskContext.get().partitionId() << 33
        for batch in batches:
            vectors = matrix(batch.column("vector"))
            if not len(vectors):
                continue
            unit = unit_rows(vectors)
            cell = (distances(unit[:, :cut], halves[0]).argmin(axis=1) * columns
                    + distances(unit[:, cut:], halves[1]).argmin(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(name, name + len(cell))), batch.column("id"), pa.array(cell.astype(np.int32)),
                 rows_of(vectors, kind)], names=["row", "id", "cell", "vector"])
            name += len(cell)

    index = materialize(rows.mapInArrow(assign, "row bigint, id bigint, cell int, vector binary"), "multi-index")
    # one row per cell that holds any: centroids squared at most
    held = np.zeros(len(halves[0]) * columns, np.int64)
    for r in index.groupBy("cell").count().collect():
        held[r["cell"]] = r["count"]
    wanted = max(k + 1, int(np.ceil(share * held.sum())))
    row_bytes = width * np.dtype(kind).itemsize
    asks = query_groups(index.where(queries), query_rows or max(1, min(ASK_ROWS, ASK_BYTES // row_bytes)))
    if pack_rows is None:
        # then queries, each of which may meet every pack, move as many bytes as rows
        asked = asks.agg(F.sum(F.size("ids"))).first()[0] or 0
        pack_rows = max(1, min(max(PACK_ROWS, asked), PACK_BYTES // row_bytes))
    pack, parts = packs_of(held, pack_rows)
    # a pack's parts are units of their own
    first_unit = np.cumsum(parts) - parts

    def deal(batches):
        """Rows of a batch that lie in one unit as one row."""
        for batch in batches:
            cells, ids = batch.column("cell").to_numpy(), batch.column("id").to_numpy()
            vectors = _floats(batch.column("vector").to_pylist(), kind, width)
            own = pack[cells]
            units = first_unit[own] + batch.column("row").to_numpy() % parts[own]
            order = np.argsort(units, kind="stable")
            heads = np.flatnonzero(np.diff(units[order], prepend=-1))
            some = np.split(order, heads[1:]) if len(order) else []
            yield _meeting([(units[o[0]], -1, ids[o], cells[o], vectors[o], *_NONE) for o in some], kind)

    def probe(batches):
        """For each unit, the queries of a group that visit a cell of its pack."""
        for batch in batches:
            for r in batch.to_pylist():
                names, asked = np.array(r["ids"], np.int64), _floats(r["vectors"], kind, width)
                unit = unit_rows(asked.astype(float))
                left, right = distances(unit[:, :cut], halves[0]), distances(unit[:, cut:], halves[1])
                meets, ends, edges = np.zeros((len(unit), len(parts)), bool), np.zeros(len(unit)), []
                for q in range(len(unit)):
                    cells = traverse(left[q], right[q], held, wanted)
                    meets[q, pack[cells]] = True
                    sums = left[q, cells // columns] + right[q, cells % columns]
                    ends[q] = sums[-1]
                    edge = cells[np.searchsorted(sums, ends[q] - 2 * _ROUGH):]
                    edges.append(np.stack([np.full(len(edge), q), edge]))
                edge_of, edge = np.concatenate(edges, axis=1)
                for p in np.flatnonzero(meets.any(axis=0)).tolist():
                    places, own = np.flatnonzero(meets[:, p]), pack[edge] == p
                    for u in range(first_unit[p], first_unit[p] + parts[p]):
                        yield _meeting([(u, r["group"], names[places], places, asked[places], ends[places],
                                         edge_of[own], edge[own])], kind)

    def compare(batches):
        unit, chunks, block = None, [], None
        for batch in batches:
            for r in batch.to_pylist():
                if r["unit"] != unit:
                    unit, chunks, block = r["unit"], [], None
                ids, places = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["places"], "<i4")
                vectors = _floats([r["vectors"]], kind, width)
                if r["group"] < 0:
                    chunks.append((ids, places, vectors))
                    continue
                if block is None and chunks:
                    block = _block(chunks, k)
                if block is None:
                    continue
                asked = vectors.astype(float)
                own = unit_rows(asked)
                # cells of which this machine's rounding could leave open whether they are visited are listed
                cells = block["cells"]
                visits = (distances(own[:, :cut], halves[0])[:, cells // columns]
                          + distances(own[:, cut:], halves[1])[:, cells % columns]
                          < np.frombuffer(r["ends"], "<f8")[:, None] - _ROUGH)
                at = np.searchsorted(cells, edge := np.frombuffer(r["edges"], "<i4"))
                there = np.append(cells, -1)[at] == edge
                visits[np.searchsorted(places, np.frombuffer(r["edge_places"], "<i4")[there]), at[there]] = True
                who, found, score = _best(ids, asked, own.astype("<f4"), visits, block, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(who), r["group"])), pa.array(places[who]), pa.array(ids[who]),
                     pa.array(found), pa.array(score)], names=["group", "place", "query_id", "id", "score"])

    meetings = index.mapInArrow(deal, _MEETING).unionByName(asks.mapInArrow(probe, _MEETING))
    order = Window.partitionBy("group", "place").orderBy(F.desc("score"), "id")
    # so that units seldom share a task there are more tasks than units; a unit's rows come before its queries
    return meetings.repartition(4 * int(parts.sum()), "unit").sortWithinPartitions("unit", "group").mapInArrow(
        compare, "group bigint, place int, query_id bigint, id bigint, score double").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


# What meets in a unit: its rows, under the group -1, with their cells as places; queries, with the summed distance
# that ends their visits and the cells at that distance.
_MEETING = ("unit bigint, group bigint, ids binary, places binary, vectors binary, ends binary, edge_places binary, "
            "edges binary")
_NONE = [np.zeros(0)] * 3


def _meeting(rows: list[tuple], kind: str) -> pa.RecordBatch:
    kinds = ["<i8", "<i4", kind, "<f8", "<i4", "<i4"]
    columns = [[r[c] for r in rows] for c in range(8)]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
         *[pa.array([v.astype(t).tobytes() for v in c], pa.binary()) for c, t in zip(columns[2:], kinds)]],
        names=[c.split()[0] for c in _MEETING.split(", ")])


def _floats(data: list[bytes], kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(data), kind).reshape(-1, width)


def _block(chunks: list[tuple], k: int) -> dict:
    """Rows of a unit by cell; the chunks are emptied, so that their vectors are not held twice.

    Of rows with one vector ``k`` an id and ``2 * k`` in all are kept, those with the smallest ids: without the id that a
    query may not have, these are all that its ``k`` nearest can hold.
    """
    ids, cells, vectors = (np.concatenate(c) for c in zip(*chunks))
    chunks.clear()
    digest = np.fromiter((hash(v.tobytes()) for v in vectors), np.int64, len(vectors))
    order = np.lexsort((ids, digest, cells))
    near = np.flatnonzero((np.diff(digest[order]) == 0) & (np.diff(cells[order]) == 0)) + 1
    same = np.zeros(len(order), bool)
    for some in np.array_split(near, -(-len(near) // STEP_ROWS) or 1):
        same[some] = (vectors[order[some]] == vectors[order[some - 1]]).all(axis=1)
    own_id = same & (np.diff(ids[order], prepend=0) == 0)
    order = order[_nth(own_id) < k]
    same = same[_nth(own_id) < k]
    order = np.sort(order[_nth(same) < 2 * k])
    order = order[np.argsort(cells[order], kind="stable")]
    ids, cells, vectors = ids[order], cells[order], vectors[order]
    heads = np.flatnonzero(np.diff(cells, prepend=-1))
    unit = np.empty(vectors.shape, "<f4")
    for first in range(0, len(unit), STEP_ROWS):
        unit[first:first + STEP_ROWS] = unit_rows(vectors[first:first + STEP_ROWS].astype(float))
    return {"ids": ids, "vectors": vectors, "unit": unit, "cells": cells[heads].astype(np.int64), "heads": heads}


def _nth(follows: np.ndarray) -> np.ndarray:
    """Each entry's place in its run, where a run goes on at entries that follow the one before."""
    at = np.arange(len(follows))
    return at - np.maximum.accumulate(np.where(follows, 0, at))


def _best(names: np.ndarray, asked: np.ndarray, unit: np.ndarray, visits: np.ndarray, block: dict,
          k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, ids and cosines: of each query its ``k`` nearest among the rows of the cells it visits.

    Products in single precision leave out what is farther than ``k`` rows by more than their rounding; the rest is
    compared exactly.
    """
    ids, vectors = block["ids"], block["vectors"]
    slack = np.float32(2.5e-7 * (asked.shape[1] + 16))
    top = np.full((len(names), k), -2, "<f4")
    least = top[:, 0] - slack
    mine = np.isin(ids, names)
    ends = np.append(block["heads"][1:], len(ids))
    done, pending, held = [], [], 0

    def settle():
        who, rows, rough = (np.concatenate(c) for c in zip(*pending))
        kept = rough >= least[who]
        who, rows = who[kept], rows[kept]
        size = max(1, (1 << 20) // asked.shape[1])
        score = [cosines(asked[who[s:s + size]], vectors[rows[s:s + size]].astype(float))
                 for s in range(0, len(who), size)]
        done.append((who, ids[rows], np.concatenate([np.zeros(0), *score])))
        who, found, score = (np.concatenate(c) for c in zip(*done))
        order = np.lexsort((found, -score, who))
        order = order[_nth(np.diff(who[order], prepend=-1) == 0) < k]
        done[:] = [(who[order], found[order], score[order])]
        pending.clear()

    for c, visiting in enumerate(np.ascontiguousarray(visits.T)):
        visitors = np.flatnonzero(visiting)
        if not len(visitors):
            continue
        asking = unit[visitors]
        for first in range(block["heads"][c], ends[c], STEP_ROWS):
            last = min(first + STEP_ROWS, ends[c])
            rough = asking @ block["unit"][first:last].T
            if mine[first:last].any():
                rough[names[visitors][:, None] == ids[None, first:last]] = -np.inf
            near = np.flatnonzero(rough.max(axis=1) >= least[visitors])
            if not len(near):
                continue
            some, who = rough[near], visitors[near]
            top[who] = np.partition(np.concatenate([top[who], some], axis=1), -k, axis=1)[:, -k:]
            least[who] = top[who, 0] - slack
            q, rows = np.nonzero(some >= least[who][:, None])
            pending.append((who[q], first + rows, some[q, rows]))
            held += len(q)
            if held > PENDING:
                settle()
                held = 0
    if pending:
        settle()
    return done[0] if done else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows over their norms, by way of their largest entries, whose squares could leave the range of a double."""
    small = vectors / np.abs(vectors).max(axis=1)[:, None]
    return small / np.linalg.norm(small, axis=1)[:, None]

"""Exact top-k by inner product with a pivot-distance index.

Inner products become distances by one more coordinate. Vectors are split into shells by their norm, M being a shell's upper
end: x/M is extended by sqrt(1 - x*x/(M*M)) and a unit query q by zero; then |q - x|^2 = 2 - 2 q*x/M, and the
nearest vectors have the largest inner products. Vectors are keyed by shell, nearest pivot and distance from it, and
stored in this order in blocks, the annuli. An annulus keeps the least and the largest distance of its
vectors from every pivot, each of which bounds a query's distance by the triangle inequality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberfold.llm.multi_index import distances, kmeans
from emberfold.llm.vectors import BLOCK_ROWS, QUERY_ROWS, lengths_of, matrix, query_groups, rows_of, usable_vectors
from emberfold.llm.worker import BROADCAST_BYTES
from emberfold.storage import materialize

PIVOTS = 32
SAMPLE = 4_096
# Annuli of each page a query reads before the bounds decide about the others.
FIRST_ANNULI = 4
# Annuli whose bounds are looked at together.
PAGE_ANNULI = 2_048
# Slack for rounded distances between unit vectors.
_SLACK = 1e-9
# The shell of zero vectors, below that of the smallest double.
_ZERO = -4_000
_DIGITS = 38


def _scaled(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """``id, shell, vector`` with whole entries; 2**shell is above the norm and at most twice as large."""
    for batch in batches:
        vectors = np.floor(matrix(batch.column("vector")) * scale) + 0.0
        keep = np.isfinite(vectors).all(axis=1)
        vectors = vectors[keep]
        if not len(vectors):
            continue
        # by way of the largest entry, so that no square leaves the range of a double
        up = np.frexp(np.abs(vectors).max(axis=1))[1]
        rest = np.frexp(np.sqrt((np.ldexp(vectors, -up[:, None]) ** 2).sum(axis=1)))[1]
        shell = np.where((vectors != 0).any(axis=1), up + rest, _ZERO)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").filter(pa.array(keep)), pa.array(shell.astype(np.int32)), rows_of(vectors)],
            names=["id", "shell", "vector"])


def _floats(data: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(data), "<f8").reshape(-1, width)


def _extended(vectors: np.ndarray, shell: np.ndarray) -> np.ndarray:
    """Whole vectors as points on the unit sphere of one more dimension."""
    small = np.ldexp(vectors, -shell[:, None])
    return np.concatenate([small, np.sqrt(np.maximum(1 - (small ** 2).sum(axis=1), 0))[:, None]], axis=1)


def _away(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(distances(points, centres), 0))


def products(queries: np.ndarray, vectors: np.ndarray, bits: int) -> np.ndarray:
    """Exact inner products of whole vectors; ``bits`` bound their sizes and those of all partial sums.

    Doubles up to 53 bits, longs up to 63, beyond that Python's integers.
    """
    if bits <= 53:
        return (queries @ vectors.T).astype(np.int64)
    if bits <= 63:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    return whole(queries) @ whole(vectors).T


def _ordered(value: int) -> bytes:
    """A whole number as bytes in the same order, smallest first."""
    size = (abs(value).bit_length() + 7) // 8
    mark = (1 << 16) + size if value >= 0 else (1 << 16) - size
    body = value if value >= 0 else (1 << 8 * size) - 1 + value
    return mark.to_bytes(3, "big") + body.to_bytes(size, "big")


def _annuli(batches: Iterator[pa.RecordBatch], width: int, centres: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of shell, pivot and radius as blocks of one shell and pivot."""
    name = TaskContext.get().partitionId() << 32
    held: list[tuple] = []

    def block():
        nonlocal name
        shell, _, ids, vectors = zip(*held)
        far = _away(_extended(_floats(list(vectors), width), np.array(shell)), centres)
        row = [[name], [shell[0]], [far.min(axis=0).tobytes()], [far.max(axis=0).tobytes()],
               [np.array(ids, "<i8").tobytes()], [b"".join(vectors)]]
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
        name += 1
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds)],
                                          names=["block", "shell", "near", "far", "ids", "vectors"])

    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("shell", "pivot", "id", "vector")]):
            if held and (held[0][:2] != row[:2] or len(held) == size):
                yield block()
            held.append(row)
    if held:
        yield block()


def bounds(queries: np.ndarray, shells: np.ndarray, page: dict, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``upper``: what no product of a query with an annulus exceeds, and ``slack`` for its rounding, as doubles."""
    norms = np.linalg.norm(np.ldexp(queries, -shells[:, None]), axis=1)
    unit = np.ldexp(queries, -shells[:, None]) / np.where(norms > 0, norms, 1)[:, None]
    far = _away(np.pad(unit, ((0, 0), (0, 1))), centres)
    gap = np.zeros((len(queries), len(page["block"])))
    for p in range(len(centres)):
        np.maximum(gap, far[:, p, None] - page["far"][None, :, p], out=gap)
        np.maximum(gap, page["near"][None, :, p] - far[:, p, None], out=gap)
    exponent = shells[:, None] + page["shell"][None, :]
    size = np.ldexp(norms[:, None], np.minimum(exponent, 5_000))
    upper = size * (1 - gap ** 2 / 2)
    return np.where(np.isnan(upper), np.inf, upper), size * _SLACK


def _page(near: list, far: list, shell: list, block: list, pivots: int) -> dict:
    return {"near": _floats(near, pivots), "far": _floats(far, pivots), "shell": np.array(shell), "block": np.array(block)}


def highest_products(df: DataFrame, queries: str, k: int = 5, id_col: str = "vec_id",
                     vector_col: str = "embedding", scale: float = 256.0, pivots: int = PIVOTS,
                     sample: int = SAMPLE, block_rows: int = BLOCK_ROWS, first_annuli: int = FIRST_ANNULI,
                     query_rows: int = QUERY_ROWS, page_annuli: int = PAGE_ANNULI) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` largest inner products of ``floor(scale * x)``.

    ``queries`` is a condition on ``id``. A query first reads the annuli with the largest bounds; its k-th best
    product then stops it at every annulus that by the triangle inequality cannot hold one as large. The
    result is exact, whatever the size of the entries: products are summed in doubles, longs or Python's integers, as
    their sizes need. ``score`` is a long if every product fits; otherwise, for all rows, a decimal(38,0), NULL
    for a product of more digits, whose rank is still right.

    Vectors that are NULL or empty or hold NULL or non-finite values take no part, nor do those without an id or that
    ``scale`` takes beyond a double; zero vectors do. Vectors meet those of their own length, each length being
    indexed for itself. Rows that share an id are separate candidates, but not of each
    other, and separate queries. Ties go to the smaller id. With ``k`` candidates or fewer all are returned; no usable row gives none.
    """
    spark = df.sparkSession
    found = []
    usable = usable_vectors(df, id_col, vector_col)
    for length in lengths_of(usable):
        rows = materialize(usable.where(F.size("vector") == length).mapInArrow(
            lambda batches: _scaled(batches, scale), "id bigint, shell int, vector binary"), "whole-vectors")
        found.append((rows, length))
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score bigint")
    top = max((rows.agg(F.max("shell")).first()[0] or 0) for rows, _ in found)
    # norms are below 2**top, and so no sum of products reaches 2**(2 * top)
    as_long = 2 * top <= 63
    best = None
    for rows, length in found:
        own = _best_of_length(rows, length, queries, k, pivots, sample, block_rows, first_annuli, query_rows,
                              page_annuli, as_long)
        best = own if best is None else best.unionByName(own)
    return best


def _best_of_length(rows: DataFrame, width: int, queries: str, k: int, pivots: int, sample: int, block_rows: int,
                    first_annuli: int, query_rows: int, page_annuli: int, as_long: bool) -> DataFrame:
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("shell", "vector").collect()
    centres = kmeans(_extended(_floats([r["vector"] for r in drawn], width), np.array([r["shell"] for r in drawn])),
                     pivots) if drawn else np.zeros((1, width + 1))
    n_pivots = len(centres)

    def key(batches):
        for batch in batches:
            shell = batch.column("shell").to_numpy()
            far = _away(_extended(_floats(batch.column("vector").to_pylist(), width), shell), centres)
            own = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("shell"), pa.array(own.astype(np.int32)), pa.array(far[np.arange(len(own)), own]),
                 batch.column("id"), batch.column("vector")], names=["shell", "pivot", "radius", "id", "vector"])

    order = ["shell", "pivot", "radius", "id"]
    ordered = rows.mapInArrow(key, "shell int, pivot int, radius double, id bigint, vector binary").repartitionByRange(
        *order).sortWithinPartitions(*order)
    annuli = materialize(ordered.mapInArrow(
        lambda batches: _annuli(batches, width, centres, block_rows),
        "block bigint, shell int, near binary, far binary, ids binary, vectors binary"), "annuli")
    n_pages = max(1, -(-annuli.count() // page_annuli))
    heads = F.struct("near", "far", "shell", "block")
    pages = annuli.groupBy(F.pmod(F.xxhash64("block"), F.lit(n_pages)).cast("int").alias("page")).agg(
        F.collect_list(heads).alias("h")).select("page", "h.near", "h.far", "h.shell", F.col("h.block").alias("blocks"))
    pages = materialize(pages.withColumnRenamed("shell", "annulus_shells"), "annulus-pages")
    if n_pages * page_annuli * (16 * n_pivots + 16) <= BROADCAST_BYTES:
        pages = F.broadcast(pages)
    asks = query_groups(rows.where(queries), query_rows, "shell")

    def aim(batches, later):
        """Rows for each annulus that a group's queries have to read: first ones, or those beyond."""
        for batch in batches:
            for r in batch.to_pylist():
                vectors, shells = _floats(r["vectors"], width), np.array(r["shells"], np.int32)
                page = _page(r["near"], r["far"], r["annulus_shells"], r["blocks"], n_pivots)
                upper, slack = bounds(vectors, shells, page, centres)
                # the largest bounds, ties by the annulus, so that both times the same are first
                by_bound = np.lexsort((np.broadcast_to(page["block"], upper.shape), -upper), axis=1)
                reads = np.zeros(upper.shape, bool)
                np.put_along_axis(reads, by_bound[:, :first_annuli], True, axis=1)
                if later:
                    least = np.full(len(vectors), -np.inf)
                    for place, value in zip(r["places"] or [], r["leasts"] or []):
                        least[place] = value
                    reads = ~reads & (upper + slack >= (least - np.abs(least) * _SLACK)[:, None])
                ids = np.array(r["ids"], np.int64)
                for a in np.flatnonzero(reads.any(axis=0)).tolist():
                    who = np.flatnonzero(reads[:, a])
                    cells = [page["block"][a], r["group"], who.astype("<i4").tobytes(), ids[who].tobytes(),
                             shells[who].tobytes(), vectors[who].tobytes()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c], t) for c, t in zip(cells, [pa.int64()] * 2 + [pa.binary()] * 4)],
                        names=["block", "group", "places", "names", "shells", "queries"])

    kind = "bigint" if as_long else "decimal(38,0)"

    def compare(batches):
        for batch in batches:
            for r in batch.to_pylist():
                who, names = np.frombuffer(r["places"], "<i4"), np.frombuffer(r["names"], "<i8")
                asked, vectors = (_floats([r[c]], width) for c in ("queries", "vectors"))
                ids, shells = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["shells"], "<i4")
                need = np.maximum(shells + r["shell"], 0)
                level = np.where(need <= 53, 0, np.where(need <= 63, 1, 2))
                for part in (np.flatnonzero(level == v) for v in (0, 1, 2)):
                    if len(part):
                        yield from _top(who[part], names[part], ids, products(asked[part], vectors, int(need[part].max())),
                                        r["group"], k, as_long)

    schema = f"group bigint, place int, query_id bigint, id bigint, score {kind}, rough double, sorted binary"
    data = annuli.select("block", "shell", "ids", "vectors")
    paged = lambda groups: groups.withColumn("page", F.explode(F.sequence(
        F.lit(0), F.lit(n_pages - 1)))).join(pages, "page")
    aimed = "block bigint, group bigint, places binary, names binary, shells binary, queries binary"
    meet = lambda pairs: pairs.join(data, "block").mapInArrow(compare, schema)
    place = Window.partitionBy("group", "place").orderBy(F.desc("score" if as_long else "sorted"), "id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    first = materialize(ranked(meet(paged(asks).mapInArrow(lambda b: aim(b, False), aimed))), "first-found")
    least = first.where(F.col("rank") == k).groupBy("group").agg(F.collect_list(F.struct("place", "rough")).alias("l")).select(
        "group", F.col("l.place").alias("places"), F.col("l.rough").alias("leasts"))
    more = meet(paged(asks.join(least, "group", "left")).mapInArrow(lambda b: aim(b, True), aimed))
    return ranked(first.drop("rank").unionByName(more)).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def _top(who: np.ndarray, names: np.ndarray, ids: np.ndarray, found: np.ndarray, group: int, k: int,
         as_long: bool) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of a block for each query, ties by the smaller id; none with the query's own id."""
    rows = []
    for q in range(len(who)):
        own = np.flatnonzero(ids != names[q])
        scores = found[q][own]
        if found.dtype == object:
            best = sorted(range(len(own)), key=lambda j: (-scores[j], ids[own[j]]))[:k]
        else:
            best = np.lexsort((ids[own], -scores))[:k]
        rows += [(who[q], names[q], ids[own[j]], int(scores[j])) for j in best]
    if not rows:
        return
    place, name, other, score = zip(*rows)
    fits = pa.array(score, pa.int64()) if as_long else pa.array(
        [s if abs(s) < 10 ** _DIGITS else None for s in score], pa.decimal128(_DIGITS, 0))
    # no larger than the product, where a double cannot hold it
    rough = [float(s) if abs(s) < 1 << 1023 else float(1 << 1023) if s > 0 else -np.inf for s in score]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(rows), group, np.int64)), pa.array(place, pa.int32()), pa.array(name, pa.int64()),
         pa.array(other, pa.int64()), fits, pa.array(rough, pa.float64()),
         pa.array([None if as_long else _ordered(s) for s in score], pa.binary())],
        names=["group", "place", "query_id", "id", "score", "rough", "sorted"])

"""Whitening of vectors, with covariances recovered from variances alone (polarisation).

For two dimensions, 2 cov(x, y) = var(x + y) - var(x) - var(y). So only squares are summed: those of every centred
dimension and of every sum of two. They are sums of integers, taken without rounding, so the covariances are exact
up to their last conversion to a double.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.worker import small_batches
from emberfold.storage import materialize

# Rows whose squares are summed at a time.
BLOCK_ROWS = 1_024
# Squares are summed by digits of so many bits: a block's products stay below 2**63.
_DIGIT = 24
# Sums of a task travel in parts of so many bits, so that they add up in a long.
_PART = 40
_LONG = 2 ** 63


def _packed(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """``id, size, packed``: every vector as integers ``floor(scale * c)``, as narrow as they all fit."""
    for batch in batches:
        column = batch.column("vector")
        sizes = column.value_lengths().to_numpy().astype(np.int32)
        flat = np.floor(column.flatten().to_numpy() * scale)
        big = np.abs(flat) >= float(_LONG)
        whole = np.where(big, 0, flat).astype(np.int64)
        whole[big] = np.where(flat[big] > 0, _LONG - 1, -_LONG)
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        packed = []
        # a bit more than the numbers have, for the sign
        top = np.maximum.reduceat(np.where(whole < 0, ~whole, whole), starts) if len(starts) else starts
        for start, n, most in zip(starts.tolist(), sizes.tolist(), top.tolist()):
            kind = next(k for k, bits in (("<i1", 7), ("<i2", 15), ("<i4", 31), ("<i8", 63)) if most >> bits == 0)
            packed.append(whole[start:start + n].astype(kind).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes), pa.array(packed, pa.binary())],
                                         names=["id", "size", "packed"])


def _blocks(batch: pa.RecordBatch, rows: int = BLOCK_ROWS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``size, places, matrix`` of the rows of equal size and width, in blocks."""
    sizes = batch.column("size").to_numpy()
    lengths = pa.compute.binary_length(batch.column("packed")).to_numpy()
    kinds = sizes.astype(np.int64) << 4 | lengths // sizes
    for kind in np.unique(kinds).tolist():
        places = np.flatnonzero(kinds == kind)
        for first in range(0, len(places), rows):
            at = places[first:first + rows]
            data = b"".join(batch.column("packed").take(pa.array(at)).to_pylist())
            yield kind >> 4, at, np.frombuffer(data, f"<i{kind & 15}").reshape(len(at), -1).astype(np.int64)


@dataclass(frozen=True)
class Centre:
    """Rows of one size in the fit list, the sum of each dimension, and the largest centred entry."""

    n: int
    sums: tuple[int, ...]
    most: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, as Python's integers where a long could not hold them or a sum of two."""
        if self.most < _LONG >> 2 and max(abs(s) for s in self.sums) < _LONG:
            # the difference fits, so it is right even where the product has wrapped
            return x * np.int64(self.n) - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)


def square_sums(v: np.ndarray, most: int, axis: int) -> np.ndarray:
    """Exact sums of squares as Python's integers; no entry is larger than ``most``."""
    if v.dtype == object:
        return (v * v).sum(axis=axis)
    digits = []
    for _ in range(most.bit_length() // _DIGIT):
        digits.append(v & ((1 << _DIGIT) - 1))
        v = v >> _DIGIT
    digits.append(v)
    letters = "rc,rc->" + "cr"[axis]
    total = 0
    for i, low in enumerate(digits):
        for j in range(i, len(digits)):
            part = np.einsum(letters, low, digits[j]).astype(object)
            total = total + part * ((1 if i == j else 2) << _DIGIT * (i + j))
    return total


def _sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per size and dimension of a task's rows: how many, sums of the halves of its numbers, smallest, largest."""
    held: dict[int, list] = {}
    for batch in batches:
        for size, _, x in _blocks(batch):
            new = [len(x), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), x.min(axis=0), x.max(axis=0)]
            old = held.get(size)
            held[size] = new if old is None else [
                old[0] + new[0], old[1] + new[1], old[2] + new[2], np.minimum(old[3], new[3]),
                np.maximum(old[4], new[4])]
    for size, (n, high, low, least, most) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, size, np.int32)), pa.array(np.arange(size, dtype=np.int32)),
             pa.array(np.full(size, n, np.int64)), *map(pa.array, (high, low, least, most))],
            names=["size", "i", "n", "high", "low", "least", "most"])


def centres(fit: DataFrame) -> dict[int, Centre]:
    """The centre of each size of vectors; one row per dimension reaches the driver."""
    rows = fit.mapInArrow(
        _sums_of, "size int, i int, n bigint, high bigint, low bigint, least bigint, most bigint")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = rows.groupBy("size", "i").agg(
        F.sum("n").alias("n"), exact("high"), exact("low"), F.min("least").alias("least"),
        F.max("most").alias("most")).orderBy("size", "i").collect()
    out = {}
    for size in sorted({r["size"] for r in found}):
        own = [r for r in found if r["size"] == size]
        sums = [(int(r["high"]) << 32) + int(r["low"]) for r in own]
        most = max(abs(r["n"] * x - s) for r, s in zip(own, sums) for x in (r["least"], r["most"]))
        out[size] = Centre(own[0]["n"], tuple(sums), most)
    return out


def _squares(around: dict[int, Centre]) -> Callable:
    """Per size and pair of dimensions: the sum of squares of a task's centred rows, in parts."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for size, _, x in _blocks(batch):
                centre = around[size]
                u = centre.centred(x)
                new = []
                for i in range(size):
                    v = u[:, i:].copy()
                    v[:, 1:] += u[:, i:i + 1]  # the dimension alone, then its sums with all later ones
                    new.append(square_sums(v, 2 * centre.most, 0))
                old = held.get(size)
                held[size] = new if old is None else [a + b for a, b in zip(old, new)]
        for size, totals in held.items():
            rows = [(size, i, i + k, part, int(total) >> _PART * part & (1 << _PART) - 1)
                    for i, row in enumerate(totals) for k, total in enumerate(row)
                    for part in range(-(-int(total).bit_length() // _PART))]
            for first in range(0, len(rows), 50_000):
                columns = list(zip(*rows[first:first + 50_000]))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int32()) for c in columns[:4]], pa.array(columns[4], pa.int64())],
                    names=["size", "i", "j", "part", "value"])

    return run


def covariances(fit: DataFrame, around: dict[int, Centre]) -> dict[int, np.ndarray]:
    """Each size's covariance matrix; half of its entries reach the driver as sums of squares."""
    rows = fit.mapInArrow(_squares(around), "size int, i int, j int, part int, value bigint")
    found = rows.groupBy("size", "i", "j", "part").agg(F.sum("value").alias("value")).toArrow().to_pylist()
    totals: dict[tuple, int] = {}
    for r in found:
        at = r["size"], r["i"], r["j"]
        totals[at] = totals.get(at, 0) + (r["value"] << _PART * r["part"])
    out = {}
    for size, centre in around.items():
        square = lambda i, j: totals.get((size, i, j), 0)  # noqa: E731, B023
        matrix = np.zeros((size, size))
        for i in range(size):
            matrix[i, i] = square(i, i) / centre.n ** 3
            for j in range(i + 1, size):
                # var(x + y) - var(x) - var(y), of numbers that are n times too large
                twice = square(i, j) - square(i, i) - square(j, j)
                matrix[i, j] = matrix[j, i] = twice / (2 * centre.n ** 3)
        out[size] = matrix
    return out


@dataclass(frozen=True)
class Whitener:
    """What whitens vectors of one size: rows of ``axes`` are eigenvectors over the root of their eigenvalue."""

    centre: Centre
    axes: np.ndarray
    explained: np.ndarray

    def whitened(self, u: np.ndarray) -> np.ndarray:
        return (u / self.centre.n).astype(float) @ self.axes.T


def whitener(centre: Centre, matrix: np.ndarray, components: int) -> Whitener:
    """Components by falling eigenvalue; those without variance, up to rounding, are left out."""
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order].T
    keep = values > max(values[0], 0) * len(matrix) * np.finfo(float).eps
    values, vectors = values[keep], vectors[keep]
    # of the two signs the one that makes the largest entry positive
    most = np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], axis=1)
    return Whitener(centre, vectors * np.sign(most) / np.sqrt(values)[:, None], values / np.trace(matrix))


def _moments(fits: dict[int, Whitener], means: dict[int, np.ndarray] | None) -> Callable:
    """A task's sums of whitened entries, or of products of entries less their means."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, x in _blocks(batch):
                z = fits[size].whitened(fits[size].centre.centred(x))
                if means is None:
                    new = z.sum(axis=0)[:, None]
                else:
                    z = z - means[size]
                    new = z.T @ z
                held[size] = held.get(size, 0.0) + new
        for size, total in held.items():
            i, j = (index.ravel().astype(np.int32) for index in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(total.size, size, np.int32)), pa.array(i), pa.array(j), pa.array(total.ravel())],
                names=["size", "i", "j", "value"])

    return run


def identity_errors(fit: DataFrame, fits: dict[int, Whitener]) -> dict[int, float]:
    """The largest entry of the whitened fit list's covariance less the identity, per size."""
    def total(means):
        rows = fit.mapInArrow(_moments(fits, means), "size int, i int, j int, value double").groupBy(
            "size", "i", "j").agg(F.sum("value").alias("value")).collect()
        out = {size: np.zeros((len(f.axes), len(f.axes) if means else 1)) for size, f in fits.items()}
        for r in rows:
            out[r["size"]][r["i"], r["j"]] = r["value"] / fits[r["size"]].centre.n
        return out

    means = {size: m[:, 0] for size, m in total(None).items()}
    return {size: float(np.abs(cov - np.eye(len(cov))).max(initial=0.0)) for size, cov in total(means).items()}


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4,
           scale: float = 256.0) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, one row per vector and component.

    A vector's entries become integers x = ``floor(scale * c)``, at the ends of a long if beyond. The fit list has
    each distinct x once: ``n`` vectors with sums S. ``deviation`` is the sum over the dimensions of
    (n*x - S)**2, exact: a long if every row's fits, otherwise for all rows a decimal(38,0), NULL beyond that.
    ``whitened`` is x - S/n on the component, over the root of its eigenvalue; ``explained`` the eigenvalue's share;
    ``identity_error`` shows how well the whitened fit list has unit covariance.

    Rows whose vector is NULL or empty, or holds NULL or non-finite entries, are left out; rows without an id and
    repeated rows stay, and each is whitened. Vectors of another length are fitted and whitened among
    themselves. Components without variance are not returned, so equal vectors alone, a single one or an
    empty table give no rows. Of equal eigenvalues any order of the eigenvectors may come out.
    """
    rows = small_batches(df).select(F.col(id_col).cast("bigint").alias("id"),
                                    F.col(vector_col).cast("array<double>").alias("vector")).where(
        F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall(
            "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    packed = materialize(rows.mapInArrow(lambda batches: _packed(batches, scale),
                                         "id bigint, size int, packed binary"), "packed-vectors")
    # copies meet before they move
    fit = materialize(packed.select("size", "packed").distinct(), "fit-vectors")
    around = centres(fit)
    fits = {size: whitener(around[size], matrix, components)
            for size, matrix in covariances(fit, around).items()}
    errors = identity_errors(fit, fits) if fits else {}
    fits_long = all(size * c.most ** 2 < _LONG for size, c in around.items())
    kind = pa.int64() if fits_long else pa.decimal128(38, 0)

    def run(batches):
        for batch in batches:
            names = batch.column("id")
            for size, places, x in _blocks(batch):
                own = fits[size]
                n = len(own.axes)
                u = own.centre.centred(x)
                squares = square_sums(u, own.centre.most, 1).tolist()
                if not fits_long:
                    squares = [Decimal(s) if s < 10 ** 38 else None for s in squares]
                many = np.repeat(np.arange(len(places)), n)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(places[many])),
                     pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(places))),
                     pa.array(np.full(len(many), own.centre.n, np.int64)),
                     pa.array(squares, kind).take(pa.array(many)), pa.array(own.whitened(u).ravel()),
                     pa.array(np.tile(own.explained, len(places))), pa.array(np.full(len(many), errors[size]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return packed.mapInArrow(run, f"vec_id bigint, component int, n bigint, deviation "
                                  f"{'bigint' if fits_long else 'decimal(38,0)'}, whitened double, explained double, "
                                  "identity_error double")

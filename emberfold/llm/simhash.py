"""Near-duplicates by SimHash, joined through anchor points.

Two 64-bit fingerprints that differ in at most ``max_bits`` bits differ in at most
``max_bits // parts`` bits of one of ``parts`` disjoint bit ranges. In each range the
words of a covering code are the anchors: blocks of seven bits with the words of
the perfect Hamming code (covering radius one), left-over bits as they are (radius
zero). The more fingerprints there are, the more blocks take all their words as anchors
(radius zero), each of which multiplies the anchors by eight. A fingerprint is at home with its nearest anchor and is copied to every
anchor within covering radius plus threshold, counted block by block; so for every
close pair the home anchor of the one has a copy of the other, and comparing all copies
with the home fingerprints, anchor by anchor, finds every pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.components import connected_components
from emberfold.llm.worker import pieces, small_batches
from emberfold.storage import materialize

# Rows of one anchor that are compared in one go; larger anchors are dealt to
# pairs of blocks, each pair a unit of its own.
ANCHOR_ROWS = 32_768
# Rows an anchor gets on average: with more, the code is made finer, up to all words.
ANCHOR_MEAN = 256
_UPPER = bytes(range(65, 91))
_SHINGLES = 65_536


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of lower-cased (A-Z) shingles of words, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(shingle, len(words))
    starts, ends = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), _SHINGLES):
        hashes = np.array([digest(joined[a:b], 42) for a, b in
                           zip(starts[k:k + _SHINGLES], ends[k:k + _SHINGLES])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4) -> DataFrame:
    """``doc_id, fp``, the fingerprint as a signed 64-bit integer; one row per row."""
    rows = small_batches(df).select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for batch in pieces(batches, "text"):
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()],
                             dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


def _hamming_words() -> np.ndarray:
    data = np.arange(16)
    d = [data >> k & 1 for k in range(4)]
    checks = [d[0] ^ d[1] ^ d[3], d[0] ^ d[2] ^ d[3], d[1] ^ d[2] ^ d[3]]
    return sum(bit << k for k, bit in enumerate([*d, *checks]))


def _options(width: int, slack: int, coarse: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each value of a block: its anchors, by what they cost beyond the covering radius.

    Returns the first place of each value, the anchors' indices and their costs.
    """
    anchors, radius = (_hamming_words(), 1) if coarse else (np.arange(1 << width), 0)
    far = np.bitwise_count(np.arange(1 << width)[:, None] ^ anchors[None, :]).astype(np.int64)
    cost = np.maximum(far - radius, 0)
    value, anchor = np.nonzero(cost <= slack)
    first = np.searchsorted(value, np.arange((1 << width) + 1))
    return first, anchor, cost[value, anchor]


def _ranges(parts: int) -> list[list[tuple[int, int]]]:
    """Bit ranges as blocks (lowest bit, width) of seven bits and one rest."""
    edges = [64 * k // parts for k in range(parts + 1)]
    return [[(at, min(7, high - at)) for at in range(low, high, 7)]
            for low, high in zip(edges, edges[1:])]


def _coarse(blocks: list[tuple[int, int]], fine: int) -> list[bool]:
    """Which blocks of a range have the Hamming code: those of seven bits but the first ``fine``."""
    whole = [k for k, (_, width) in enumerate(blocks) if width == 7]
    return [k in whole[fine:] for k in range(len(blocks))]


def fine_blocks(n: int, parts: int, mean: int = ANCHOR_MEAN) -> int:
    """How many blocks of each range take all words as anchors, so that ``n`` fingerprints give an anchor ``mean`` rows.

    In all blocks, if even that is not enough.
    """
    ranges = _ranges(parts)
    most = max(sum(width == 7 for _, width in blocks) for blocks in ranges)
    for fine in range(most):
        anchors = [sum(4 if coarse else width for (_, width), coarse in zip(blocks, _coarse(blocks, fine)))
                   for blocks in ranges]
        if n <= mean << min(anchors):
            return fine
    return most


def anchor_rows(fps: np.ndarray, parts: int, max_bits: int, fine: int = 0) -> Iterator[tuple]:
    """Per range: row numbers, anchor keys, and whether the row is at home there."""
    slack = max_bits // parts
    for number, blocks in enumerate(_ranges(parts)):
        rows = np.arange(len(fps))
        keys = np.zeros(len(fps), np.int64)
        spent = np.zeros(len(fps), np.int64)
        for (low, width), coarse in zip(blocks, _coarse(blocks, fine)):
            first, anchor, cost = _options(width, slack, coarse)
            value = ((fps[rows] >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
            count = first[value + 1] - first[value]
            at = np.repeat(first[value] - (np.cumsum(count) - count), count)
            at += np.arange(len(at))
            back = np.repeat(np.arange(len(rows)), count)
            total = spent[back] + cost[at]
            fits = total <= slack
            back, at = back[fits], at[fits]
            keys = keys[back] * (16 if coarse else 1 << width) + anchor[at]
            rows, spent = rows[back], total[fits]
        yield rows, keys * parts + number, spent == 0


def _stars(home: np.ndarray, other: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the close pairs of ``home`` and ``other`` connect."""
    nodes, place = np.unique(np.concatenate([home, other]), return_inverse=True)
    label = np.arange(len(nodes))
    mine, theirs = place[:len(home)], place[len(home):]
    step = max(1, (1 << 21) // max(1, len(other)))
    for k in range(0, len(home), step):
        near = np.bitwise_count(home[k:k + step, None] ^ other[None, :]) <= max_bits
        i, j = np.nonzero(near)
        a, b = mine[i + k], theirs[j]
        a, b = a[a != b], b[a != b]
        while len(a):
            low = np.minimum(label[a], label[b])
            if (label[a] == low).all() and (label[b] == low).all():
                break
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[moved]], nodes[moved]


def fingerprint_links(fps: DataFrame, max_bits: int = 4, parts: int = 3,
                      anchor_limit: int = ANCHOR_ROWS) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints within ``max_bits`` bits.

    ``fps`` has one column ``fp`` of distinct values. Not every close pair is
    listed: each comparison unit returns a star per connected set, at most one
    link for each of its rows. The fingerprints are counted first, and the code follows.
    """
    fine = fine_blocks(fps.count(), parts)

    def copies(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for k in range(0, len(values), 4096):
                part = values[k:k + 4096]
                for rows, keys, home in anchor_rows(part, parts, max_bits, fine):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), pa.array(part[rows].view(np.int64)), pa.array(home)],
                        names=["anchor", "fp", "home"])

    spread = fps.select("fp").mapInArrow(copies, "anchor bigint, fp bigint, home boolean")
    large = spread.groupBy("anchor").count().where(F.col("count") > anchor_limit).select(
        "anchor", F.ceil(F.col("count") / anchor_limit).cast("int").alias("blocks"))
    dealt = spread.join(large, "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks").cast("bigint")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("home").alias("h"),
                             F.lit(True).alias("o")))
    as_home = F.when(F.col("home"), F.transform(every, lambda j: F.struct(
        own.alias("i"), j.cast("int").alias("j"), F.lit(True).alias("h"), F.lit(False).alias("o")))
    ).otherwise(F.array().cast("array<struct<i:int,j:int,h:boolean,o:boolean>>"))
    as_other = F.transform(every, lambda i: F.struct(
        i.cast("int").alias("i"), own.alias("j"), F.lit(False).alias("h"), F.lit(True).alias("o")))
    units = dealt.select("anchor", "fp", F.explode(
        F.when(F.col("blocks") == 1, alone).otherwise(F.concat(as_home, as_other))).alias("u"))
    units = units.select("anchor", "u.i", "u.j", "fp", "u.h", "u.o").repartition(
        "anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")

    def compare(batches):
        held: list[np.ndarray] = []
        for batch in (b for b in batches if b.num_rows):
            columns = [batch.column(c).to_numpy(zero_copy_only=False)
                       for c in ("anchor", "i", "j", "fp", "h", "o")]
            changed = np.zeros(batch.num_rows, bool)
            for c in columns[:3]:
                changed[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                rows = [c[a:b] for c in columns]
                if held and any(h[0] != r[0] for h, r in zip(held[0][:3], rows[:3])):
                    yield from finish(held)
                    held = []
                held = [*held, rows]
        if held:
            yield from finish(held)

    def finish(held):
        fp, h, o = (np.concatenate([r[k] for r in held]) for k in (3, 4, 5))
        values = fp.view(np.uint64)
        a, b = _stars(values[h], values[o], max_bits)
        if len(a):
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return units.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4, parts: int = 3,
                    anchor_limit: int = ANCHOR_ROWS) -> DataFrame:
    """``doc_id, fp, component_id`` per row; equal fingerprints are one node.

    ``component_id`` is the smallest id reachable over links of ``max_bits`` bits or
    fewer. A NULL or empty text has fingerprint zero and links like any other. Rows
    with a NULL id belong to their component and never name it, unless all its ids are
    NULL. Repeated ids stay separate rows. An empty table gives no rows.
    ``parts=1`` uses one covering code over all 64 bits (many more copies).
    """
    rows = materialize(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    links = fingerprint_links(nodes.select("fp"), max_bits, parts, anchor_limit)
    roots = connected_components(links).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = placed.join(names, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")

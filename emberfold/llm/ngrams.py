"""Document scores of a stupid-backoff bigram model, by joins on count tables.

Documents are dealt to chunks. A chunk explodes its texts into unigrams and bigrams and asks
for the counts of its distinct n-grams: one block of sorted hashes per hash range, sent as
differences. The count table of a hash range is the sum of what all chunks sent, and each
block is joined to it and goes back to its chunk, where the logarithms are summed per
document. A frequent n-gram is one entry per chunk, however often it occurs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.worker import small_batches
from emberfold.storage import materialize

BACKOFF = 0.4
# Bytes of text in a chunk, and of text behind the n-grams of a hash range, on average.
CHUNK_BYTES = 8 << 20
RANGE_BYTES = 16 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _grams(texts: list[bytes | None]):
    """Word hashes, bigram hashes (of each word with the one before) and words per text."""
    digest = xxhash.xxh64_intdigest
    parts, sizes = [], []
    for text in texts:
        words = (text or b"").split()
        parts.append(np.array([digest(w) for w in words], dtype=np.uint64))
        sizes.append(len(words))
    words = np.concatenate(parts)
    sizes = np.array(sizes, np.int64)
    pairs = words.copy()
    pairs[1:] ^= (words[:-1] + np.uint64(1)) * _MIX
    pairs ^= pairs >> np.uint64(32)
    pairs *= _MIX
    begins = (np.cumsum(sizes) - sizes)[sizes > 0]
    second = np.ones(len(words), bool)
    second[begins] = False
    return words, pairs, second, sizes


def _ranges(keys: np.ndarray, count: int) -> np.ndarray:
    """First place of each hash range in sorted keys."""
    edges = [-(-(k << 64) // count) for k in range(count)]
    return np.append(np.searchsorted(keys, np.array(edges, np.uint64)), len(keys))


def _planes(values: np.ndarray) -> bytes:
    """64-bit integers with equal byte places together, so that high zeros compress away."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _mark(keys: np.ndarray) -> int:
    """Tells lists of distinct keys apart."""
    return int(np.bitwise_xor.reduce(keys * _MIX + np.uint64(len(keys))).astype(np.int64))


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_count: int = 2, backoff: float = BACKOFF) -> DataFrame:
    """``doc_id, n_words, n_backoff, logp, perplexity`` per row, counts over all rows.

    A word scores ``count(before, word) / count(before)`` if its bigram occurs ``min_count`` times
    or more, else ``backoff * count(word) / N``; a text's first word scores ``count(word) / N``.
    ``logp`` sums natural logarithms, rounded to six places; ``n_backoff`` counts words
    that backed off. Words are told apart by 64-bit hashes.

    A NULL text and one without words have ``logp`` 0 and no perplexity. Repeated rows and
    NULL or repeated ids are separate texts. An empty table gives no rows. ``df`` is read twice and has to give the
    same rows each time, as a stored table does; if it does not, the job fails.
    """
    rows = small_batches(df).select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.col(text_col).cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, ranges = max(1, -(-size // CHUNK_BYTES)), max(1, -(-size // RANGE_BYTES))
    # rows equal in id and text are told apart by their place in the scan
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64(
        "doc_id", F.length("text"), F.monotonically_increasing_id()), F.lit(chunks)))

    def ask(table: pa.Table) -> pa.Table:
        words, pairs, second, _ = _grams(table["text"].to_pylist())
        out = []
        for kind, keys in ((1, words), (2, pairs[second])):
            keys, counts = np.unique(keys, return_counts=True)
            edges = _ranges(keys, ranges)
            for part, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                if a < b:
                    out.append((kind, part, table["chunk"][0].as_py(), _mark(keys[a:b]),
                                _planes(np.diff(keys[a:b], prepend=np.uint64(0))),
                                _planes(counts[a:b])))
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(types)],
                        names=["kind", "part", "chunk", "mark", "keys", "counts"])

    def count(table: pa.Table) -> pa.Table:
        blocks = [np.cumsum(_from_planes(k), dtype=np.uint64) for k in table["keys"].to_pylist()]
        counts = np.concatenate([_from_planes(c) for c in table["counts"].to_pylist()])
        _, place = np.unique(np.concatenate(blocks), return_inverse=True)
        total = np.bincount(place, counts).astype("<u8")[place]
        ends = np.cumsum([len(b) for b in blocks])
        return pa.table([table["kind"], table["part"], table["chunk"], table["mark"],
                         pa.array([_planes(t) for t in np.split(total, ends[:-1])], pa.binary())],
                        names=["kind", "part", "chunk", "mark", "totals"])

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        words, pairs, second, sizes = _grams(table["text"].to_pylist())
        answers = answers.sort_by([("kind", "ascending"), ("part", "ascending")])
        kinds = answers["kind"].to_numpy()
        blobs = answers["totals"].to_pylist()
        of = {kind: np.concatenate([np.empty(0, np.uint64), *[
                  _from_planes(b) for b, k in zip(blobs, kinds) if k == kind]])
              for kind in (1, 2)}
        distinct, place = {}, {}
        for kind, grams in ((1, words), (2, pairs[second])):
            distinct[kind], place[kind] = np.unique(grams, return_inverse=True)
        # a chunk that other rows came to when it was read again would take counts of other n-grams
        marks = [_mark(keys[a:b]) for keys in (distinct[1], distinct[2])
                 for edges in [_ranges(keys, ranges)] for a, b in zip(edges[:-1], edges[1:]) if a < b]
        if marks != answers["mark"].to_pylist():
            raise ValueError("the input gave other rows when it was read again; store it first")
        single = of[1][place[1]].astype(float)
        double = np.zeros(len(words))
        double[second] = of[2][place[2]]
        found = second & (double >= min_count)
        before = np.ones(len(words))
        before[1:] = single[:-1]
        log = np.log(np.where(found, double / before, single))
        log[second & ~found] += np.log(backoff)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        add = lambda w: np.bincount(owner, w, len(sizes)).astype(float)
        return pa.table([table["doc_id"], pa.array(sizes), pa.array(add(second & ~found).astype(np.int64)),
                         pa.array(add(~found).astype(np.int64)), pa.array(add(log))],
                        names=["doc_id", "n_words", "n_backoff", "n_single", "log"])

    asked = dealt.groupBy("chunk").applyInArrow(
        ask, "kind int, part int, chunk bigint, mark bigint, keys binary, counts binary")
    answered = asked.groupBy("kind", "part").applyInArrow(
        count, "kind int, part int, chunk bigint, mark bigint, totals binary")
    scored = materialize(dealt.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(
        score, "doc_id bigint, n_words bigint, n_backoff bigint, n_single bigint, log double"), "scores")
    total = scored.agg(F.sum("n_words")).first()[0] or 1
    logp = F.round(F.col("log") - F.col("n_single") * F.log(F.lit(float(total))), 6)
    return scored.select("doc_id", "n_words", "n_backoff", (logp + F.lit(0.0)).alias("logp")).withColumn(
        "perplexity", F.when(F.col("n_words") > 0, F.round(F.exp(-F.col("logp") / F.col("n_words")), 3)))

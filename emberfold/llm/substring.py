"""Removal of passages that occurred before, by FM-indexes over shards of passages.

A window is ``window`` consecutive words of one document. The smallest hash of the
word groups inside it picks its shard, so equal windows always meet; windows in a row
that share it form a passage. A passage whose hash occurs once in the corpus has
no copy. All others are indexed, equal passages once with their earliest place, and
streamed against the index of their shard: backward search gives the places where each window
occurs, and a window that also starts earlier is removed.

Passages that share their hash with too many others are cut again, by more of the smallest hashes
of each window and at last by the whole window's, so that a shard takes as many as it may hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.fm_index import FMIndex
from emberfold.llm.worker import attach, pieces, small_batches
from emberfold.storage import materialize

GROUP = 6
PASSAGE_WINDOWS = 64
# Words of a shard's index, and passages of one hash that a shard takes.
SHARD_WORDS = 65_536
KEY_PASSAGES = 1_024
# Smallest hashes of a window that tell the passages of a full hash apart; none: all its words.
FINER = (2, 4, None)
_LAST = (1 << 63) - 1


def _word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in words], dtype=np.uint64)


def _group_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` values in a row."""
    groups = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        groups = groups * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + len(groups)]
    groups ^= groups >> np.uint64(31)
    groups *= np.uint64(0xBF58476D1CE4E5B9)
    groups ^= groups >> np.uint64(29)
    return groups


def passages(hashes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Keys, first windows, numbers of windows, and whether the key's words recur nearby.

    Every window is in one passage.
    """
    count = len(hashes) - window + 1
    if count < 1:
        return np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 2, np.empty(0, bool)
    size = min(GROUP, window)
    groups = _group_hashes(hashes, size)
    width, need = 1, window - size + 1
    least = groups
    while 2 * width <= need:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if need > width:
        least = np.minimum(least[:len(least) - (need - width)], least[need - width:])
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    lengths = np.diff(np.append(starts, count))
    if lengths.max() > PASSAGE_WINDOWS:
        cuts = -(-lengths // PASSAGE_WINDOWS)
        step = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        starts = np.repeat(starts, cuts) + step * PASSAGE_WINDOWS
        lengths = np.diff(np.append(starts, count))
    # a run of equal words can repeat a window inside one passage
    ordered = np.sort(groups)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    return least[starts], starts, lengths, np.isin(least[starts], again)


_PLACE = "doc bigint, row bigint, start int, n int"


def _list_passages(rows: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for batch in pieces(batches, "text"):
            keys, starts, counts, again, sizes = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                k, s, n, r = passages(_word_hashes((text or b"").split()), window)
                keys.append(k)
                starts.append(s)
                counts.append(n)
                again.append(r)
                sizes.append(len(k))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)),
                 batch.column("doc").take(pa.array(owner)), batch.column("row").take(pa.array(owner)),
                 pa.array(np.concatenate(starts).astype(np.int32)),
                 pa.array(np.concatenate(counts).astype(np.int32)), pa.array(np.concatenate(again))],
                names=["key", "doc", "row", "start", "n", "again"])

    return rows.mapInArrow(run, f"key bigint, {_PLACE}, again boolean")


def _merged(spans: DataFrame) -> DataFrame:
    """``doc, row, _from, _to``: spans (``a``, ``b``) of each row, touching ones joined."""
    grouped = spans.groupBy("doc", "row").agg(
        F.array_sort(F.collect_list(F.struct("a", "b"))).alias("s"))

    def run(batches):
        for batch in batches:
            begins, ends = [], []
            for spans in batch.column("s").to_pylist():
                a, b = [], []
                for s in spans:
                    if b and s["a"] <= b[-1]:
                        b[-1] = max(b[-1], s["b"])
                    else:
                        a.append(s["a"])
                        b.append(s["b"])
                begins.append(a)
                ends.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("row"), pa.array(begins, pa.list_(pa.int32())),
                 pa.array(ends, pa.list_(pa.int32()))], names=["doc", "row", "_from", "_to"])

    return grouped.mapInArrow(run, "doc bigint, row bigint, _from array<int>, _to array<int>")


def _cut_passages(rows: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """Words of the passages whose windows lie in a row's spans."""
    joined = attach(rows, spans, ["doc", "row"], "repeated-spans", "inner", list_column="_from")

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out: list[tuple] = []
            for doc, row, text, begins, ends in zip(*(batch.column(c).to_pylist() for c in (
                    "doc", "row", "text", "_from", "_to"))):
                words = text.split()
                keys, starts, counts, _ = passages(_word_hashes(words), window)
                span = np.searchsorted(begins, starts, "right") - 1
                wanted = (span >= 0) & (starts < np.array(ends)[np.maximum(span, 0)])
                for key, start, n in zip(keys[wanted].view(np.int64).tolist(),
                                         starts[wanted].tolist(), counts[wanted].tolist()):
                    body = b" ".join(words[start:start + n + window - 1])
                    out.append((key, xxhash.xxh64_intdigest(body) - (1 << 63), doc, row, start, n, body))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            for k in range(0, len(out) or 1, 20_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in out[k:k + 20_000]], t) for c, t in enumerate(types)],
                    names=["key", "body_id", "doc", "row", "start", "n", "body"])

    return joined.select("doc", "row", "text", "_from", "_to").mapInArrow(
        cut, f"key bigint, body_id bigint, {_PLACE}, body binary")


def _finer_passages(first: DataFrame, window: int, depth: int | None) -> DataFrame:
    """Passages cut where the ``depth`` smallest hashes of a window change, or any of its words."""
    size = min(GROUP, window)

    def cut(batches) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
        names = ["key", "body_id", "doc", "row", "start", "n", "body", "again"]
        for batch in pieces(batches, "body", 1 << 18):
            out: list[tuple] = []
            for doc, row, start, body in zip(*(batch.column(c).to_pylist() for c in (
                    "doc", "row", "start", "body"))):
                words = body.split(b" ")
                hashes = _word_hashes(words)
                whole = _group_hashes(hashes, window)
                keys = whole
                if depth is not None:
                    groups = np.lib.stride_tricks.sliding_window_view(
                        _group_hashes(hashes, size), window - size + 1)
                    least = np.sort(groups, axis=1)[:, :depth]
                    keys = _group_hashes(least.ravel(), least.shape[1])[::least.shape[1]]
                starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist()
                for a, b in zip(starts, [*starts[1:], len(keys)]):
                    part = b" ".join(words[a:b + window - 1])
                    out.append((int(keys[a].view(np.int64)), xxhash.xxh64_intdigest(part) - (1 << 63), doc, row,
                                start + a, b - a, part, len(np.unique(whole[a:b])) < b - a))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], t) for c, t in enumerate(types)], names=names)

    return first.select("first.*", "body").mapInArrow(
        cut, f"key bigint, body_id bigint, {_PLACE}, body binary, again boolean")


def _shard_spans(table: pa.Table, window: int) -> pa.Table:
    """Windows of the shard's passages that start earlier in one of them, as spans."""
    bodies = [b.split(b" ") for b in table["body"].to_pylist()]
    hashes = _word_hashes([w for b in bodies for w in b])
    sizes = np.array([len(b) for b in bodies])
    firsts = np.cumsum(sizes) - sizes
    inside = np.arange(len(hashes)) - np.repeat(firsts, sizes)
    # order of all places: document, row, position
    doc, row, start = (table[c].to_numpy() for c in ("doc", "row", "start"))
    place = np.stack([np.repeat(doc, sizes), np.repeat(row, sizes), np.repeat(start, sizes) + inside])
    order = np.lexsort(place[::-1])
    step = np.concatenate([[0], (np.diff(place[:, order], axis=1) != 0).any(axis=0)])
    rank = np.empty(len(hashes), np.int64)
    rank[order] = np.cumsum(step)
    # the passages, a zero after each
    symbols = np.unique(hashes, return_inverse=True)[1] + 1
    spot = np.arange(len(hashes)) + np.repeat(np.arange(len(sizes)), sizes)
    text = np.zeros(len(hashes) + len(sizes), np.int64)
    ranks = np.full(len(text), len(hashes), np.int64)
    text[spot], ranks[spot] = symbols, rank
    found = [np.empty(0, np.int64)] * 2
    if len(text):
        index = FMIndex(text, window)
        windows = np.flatnonzero(inside + window <= np.repeat(sizes, sizes))
        which, low, high = index.windows(symbols, windows, window, np.ones(len(windows), np.int64))
        # windows are as long as the sort is deep: their intervals are equal or disjoint
        lows, back = np.unique(low, return_inverse=True)
        if len(lows):
            highs = np.zeros(len(lows), np.int64)
            highs[back] = high
            sorted_ranks = ranks[index.places]
            edges = np.stack([lows, highs], axis=1).ravel()
            earliest = np.minimum.reduceat(np.append(sorted_ranks, len(hashes)), edges)[::2]
            early = windows[which[earliest[back] < rank[windows[which]]]]
            early.sort()
            cut = np.flatnonzero(np.concatenate(
                [[True], (np.diff(early) != 1) | (inside[early[1:]] == 0)])) if len(early) else early
            ends = np.append(cut[1:], len(early)) - 1 if len(early) else early
            found = [early[cut], early[ends]] if len(early) else found
    part = np.searchsorted(firsts, found[0], "right") - 1
    begin = start[part] + inside[found[0]]
    return pa.table({"doc": pa.array(doc[part], pa.int64()), "row": pa.array(row[part], pa.int64()),
                     "a": pa.array(begin, pa.int32()),
                     "b": pa.array(begin + (found[1] - found[0]) + window, pa.int32())})


def _first_passages(found: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """``key, body_id, first, body`` of distinct passages, and the spans of their later copies."""
    body = ["key", "body_id"]
    place = F.struct("doc", "row", "start")
    first = found.groupBy(*body).agg(F.min(place).alias("first"), F.any_value("body").alias("body"))
    first = materialize(first, "first-passages")
    later = found.select(*body, "doc", "row", "start", "n").join(
        first.select(*body, "first"), body).where(place != F.col("first")).select(
        "doc", "row", F.col("start").alias("a"), (F.col("start") + F.col("n") + window - 1).alias("b"))
    return first, later


def repeated_spans(rows: DataFrame, window: int, shard_words: int = SHARD_WORDS,
                   key_passages: int = KEY_PASSAGES) -> DataFrame:
    """``doc, row, a, b``: words from ``a`` up to ``b`` are covered by windows seen earlier.

    ``rows`` has ``doc`` (order of the documents), ``row`` (tells rows of one document
    apart) and ``text`` (binary).
    """
    listed = _list_passages(rows, window)
    twice = listed.groupBy("key").agg(F.count(F.lit(1)).alias("count"), F.max("again").alias("again"))
    twice = twice.where((F.col("count") > 1) | F.col("again")).select("key")
    repeated = listed.join(twice, "key", "left_semi").select(
        "doc", "row", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))
    found = materialize(_cut_passages(rows, _merged(repeated), window), "passages")
    first, later = _first_passages(found, window)
    spans, dealt = [later], []
    for depth in FINER:
        counts = first.groupBy("key").agg(F.count(F.lit(1)).alias("count"))
        full = materialize(counts.where(F.col("count") > key_passages).select("key"), "full-keys")
        if not full.head(1):
            break
        dealt.append(attach(first, full, "key", "full-keys", "left_anti", row_bytes=32))
        finer = materialize(_finer_passages(
            attach(first, full, "key", "full-keys", "left_semi", row_bytes=32), window, depth), "finer-passages")
        # counted with their copies: all of a hash that occurs once have nothing to find
        common = finer.groupBy("key").agg(F.count(F.lit(1)).alias("count"), F.max("again").alias("again")).where(
            (F.col("count") > 1) | F.col("again")).select("key")
        first, later = _first_passages(finer.join(common, "key", "left_semi"), window)
        spans.append(later)
    sent = first
    for table in dealt:
        sent = sent.unionByName(table)
    size = sent.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = max(1, -(-size // (6 * shard_words)))
    sent = sent.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "first.*", "body")
    spans.append(sent.groupBy("shard").applyInArrow(
        lambda table: _shard_spans(table, window), "doc bigint, row bigint, a int, b int"))
    out = spans[0]
    for table in spans[1:]:
        out = out.unionByName(table)
    return out


def drop_repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           window: int = 20, **limits: int) -> DataFrame:
    """``doc_id, text, n_words, n_removed``: texts without words that a seen window covers.

    A window is seen if its words also start earlier: in a document with a smaller id, or
    earlier in the same one. All windows are judged on the input. The kept words are joined by
    one space.

    Words are told apart by 64-bit hashes. A NULL text has no words and gives an empty text.
    Rows with a NULL id come after all others, in the order of their text's hash, as do rows
    that share an id; rows equal in both are one document and lose the same words.
    An empty table gives no rows.
    """
    rows = small_batches(df).select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("doc"),
        F.xxhash64(F.col(id_col).isNull(), F.col(text_col)).alias("row"),
        F.col(text_col).cast("binary").alias("text"))
    spans = _merged(repeated_spans(rows.drop("doc_id"), window, **limits))
    joined = attach(rows, spans, ["doc", "row"], "seen-spans", list_column="_from")

    def run(batches):
        for batch in pieces(batches, "text"):
            texts, totals, removed = [], [], []
            for text, begins, ends in zip(*(batch.column(c).to_pylist() for c in (
                    "text", "_from", "_to"))):
                words = (text or b"").split()
                kept, at = [], 0
                for a, b in zip(begins or (), ends or ()):
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                texts.append(b" ".join(kept).decode())
                totals.append(len(words))
                removed.append(len(words) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(totals, pa.int64()),
                 pa.array(removed, pa.int64())], names=["doc_id", "text", "n_words", "n_removed"])

    return joined.select("doc_id", "text", "_from", "_to").mapInArrow(
        run, "doc_id bigint, text string, n_words bigint, n_removed bigint")

"""Alignment of the tokens of two tokenizers over the same bytes.

Every token ends at a byte of the text. Where tokens of both tokenizers end at the same byte,
both sequences are cut into a group. The common ends are found by galloping: the tokenizer with fewer
tokens drives, and each of its ends is searched in the longer list by steps that double and then a
binary search. The rank found for an end, less the rank found for the end before, is the range of tokens that a
token overlaps: its links.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.tokens import Encoder
from emberfold.llm.worker import attach, id_arrays, once, pieces, small_batches
from emberfold.storage import materialize

# Text whose pairs of ids are counted together; a longer text is counted by itself.
CHUNK_BYTES = 6 << 20
# Characters encoded at a time, as repeated words are encoded once, and aligned at a time. A text that is
# longer than the latter is cut where both tokenizers must cut.
ENCODE_CHARS, SLICE_CHARS = 4 << 20, 1 << 20
# Words remembered per Python worker, and their length at most.
MEMO_WORDS, MEMO_CHARS = 250_000, 64

# Pairs of a long text that are held before equal ones are merged.
_HELD_PAIRS = 4 << 20
_SPACE = "▁"
_WORD = re.compile(" +[^ ]*")
# A space between visible characters: a word begins there for both kinds of tokenizers.
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Ends of the shorter list are searched coarse ones first, each level so many times finer.
_STRIDES, _FINER = (64, 16, 4, 1), 4


class Pieces:
    """Ids of texts by a sentencepiece model, each distinct word encoded once.

    No piece of such a model joins a visible character with the space after it, which is checked, so words that
    begin with their spaces are encoded alone with the same ids. Other models encode whole texts.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = model = SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_SPACE, " ").encode()
                      for i, p in enumerate(names)]
        probe = b"".join(self.bytes[i] for i in model.encode("a  b \n"))
        self.cuts = probe == b" a  b \n" and not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in names)
        # a last space alone; the model returns nothing for an empty text
        self.words = {" ": array("I", [model.piece_to_id(_SPACE)]).tobytes()}

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each distinct word, given with its spaces; one of them is the model's own."""
        known = self.words
        out = list(map(known.get, words))
        misses = [k for k, ids in enumerate(out) if ids is None]
        coded = self.model.encode([words[k][1:] for k in misses], num_threads=1)
        room = MEMO_WORDS - len(known)
        for n, (k, ids) in enumerate(zip(misses, coded)):
            out[k] = array("I", ids).tobytes()
            if n < room and len(words[k]) <= MEMO_CHARS:
                known[words[k]] = out[k]
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, given without the space that the model puts before it."""
        if not self.cuts:
            return [np.array(ids, "<u4") for ids in self.model.encode(texts.to_pylist(), num_threads=1)]
        spaced = pc.binary_join_element_wise("", texts, " ")  # a space and the text
        lists = pc.split_pattern(spaced, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = lists.flatten().dictionary_encode()
        index = coded.indices.to_numpy()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        blobs = self._ids([" " + w for w in words])
        # what split puts before a text is not of the text
        inner = np.ones(len(index), bool)
        inner[offsets[:-1]] = False
        out = gathered(blobs, index[inner], np.diff(offsets) - 1)
        # spaces that follow each other belong to the word behind them
        runs = pc.or_(pc.match_substring(spaced, "  "), pc.ends_with(spaced, " "))
        for k in np.flatnonzero(runs.to_numpy(zero_copy_only=False)):
            found = _WORD.findall(" " + texts[int(k)].as_py())
            distinct = list(set(found))
            ids = dict(zip(distinct, self._ids(distinct)))
            out[k] = np.frombuffer(b"".join([ids[w] for w in found]), "<u4")
        return out


def gathered(blobs: list[bytes], index: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The ids of the blobs at ``index``, in lists of ``sizes`` blobs."""
    lengths = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
    starts = np.cumsum(lengths) - lengths
    ids = np.frombuffer(b"".join(blobs), "<u4")
    n = lengths[index]
    ends = np.cumsum(n)
    flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[index] - (ends - n), n)]
    return np.split(flat, np.concatenate([[0], ends])[np.cumsum(sizes)][:-1])


@dataclass
class Pair:
    """Both tokenizers, the bytes of their tokens and how many ids they have."""

    path_a: str
    path_b: str

    def __post_init__(self):
        self.a, self.b = Encoder(self.path_a), Pieces(self.path_b)
        self.a.tokenizer.encode_special_tokens = True
        shown = {c: b for b, c in self.a.table.items()}
        size = self.a.tokenizer.get_vocab_size()
        names = [self.a.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [b"".join(bytes([shown[c]]) if c in shown else c.encode("latin-1", "replace")
                                 for c in name) for name in names]
        self.bytes_b = self.b.bytes
        self.sizes_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(t) for t in self.bytes_b], np.int64)
        # an id's digits behind a comma, and behind the mark that begins a group or its second half
        self.digits = [b"%b%d" % (mark, i) for n, first in ((size, b";"), (len(self.bytes_b), b"|"))
                       for i in range(n) for mark in (b",", first)]

    @property
    def width(self) -> int:
        return len(self.bytes_b)


def tokenizers(path_a: str, path_b: str) -> Pair:
    return once(("token-pair", path_a, path_b), lambda: Pair(path_a, path_b))


def search(keys: np.ndarray, into: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each key the first place, from its ``low`` on, whose entry reaches the key.

    Exponential steps find a range, a binary search the place in it; for all keys side by side. The last
    entry of ``into`` reaches every key.
    """
    low, high, step = low.copy(), low.copy(), 1
    live = np.flatnonzero(into[low] < keys)
    while len(live):
        at = high[live]
        low[live] = at + 1
        at = np.minimum(at + step, len(into) - 1)
        high[live] = at
        live = live[into[at] < keys[live]]
        step *= 2
    live = np.flatnonzero(low < high)
    while len(live):
        a, b = low[live], high[live]
        middle = (a + b) >> 1
        less = into[middle] < keys[live]
        a, b = np.where(less, middle + 1, a), np.where(less, b, middle)
        low[live], high[live] = a, b
        live = live[a < b]
    return low


def gallop(keys: np.ndarray, into: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first place in ``into`` that reaches each of the ascending ``keys``.

    The keys lie in runs of ``sizes``; a run's search begins at its place in ``begins``. Every 64th key is
    searched from there, then every 16th, every fourth and all others, each from the nearest key that was
    found before it.
    """
    place = np.repeat(begins, sizes)
    rank = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for stride in _STRIDES:
        below = stride * _FINER - 1
        if stride == _STRIDES[0]:
            at = np.flatnonzero(rank % stride == 0)
            low = place[at]
        else:
            at = np.flatnonzero((rank % stride == 0) & (rank & below > 0))
            low = place[at - (rank[at] & below)]
        place[at] = search(keys[at], into, low)
    return place


@dataclass
class Aligned:
    """Tokens of some texts one after the other, marked where groups end, with their links."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(ids_a: list[np.ndarray], ids_b: list[np.ndarray], sizes_a: np.ndarray,
          sizes_b: np.ndarray) -> Aligned:
    """Groups and links of texts, whose tokens have the same bytes in both lists."""
    n_a, n_b = (np.array([len(i) for i in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.concatenate(ids).astype(np.int64) if ids else np.empty(0, np.int64) for ids in (ids_a, ids_b))
    # the texts lie one behind the other, so that all ends ascend
    ends = np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b])
    counts = n_a, n_b
    begins = [np.cumsum(n) - n for n in counts]
    marks = [np.zeros(len(e), bool) for e in ends]
    links = []
    a_drives = n_a <= n_b
    for short, long, drives in ((0, 1, a_drives), (1, 0, ~a_drives)):
        runs = np.where(drives, counts[short], 0)
        if not runs.any():
            continue
        index = np.flatnonzero(np.repeat(drives, counts[short]))
        keys = ends[short][index]
        place = gallop(keys, ends[long], begins[long], runs)
        common = ends[long][place] == keys
        marks[short][index[common]] = True
        marks[long][place[common]] = True
        # a token overlaps what lies between the rank of the end before and its own
        first = np.roll(place + common, 1)
        first[(np.cumsum(runs) - runs)[runs > 0]] = begins[long][runs > 0]
        n = place - first + 1
        total = np.cumsum(n)
        other = np.arange(total[-1]) - np.repeat(total - n - first, n)
        pair = (np.repeat(index, n), other)
        links.append(pair if short == 0 else pair[::-1])
    none = np.empty(0, np.int64)
    link_a, link_b = (np.concatenate([pair[k] for pair in links] or [none]) for k in (0, 1))
    return Aligned(a, b, n_a, n_b, marks[0], marks[1], link_a, link_b)


def slices(text: str, size: int = SLICE_CHARS) -> list[str]:
    """A text in parts that both tokenizers encode alone as within the whole.

    All but the first are given without the space they begin with.
    """
    out, first = [], 0
    while len(text) - first > size:
        cut = _CUT.search(text, first + size - 1)
        if cut is None:
            break
        out.append(text[first:cut.start()])
        first = cut.end()
    return out + [text[first:]]


def _batches(parts: list[tuple[int, str]], size: int) -> Iterator[range]:
    """Places of parts that hold about ``size`` characters together."""
    first, chars = 0, 0
    for k, (_, part) in enumerate(parts):
        chars += len(part) + 1
        if chars >= size:
            yield range(first, k + 1)
            first, chars = k + 1, 0
    if first < len(parts):
        yield range(first, len(parts))


def aligned_batches(texts: list[str | None], pair: Pair, size: int = SLICE_CHARS):
    """``owners, aligned, wrong``: parts of texts aligned, whose part each is, texts found to differ."""
    parts = [(i, part) for i, text in enumerate(texts) if text for part in slices(text, size)]
    for some in _batches(parts, max(size, ENCODE_CHARS)):
        held = parts[some.start:some.stop]
        column = pa.array([part for _, part in held], pa.string())
        ids_a = pair.a.encode(pc.binary_join_element_wise("", column, " "))
        ids_b = pair.b.encode(column)
        for batch in _batches(held, size):
            keep, wrong = [], []
            for k in batch:
                want = (" " + held[k][1]).encode()
                same = all(b"".join(map(names.__getitem__, ids[k].tolist())) == want
                           for names, ids in ((pair.bytes_a, ids_a), (pair.bytes_b, ids_b)))
                (keep if same else wrong).append(k)
            yield (np.array([held[k][0] for k in keep], np.int64),
                   align([ids_a[k] for k in keep], [ids_b[k] for k in keep], pair.sizes_a, pair.sizes_b),
                   [held[k][0] for k in wrong])


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _listing(found: Aligned, pair: Pair) -> list[bytes]:
    """The groups of each part in digits, every group behind a semicolon."""
    firsts = []
    for ends in (found.end_a, found.end_b):
        begin = np.ones(len(ends), bool)
        begin[1:] = ends[:-1]
        firsts.append(begin)
    group_a, group_b = (np.cumsum(f) - 1 for f in firsts)
    starts_a, ends_b = np.flatnonzero(firsts[0]), np.flatnonzero(found.end_b) + 1
    after_a = np.append(starts_a[1:], len(found.a))
    before_b = np.concatenate([[0], ends_b[:-1]]) if len(ends_b) else ends_b
    codes = np.empty(len(found.a) + len(found.b), np.int64)
    codes[np.arange(len(found.a)) + before_b[group_a]] = found.a * 2 + firsts[0]
    codes[np.arange(len(found.b)) + after_a[group_b]] = (found.b + len(pair.bytes_a)) * 2 + firsts[1]
    digits = list(map(pair.digits.__getitem__, codes.tolist()))
    ends = np.cumsum(found.n_a + found.n_b).tolist()
    return [b"".join(digits[x:y]) for x, y in zip([0, *ends], ends)]


def token_groups(df: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, a, b, ends_a, ends_b``: ids of both tokenizers and where each group ends in them.

    ``tokenizer_a`` is a byte-level file of the tokenizers library, whose tokens are those of a space and the text;
    ``tokenizer_b`` a sentencepiece model, which puts that space itself. Strings of special tokens are plain
    text. Group g holds the tokens from ``ends[g - 1]`` up to ``ends[g]``. A text that is NULL or empty, or
    whose tokens' bytes differ from the space and the text, has empty lists. One row per row, whatever its
    id; an empty table gives none.
    """
    rows = small_batches(df).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        pair = tokenizers(tokenizer_a, tokenizer_b)
        for batch in pieces(batches, "text"):
            texts = batch.column("text").to_pylist()
            parts = [([], [], [0], [0]) for _ in texts]
            lost = set()
            for owners, found, wrong in aligned_batches(texts, pair):
                lost.update(wrong)
                at_a, at_b = np.cumsum(found.n_a) - found.n_a, np.cumsum(found.n_b) - found.n_b
                for k, i in enumerate(owners):
                    for column, ids, marks, at, n in ((0, found.a, found.end_a, at_a[k], found.n_a[k]),
                                                      (1, found.b, found.end_b, at_b[k], found.n_b[k])):
                        part, before = parts[i], sum(map(len, parts[i][column]))
                        part[column].append(ids[at:at + n])
                        part[column + 2].extend((np.flatnonzero(marks[at:at + n]) + before + 1).tolist())
            none = np.empty(0, np.int64)
            cells = [[none if i in lost else np.concatenate([none, *p[c]]) if c < 2 else np.array(p[c][1:], np.int64)
                      for i, p in enumerate(parts)] for c in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(id_arrays, cells)],
                                             names=["doc_id", "a", "b", "ends_a", "ends_b"])

    return rows.mapInArrow(run, "doc_id bigint, a array<int>, b array<int>, ends_a array<int>, ends_b array<int>")


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_CHUNK = ("chunk bigint, ids array<bigint>, " + ", ".join(f"{c} array<bigint>" for c in _COUNTS)
          + ", groups array<string>, pairs array<bigint>, times array<bigint>, links binary")


def _packed(numbers: list[np.ndarray]) -> bytes:
    """Lists of small numbers, compressed by byte planes; each behind its length."""
    planes = [np.concatenate([np.array([len(v)], "<u4"), v.astype("<u4")]).view(np.uint8).reshape(-1, 4)
              for v in numbers]
    raw = b"".join(np.ascontiguousarray(p.T).tobytes() for p in planes)
    head = np.array([len(p) for p in planes], "<u8").tobytes()
    return np.array([len(planes), len(raw)], "<u8").tobytes() + head + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    n, size = np.frombuffer(data, "<u8", 2).astype(int)
    lengths = np.frombuffer(data, "<u8", n, 16).astype(int)
    raw = np.frombuffer(pa.decompress(data[16 + 8 * n:], int(size), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for length in lengths:
        plane = np.ascontiguousarray(raw[at:at + 4 * length].reshape(4, length).T)
        out.append(plane.view("<u4").ravel()[1:].astype(np.int64))
        at += 4 * length
    return out


def _merged(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their times."""
    if len(keys) == 1:
        return keys[0], times[0]
    found, place = np.unique(np.concatenate([np.empty(0, np.int64), *keys]), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, np.concatenate([np.empty(0, np.int64), *times]))
    return found, total


def _chunk(texts: list[str | None], pair: Pair) -> tuple[np.ndarray, list[str], tuple]:
    """Counts and digests of texts, and their distinct links as ``(text and pair, times)``."""
    counts = np.zeros((len(texts), len(_COUNTS)), np.int64)
    digests, lost, keys, times = {}, set(), [], []
    top = len(pair.bytes_a) * pair.width
    for owners, found, wrong in aligned_batches(texts, pair):
        lost.update(wrong)
        groups = _sums(found.end_a, found.n_a)
        np.add.at(counts, owners, np.stack(
            [found.n_a, found.n_b, groups, found.n_a + found.n_b - groups], axis=1))
        for i, listing in zip(owners.tolist(), _listing(found, pair)):
            if i in digests:
                digests[i].update(listing)
            else:
                digests[i] = hashlib.sha256(listing[1:])
        owner = np.repeat(owners, found.n_a)[found.link_a]
        key, n = np.unique(owner * top + found.a[found.link_a] * pair.width + found.b[found.link_b],
                           return_counts=True)
        keys.append(key)
        times.append(n)
        if sum(map(len, keys)) > _HELD_PAIRS:
            keys, times = ([merged] for merged in _merged(keys, times))
    key, n = _merged(keys, times)
    if lost:
        counts[list(lost)] = 0
        keep = ~np.isin(key // top, list(lost))
        key, n = key[keep], n[keep]
    listed = [digests[i].hexdigest() if i in digests and i not in lost else "" for i in range(len(texts))]
    return counts, listed, (key // top, key % top, n)


def align_documents(df: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id",
                    text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per text with its groups, its links and how usual they are in the whole table.

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. A pair of ids counts as often as
    any link of the table holds it. ``n_best`` are the links whose pair has the highest count of
    its second id, ties included, ``count_sum`` sums the counts over the links. ``groups_sha256`` is the digest of
    the groups in digits, ``a1,a2|b1;a3|b2,b3``, or empty for a text without tokens.

    Texts are tokenized once, as for :func:`token_groups`, and written in chunks of bounded size with the
    chunk's distinct pairs. The pairs of chunks, not the links, are summed and joined back as rows. A
    text that is NULL or empty, or whose tokens' bytes differ, has zeros. Repeated and NULL ids stay
    separate rows; an empty table gives none.
    """
    rows = small_batches(df).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def chunks(batches):
        pair = tokenizers(tokenizer_a, tokenizer_b)
        name = TaskContext.get().partitionId() << 33
        for batch in pieces(batches, "text", chunk_bytes):
            counts, listed, (owner, code, n) = _chunk(batch.column("text").to_pylist(), pair)
            pairs, place = np.unique(code, return_inverse=True)
            times = np.zeros(len(pairs), np.int64)
            np.add.at(times, place, n)
            # a text's distinct pairs as gaps between their places in the chunk
            sizes = np.bincount(owner, minlength=len(listed))
            gaps = np.diff(place, prepend=0)
            heads = (np.cumsum(sizes) - sizes)[sizes > 0]
            gaps[heads] = place[heads]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), *[pa.array([c], pa.list_(pa.int64())) for c in (
                    batch.column("doc_id").to_pylist(), *counts.T)],
                 pa.array([listed], pa.list_(pa.string())),
                 *[pa.array([c], pa.list_(pa.int64())) for c in (pairs, times)],
                 pa.array([_packed([sizes, gaps, n])], pa.binary())],
                names=["chunk", "ids", *_COUNTS, "groups", "pairs", "times", "links"])
            name += 1

    width = tokenizers(tokenizer_a, tokenizer_b).width
    stored = materialize(rows.mapInArrow(chunks, _CHUNK), "aligned-chunks")
    asked = stored.select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "_p")).select(
        "chunk", "place", F.col("_p.pairs").alias("pair"), F.col("_p.times").alias("times"))
    counts = materialize(asked.groupBy("pair").agg(F.sum("times").alias("n")).withColumn(
        "b", F.col("pair") % width), "pair-counts")
    # one row per id of the second vocabulary at most
    best = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("most")))
    rated = counts.join(best, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("is_best"))
    answers = attach(asked.drop("times"), rated, "pair", "rated-pairs", row_bytes=32).groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("place", "n", "is_best"))).alias("answers"))
    answered = stored.drop("pairs", "times").join(answers, "chunk", "left").select(
        "ids", *_COUNTS, "groups", "links", F.col("answers.n").alias("n"), F.col("answers.is_best").alias("best"))

    def rate(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                flat = [row.column(c).flatten() for c in range(len(row.schema)) if c != 6]
                sizes, gaps, times = _unpacked(row.column(6)[0].as_py())
                place = np.cumsum(gaps)
                before = np.concatenate([[0], place])[np.cumsum(sizes) - sizes]
                place -= np.repeat(before, sizes)
                n, best = (flat[k].to_numpy(zero_copy_only=False) for k in (6, 7))
                yield pa.RecordBatch.from_arrays(
                    [*flat[:5], pa.array(_sums(times * best[place].astype(bool), sizes)),
                     pa.array(_sums(times * n[place].astype(np.int64), sizes)), flat[5]],
                    names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    return answered.mapInArrow(rate, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
                               + ", n_best bigint, count_sum bigint, groups_sha256 string")

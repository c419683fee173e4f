"""Line dedup by log templates.

A line's words are parsed along a tree of fixed depth: the number of words, then the
leading words, with words that hold a digit as a variable field. Lines of a leaf that agree
in most places share a template, in which the places that differ become
variable fields too. Templates that recur across documents are dropped.

A leaf may hold any number of lines. Lines that agree in enough places differ in few, so of
one block of places more than these they share one: a leaf finds a line's templates by such blocks, and of
a full leaf only the lines that share a block with another are moved at all.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.worker import attach, pieces, small_batches
from emberfold.storage import materialize

FIELD = b"<*>"
DEPTH = 3
# Distinct lines of a leaf that are all moved; of a fuller one those without company stay.
LEAF_LINES = 2_000
# Templates of a leaf that are all compared; more are looked up by their blocks.
FEW_TEMPLATES = 64
_DIGIT = re.compile(rb"[0-9]").search


def parse(line: bytes) -> list[bytes]:
    """Words of a line, variable fields masked."""
    words = line.split()
    return [FIELD if _DIGIT(w) else w for w in words] if _DIGIT(line) else words


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) - (1 << 63)


def line_key(words: list[bytes]) -> int:
    return _hash(b" ".join(words))


def _leaf(words: list[bytes]) -> int:
    return _hash(b"%d " % len(words) + b" ".join(words[:DEPTH]))


def blocks(count: int, similarity: float) -> list[tuple[int, int]]:
    """Ranges of a line's places, one of which lines that agree in enough places share.

    The leading words, equal in a leaf, are in none. Empty if there are too few places.
    """
    parts = count - math.ceil(similarity * count) + 1
    edges = [DEPTH + (count - DEPTH) * k // parts for k in range(parts + 1)]
    return list(zip(edges, edges[1:])) if count - DEPTH >= parts else []


class Leaf:
    """Templates of one leaf; lines must come in a fixed order."""

    def __init__(self, similarity: float):
        self.similarity = similarity
        self.rows = np.empty((0, 0), np.uint64)
        self.keys: list[int] = []
        self.blocks: list[tuple[int, int]] = []
        self.held: dict[tuple[int, bytes], list[int]] | None = None

    def _note(self, number: int, changed: np.ndarray | None = None) -> None:
        """Have the template found by its blocks, or those with changed places."""
        for a, b in self.blocks:
            if changed is None or changed[a:b].any():
                self.held.setdefault((a, self.rows[number, a:b].tobytes()), []).append(number)

    def _alike(self, line: np.ndarray) -> np.ndarray:
        """Numbers, rising, of all templates that may take the line in."""
        count = len(self.keys)
        if self.held is None and count > FEW_TEMPLATES:
            self.held, self.blocks = {}, blocks(len(line), self.similarity)
            for number in range(count):
                self._note(number)
        if not self.blocks:
            return np.arange(count)
        found = [self.held.get((a, line[a:b].tobytes()), ()) for a, b in self.blocks]
        return np.unique(np.concatenate([np.array(f, np.int64) for f in found]))

    def add(self, key: int, words: list[bytes]) -> int:
        """The key of the template that takes the line in, the line's own if it is the first.

        The template that agrees in the largest share of places, the oldest of equals,
        takes it if that share reaches ``similarity``; variable fields (zero) agree with
        fields only.
        """
        line = np.array([0 if w == FIELD else xxhash.xxh64_intdigest(w) | 1 for w in words], np.uint64)
        if self.keys:
            alike = self._alike(line)
            if len(alike):
                same = (self.rows[alike] == line).sum(axis=1)
                best = int(same.argmax())
                if same[best] >= self.similarity * len(words):
                    number = int(alike[best])
                    row = self.rows[number]
                    changed = (row != line) & (row != 0)
                    row[changed] = 0
                    self._note(number, changed)
                    return self.keys[number]
        else:
            self.rows = np.empty((4, len(words)), np.uint64)
        if len(self.keys) == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[len(self.keys)] = line
        self.keys.append(key)
        self._note(len(self.keys) - 1)
        return key


def line_table(df: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    """``doc_id, line, leaf``: the distinct masked lines of each row, as hashes.

    Lines so short that they must agree in all places have no leaf.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for batch in pieces(batches, "text"):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(),
                                 batch.column("text").to_pylist()):
                seen = set()
                for line in (text or b"").split(b"\n"):
                    words = parse(line)
                    key = line_key(words)
                    if words and key not in seen:
                        seen.add(key)
                        out.append((doc, key, _leaf(words) if similarity * len(words) <= len(words) - 1
                                    else None))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], pa.int64()) for k in range(3)],
                names=["doc_id", "line", "leaf"])

    return rows.mapInArrow(run, "doc_id bigint, line bigint, leaf bigint")


def _words_of(df: DataFrame, lines: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_leaf, line, first_doc, words`` of ``lines``, read again from their first documents."""
    wanted = lines.groupBy(F.col("first_doc").alias("_doc")).agg(
        F.collect_list("line").alias("_lines"), F.collect_list("_leaf").alias("_leaves"))
    rows = df.select(F.col(id_col).cast("bigint").alias("_doc"),
                     F.col(text_col).cast("binary").alias("text"))
    joined = attach(rows, wanted, "_doc", "wanted-lines", "inner", list_column="_lines", entry_bytes=16)

    def run(batches):
        for batch in pieces(batches, "text"):
            out: list[tuple] = []
            for doc, text, keys, leaves in zip(*(batch.column(c).to_pylist() for c in (
                    "_doc", "text", "_lines", "_leaves"))):
                leaf_of = dict(zip(keys, leaves))
                for line in (text or b"").split(b"\n"):
                    words = parse(line)
                    leaf = leaf_of.pop(line_key(words), None)
                    if leaf is not None:
                        out.append((leaf, line_key(words), doc, b" ".join(words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate(
                    [pa.int64(), pa.int64(), pa.int64(), pa.binary()])],
                names=["_leaf", "line", "first_doc", "words"])

    return joined.select("_doc", "text", "_lines", "_leaves").mapInArrow(
        run, "_leaf bigint, line bigint, first_doc bigint, words binary")


def _with_company(words: DataFrame, similarity: float) -> DataFrame:
    """Rows of ``_leaf, line, first_doc, words`` that may share a template with another.

    Without a field of its own, a line agrees with a template where it agrees with the
    template's first line, so it shares a block with that one. Lines with a field all stay.
    """
    def run(batches):
        for batch in pieces(batches, "words"):
            out: list[tuple] = []
            for leaf, key, line in zip(*(batch.column(c).to_pylist() for c in ("_leaf", "line", "words"))):
                parts = line.split(b" ")
                places = blocks(len(parts), similarity)
                always = FIELD in parts or not places
                out += [(key, _hash(b"%d %d " % (leaf, a) + b" ".join(parts[a:b])), always)
                        for a, b in places or [(0, 0)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], t) for k, t in enumerate([pa.int64(), pa.int64(), pa.bool_()])],
                names=["line", "block", "always"])

    keyed = words.mapInArrow(run, "line bigint, block bigint, always boolean")
    common = keyed.groupBy("block").agg(F.min("line").alias("_a"), F.max("line").alias("_b")).where(
        F.col("_a") < F.col("_b"))
    company = keyed.join(common, "block", "left").where(
        F.col("always") | F.col("_a").isNotNull()).select("line").distinct()
    return words.join(company, "line", "left_semi").select(*words.columns)


def line_templates(df: DataFrame, lines: DataFrame, id_col: str, text_col: str, similarity: float,
                   leaf_lines: int) -> DataFrame:
    """``line, template`` for each distinct masked line; ``lines`` has one row per line."""
    # only leaves with company need the words of their lines
    sizes = lines.where(F.col("leaf").isNotNull()).groupBy("leaf").agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") > 1)
    sizes = materialize(sizes, "leaf-sizes")
    shared = lines.join(sizes.select("leaf"), "leaf").select("line", "first_doc", F.col("leaf").alias("_leaf"))
    moved = _words_of(df, shared, id_col, text_col)
    full = sizes.where(F.col("_n") > leaf_lines).select(F.col("leaf").alias("_leaf"))
    if full.head(1):
        moved = materialize(moved, "leaf-words")
        of_full = attach(moved, full, "_leaf", "full-leaves", "left_semi", row_bytes=32)
        others = attach(moved, full, "_leaf", "full-leaves", "left_anti", row_bytes=32)
        moved = others.unionByName(_with_company(of_full, similarity))
    grouped = moved.repartition("_leaf").sortWithinPartitions("_leaf", "first_doc", "line")

    def run(batches) -> Iterator[pa.RecordBatch]:
        current, last, leaf = None, None, Leaf(similarity)
        for batch in pieces(batches, "words"):
            keys, found = [], []
            for name, key, words in zip(batch.column("_leaf").to_pylist(), batch.column("line").to_pylist(),
                                        batch.column("words").to_pylist()):
                if name != current:
                    current, last, leaf = name, None, Leaf(similarity)
                if key != last:  # rows that share the first id may both have the line
                    keys.append(key)
                    found.append(leaf.add(key, words.split(b" ")))
                last = key
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.int64())],
                                             names=["line", "template"])

    merged = grouped.mapInArrow(run, "line bigint, template bigint").where(
        F.col("line") != F.col("template"))
    return lines.select("line").join(merged, "line", "left").select(
        "line", F.coalesce("template", "line").alias("template"))


def drop_recurring_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_docs: int = 5, similarity: float = 0.8,
                         leaf_lines: int = LEAF_LINES, n_lines: str = "n_lines",
                         n_dropped: str = "n_dropped") -> DataFrame:
    """Every row of ``df`` with the lines of recurring templates removed from its text.

    A template recurs if lines of it stand in ``min_docs`` documents or more. The document
    with the smallest id keeps its lines of the template, so that no passage is lost altogether; all
    others drop theirs. Adds ``n_lines`` (with words) and ``n_dropped``.

    Blank lines stay where they are. A NULL text stays NULL and has no lines; a text all of
    whose lines go becomes empty. Rows that share an id count as one document and lose
    the same lines; rows with a NULL id count as none and lose nothing. Empty tables give no
    rows. ``n_lines``, ``n_dropped`` must be new names; other columns are carried along.
    """
    if {n_lines, n_dropped} & set(df.columns):
        raise ValueError(f"{n_lines} or {n_dropped} is a column already")
    known = small_batches(df).where(F.col(id_col).isNotNull())
    found = materialize(line_table(known, id_col, text_col, similarity), "lines")
    lines = materialize(found.groupBy("line", "leaf").agg(
        F.min("doc_id").alias("first_doc")), "distinct-lines")
    templates = materialize(line_templates(known, lines, id_col, text_col, similarity, leaf_lines),
                            "templates")
    uses = found.select("line", "doc_id").join(templates, "line")
    per_doc = uses.groupBy("template", "doc_id").agg(F.lit(1).alias("one"))
    recurring = per_doc.groupBy("template").agg(
        F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("keeper")).where(
        F.col("docs") >= min_docs)
    # stored, so that the planner may split a template with very many uses
    gone = attach(uses, recurring, "template", "recurring", "inner").where(
        F.col("doc_id") != F.col("keeper"))
    drops = gone.groupBy("doc_id").agg(F.collect_set("line").alias("_drops")).select(
        F.col("doc_id").alias("_doc"), "_drops")
    names = df.columns
    rows = df.withColumn("_doc", F.col(id_col).cast("bigint"))
    joined = attach(rows, drops, "_doc", "line-drops", list_column="_drops").select(*names, "_drops")
    schema = df.select("*", F.lit(0).alias(n_lines), F.lit(0).alias(n_dropped)).schema

    def apply(batches):
        for batch in pieces(batches, text_col):
            texts, totals, dropped = [], [], []
            for text, drops in zip(batch.column(text_col).to_pylist(),
                                   batch.column("_drops").to_pylist()):
                drops = set(drops or ())
                kept, n, gone = [], 0, 0
                for line in (text or "").split("\n"):
                    words = parse(line.encode())
                    n += bool(words)
                    if words and drops and line_key(words) in drops:
                        gone += 1
                    else:
                        kept.append(line)
                texts.append("\n".join(kept) if text is not None else None)
                totals.append(n)
                dropped.append(gone)
            columns = [pa.array(texts, batch.schema.field(text_col).type) if c == text_col
                       else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int32()), pa.array(dropped, pa.int32())],
                names=[*names, n_lines, n_dropped])

    return joined.mapInArrow(apply, schema)

"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberfold.llm.worker import pieces, small_batches

UNDETERMINED = "und"
# A text is read in windows of so many bytes, each from a fresh state; all bytes are read.
WINDOW = 256
_BATCH = 512
# How many times the rows that are drawn are ranked.
_SPARE = 4.0
# Windows held at a time, and the lengths they are filled to.
_WINDOWS, _FILL = 4_096, 64


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample and of the fit.

    ``docs_per_label`` documents of each of the ``max_labels`` most frequent labels, drawn
    by a hash of their id, give ``windows_per_doc`` windows of ``width`` bytes each, spread
    over the whole text.
    """

    docs_per_label: int = 600
    max_labels: int = 200
    windows_per_doc: int = 8
    width: int = 64
    hidden: int = 16
    steps: int = 250
    batch: int = 128
    rate: float = 0.01
    seed: int = 1


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Tagger:
    """One label distribution per byte position, from a forward and a backward GRU."""

    def __init__(self, labels: list[str], hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        draw = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
        self.weights = {
            "in0": draw(256, 3 * hidden), "rec0": draw(hidden, 3 * hidden),
            "in1": draw(256, 3 * hidden), "rec1": draw(hidden, 3 * hidden),
            "out": draw(2 * hidden, len(labels)), "bias": np.zeros(len(labels), np.float32)}

    def _run(self, x: np.ndarray, way: int, keep: list | None = None) -> np.ndarray:
        """States of one direction; ``x`` is (time, batch), read from its start."""
        h2 = 2 * self.hidden
        table, rec = self.weights[f"in{way}"], self.weights[f"rec{way}"]
        # gates as 0.5 * tanh(0.5 x) + 0.5, the inner half folded into the weights
        gate_in, new_in = table[:, :h2] * np.float32(0.5), np.ascontiguousarray(table[:, h2:])
        gate_rec, new_rec = rec[:, :h2] * np.float32(0.5), np.ascontiguousarray(rec[:, h2:])
        steps, batch = x.shape
        out = np.empty((steps, batch, self.hidden), np.float32)
        h = np.zeros((batch, self.hidden), np.float32)
        gates = np.empty((batch, h2), np.float32)
        new, left = np.empty_like(h), np.empty((batch, h2), np.float32)
        for t in range(steps):
            np.take(gate_in, x[t], axis=0, out=gates, mode="clip")
            np.matmul(h, gate_rec, out=left)
            gates += left
            np.tanh(gates, out=gates)
            gates *= np.float32(0.5)
            gates += np.float32(0.5)
            z, r = gates[:, :self.hidden], gates[:, self.hidden:]
            back = h @ new_rec
            np.take(new_in, x[t], axis=0, out=new, mode="clip")
            new += r * back
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((h, z.copy(), r.copy(), new.copy(), back))
            h = np.subtract(h, new)
            h *= z
            np.add(h, new, out=out[t])
            h = out[t]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(time, batch, label) for windows given as (time, batch) bytes."""
        half = self.hidden
        score = self._run(x, 0) @ self.weights["out"][:half]
        score += self._run(x[::-1], 1)[::-1] @ self.weights["out"][half:]
        score += self.weights["bias"]
        score -= score.max(axis=2, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(axis=2, keepdims=True)
        return score

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of the mean cross entropy over all positions."""
        w, half = self.weights, self.hidden
        kept: list[list] = [[], []]
        states = [self._run(x, 0, kept[0]), self._run(x[::-1], 1, kept[1])]
        both = np.concatenate([states[0], states[1][::-1]], axis=2)
        score = both @ w["out"] + w["bias"]
        score -= score.max(axis=2, keepdims=True)
        p = np.exp(score)
        p /= p.sum(axis=2, keepdims=True)
        p[:, np.arange(x.shape[1]), y] -= 1
        p /= x.size
        flat = p.reshape(-1, p.shape[2])
        grads = {"out": both.reshape(-1, 2 * half).T @ flat, "bias": flat.sum(axis=0)}
        d_both = p @ w["out"].T
        for way in (0, 1):
            bytes_in = x if way == 0 else x[::-1]
            d_out = d_both[:, :, :half] if way == 0 else d_both[::-1, :, half:]
            rec = w[f"rec{way}"]
            d_rec = np.zeros_like(rec)
            d_in = np.empty((*x.shape, 3 * half), np.float32)
            d_h = np.zeros((x.shape[1], half), np.float32)
            for t in reversed(range(len(x))):
                h, z, r, new, back = kept[way][t]
                d_h = d_h + d_out[t]
                d_new = d_h * (1 - z) * (1 - new * new)
                d_z = d_h * (h - new) * z * (1 - z)
                d_r = d_new * back * r * (1 - r)
                d_in[t] = np.concatenate([d_z, d_r, d_new], axis=1)
                d_left = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_rec += h.T @ d_left
                d_h = d_h * z + d_left @ rec.T
            grads[f"rec{way}"] = d_rec
            seen = np.zeros((256, x.size), np.float32)
            seen[bytes_in.reshape(-1), np.arange(x.size)] = 1
            grads[f"in{way}"] = seen @ d_in.reshape(x.size, -1)
        return grads

    def fit(self, x: np.ndarray, y: np.ndarray, plan: Training) -> None:
        """Adam over seeded batches; ``x`` is (rows, width) bytes, labels drawn evenly."""
        rng = np.random.default_rng(plan.seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        of_label = [np.flatnonzero(y == k) for k in range(len(self.labels))]
        for step in range(1, plan.steps + 1):
            picks = rng.integers(0, len(self.labels), plan.batch)
            rows = np.array([rng.choice(of_label[k]) for k in picks])
            grads = self._gradients(np.ascontiguousarray(x[rows].T), y[rows])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            rate = plan.rate * min(1.0, 4 * (1 - (step - 1) / plan.steps)) * min(1.0, 5 / max(norm, 1e-9))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                move = first[k] / (1 - 0.9 ** step)
                self.weights[k] -= rate * move / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def pool(self, texts: list[bytes]) -> np.ndarray:
        """(text, label): the mean distribution over the positions that hold letters.

        Windows are read a bounded number at a time, however long a text is. A window ends at its last
        visible byte and is filled with spaces to a multiple of ``_FILL``, so that it comes out the same
        whatever it is read together with.
        """
        total = np.zeros((len(texts), len(self.labels)))
        mass = np.zeros(len(texts))
        owners, cuts = [], []
        for i, text in enumerate(texts):
            for at in range(0, len(text), WINDOW):
                owners.append(i)
                cuts.append(text[at:at + WINDOW])
                if len(cuts) == _WINDOWS:
                    self._add(np.array(owners), cuts, total, mass)
                    owners, cuts = [], []
        if cuts:
            self._add(np.array(owners), cuts, total, mass)
        return total / np.maximum(mass, 1e-9)[:, None]

    def _add(self, owner: np.ndarray, windows: list[bytes], total: np.ndarray, mass: np.ndarray) -> None:
        x = np.frombuffer(b"".join([w.ljust(WINDOW) for w in windows]), np.uint8).reshape(-1, WINDOW)
        seen = x[:, ::-1] != 32
        used = np.where(seen.any(axis=1), WINDOW - seen.argmax(axis=1), 0)
        filled = -(-used // _FILL) * _FILL
        letter = np.zeros(256, np.float32)
        letter[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
        for size in np.unique(filled[filled > 0]).tolist():
            rows = np.flatnonzero(filled == size)
            for k in range(0, len(rows), _BATCH):
                part = rows[k:k + _BATCH]
                block = np.ascontiguousarray(x[part, :size].T).astype(np.intp)
                weight = letter[block]
                p = np.einsum("tbk,tb->bk", self.probabilities(block), weight, optimize=False)
                np.add.at(total, owner[part], p)
                np.add.at(mass, owner[part], weight.sum(axis=0))


def fit_tagger(df: DataFrame, id_col: str, text_col: str, label_col: str,
               plan: Training = Training()) -> Tagger | None:
    """Train on a bounded sample of the labelled rows of ``df``; None without any."""
    rows = df.where(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.col(label_col).cast("string").alias("label"))
    top = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(plan.max_labels)
    counts = top.collect()
    labels = sorted(r["label"] for r in counts)
    if not labels:
        return None
    order = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    place = F.row_number().over(order)

    def lowest(held: DataFrame) -> list:
        """The ids drawn: at most labels x documents rows."""
        return held.withColumn("place", place).where(F.col("place") <= plan.docs_per_label).collect()

    # the lowest hashes of a label lie below a bound that its count gives, with much to spare; so few
    # rows are ranked. Where ids repeat too often for that, all are.
    share = F.create_map(*[F.lit(v) for r in counts for v in (r["label"], min(1.0, _SPARE * plan.docs_per_label / r["count"]))])
    named = rows.where(F.col("label").isin(labels)).select("id", "label")
    chosen = lowest(named.where(F.xxhash64("id") <= share[F.col("label")] * 2.0 ** 64 - 2.0 ** 63))
    drawn_of = Counter(r["label"] for r in chosen)
    if any(drawn_of[r["label"]] < min(plan.docs_per_label, r["count"]) for r in counts):
        chosen = lowest(named)
    names = {(r["id"], r["label"]) for r in chosen}
    ids = df.sparkSession.createDataFrame(list(names), rows.select("id", "label").schema)
    width, each = plan.width, plan.windows_per_doc

    def windows(batches):
        for batch in batches:
            cut, marks = [], []
            for text, label in zip(batch.column("text").to_pylist(),
                                   batch.column("label").to_pylist()):
                text = text.encode()
                last = max(0, len(text) - width)
                for at in sorted({last * k // max(1, each - 1) for k in range(each)}):
                    cut.append(text[at:at + width].ljust(width))
                    marks.append(label)
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary()), pa.array(marks, pa.string())],
                                             names=["bytes", "label"])

    # rows that share a drawn id are ranked again, by their text, as all of them match
    again = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id", F.xxhash64("text"), "text")
    drawn = rows.join(F.broadcast(ids), ["id", "label"], "left_semi").withColumn(
        "place", F.row_number().over(again)).where(F.col("place") <= plan.docs_per_label)
    sample = drawn.select("text", "label").mapInArrow(
        windows, "bytes binary, label string").toArrow().sort_by([("label", "ascending"),
                                                                  ("bytes", "ascending")])
    x = np.frombuffer(b"".join(sample["bytes"].to_pylist()), np.uint8).reshape(-1, width)
    y = np.searchsorted(labels, np.array(sample["label"].to_pylist()))
    tagger = Tagger(labels, plan.hidden, plan.seed)
    tagger.fit(x.astype(np.intp), y, plan)
    return tagger


def with_language(df: DataFrame, tagger: Tagger | None, text_col: str = "text",
                  pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Every column of ``df`` plus the pooled label of the whole text and its probability.

    A NULL text and one without a letter are ``und`` with score 0, as is every text if there
    is no tagger. Of labels with equal probability the first by name is taken. Repeated rows stay;
    NULLs elsewhere are carried along; an empty table gives none. ``pred`` and ``score`` must be new names.
    """
    if {pred, score} & set(df.columns):
        raise ValueError(f"{pred} or {score} is a column already")
    if tagger is None:
        return df.withColumns({pred: F.lit(UNDETERMINED), score: F.lit(0.0)})
    names = df.columns
    usable = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = small_batches(df).withColumn("_usable", usable)
    schema = df.select("*", F.lit("").alias(pred), F.lit(0.0).alias(score)).schema

    def run(batches):
        for batch in pieces(batches, text_col, 1 << 20):
            texts = [t.encode() if ok else b"" for t, ok in zip(
                batch.column(text_col).to_pylist(), batch.column("_usable").to_pylist())]
            p = tagger.pool(texts)
            best = p.argmax(axis=1)
            marks = [tagger.labels[k] if t else UNDETERMINED for t, k in zip(texts, best)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(marks, pa.string()),
                 pa.array(np.minimum(p[np.arange(len(best)), best], 1.0))], names=[*names, pred, score])

    return rows.mapInArrow(run, schema)

"""Vector bin packing of examples into training sequences.

An example demands three things at once: tokens, one segment, and the tokens that
bear loss. A sequence offers a limited amount of each. Sequences are filled one
after the other, each time with the example that fits and whose demand has the
largest dot product with what the sequence still offers.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberfold.llm.tokens import encoder
from emberfold.llm.worker import id_arrays, pieces, small_batches


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 128
    loss: int = 2048


# Examples packed together, and the ids they hold at most (unless one has more).
GROUP_EXAMPLES = 4096
GROUP_TOKENS = 4 << 20
# Text encoded at a time.
BATCH_BYTES = 8 << 20


def pack(tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool) -> list[list[tuple]]:
    """Sequences of ``(example, start, length)``.

    ``loss`` says which examples bear loss, on all their tokens or on none. What is longer
    than a sequence can take is split first. With ``cut`` an example is also cut where nothing
    fits whole, and a sequence that stays below the limit is split into lengths that are
    powers of two; without, it stays short.
    """
    top = limits.tokens
    whole = min(top, limits.loss)
    bins, left, at = [], tokens.astype(np.int64).copy(), np.zeros(len(tokens), np.int64)
    for i in np.flatnonzero(left > np.where(loss, whole, top)):
        step = whole if loss[i] else top
        if cut and step < top:
            continue
        while left[i] > step or (cut and left[i] == step):
            bins.append([(int(i), int(at[i]), step)])
            at[i] += step
            left[i] -= step
    # Within those that bear loss, and within the others, the product grows with the tokens. So the best of
    # each is its largest that fits, in a list by size; of equal sizes the first example stands last.
    lists: tuple[list, list] = ([], [])
    for i in np.flatnonzero(left > 0).tolist():
        lists[bool(loss[i])].append((int(left[i]), -i))
    for sizes in lists:
        sizes.sort()
    per_token, per_loss = 1 / top ** 2, 1 / limits.loss ** 2
    while lists[0] or lists[1]:
        room, tokens_left, loss_left = [], top, limits.loss
        while len(room) < limits.segments and tokens_left > 0:
            best = None
            for bears, sizes in enumerate(lists):
                space = min(tokens_left, loss_left) if bears else tokens_left
                k = bisect_right(sizes, (space, 1)) - 1
                if k >= 0:
                    n, name = sizes[k]
                    product = n * tokens_left * per_token + (n * loss_left * per_loss if bears else 0)
                    best = max(best or (0, 0), (product, name, bears, k, n))
            if best:
                _, _, bears, k, take = best
            elif cut:
                # of what is too long, the example that is least so, of the kind with the more space
                space, bears = max((min(tokens_left, loss_left) if bears else tokens_left, -bears)
                                   for bears, sizes in enumerate(lists) if sizes) if lists[0] or lists[1] else (0, 0)
                if space <= 0:
                    break
                bears, k, take = -bears, 0, space
            else:
                break
            n, name = lists[bears].pop(k)
            i = -name
            room.append((i, int(at[i]), take))
            at[i] += take
            if n > take:
                insort(lists[bears], (n - take, name))
            tokens_left -= take
            loss_left -= take * bears
        total = sum(p[2] for p in room)
        bins.extend(_powers(room, total) if cut and total < top else [room])
    return bins


def _powers(room: list[tuple], total: int) -> list[list[tuple]]:
    """The pieces of one sequence dealt to sequences whose lengths are powers of two."""
    out, rest = [], list(room)
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        size, part = 1 << bit, []
        while size:
            i, start, n = rest[0]
            take = min(n, size)
            part.append((i, start, take))
            size -= take
            if take == n:
                rest.pop(0)
            else:
                rest[0] = (i, start + take, n - take)
        out.append(part)
    return out


def pack_texts(df: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id",
               text_col: str = "text", loss_col: str | None = None, limits: Limits = Limits(),
               cut: bool = True, group_examples: int = GROUP_EXAMPLES,
               batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Encode whole texts, append ``end_id``, pack: one row per piece.

    ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: the piece holds
    ids ``start`` up to ``start + length`` of its text and stands at ``offset`` of its sequence.
    ``loss_col`` is a boolean, NULL counts as false; without it all tokens bear loss. Texts are encoded
    ``batch_bytes`` at a time: the more, the fewer words are encoded twice, and the more memory a task takes.

    Each task packs its own rows in groups of bounded size, so nothing is shuffled and a
    rerun gives the same rows. A NULL or empty text has the end id alone; NULL
    and repeated ids keep one set of pieces per row; of equal demands the first row of the task
    is taken; an empty table gives none.
    """
    bears = F.lit(True) if loss_col is None else F.coalesce(F.col(loss_col), F.lit(False))
    rows = small_batches(df, f"{batch_bytes >> 20}m").select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), bears.alias("bears"))

    def run(batches):
        encode_all = encoder(tokenizer).encode
        end = np.array([end_id], dtype="<u4")
        next_id = TaskContext.get().partitionId() << 33
        ids, names, marks, held = [], [], [], 0

        def flush():
            nonlocal next_id
            sizes = np.array([len(i) for i in ids], np.int64)
            rows = []
            for room in pack(sizes, np.array(marks, bool), limits, cut):
                offset = 0
                for i, start, n in room:
                    rows.append((names[i], start, n, int(sizes[i]), next_id, offset, i))
                    offset += n
                next_id += 1
            for a in range(0, len(rows), 4096):
                part = rows[a:a + 4096]
                cols = list(zip(*part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int64()),
                     id_arrays([ids[r[6]][r[1]:r[1] + r[2]] for r in part]),
                     *[pa.array(cols[k], pa.int64()) for k in (3, 4, 5)]],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id",
                           "offset"])

        for batch in pieces(batches, "text", batch_bytes + (2 << 20)):
            for name, mark, code in zip(batch.column("doc_id").to_pylist(),
                                        batch.column("bears").to_pylist(),
                                        encode_all(batch.column("text"))):
                ids.append(np.concatenate([code, end]))
                names.append(name)
                marks.append(mark)
                held += len(ids[-1])
                if len(ids) >= group_examples or held >= GROUP_TOKENS:
                    yield from flush()
                    ids, names, marks, held = [], [], [], 0
        if ids:
            yield from flush()

    return rows.mapInArrow(run, "doc_id bigint, start bigint, length bigint, ids array<int>, "
                                "doc_tokens bigint, sequence_id bigint, offset bigint")

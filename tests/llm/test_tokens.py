"""Token files and packing: exact round trips."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import *  # noqa: F401,F403
from tokenizers import Tokenizer

from emberfold.llm.packing import Limits, pack, pack_texts
from emberfold.llm.queries import QUERIES
from emberfold.llm.tokenfile import read_tokens, write_tokens
from emberfold.llm.tokens import default_tokenizer
from emberfold.storage import scratch_path


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_file_query(spark, sf_dir, docs, encode):
    got = {r["doc_id"]: r for r in QUERIES["op2_token_files"](spark, sf_dir).collect()}
    start = 0
    for row in docs.orderBy("doc_id").collect():
        ids = encode(row["text"]) + [0]
        r = got.pop(row["doc_id"])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert not got


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_file_layout(spark, odd, encode, encoding):
    path = scratch_path(spark, "tokens")
    write_tokens(odd, path, default_tokenizer(), 0, keep=["lang", "part"], encoding=encoding)
    rows = read_tokens(spark, path, ["ids", "meta"]).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == Counter(
        (r["doc_id"], (*encode(r["text"]), 0)) for r in odd.collect())
    rows.sort(key=lambda r: r["start"])
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids == sorted(ids)
    assert [r["start"] for r in rows] == list(np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1])
    files = [f.path for f in spark.read.parquet(path).select("_metadata.file_path").distinct()
             .selectExpr("replace(file_path, 'file://', '') AS path").collect()]
    for file in files:
        meta = pq.ParquetFile(file).metadata
        names = {meta.row_group(0).column(k).path_in_schema: meta.row_group(0).column(k)
                 for k in range(meta.num_columns)}
        assert names["doc_id"].has_offset_index and names["doc_id"].has_column_index
        used = names["ids.list.element"].encodings
        assert ("DELTA_BINARY_PACKED" in used) == (encoding == "delta")


def test_metadata_read_leaves_the_ids(spark, odd):
    path = scratch_path(spark, "tokens")
    write_tokens(odd, path, default_tokenizer(), 0)
    plan = read_tokens(spark, path, []).where("doc_id = 3")._jdf.queryExecution().toString()
    scans = [x for x in plan.splitlines() if "ReadSchema" in x]
    assert scans and all("ids" not in x.split("ReadSchema")[1] for x in scans)
    assert "EqualTo(doc_id,3)" in plan


def test_files_of_nothing(spark, empty):
    path = scratch_path(spark, "tokens")
    write_tokens(empty, path, default_tokenizer(), 0)
    assert read_tokens(spark, path).count() == 0


def check_pieces(pieces, expected, limit):
    """Every id in one piece, sequences gapless and full or a power of two."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for doc, ids in expected.items():
        found = sorted(by_doc.pop(doc), key=lambda p: p["start"])
        assert [p["start"] for p in found] == list(np.cumsum([0, *[p["length"] for p in found]])[:-1])
        assert [x for p in found for x in p["ids"]] == ids
        assert {p["doc_tokens"] for p in found} == {len(ids)}
    assert not by_doc
    for seq in by_seq.values():
        seq.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in seq])
        assert [p["offset"] for p in seq] == [0, *ends[:-1]]
        assert ends[-1] <= limit and (ends[-1] & (ends[-1] - 1)) == 0


def test_packing_query(spark, sf_dir, docs, encode):
    got = QUERIES["op5_packing"](spark, sf_dir).collect()
    ids = {r["doc_id"]: encode(r["text"]) + [1] for r in docs.collect()}
    for p in got:
        part = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert p["ids_crc32"] == crc(part)
    pieces = [{**p.asDict(), "ids": ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]} for p in got]
    check_pieces(pieces, ids, 2048)


def test_packing_query_bounds_loss(spark, sf_dir, docs):
    """English texts bear loss, three quarters of a sequence at most; without the limit other sequences come out."""
    english = {r["doc_id"] for r in docs.where("lang = 'en'").select("doc_id").collect()}

    def loss_of(rows):
        held = Counter()
        for r in rows:
            held[r["sequence_id"]] += r["length"] if r["doc_id"] in english else 0
        return held

    got = QUERIES["op5_packing"](spark, sf_dir).collect()
    assert max(loss_of(got).values()) <= 1536
    free = pack_texts(docs.withColumn("b", docs["lang"] == "en"), default_tokenizer(), 1, loss_col="b").collect()
    assert max(loss_of(free).values()) > 1536
    place = lambda rows: {(r["doc_id"], r["start"], r["length"]) for r in rows}
    assert place(got) != place(free)


def test_packing_odd_rows(spark, odd, empty, encode):
    unique = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = [r.asDict() for r in pack_texts(unique, default_tokenizer(), 1).collect()]
    check_pieces(got, {r["doc_id"]: encode(r["text"]) + [1] for r in unique.collect()}, 2048)
    assert sum(r["length"] for r in pack_texts(odd, default_tokenizer(), 1).collect()) == sum(
        len(encode(r["text"])) + 1 for r in odd.collect())
    assert pack_texts(empty, default_tokenizer(), 1).count() == 0


def test_instruction_limits(spark):
    """Whole examples under three limits at once; only some bear loss."""
    rng = np.random.default_rng(3)
    tokens, loss = rng.integers(1, 900, 400), rng.random(400) < 0.6
    limits = Limits(tokens=2048, segments=6, loss=1000)
    bins = pack(tokens, loss, limits, cut=False)
    placed = Counter(i for room in bins for i, _, _ in room)
    assert placed == Counter(range(400))
    for room in bins:
        assert len(room) <= 6 and sum(n for _, _, n in room) <= 2048
        assert sum(n for i, _, n in room if loss[i]) <= 1000
        assert all(start == 0 and n == tokens[i] for i, start, n in room)
    least = max(tokens.sum() / 2048, tokens[loss].sum() / 1000, 400 / 6)
    assert len(bins) <= 1.25 * least


def test_limits_hold_when_cutting():
    rng = np.random.default_rng(4)
    tokens, loss = rng.integers(1, 5000, 300), rng.random(300) < 0.5
    for limits in (Limits(), Limits(2048, 4, 2048), Limits(2048, 8, 500)):
        held = Counter()
        for room in pack(tokens, loss, limits, cut=True):
            total = sum(n for _, _, n in room)
            assert len(room) <= limits.segments and total <= 2048 and total & (total - 1) == 0
            assert sum(n for i, _, n in room if loss[i]) <= limits.loss
            held.update({i: 0 for i, _, _ in room})
            for i, _, n in room:
                held[i] += n
        assert [held[i] for i in range(300)] == tokens.tolist()


def test_conversations_bear_loss_on_answers(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr(
        "conv_id * 1000 + turn AS id", "text", "role = 'assistant' AS answer")
    packed = pack_texts(turns, default_tokenizer(), 1, "id", "text", "answer",
                        Limits(1024, 16, 512), cut=False)
    answers = {r["id"] for r in turns.where("answer").collect()}
    by_seq = defaultdict(list)
    for r in packed.collect():
        by_seq[r["sequence_id"]].append(r)
    for seq in by_seq.values():
        assert len(seq) <= 16 and sum(r["length"] for r in seq) <= 1024
        assert sum(r["length"] for r in seq if r["doc_id"] in answers) <= 512

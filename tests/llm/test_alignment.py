"""Token alignment against a plain version that compares every pair of tokens."""

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import *  # noqa: F401,F403
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from emberfold.llm import alignment
from emberfold.llm.alignment import Pair, align, align_documents, gallop, slices, token_groups
from emberfold.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def models():
    plain = Tokenizer.from_file(A)
    plain.encode_special_tokens = True
    return plain, SentencePieceProcessor(model_file=B), Pair(A, B)


def plain_tokens(text, models):
    """Ids of whole texts and the bytes of each token, or nothing."""
    tokenizer, model, pair = models
    if not text:
        return None
    a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    bytes_b = [bytes([model.id_to_piece(i).startswith("<0x") and int(model.id_to_piece(i)[3:5], 16)])
               if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
    bytes_a = [pair.bytes_a[i] for i in a]
    want = (" " + text).encode()
    return (a, b, bytes_a, bytes_b) if b"".join(bytes_a) == b"".join(bytes_b) == want else None


def plain_alignment(texts, models):
    """Per text: n_a, n_b, groups in digits, links as pairs of ids; tokens are compared two by two."""
    out = []
    for text in texts:
        tokens = plain_tokens(text, models)
        if tokens is None:
            out.append((0, 0, None, []))
            continue
        a, b, bytes_a, bytes_b = tokens
        ends = [np.cumsum([len(t) for t in x]).tolist() for x in (bytes_a, bytes_b)]
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, at = [], [0, 0]
        for end in both:
            to = [bisect_left(e, end) + 1 for e in ends]
            groups.append((a[at[0]:to[0]], b[at[1]:to[1]], at[0], at[1]))
            at = to
        starts = [[0, *e] for e in ends]
        links = [(x, y) for ga, gb, i, j in groups for p, x in enumerate(ga) for q, y in enumerate(gb)
                 if starts[0][i + p] < ends[1][j + q] and starts[1][j + q] < ends[0][i + p]]
        out.append((len(a), len(b), [g[:2] for g in groups], links))
    return out


def plain_rows(ids, texts, models):
    aligned = plain_alignment(texts, models)
    count = Counter(link for row in aligned for link in row[3])
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    rows = []
    for i, (n_a, n_b, groups, links) in zip(ids, aligned):
        digits = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups or [])
        rows.append((i, n_a, n_b, len(groups or []), len(links), sum(count[p] == most[p[1]] for p in links),
                     sum(count[p] for p in links), hashlib.sha256(digits.encode()).hexdigest() if groups else ""))
    return Counter(rows)


ODD_TEXTS = ["a  b   c ", " lead", "trail ", "tab\there\nline", "é ﬁ 你好 🙂🙃", "under▁score", "<|endoftext|> </s> <0x41> <unk>",
             "x" * 300, "don't stop", " wide　blank", "\x00nul\x1c", " ", "\n", "123 45.67", "A B" * 40, None, ""]


def test_query_equals_plain_version(spark, sf_dir, docs, models):
    rows = docs.select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in QUERIES["op11_alignment"](spark, sf_dir).collect())
    assert got == plain_rows([r[0] for r in rows], [r[1] for r in rows], models)


def test_odd_texts(spark, odd, empty, models, monkeypatch):
    rows = odd.select("doc_id", "text").collect() + [(100 + k, t) for k, t in enumerate(ODD_TEXTS)]
    df = spark.createDataFrame([tuple(r) for r in rows], "doc_id bigint, text string").repartition(3)
    want = plain_rows([r[0] for r in rows], [r[1] for r in rows], models)
    assert Counter(tuple(r) for r in align_documents(df, A, B).collect()) == want
    # small chunks and cut texts give the same
    assert Counter(tuple(r) for r in align_documents(df, A, B, chunk_bytes=1000).collect()) == want
    assert align_documents(empty, A, B).count() == 0
    assert align_documents(odd, A, B).count() == odd.count()


@pytest.mark.parametrize("held", [1, 1 << 22])
def test_cut_texts_give_the_same(models, held, monkeypatch):
    monkeypatch.setattr(alignment, "_HELD_PAIRS", held)
    texts = [" ".join(f"w{k % 91}x don't" for k in range(400)), None, "y" * 900, "", "under▁score " * 90, "a b " * 300]
    for part in (7, 50, 333):
        counts, listed, (owner, code, n) = alignment._chunk(texts, models[2])
        found = [(o, t, w) for o, t, w in alignment.aligned_batches(texts, models[2], part)]
        assert sum(len(t.link_a) for o, t, w in found) >= counts[:, 3].sum()
        old, alignment.aligned_batches.__defaults__ = alignment.aligned_batches.__defaults__, (part,)
        try:
            again = alignment._chunk(texts, models[2])
        finally:
            alignment.aligned_batches.__defaults__ = old
        assert (again[0] == counts).all() and again[1] == listed
        assert all((x == y).all() for x, y in zip(again[2], (owner, code, n)))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t🙂▁'s1.  ") | st.characters(codec="utf-8"), max_size=40), max_size=6))
def test_random_texts(models, texts):
    pair = models[2]
    counts, listed, (owner, code, n) = alignment._chunk(texts, pair)
    for i, (n_a, n_b, groups, links) in enumerate(plain_alignment(texts, models)):
        assert counts[i].tolist() == [n_a, n_b, len(groups or []), len(links)]
        here = owner == i
        assert {(c // pair.width, c % pair.width): m for c, m in zip(code[here].tolist(), n[here].tolist())} == Counter(links)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 9), min_size=1, max_size=200), st.integers(0, 10)), min_size=1, max_size=4))
def test_gallop_finds_first_place(runs):
    keys, into, begins, sizes, base = [], [], [], [], 0
    for steps, every in runs:
        ends = (np.cumsum(steps) + base).tolist()
        own = [e for k, e in enumerate(ends) if every and k % every == 0 or k == len(ends) - 1]
        begins.append(len(into))
        into += ends
        keys += own
        sizes.append(len(own))
        base = ends[-1]
    got = gallop(np.array(keys), np.array(into), np.array(begins), np.array(sizes))
    assert got.tolist() == [bisect_left(into, k) for k in keys]


def test_groups_hold_the_same_bytes(spark, docs, models):
    pair = models[2]
    got = token_groups(docs.limit(40), A, B).collect()
    for r in got:
        at = [0, 0]
        for ends in zip(r["ends_a"], r["ends_b"]):
            left, right = (b"".join(names[i] for i in ids[x:y]) for names, ids, x, y in zip(
                (pair.bytes_a, pair.bytes_b), (r["a"], r["b"]), at, ends))
            assert left == right
            at = ends
        assert list(at) == [len(r["a"]), len(r["b"])] if at != [0, 0] else not r["a"]


def test_cuts_leave_words_whole():
    text = "one two  three\n four 　five six"
    for size in range(1, 30):
        parts = slices(text, size)
        assert " ".join(parts) == text

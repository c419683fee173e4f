"""Passage removal against a plain search."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from conftest import *  # noqa: F401,F403

from emberfold.llm import substring
from emberfold.llm.fm_index import FMIndex, WaveletTree
from emberfold.llm.queries import QUERIES
from emberfold.llm.substring import drop_repeated_passages, passages


def plain(rows, window=20):
    """rows: (place in the order, text); equal rows share a place."""
    first = {}
    texts = sorted({r for r in rows})
    for place, text in texts:
        words = (text or "").encode().split()
        for k in range(len(words) - window + 1):
            first.setdefault(tuple(words[k:k + window]), (place, k))
    out = {}
    for place, text in texts:
        words = (text or "").encode().split()
        gone = np.zeros(len(words), bool)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k:k + window])] < (place, k):
                gone[k:k + window] = True
        out[place, text] = (len(words), int(gone.sum()),
                            b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return out


def test_query(spark, sf_dir, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain(rows)
    got = {tuple(r) for r in QUERIES["op4_substrings"](spark, sf_dir).collect()}
    assert got == {(k[0], n, g, hashlib.sha256(t.encode()).hexdigest()) for k, (n, g, t) in want.items()}
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("limits", [{}, {"shard_words": 200, "key_passages": 2}])
def test_made_passages(spark, limits):
    rng = np.random.default_rng(1)
    word = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 40, n))
    shared = [word(30) for _ in range(4)]
    rows = []
    for k in range(120):
        parts = [word(int(rng.integers(0, 25))), shared[int(rng.integers(0, 4))][int(rng.integers(0, 9)):],
                 word(int(rng.integers(0, 10)))]
        if k % 17 == 0:
            parts = ["again and " * 60, *parts]
        rows.append((k, "  ".join(parts)))
    rows.append((200, rows[5][1]))
    rows.append((201, rows[5][1] + " z"))
    got = {(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in drop_repeated_passages(
        spark.createDataFrame(rows, "doc_id bigint, text string"), **limits).collect()}
    assert got == {(k[0], *v) for k, v in plain(rows).items()}


def test_shards_of_a_hot_passage_are_bounded(spark, monkeypatch):
    rng = np.random.default_rng(6)
    word = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 5_000, n))
    hot, long, filled = word(12), word(26), "so " * 30
    rows = []
    for k in range(900):
        middle = [hot, long, filled, "so it is " * 9 + hot][k % 4]
        rows.append((k, f"{word(18)} {middle} {word(18)}"))
    rows += [(1_000 + k, f"{word(3)} {rows[k][1]} {word(3)}") for k in range(0, 900, 9)]
    spans = substring._shard_spans

    def bounded(table, window):
        assert len(table) <= 150, f"{len(table)} passages in one shard"
        return spans(table, window)

    monkeypatch.setattr(substring, "_shard_spans", bounded)
    got = {(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in drop_repeated_passages(
        spark.createDataFrame(rows, "doc_id bigint, text string"), key_passages=40, shard_words=400).collect()}
    assert got == {(k[0], *v) for k, v in plain(rows).items()}


def test_odd_rows(spark, odd, empty):
    rows = odd.selectExpr("doc_id", "text", "coalesce(doc_id, 1L << 62) AS doc",
                          "xxhash64(doc_id is null, text) AS row").collect()
    want = plain([((r["doc"], r["row"]), r["text"] or "") for r in rows])
    got = Counter(tuple(r) for r in drop_repeated_passages(odd).collect())
    assert got == Counter((r["doc_id"], want[(r["doc"], r["row"]), r["text"] or ""][2],
                           *want[(r["doc"], r["row"]), r["text"] or ""][:2]) for r in rows)
    assert drop_repeated_passages(empty).count() == 0


def test_every_window_is_in_one_passage():
    rng = np.random.default_rng(2)
    for n in (0, 19, 20, 21, 500):
        for top in (1, 3, 1000):
            words = rng.integers(0, top, n).astype(np.uint64)
            keys, starts, counts, _ = passages(words, 20)
            covered = [w for s, c in zip(starts, counts) for w in range(s, s + c)]
            assert covered == list(range(max(0, n - 19))) and (counts <= 64).all()


def test_index_finds_what_is_there():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 5, 3000)
    tree = WaveletTree(text, 3)
    at, symbol = rng.integers(0, 3001, 200), rng.integers(0, 5, 200)
    assert [int((text[:a] == s).sum()) for a, s in zip(at, symbol)] == tree.rank(symbol, at).tolist()
    text[::97] = 0
    index = FMIndex(text, 6)
    starts = np.array([k for k in range(2900) if (text[k:k + 6] > 0).all()])
    which, low, high = index.windows(text, starts, 6, np.zeros(len(starts), np.int64))
    assert len(which) == len(starts)
    for w, a, b in zip(which[:300], low, high):
        same = [k for k in range(2995) if (text[k:k + 6] == text[starts[w]:starts[w] + 6]).all()]
        assert sorted(index.places[a:b].tolist()) == same

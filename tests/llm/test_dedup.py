"""Near-duplicates, components and line templates against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest import *  # noqa: F401,F403
from pyspark.sql import functions as F

from emberfold.llm.components import connected_components
from emberfold.llm.queries import QUERIES
from emberfold.llm.simhash import anchor_rows, fine_blocks, fingerprint_links, near_duplicates
from emberfold.llm.templates import Leaf, drop_recurring_lines, line_key, parse


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_pairs(fps, bits):
    values = np.array(fps, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1:]) <= bits):
            yield i, i + 1 + int(j)


def plain_near(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    of = plain_components(near_pairs(fps, 4), range(len(rows)))
    least = defaultdict(list)
    for k, (doc, _) in enumerate(rows):
        least[of[k]].append(doc)
    best = {r: min((d for d in v if d is not None), default=None) for r, v in least.items()}
    return Counter((doc, f"{fps[k]:016x}", best[of[k]]) for k, (doc, _) in enumerate(rows))


def test_simhash_query(spark, sf_dir, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = Counter(tuple(r) for r in QUERIES["op3_simhash"](spark, sf_dir).collect())
    assert got == plain_near(rows)


def test_simhash_odd_rows(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = Counter((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"])
                  for r in near_duplicates(odd).collect())
    assert got == plain_near(rows)
    assert near_duplicates(empty).count() == 0


def clustered(n, seed=0):
    """Fingerprints around a few centres, so that many are 0 to 8 bits apart."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 64, n // 12 + 1, dtype=np.uint64)
    values = rng.choice(centres, n)
    for _ in range(5):
        flip = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        values = np.where(rng.random(n) < 0.6, values ^ flip, values)
    return np.unique(values)


def comparisons(n, mean):
    """Comparisons per fingerprint of random ones, which no two of are close."""
    values = np.unique(np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64))
    total = 0
    for _, keys, home in anchor_rows(values, 3, 4, fine_blocks(n, 3, mean)):
        names, place = np.unique(keys, return_inverse=True)
        total += int((np.bincount(place, home) * np.bincount(place)).sum())
    return total / n


def test_anchors_follow_the_number_of_fingerprints():
    small, large = comparisons(20_000, 8), comparisons(160_000, 8)
    assert 0.5 < large / small < 2  # anchors grew by eight, as the fingerprints did
    assert [fine_blocks(n, 3) for n in (0, 1 << 20, 1 << 21, 1 << 24, 1 << 40)] == [0, 0, 1, 2, 3]


@pytest.mark.parametrize("mean", [1, 8])
def test_links_do_not_depend_on_the_anchors(spark, mean, monkeypatch):
    import emberfold.llm.simhash as simhash
    values = clustered(3000, 4)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    monkeypatch.setattr(simhash.fine_blocks, "__defaults__", (mean,))
    links = [tuple(r) for r in fingerprint_links(df, 4, 3).collect()]
    got = plain_components([(place[a], place[b]) for place in [{v: k for k, v in enumerate(values.view(np.int64).tolist())}]
                            for a, b in links], range(len(values)))
    assert got == plain_components(near_pairs(values, 4), range(len(values)))


@pytest.mark.parametrize("parts, fine", [(1, 0), (2, 0), (2, 2), (3, 0), (3, 1), (3, 2), (3, 3), (4, 0), (4, 2)])
def test_every_close_pair_meets_at_an_anchor(parts, fine):
    values = clustered(240)
    home, held = defaultdict(set), defaultdict(set)
    for rows, keys, at_home in anchor_rows(values, parts, 4, fine):
        for r, k, h in zip(rows.tolist(), keys.tolist(), at_home.tolist()):
            held[k].add(r)
            if h:
                home[k].add(r)
    met = {(min(a, b), max(a, b)) for k in home for a in home[k] for b in held[k]}
    assert set(near_pairs(values, 4)) <= met


@pytest.mark.parametrize("limit", [32_768, 7])
def test_links_connect_what_close_pairs_connect(spark, limit):
    values = clustered(1500, 5)
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    links = fingerprint_links(df, 4, 3, limit).collect()
    place = {int(v): k for k, v in enumerate(values.view(np.int64))}
    got = plain_components([(place[r["a"]], place[r["b"]]) for r in links], range(len(values)))
    assert got == plain_components(near_pairs(values, 4), range(len(values)))
    assert all(np.bitwise_count(np.uint64(r["a"] & (1 << 64) - 1) ^ np.uint64(
        r["b"] & (1 << 64) - 1)) <= 64 for r in links)


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)]
    star = [(100, k) for k in range(101, 140)]
    pairs = chain + star + [(100, 100), (None, 5), (7, None), (300, 200), (0, 1)]
    got = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}, 200: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_lines(rows, min_docs=5, similarity=0.8):
    """The same rules over Python lists; leaves are small here."""
    first, leaves = {}, defaultdict(set)
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").encode().split(b"\n"):
            words = parse(line)
            if words and doc is not None:
                key = line_key(words)
                first[key] = min(first.get(key, doc), doc)
                leaves[len(words), tuple(words[:3])].add((key, tuple(words)))
                held[key].add(doc)
    template = {}
    for lines in leaves.values():
        leaf = Leaf(similarity)
        for key, words in sorted(lines, key=lambda r: (first[r[0]], r[0])):
            template[key] = leaf.add(key, list(words))
    users = defaultdict(set)
    for key, docs in held.items():
        users[template[key]] |= docs
    out = []
    for doc, text in rows:
        kept, n, gone = [], 0, 0
        for line in (text or "").split("\n"):
            words = parse(line.encode())
            n += bool(words)
            use = users[template[line_key(words)]] if words and doc is not None else ()
            if len(use) >= min_docs and doc != min(use):
                gone += 1
            else:
                kept.append(line)
        out.append((doc, "\n".join(kept) if text is not None else None, n, gone))
    return Counter(out)


def test_line_query(spark, sf_dir, docs):
    want = plain_lines([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = Counter(tuple(r) for r in QUERIES["op6_line_templates"](spark, sf_dir).collect())
    assert got == Counter({(d, n, g, hashlib.sha256(t.encode()).hexdigest()): c
                           for (d, t, n, g), c in want.items()})
    assert sum(r[2] for r in got) > 0


def test_lines_odd_rows(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = drop_recurring_lines(odd, min_docs=2)
    assert got.columns == [*odd.columns, "n_lines", "n_dropped"]
    assert Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"])
                   for r in got.collect()) == plain_lines(rows, 2)
    assert drop_recurring_lines(empty).count() == 0


def test_variable_fields_share_a_template(spark):
    rows = [(k, f"Call {k} items now at noon for you and me\nown words of {chr(97 + k)} only")
            for k in range(6)]
    got = drop_recurring_lines(spark.createDataFrame(rows, "doc_id bigint, text string"),
                               min_docs=6).orderBy("doc_id").collect()
    assert [r["n_dropped"] for r in got] == [0, 2, 2, 2, 2, 2]
    leaf = Leaf(0.8)
    a = leaf.add(1, [b"x", b"y", b"z", b"v", b"w"])
    assert leaf.add(2, [b"x", b"y", b"z", b"v", b"u"]) == a
    assert leaf.add(3, [b"x", b"y", b"z", b"q", b"r"]) == 3


def test_full_leaves_are_split(spark):
    rows = [(k, f"same first words {' '.join(chr(97 + (k * j) % 26) for j in range(12))}")
            for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = drop_recurring_lines(df, min_docs=2, leaf_lines=5)
    assert out.count() == 60 and out.agg(F.max("n_lines")).first()[0] == 1


@pytest.mark.parametrize("leaf_lines", [2_000, 5])
def test_full_leaves_are_whole(spark, leaf_lines):
    rng = np.random.default_rng(4)
    rows = [(k, f"See more from name{chr(97 + k % 26)}{'x' * (k // 26)} today\nown line of {k}")
            for k in range(2_100)]
    word = lambda: "uvwxyz"[rng.integers(0, 6)]
    # lines that agree in some places and not in others, some with fields of their own
    rows += [(5_000 + k, "all of these " + " ".join(
        str(k) if rng.random() < 0.05 else word() * int(rng.integers(1, 3)) for _ in range(9)))
        for k in range(2_400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = drop_recurring_lines(df, leaf_lines=leaf_lines).select("doc_id", "text", "n_lines", "n_dropped")
    got = Counter(tuple(r) for r in got.collect())
    assert got == plain_lines(rows)
    assert sum(r[3] for r in got if r[0] < 5_000) >= 2_099


def test_blocks_find_the_same_templates():
    rng = np.random.default_rng(5)
    for count, top in ((5, 300), (9, 4), (16, 3)):
        quick, slow = Leaf(0.8), Leaf(0.8)
        slow._alike = lambda line: np.arange(len(slow.keys))  # noqa: B023
        for key in range(3_000):
            words = [b"a", b"b", b"c"] + [b"<*>" if v == 0 else b"%d" % v
                                          for v in rng.integers(0, top, count - 3)]
            assert quick.add(key, words) == slow.add(key, words)
        assert quick.blocks

"""Budgets and the rows that fill them."""

from collections import Counter, defaultdict

import pytest
from compare import connect, differences
from conftest import *  # noqa: F401,F403

from emberfold.llm.mixing import leaf_budgets, mix
from emberfold.llm.queries import ORACLES, QUERIES


def plain_share(budget, children):
    """children: name -> (weight, capacity)."""
    got, left = {}, dict(children)
    while left:
        weight = sum(w for w, _ in left.values())
        full = [k for k, (w, c) in left.items() if c * weight <= w * budget]
        if not full:
            return got | {k: min(c, w * budget // weight) for k, (w, c) in left.items()}
        k = min(full, key=lambda k: left[k][1] / left[k][0])
        got[k] = left[k][1]
        budget -= left.pop(k)[1]
    return got


LEAVES = [("a", "x", "1", 100), ("a", "x", "2", 5), ("a", "y", "3", 400), ("b", "x", "4", 10),
          ("b", "z", "5", 20), ("b", "z", None, 3), (None, "x", "6", 50)]


@pytest.mark.parametrize("total", [0, 7, 100, 350, 10_000])
def test_budgets(spark, total):
    weights = {"d": {"a": 3, "b": 2}, "l": {"x": 2}}
    df = spark.createDataFrame(LEAVES, "d string, l string, s string, tokens bigint")
    got = {(r["d"], r["l"], r["s"]): r["budget"]
           for r in leaf_budgets(df, ["d", "l", "s"], total, 2, weights).collect()}
    want = {(): min(total, sum(r[3] for r in LEAVES) * 2)}
    for depth in range(3):
        by = defaultdict(lambda: defaultdict(int))
        for r in LEAVES:
            by[r[:depth]][r[:depth + 1]] += 2 * r[3]
        names = ["d", "l", "s"]
        want = {k: b for parent, kids in by.items() for k, b in plain_share(want[parent], {
            k: (weights.get(names[depth], {}).get(k[-1], 1), c) for k, c in kids.items()}).items()}
    assert got == want


def test_query_equals_sql(spark, sf_dir):
    got = QUERIES["op7_mixing"](spark, sf_dir).toArrow()
    assert differences(got, connect(sf_dir).sql(ORACLES["op7_mixing"]).to_arrow_table()) == []
    assert got.num_rows > 0


def test_prefixes_of_epochs(spark, odd, empty):
    rows = odd.selectExpr("doc_id", "lang", "source", "length(text) AS size", "epoch AS start")
    out = mix(rows, ["lang", "source"], total=400_000, max_epochs=3, tokens_col="size").collect()
    sizes = Counter()
    for r in rows.collect():
        sizes[r["lang"], r["source"]] += r["size"] or 0
    by = defaultdict(list)
    for r in out:
        by[r["lang"], r["source"], r["epoch"]].append(r)
    for (lang, source, epoch), part in by.items():
        whole = sizes[lang, source]
        later = (lang, source, epoch + 1) in by
        if later:
            assert sum(r["tokens"] for r in part) == whole
        assert epoch < 3 and all(0 <= r["start"] <= whole for r in part)
    assert mix(empty, ["lang", "source"], tokens_col="n_chars").count() == 0


def test_slices_do_not_show(spark, sf_dir, docs):
    df = docs.selectExpr("doc_id", "lang", "source", "n_chars AS tokens")
    one, many = (Counter(tuple(r) for r in mix(df, ["lang", "source"], share=0.6, slice_rows=s)
                         .collect()) for s in (1_000_000, 3))
    assert one == many

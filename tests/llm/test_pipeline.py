"""The stages of the corpus pipeline, each on its own input, against plain versions."""

from collections import Counter

import pytest
from conftest import *  # noqa: F401,F403
from pyspark.sql import functions as F
from test_dedup import plain_lines, plain_near

import corpus_pipeline as pipeline
from emberfold.storage import materialize


def rows(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


@pytest.fixture(scope="module")
def steps(spark, sf_dir, docs):
    """Input and output of each stage."""
    out, df = {}, docs
    for name, stage in pipeline.STAGES:
        after = materialize(stage(spark, df, sf_dir), "step")
        out[name] = (df, after)
        df = after
    return out


def test_columns(steps, docs):
    for name, (_, after) in list(steps.items())[:-1]:
        assert after.dtypes == docs.dtypes, name


def test_language_keeps_texts_with_letters(steps):
    before, after = (rows(df) for df in steps["language"])
    assert not after - before
    gone = before - after
    assert all(not any(c.isalpha() for c in t or "") for _, t in gone)


def test_lines_and_near_copies(steps):
    before, after = steps["lines"]
    want = plain_lines([(r["doc_id"], r["text"]) for r in before.collect()])
    assert rows(after) == Counter({(d, t): c for (d, t, _, _), c in want.items()})
    before, after = steps["near_copies"]
    first = {d for d, _, c in plain_near([(r["doc_id"], r["text"]) for r in before.collect()]) if d == c}
    assert {r["doc_id"] for r in after.collect()} == first


def test_mixing_and_packing(steps):
    before, after = steps["mixing"]
    size = lambda df: sum(len((t or "").split()) for _, t in rows(df).elements())
    assert not rows(after) - rows(before) and 0 < size(after) <= size(before)
    docs, pieces = steps["packing"]
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in docs.collect()}


def test_odd_and_empty_tables(spark, odd, empty, sf_dir):
    for df in (odd, empty):
        for _, stage in pipeline.STAGES:
            df = materialize(stage(spark, df, sf_dir), "odd-step")
        assert "sequence_id" in df.columns


def test_rows_without_id_are_told_apart(spark, sf_dir):
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(None, text(1)), (None, text(1)), (None, text(2)), (5, text(2)), (5, text(3)), (6, text(3)),
            (7, text(4)), (7, text(4)), (7, text(5))]
    df = spark.createDataFrame([(*r, "en", "src1", 9) for r in rows], DOCS)  # noqa: F405
    got = pipeline.near_copies(spark, df, sf_dir)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(
        [(None, text(1)), (5, text(2)), (5, text(3)), (7, text(4)), (7, text(5))])
    df = spark.createDataFrame([(None, text(k), "en", "src1", 9) for k in range(100)], DOCS)  # noqa: F405
    assert pipeline.mixing(spark, df, sf_dir).count() == 80


@pytest.mark.parametrize("labels,kept", [(1, [1, 2, 3]), (2, [3]), (4, [2, 3]), (40, [1, 2, 3])])
def test_least_score_follows_the_labels(spark, sf_dir, monkeypatch, labels, kept):
    scores = {1: 0.05, 2: 0.31, 3: 0.61}
    tagger = type("Made", (), {"labels": [str(k) for k in range(labels)]})
    monkeypatch.setattr(pipeline, "fit_tagger", lambda *_: tagger)
    monkeypatch.setattr(pipeline, "with_language", lambda df, *_, pred, score: df.withColumns(
        {pred: F.lit("0"), score: F.element_at(F.create_map(*[
            F.lit(x) for kv in scores.items() for x in kv]), F.col("doc_id").cast("int"))}))
    df = spark.createDataFrame([(k, "some words", "0", None, 10) for k in scores], DOCS)  # noqa: F405
    assert sorted(r["doc_id"] for r in pipeline.language(spark, df, sf_dir).collect()) == kept

"""Documents to packed training sequences, as stages over stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.llm.language import UNDETERMINED, fit_tagger, held_out, with_language
from emberfold.llm.mixing import mix, word_count
from emberfold.llm.queries import LEVELS, MIX_SEED, MIX_WEIGHTS, documents, domain, packed
from emberfold.llm.simhash import near_duplicates
from emberfold.llm.templates import drop_recurring_lines
from emberfold.llm.worker import attach
from emberfold.storage import materialize

# A document goes if no language reaches this many times the share that all equal ones have.
LANGUAGE_LIFT = 1.2
MIX_SHARE = 0.8


def row_key(*columns: str) -> Column:
    """A hash that only rows equal in ``columns`` share; a NULL differs from all values."""
    return F.xxhash64(*[c for name in columns for c in (F.col(name).isNull(), F.col(name))])


def least_score(labels: int) -> float:
    """The share that a document's language must reach; a single one has nothing to compare with."""
    return LANGUAGE_LIFT / labels if labels > 1 else 0.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, NULL ones among them, or without any likely language; an empty table stays so."""
    tagger = fit_tagger(docs.where(~held_out()), "doc_id", "text", "lang")
    tagged = with_language(docs, tagger, pred="_pred", score="_score")
    # without a single labelled document there is nothing to reject by but the letters
    least = least_score(len(tagger.labels)) if tagger else 0.0
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    sure = (F.col("_pred") != UNDETERMINED) & (F.col("_score") >= least)
    return tagged.where(sure if tagger else has_letter).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes recurring lines from the texts; every document stays, ``n_chars`` follows. NULL texts stay NULL."""
    kept = drop_recurring_lines(docs, n_lines="_lines", n_dropped="_dropped")
    return kept.withColumn("n_chars", F.when(F.col("_dropped") > 0, F.length("text")).otherwise(
        F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate group, the one with the smallest id.

    A row without an id stays only if no row of its group has one. Among rows that share the
    id, or have none, a hash of id and text decides; of rows equal in both one stays.
    """
    rows = docs.withColumn("_key", row_key("doc_id", "text"))
    group = near_duplicates(rows, "_key", shingle=4, max_bits=4).select(
        F.col("doc_id").alias("_key"), "component_id").distinct()
    keys = rows.groupBy("_key").agg(F.min("doc_id").alias("_doc"), F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct(F.col("_doc").isNull().alias("_none"), "_doc", "_key", "_n"))
    keep = group.join(keys, "_key").groupBy("component_id").agg(best.alias("b")).select("b._key", "b._n")
    keep = materialize(keep, "kept-keys")
    kept = attach(rows, keep.where(F.col("_n") == 1).select("_key"), "_key", "kept-rows", "left_semi",
                  row_bytes=32)
    repeated = keep.where(F.col("_n") > 1).select("_key")
    if repeated.head(1):
        kept = kept.unionByName(attach(rows, repeated, "_key", "repeated-rows", "left_semi",
                                       row_bytes=32).dropDuplicates(["_key"]))
    return kept.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that fill the leaves' budgets in a single epoch.

    Rows are chosen by a hash of id, text, language and source, so that rows without an id are
    told apart; rows equal in all four go together. Rows without a language or source are leaves of their
    own; an empty table stays so.
    """
    rows = docs.withColumn("_key", row_key("doc_id", "text", "lang", "source"))
    counted = rows.select("_key", domain().alias("domain"), "lang", "source",
                          word_count(F.col("text")).alias("tokens"))
    chosen = mix(counted, LEVELS, share=MIX_SHARE, weights=MIX_WEIGHTS, max_epochs=1, seed=MIX_SEED,
                 id_col="_key")
    keep = chosen.select("_key").distinct()
    return attach(rows, keep, "_key", "mixed-keys", how="left_semi", row_bytes=32).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in training sequences; NULL and empty texts have the end id alone."""
    # workers that have served the stages before hold their memories: smaller batches leave them room
    return packed(docs, batch_bytes=4 << 20)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies),
          ("mixing", mixing), ("packing", packing)]

# The language model, the templates and the fingerprints are beyond SQL; tests/llm compares
# the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each over what the one before wrote.

    NULL and empty texts are rejected by the first stage; an empty table gives no rows.
    """
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""One registered query per operator, over whole tables, with SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.llm.alignment import align_documents
from emberfold.llm.language import fit_tagger, held_out, with_language
from emberfold.llm.licenses import license_labels, scan_licenses
from emberfold.llm.mixing import mix, word_count
from emberfold.llm.multi_index import nearest
from emberfold.llm.ngrams import score_documents
from emberfold.llm.packing import BATCH_BYTES, Limits, pack_texts
from emberfold.llm.pivots import highest_products
from emberfold.llm.simhash import near_duplicates
from emberfold.llm.substring import drop_repeated_passages
from emberfold.llm.templates import drop_recurring_lines
from emberfold.llm.tokenfile import read_tokens, write_tokens
from emberfold.llm.tokens import default_tokenizer, piece_model
from emberfold.llm.whitening import whiten
from emberfold.llm.worker import with_ids_crc32
from emberfold.storage import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_language")
def op1(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    tagger = fit_tagger(docs.where(~held_out()), "doc_id", "text", "lang")
    return with_language(docs.select("doc_id", "text"), tagger).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op2_token_files")
def op2(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write_tokens(documents(spark, sf_dir), path, default_tokenizer(), end_id=0,
                 keep=["lang", "source"])
    return with_ids_crc32(read_tokens(spark, path))


@query("op3_simhash")
def op3(spark, sf_dir):
    found = near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


@query("op4_substrings")
def op4(spark, sf_dir):
    kept = drop_repeated_passages(documents(spark, sf_dir), window=20)
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


# English texts bear loss, the others are context; a sequence takes three quarters of loss at most.
LOSS = "lang = 'en'"
PACK_LIMITS = Limits(tokens=2048, segments=128, loss=1536)


def packed(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    return pack_texts(docs.withColumn("_bears_loss", F.expr(LOSS)), default_tokenizer(), end_id=1,
                      loss_col="_bears_loss", limits=PACK_LIMITS, batch_bytes=batch_bytes)


@query("op5_packing")
def op5(spark, sf_dir):
    return with_ids_crc32(packed(documents(spark, sf_dir), batch_bytes=14 << 20))


@query("op6_line_templates")
def op6(spark, sf_dir):
    kept = drop_recurring_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped",
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = {"domain": {"first": 3, "second": 1}, "lang": {"en": 2, "de": 1, "es": 1, "fr": 1}}
MIX_SEED = 7


def domain(source: str = "source"):
    """The two halves of the sources, by the last character of their name."""
    return F.when(F.substring(source, -1, 1) < "5", "first").when(
        F.col(source).isNotNull(), "second")


def sql_share(table: str, parents: list[str], node: str, out: str) -> str:
    """Water-filling of one level of the tree, as common table expressions."""
    by = ", ".join(parents)
    return f"""
{out}_c AS (SELECT *, coalesce(sum(capacity) OVER (PARTITION BY {by}
      ORDER BY capacity / weight, {node} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
    sum(weight) OVER (PARTITION BY {by} ORDER BY capacity / weight, {node}
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w FROM {table}),
{out}_s AS (SELECT *, capacity * w <= weight * (budget - c) AS is_full FROM {out}_c),
{out}_m AS (SELECT *, min(CASE WHEN NOT is_full THEN c END) OVER (PARTITION BY {by}) AS sc,
    max(CASE WHEN NOT is_full THEN w END) OVER (PARTITION BY {by}) AS sw FROM {out}_s),
{out} AS (SELECT {by}, {node}, CASE WHEN is_full THEN capacity ELSE
    least(capacity, floor(weight * (budget - sc) / sw)) END AS budget FROM {out}_m)"""


SQL_MIX = f"""
WITH d AS (SELECT 0 AS top, CASE WHEN right(source, 1) < '5' THEN 'first' ELSE 'second' END AS domain,
    lang, source, doc_id,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents),
leaves AS (SELECT top, domain, lang, source, sum(n)::BIGINT AS tokens FROM d GROUP BY ALL),
total AS (SELECT least(floor(sum(tokens) * 0.5), sum(tokens) * 4)::BIGINT AS budget FROM leaves),
n1 AS (SELECT top, domain, sum(tokens * 4)::BIGINT AS capacity,
    CASE domain WHEN 'first' THEN 3 ELSE 1 END AS weight, any_value(budget) AS budget
    FROM leaves, total GROUP BY top, domain),
{sql_share("n1", ["top"], "domain", "b1")},
n2 AS (SELECT l.top, l.domain, l.lang, sum(tokens * 4)::BIGINT AS capacity,
    CASE l.lang WHEN 'en' THEN 2 ELSE 1 END AS weight, any_value(budget) AS budget
    FROM leaves l JOIN b1 USING (top, domain) GROUP BY l.top, l.domain, l.lang),
{sql_share("n2", ["top", "domain"], "lang", "b2")},
n3 AS (SELECT l.top, l.domain, l.lang, l.source, (tokens * 4)::BIGINT AS capacity, 1 AS weight, budget
    FROM leaves l JOIN b2 USING (top, domain, lang)),
{sql_share("n3", ["top", "domain", "lang"], "source", "b3")},
plan AS (SELECT l.*, budget::BIGINT AS budget FROM leaves l JOIN b3 USING (top, domain, lang, source)
    WHERE budget > 0),
reads AS (SELECT *, least(tokens, budget - epoch * tokens) AS wanted FROM (SELECT *,
    unnest(range(0, CAST(ceil(budget / tokens) AS BIGINT))) AS epoch FROM plan)),
placed AS (SELECT d.*, epoch, wanted, ('0x' || substr(md5('7|' || epoch || '|' || doc_id), 1, 15))::BIGINT
    AS p FROM d JOIN reads USING (domain, lang, source)),
run AS (SELECT *, sum(n) OVER (PARTITION BY domain, lang, source, epoch ORDER BY p, doc_id
    ROWS UNBOUNDED PRECEDING) - n AS s FROM placed)
SELECT domain, lang, source, doc_id, n::BIGINT AS tokens, epoch, s::BIGINT AS start FROM run WHERE s < wanted
"""


@query("op7_mixing", SQL_MIX)
def op7(spark, sf_dir):
    docs = documents(spark, sf_dir).select(
        "doc_id", domain().alias("domain"), "lang", "source", word_count(F.col("text")).alias("tokens"))
    return mix(docs, LEVELS, share=0.5, weights=MIX_WEIGHTS, max_epochs=4, seed=MIX_SEED)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


@query("op8_multi_index")
def op8(spark, sf_dir):
    return nearest(embeddings(spark, sf_dir), "id % 50 = 0", k=5).withColumnRenamed("id", "vec_id")


SQL_SCORES = """
WITH lists AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
w AS (SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS i FROM lists),
n AS (SELECT count(*) AS n FROM w),
uni AS (SELECT w, count(*) AS c FROM w GROUP BY w),
pairs AS (SELECT *, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM w),
bi AS (SELECT b, w, count(*) AS c FROM pairs WHERE b IS NOT NULL GROUP BY b, w HAVING count(*) >= 2),
scored AS (SELECT doc_id, i > 1 AND bi.c IS NULL AS backs, CASE WHEN i = 1 THEN ln(uni.c) - ln(n)
    WHEN bi.c IS NULL THEN ln(0.4) + ln(uni.c) - ln(n) ELSE ln(bi.c / before.c) END AS s
  FROM pairs JOIN uni USING (w) CROSS JOIN n LEFT JOIN bi ON bi.b = pairs.b AND bi.w = pairs.w
  LEFT JOIN uni AS before ON before.w = pairs.b),
sums AS (SELECT doc_id, count(*) AS k, count_if(backs) AS b, round(sum(s), 6) AS logp FROM scored GROUP BY doc_id)
SELECT doc_id, coalesce(k, 0)::BIGINT AS n_words, coalesce(b, 0)::BIGINT AS n_backoff,
  coalesce(logp, 0.0) AS logp, CASE WHEN k > 0 THEN round(exp(-logp / k), 3) END AS perplexity
FROM lists LEFT JOIN sums USING (doc_id)
"""


@query("op9_backoff_scores", SQL_SCORES)
def op9(spark, sf_dir):
    return score_documents(documents(spark, sf_dir))


@query("op10_pivot_search")
def op10(spark, sf_dir):
    return highest_products(embeddings(spark, sf_dir), "id % 50 = 0", k=5).withColumnRenamed(
        "id", "vec_id")


@query("op11_alignment")
def op11(spark, sf_dir):
    return align_documents(documents(spark, sf_dir), default_tokenizer(), piece_model())


@query("op12_whitening")
def op12(spark, sf_dir):
    return whiten(embeddings(spark, sf_dir))


@query("op13_licenses")
def op13(spark, sf_dir):
    return license_labels(scan_licenses(documents(spark, sf_dir)))

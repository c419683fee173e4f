"""Models, metrics, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberfold.functions.fire import fire_codes
from emberfold.functions.scalars import threshold_label
from emberfold.operators import learn
from emberfold.queries.base import amount, query, sql_money, table
from emberfold.queries.weather import READINGS_SQL, float_codes_sql, readings
from emberfold.sources.files import (TESTING_FOLDER, TRAINING_FOLDER, image_labels, read_csv,
                                     read_images)
from emberfold.storage import scratch_path


_PLANE_SQL = f"""
    SELECT event_id, round(0.4 * isi::DOUBLE + 0.2 * bui::DOUBLE + 0.05 * temperature::DOUBLE
                           - 0.03 * rh::DOUBLE + 1.5, 4) AS prediction
    FROM {float_codes_sql(READINGS_SQL)} x"""


def _known(coded):
    """With a target that is a plane over the features, so a right fit returns the plane."""
    return coded.withColumn("fwi", sum(
        [F.lit(a) * F.col(c).cast("double") for c, a in
         (("isi", 0.4), ("bui", 0.2), ("temperature", 0.05), ("rh", -0.03))], F.lit(1.5)))


def _predictions(scored):
    return scored.select("event_id", F.round("prediction", 4).alias("prediction"))


@query("m1_regression", _PLANE_SQL)
def m1_regression(spark, sf_dir):
    coded = fire_codes(readings(spark, sf_dir), F.col("month"))
    train, _ = learn.train_test_split(_known(coded), "event_id")
    return _predictions(learn.score(learn.fit_regression(train), coded))


@query("a14_csv_training", _PLANE_SQL)
def a14_csv_training(spark, sf_dir):
    """Trained and scored on what a CSV file holds."""
    path = scratch_path(spark, "training-csv")
    known = _known(fire_codes(readings(spark, sf_dir), F.col("month"))).select(
        "event_id", *learn.FIRE_FEATURES, learn.FIRE_TARGET)
    known.write.option("header", True).csv(path)
    stored = read_csv(spark, path, schema=known.schema)
    train, _ = learn.train_test_split(stored, "event_id")
    return _predictions(learn.score(learn.fit_regression(train), stored))


@query("m4_stream_scoring", _PLANE_SQL)
def m4_stream_scoring(spark, sf_dir):
    """Trained on a table, scored on a stream of readings without codes."""
    out = scratch_path(spark, "scored")
    readings(spark, sf_dir).write.parquet(out + "-landed")
    landed = spark.read.schema(readings(spark, sf_dir).schema).parquet(out + "-landed")
    train, _ = learn.train_test_split(_known(fire_codes(landed, F.col("month"))), "event_id")
    model = learn.fit_regression(train)
    stream = spark.readStream.schema(landed.schema).parquet(out + "-landed")
    scored = _predictions(learn.score(model, fire_codes(stream, F.col("month"))))
    scored.writeStream.format("parquet").option("checkpointLocation", out + "-checkpoint").trigger(
        availableNow=True).start(out).awaitTermination()
    return spark.read.schema(scored.schema).parquet(out)


@query("m2_split", """
    SELECT event_id, CAST(('0x' || substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT)
                       % 10000 < 7500 AS is_train
    FROM events""")
def m2_split(spark, sf_dir):
    train, test = learn.train_test_split(
        table(spark, sf_dir, "events").select("event_id"), "event_id")
    return train.withColumn("is_train", F.lit(True)).unionByName(
        test.withColumn("is_train", F.lit(False)))


_PLACED_SQL = """(SELECT event_id, row_number() OVER (ORDER BY
    ('0x' || substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 15))::BIGINT) AS n FROM events)"""


@query("l5_exact_split", f"""
    SELECT event_id, CAST(CASE WHEN n <= 401 THEN 0 WHEN n <= 588 THEN 1 END AS INTEGER) AS split
    FROM {_PLACED_SQL} p""")
def l5_exact_split(spark, sf_dir):
    return learn.exact_split(table(spark, sf_dir, "events").select("event_id"), "event_id", [401, 187])


@query("m3_regression_metrics", """
    SELECT COUNT(*) AS n, round(AVG(abs(value - k)), 6) AS mae,
           round(AVG((value - k) * (value - k)), 6) AS mse,
           round(sqrt(AVG((value - k) * (value - k))), 6) AS rmse,
           round(1 - AVG((value - k) * (value - k)) / var_pop(value), 6) AS r2
    FROM (SELECT value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events) e""")
def m3_regression_metrics(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    metrics = learn.regression_metrics(events, "value", "k")
    return metrics.select(
        "n", *[F.round(c, 6).alias(c) for c in ("mae", "mse", "rmse", "r2")])


# The class is the sign of one coordinate, moved off zero by row key on every row.
@query("m5_vector_classifier", """
    SELECT vec_id, CAST(vec_id % 2 AS INTEGER) AS y,
           CASE WHEN vec_id % 2 = 1 THEN 'upper' ELSE 'lower' END AS decision FROM embeddings""")
def m5_vector_classifier(spark, sf_dir):
    odd = F.col("vec_id") % 2 == 1
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", odd.cast("int").alias("y"), F.transform(
        "embedding", lambda x, i: x + F.when(i == 3, F.when(odd, 3.0).otherwise(-3.0)).otherwise(
            0.0)).alias("embedding"))
    train, _ = learn.train_test_split(vectors, "vec_id")
    model = learn.fit_vector_classifier(train, "embedding", "y", dim=64)
    scored = learn.score_vectors(model, vectors, "embedding")
    return scored.select(
        "vec_id", "y", threshold_label(F.col("probability"), "upper", "lower").alias("decision"))


_PROBABILITY_SQL = """(SELECT d.doc_id, l.quality, ((d.doc_id * 37) % 1009) / 1009.0::DOUBLE AS p
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def _probabilities(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels"), "doc_id", "left").select(
        "doc_id", "quality", (((F.col("doc_id") * 37) % 1009) / 1009.0).alias("p"))


@query("m6_binary_metrics", f"""
    SELECT n, unused, tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision,
           round(tp / (tp + fn), 6) AS recall, round((tp + tn) / n, 6) AS accuracy
    FROM (SELECT COUNT(quality) AS n, COUNT(*) FILTER (quality IS NULL) AS unused,
                 COUNT(*) FILTER (p > 0.5 AND quality = 1) AS tp,
                 COUNT(*) FILTER (p > 0.5 AND quality <> 1) AS fp,
                 COUNT(*) FILTER (p <= 0.5 AND quality = 1) AS fn,
                 COUNT(*) FILTER (p <= 0.5 AND quality <> 1) AS tn
          FROM {_PROBABILITY_SQL} q) c""")
def m6_binary_metrics(spark, sf_dir):
    metrics = learn.binary_metrics(_probabilities(spark, sf_dir), "quality", "p")
    return metrics.select("n", "unused", "tp", "fp", "fn", "tn", *[
        F.round(c, 6).alias(c) for c in ("precision", "recall", "accuracy")])


_RUNS_SQL = f"""(SELECT event_type AS experiment, 'run-' || user_id AS run_id,
    {sql_money('value')} AS rmse, COUNT(*) AS accuracy
  FROM events GROUP BY event_type, user_id)"""


@query("m7_best_run", f"""
    SELECT experiment, 'rmse' AS metric, min_by(run_id, (rmse, run_id)) AS run_id,
           MIN(rmse) AS value FROM {_RUNS_SQL} r GROUP BY experiment
    UNION ALL
    SELECT experiment, 'accuracy', min_by(run_id, (-accuracy, run_id)),
           CAST(MAX(accuracy) AS DOUBLE) FROM {_RUNS_SQL} r GROUP BY experiment""")
def m7_best_run(spark, sf_dir):
    per_run = table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("experiment"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id")).agg(
        (F.sum(amount("value")) / 100.0).alias("rmse"),
        F.count(F.lit(1)).cast("double").alias("accuracy"))
    runs = per_run.unpivot(["experiment", "run_id"], ["rmse", "accuracy"], "metric", "value")
    best = [learn.best_run(runs, m, descending).select(
        "experiment", F.lit(m).alias("metric"), "run_id", "value")
        for m, descending in (("rmse", False), ("accuracy", True))]
    return best[0].unionByName(best[1])


@query("m10_run_log", f"""
    SELECT 'events' AS experiment, min_by(run_id, (value, run_id)) AS run_id, MIN(value) AS value
    FROM (SELECT 'run-' || event_type AS run_id, {sql_money('value')} AS value
          FROM events GROUP BY event_type) r""")
def m10_run_log(spark, sf_dir):
    """One logged run per event type, of which there are a handful; the best from the stored log."""
    path = scratch_path(spark, "runs")
    totals = table(spark, sf_dir, "events").groupBy("event_type").agg((F.sum(amount("value")) / 100.0).alias("total"))
    learn.log_runs(spark, path, "events", {
        f"run-{r['event_type']}": ({"type": r["event_type"]}, {"rmse": r["total"], "other": 0.0}) for r in totals.collect()})
    return learn.best_run(spark.read.parquet(path), "rmse", False)


_TREE = [(split, label) for split in (TESTING_FOLDER, TRAINING_FOLDER) for label in ("fire", "nofire")]


@query("a13_image_tree", """
    SELECT CASE WHEN page_id % 3 = 0 THEN 'test' ELSE 'train' END AS split,
           CASE WHEN length(html) % 2 = 0 THEN 'fire' ELSE 'nofire' END AS label,
           CAST(SUM(coalesce(strlen(html), 0) + 1) AS BIGINT) AS bytes
    FROM pages GROUP BY 1, 2""")
def a13_image_tree(spark, sf_dir):
    """Pages written as files of an image tree, scanned without their contents."""
    root = scratch_path(spark, "images")
    pages = table(spark, sf_dir, "pages").select(
        "html", F.when(F.col("page_id") % 3 == 0, TESTING_FOLDER).otherwise(TRAINING_FOLDER).alias("split"),
        F.when(F.length("html") % 2 == 0, "fire").otherwise("nofire").alias("label"))
    for split, label in _TREE:
        pages.where((F.col("split") == split) & (F.col("label") == label)).select("html").write.text(
            f"{root}/{split}/{label}")
    found = read_images(spark, root).where("length > 0")
    return found.groupBy("split", "label").agg(F.sum("length").alias("bytes"))


@query("m8_label_from_path", """
    SELECT CASE WHEN page_id % 3 = 0 THEN 'test' ELSE 'train' END AS split,
           CASE WHEN length(html) % 2 = 0 THEN 'fire' ELSE 'nofire' END AS label,
           COUNT(*) AS files, COUNT(DISTINCT page_id) AS names
    FROM pages GROUP BY 1, 2""")
def m8_label_from_path(spark, sf_dir):
    page = F.col("page_id")
    path = F.concat(
        F.lit("bronze/forest_fire/"),
        F.when(page % 3 == 0, TESTING_FOLDER).otherwise(TRAINING_FOLDER), F.lit("/"),
        F.when(F.length("html") % 2 == 0, "fire").otherwise("nofire"), F.lit("/"),
        page.cast("string"), F.lit(".jpg"))
    images = table(spark, sf_dir, "pages").select(path.alias("path"))
    return images.withColumns(image_labels(F.col("path"))).groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("files"), F.countDistinct("file").alias("names"))


@query("m9_threshold_label", f"""
    SELECT doc_id, CASE WHEN p > 0.5 THEN 'No Fire' ELSE 'Fire' END AS decision
    FROM (SELECT doc_id, ((doc_id * 37) % 1009) / 1009.0::DOUBLE AS p FROM documents) q""")
def m9_threshold_label(spark, sf_dir):
    p = (((F.col("doc_id") * 37) % 1009) / 1009.0).alias("p")
    return table(spark, sf_dir, "documents").select("doc_id", p).select(
        "doc_id", threshold_label(F.col("p"), "No Fire", "Fire").alias("decision"))

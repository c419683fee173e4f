"""Regression and classification over tables, their metrics and run records."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.storage import materialize

# Model inputs in order, and the target.
FIRE_FEATURES = ["temperature", "rh", "ws", "rain", "ffmc", "dmc", "dc", "isi", "bui"]
FIRE_TARGET = "fwi"


def split_bucket(key: Column, buckets: int = 100, seed: int = 42) -> Column:
    """Bucket of a row from its id alone: the same in every run, layout and engine."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def train_test_split(df: DataFrame, key: str, train_share: float = 0.75,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    is_train = split_bucket(F.col(key), 10_000, seed) < round(train_share * 10_000)
    return df.where(is_train), df.where(~is_train)


# Bins of one count, and rows whose places are sorted on the driver once a bin is that small.
_BINS_BITS, _FEW_ROWS = 12, 4_096
_PLACE_BITS = 60


def split_place(key: Column, seed: int = 42) -> Column:
    """Place of a row in a seeded order, a whole number of 60 bits from its id alone."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, _PLACE_BITS // 4), 16, 10).cast("bigint")


def nth_place(df: DataFrame, place: str, rank: int) -> tuple[int, int, int]:
    """The value of rank ``rank`` in the order of ``place``, rows below it, and rows that have it.

    Counts histograms of ever narrower bins, 4,096 rows of which reach the driver; the rows are
    neither sorted nor moved.
    """
    at, below, low, width = F.col(place), 0, 0, 1 << _PLACE_BITS
    n = None
    while width > 1:
        inside = df.where((at >= low) & (at < low + width))
        if n is not None and n <= _FEW_ROWS:
            values = sorted(r[0] for r in inside.select(place).collect())
            value = values[rank - below - 1]
            return value, below + sum(v < value for v in values), values.count(value)
        step = max(1, width >> _BINS_BITS)
        bins = inside.groupBy(F.floor((at - low) / step).alias("b") if step == 1 else F.shiftright(
            at - low, step.bit_length() - 1).alias("b")).count().collect()
        for b, n in sorted(map(tuple, bins)):
            if below + n >= rank:
                low, width = low + b * step, step
                break
            below += n
    return low, below, n


def exact_split(df: DataFrame, key: str, counts: Sequence[int], seed: int = 42,
                column: str = "split") -> DataFrame:
    """Add ``column``: 0 for the first ``counts[0]`` rows of a seeded order, 1 for the next ``counts[1]``, NULL for the rest.

    The order is that of a hash of ``key``, among equal keys of a hash of the row; equal rows take any
    order. Exactly as many rows as asked for, or what there is. ``df`` is read a few times and has to
    give the same rows each time.
    """
    ordered = df.withColumns({"_p": split_place(F.coalesce(F.col(key).cast("string"), F.lit("")), seed),
                              "_q": F.shiftrightunsigned(F.xxhash64(*df.columns), 64 - _PLACE_BITS)})
    total, cut, cuts = ordered.count(), 0, []
    for n in counts:
        cut += n
        if 0 < cut < total:
            p, below, same = nth_place(ordered, "_p", cut)
            q, less, same = nth_place(ordered.where(F.col("_p") == p), "_q", cut - below)
            # equal rows take the ranks from first + 1 to first + same
            cuts.append((p, q, below + less, same, cut))
        else:
            cuts.append((-1, -1, 0, 0, cut) if cut <= 0 else (1 << _PLACE_BITS, 0, total, 0, cut))
    split = F.lit(None).cast("int")
    for i, (p, q, first, same, cut) in reversed(list(enumerate(cuts))):
        inside = (F.col("_p") < p) | ((F.col("_p") == p) & (F.col("_q") <= q))
        split = F.when(inside, i).otherwise(split)
    parted = sorted({(p, q, first, same) for p, q, first, same, cut in cuts if first < cut < first + same})
    tagged = ordered.withColumn(column, split)
    if not parted:
        return tagged.drop("_p", "_q")
    # a cut runs through equal rows: they are counted and dealt out again, in blocks
    apart = F.lit(False)
    for p, q, _, _ in parted:
        apart = apart | ((F.col("_p") == p) & (F.col("_q") == q))
    out = tagged.where(~apart).drop("_p", "_q")
    for p, q, first, same in parted:
        one = ordered.where((F.col("_p") == p) & (F.col("_q") == q)).drop("_p", "_q").limit(1)
        bounds = [0, *[min(max(c[4] - first, 0), same) for c in cuts], same]
        shares = [(i if i < len(counts) else None, a, b) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]
        dealt = one.select("*", F.inline(F.array(*[F.struct(
            F.lit(i).cast("int").alias(column), F.lit(a).cast("bigint").alias("_a"), F.lit(b).cast("bigint").alias("_b"))
            for i, a, b in shares])))
        blocks = dealt.withColumn("_a", F.explode(F.sequence("_a", F.col("_b") - 1, F.lit(10_000).cast("bigint"))))
        out = out.unionByName(blocks.hint("rebalance").withColumn("_n", F.explode(F.sequence(
            "_a", F.least(F.col("_a") + 10_000, F.col("_b")) - 1))).select(*df.columns, column))
    return out


def fit_regression(train: DataFrame, features: Sequence[str] = FIRE_FEATURES,
                   label: str = FIRE_TARGET) -> PipelineModel:
    """Standardise, then ordinary least squares on the complete rows.

    The inputs are stored first, since scaling and fitting each read them. The
    normal equations need a matrix of features x features, whatever the number
    of rows.
    """
    columns = [*features, label]
    rows = materialize(train.select(*columns), "regression-rows").dropna(subset=columns)
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        LinearRegression(featuresCol="_scaled", labelCol=label, predictionCol="prediction",
                         regParam=0.0, solver="normal"),
    ]
    return Pipeline(stages=stages).fit(rows)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction``, on a table or a stream; NULL where a feature is missing."""
    scored = model.transform(df).drop("_raw", "_scaled")
    return scored.withColumn("prediction", F.nanvl("prediction", F.lit(None).cast("double")))


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: ``n, mae, mse, rmse, r2``."""
    error = F.col(label) - F.col(prediction)
    sums = df.agg(
        F.count(error).alias("n"), F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(F.when(error.isNotNull(), F.col(label))).alias("_var"))
    return sums.select(
        "n", "mae", "mse", F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_var"))).alias("r2"))


def binary_metrics(df: DataFrame, label: str, probability: str,
                   threshold: float = 0.5) -> DataFrame:
    """One row: ``n, unused, tp, fp, fn, tn, precision, recall, accuracy``.

    Rows without a label or a probability are counted as ``unused`` and nowhere else.
    """
    said, true = F.col(probability) > threshold, F.col(label) == 1
    usable = said.isNotNull() & true.isNotNull()
    counts = df.agg(
        F.count_if(usable).alias("n"), F.count_if(~usable).alias("unused"),
        *[F.coalesce(F.sum(cell.cast("bigint")), F.lit(0).cast("bigint")).alias(name)
          for name, cell in (("tp", said & true), ("fp", said & ~true),
                             ("fn", ~said & true), ("tn", ~said & ~true))])
    return counts.withColumns({
        "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
        "accuracy": F.try_divide(F.col("tp") + F.col("tn"), F.col("n")),
    })


def fit_vector_classifier(train: DataFrame, vector: str, label: str, dim: int,
                          hidden: int | None = None, max_iter: int = 50,
                          seed: int = 42) -> PipelineModel:
    """Two-class head over precomputed feature vectors (``array<float>``).

    Without ``hidden`` a logistic regression, else one hidden layer of that width.
    """
    shaped = with_vector(materialize(train.select(vector, label), "classifier-rows"), vector)
    if hidden is None:
        head = LogisticRegression(featuresCol="_vector", labelCol=label, maxIter=max_iter,
                                  probabilityCol="_probability", rawPredictionCol="_raw")
    else:
        head = MultilayerPerceptronClassifier(
            featuresCol="_vector", labelCol=label, layers=[dim, hidden, 2], maxIter=max_iter,
            seed=seed, probabilityCol="_probability", rawPredictionCol="_raw")
    return Pipeline(stages=[head]).fit(shaped)


def with_vector(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("_vector", array_to_vector(F.col(vector)))


def score_vectors(model: PipelineModel, df: DataFrame, vector: str) -> DataFrame:
    """Add ``probability`` of class 1."""
    scored = model.transform(with_vector(df, vector))
    return scored.withColumn(
        "probability", vector_to_array("_probability")[1]).drop(
        "_vector", "_raw", "_probability", "prediction")


RUNS_SCHEMA = ("experiment string, run_id string, params string, metric string, value double, "
               "model_path string, signature string, logged_at timestamp")


def log_run(spark: SparkSession, path: str, experiment: str, run_id: str,
            params: Mapping[str, object], metrics: Mapping[str, float],
            model: PipelineModel | None = None, model_root: str | None = None,
            signature: Mapping[str, Sequence[str]] | None = None) -> str | None:
    """Save the model and append one row per metric to the runs table."""
    model_path = None
    if model is not None:
        model_path = f"{model_root or path + '-models'}/{experiment}/{run_id}"
        model.write().overwrite().save(model_path)
    log_runs(spark, path, experiment, {run_id: (params, metrics)}, {run_id: model_path}, {run_id: signature})
    return model_path


def log_runs(spark: SparkSession, path: str, experiment: str,
             runs: Mapping[str, tuple[Mapping[str, object], Mapping[str, float]]],
             model_paths: Mapping[str, str | None] | None = None,
             signatures: Mapping[str, Mapping[str, Sequence[str]] | None] | None = None) -> None:
    """Append the parameters and metrics of many runs to the runs table, in one write."""
    paths, signed = model_paths or {}, signatures or {}
    rows = [(experiment, run_id, json.dumps(params, sort_keys=True, default=str), name, float(value),
             paths.get(run_id), json.dumps(signed.get(run_id), sort_keys=True))
            for run_id, (params, metrics) in runs.items() for name, value in metrics.items()]
    fields = RUNS_SCHEMA.rsplit(",", 1)[0]
    spark.createDataFrame(rows, fields).withColumn(
        "logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def best_run(runs: DataFrame, metric: str, descending: bool) -> DataFrame:
    """The run with the best ``metric`` of every experiment; ties go to the smaller id."""
    value = -F.col("value") if descending else F.col("value")
    return (
        runs.where((F.col("metric") == metric) & F.col("value").isNotNull())
        .groupBy("experiment")
        .agg(F.min_by(F.struct("run_id", "value"), F.struct(value, "run_id")).alias("best"))
        .select("experiment", "best.*"))

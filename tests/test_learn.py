"""Models against closed forms."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from emberfold.operators import learn
from emberfold.storage import scratch_path


def test_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 9)) * [5, 10, 3, 1, 8, 4, 9, 2, 3] + 20
    y = x @ rng.normal(size=9) + rng.normal(size=400)
    names = learn.FIRE_FEATURES
    df = spark.createDataFrame(
        [(i, *map(float, row), float(t)) for i, (row, t) in enumerate(zip(x, y))],
        ["id", *names, "fwi"])
    model = learn.fit_regression(df)
    got = np.array([r[0] for r in learn.score(model, df).orderBy("id").select("prediction").collect()])
    design = np.column_stack([x, np.ones(400)])
    want = design @ np.linalg.lstsq(design, y, rcond=None)[0]
    assert np.allclose(got, want, atol=1e-6)

    metrics = learn.regression_metrics(learn.score(model, df), "fwi").first()
    assert metrics["mse"] == pytest.approx(np.mean((y - want) ** 2))
    assert metrics["r2"] == pytest.approx(1 - np.mean((y - want) ** 2) / np.var(y))
    assert metrics["rmse"] == pytest.approx(metrics["mse"] ** 0.5)

    runs = scratch_path(spark, "t-runs")
    for run, rmse in (("a", 2.0), ("b", metrics["rmse"])):
        path = learn.log_run(spark, runs, "fire_weather", run, {"test_size": 0.25},
                             {"rmse": rmse, "mae": metrics["mae"]}, model,
                             signature={"inputs": names})
    best = learn.best_run(spark.read.parquet(runs), "rmse", descending=False).first()
    assert (best["run_id"], best["value"]) == ("b", pytest.approx(metrics["rmse"]))
    loaded = PipelineModel.load(path)
    assert learn.score(loaded, df).orderBy("id").first()["prediction"] == pytest.approx(want[0])

    holes = df.limit(1).withColumn("rh", F.lit(None).cast("double"))
    assert learn.score(model, holes).first()["prediction"] is None


def test_split_is_stable(spark):
    ids = spark.range(4000)
    train, test = learn.train_test_split(ids, "id")
    assert train.count() + test.count() == 4000 and abs(train.count() - 3000) < 120
    again, _ = learn.train_test_split(ids.repartition(9), "id")
    assert train.exceptAll(again).isEmpty()


def test_binary_metrics(spark):
    df = spark.createDataFrame(
        [(1, 0.9), (1, 0.5), (0, 0.6), (0, 0.1), (1, 0.7)], "y int, p double")
    m = learn.binary_metrics(df, "y", "p").first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (2, 1, 1, 1)
    assert m["precision"] == pytest.approx(2 / 3) and m["accuracy"] == pytest.approx(3 / 5)


@pytest.mark.parametrize("hidden", [None, 8])
def test_classifier_separates(spark, hidden):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(2.0 if i % 2 else -2.0, 0.5, size=4)], i % 2)
            for i in range(200)]
    df = spark.createDataFrame(rows, "id int, v array<float>, y int")
    model = learn.fit_vector_classifier(df, "v", "y", dim=4, hidden=hidden)
    scored = learn.score_vectors(model, df, "v")
    assert learn.binary_metrics(scored, "y", "probability").first()["accuracy"] > 0.98

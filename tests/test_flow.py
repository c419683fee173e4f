"""The whole batch flow from CSV files to checked gold tables."""

import uuid

import pytest
from pyspark.sql import functions as F

from emberfold.operators.quality import QualityGateError
from emberfold.plans.flow import FEEDS, read_feeds, run_batch
from emberfold.queries import feeds, hazards
from emberfold.sources.files import bronze_manifest, read_images
from emberfold.sources.tables import publish, read_table
from emberfold.storage import scratch_path


@pytest.fixture(scope="module")
def bronze(spark, sf_dir):
    root = scratch_path(spark, "t-bronze")
    shaped = {"earthquake": feeds.earthquakes, "tsunami": feeds.tsunamis,
              "landslide": feeds.landslides, "volcano": feeds.volcanoes}
    for name, (path, sep) in FEEDS.items():
        shaped[name](spark, sf_dir).coalesce(2).write.options(header=True, sep=sep).csv(
            f"{root}/{path}")
    return root


def names():
    tag = uuid.uuid4().hex[:8]
    return {"silver_schema": f"silver_{tag}", "gold_schema": f"gold_{tag}"}


def test_flow_stores_results_before_the_gate_fails(spark, bronze):
    schemas, root = names(), scratch_path(spark, "t-flow")
    with pytest.raises(QualityGateError, match="constraints failed"):
        run_batch(spark, read_feeds(spark, bronze), root, **schemas)
    results = spark.table(f"{schemas['gold_schema']}.check_results")
    assert results.count() == 73
    failed = {(r["check"], r["constraint"]) for r in
              results.where("constraint_status <> 'Success'").collect()}
    # dirt that the feeds carry on purpose; everything else has to hold
    assert ("fact_earthquake", "complete(date_key)") in failed
    assert not any(check.startswith("dim_") for check, _ in failed - {
        ("dim_volcano", "Elevation Must Be Positive")})
    assert not any("Key Missing in dim_l" in c or "Key Missing in dim_t" in c for _, c in failed)


def test_csv_flow_equals_direct_flow(spark, sf_dir, bronze):
    from emberfold.plans.cleaning import clean_volcanoes
    direct = clean_volcanoes(feeds.volcanoes(spark, sf_dir))
    read = clean_volcanoes(read_feeds(spark, bronze)["volcano"])
    assert direct.exceptAll(read).isEmpty() and read.exceptAll(direct).isEmpty()


def test_narrow_keys_are_the_plain_hash(spark, bronze):
    gold = run_batch(spark, read_feeds(spark, bronze), scratch_path(spark, "t-narrow"),
                     narrow=True, enforce=False, by_decade=True, **names())
    nineties = gold["fact_volcano"].where("decade = 1990")
    assert nineties.count() == gold["fact_volcano"].where(
        "date_key % 10000 BETWEEN 1990 AND 1999").count() > 0
    assert all("decade=1990" in f for f in nineties.inputFiles())
    wrong = gold["dim_location"].where(
        F.col("location_key") != F.abs(F.hash("location").cast("bigint")))
    assert wrong.isEmpty()
    assert gold["dim_location"].where("location IS NULL AND location_key = 42").count() == 1
    matched = gold["fact_landslide"].join(gold["dim_location"], "location_key")
    assert matched.count() == gold["fact_landslide"].count()


def test_publish_replaces_and_may_read_itself(spark):
    schema, root = f"pub_{uuid.uuid4().hex[:8]}", scratch_path(spark, "t-publish")
    publish(spark.range(5), schema, "t", root)
    twice = read_table(spark, f"{schema}.t").withColumn("id", F.col("id") * 2)
    assert publish(twice, schema, "t", root).agg(F.sum("id")).first()[0] == 20
    parts = publish(spark.range(5).withColumn("p", F.col("id") % 2), schema, "t", root, ["p"])
    assert parts.where("p = 1").count() == 2 and parts.columns == ["id", "p"]
    again = publish(spark.range(7).withColumn("p", F.col("id") % 3), schema, "t", root, ["p"])
    assert again.count() == 7


def test_manifest(spark, bronze):
    found = {r["dataset"] for r in bronze_manifest(spark, bronze).collect()}
    assert found == {path.split("/")[0] for path, _ in FEEDS.values()}


def test_images(spark, tmp_path):
    for split in ("Training and Validation", "Testing"):
        for label in ("fire", "nofire"):
            folder = tmp_path / "forest_fire" / split / label
            folder.mkdir(parents=True)
            (folder / "a b.jpg").write_bytes(b"\xff\xd8" + label.encode())
    images = read_images(spark, str(tmp_path / "forest_fire"))
    got = {(r["split"], r["label"], r["length"]) for r in images.collect()}
    assert got == {("train", "fire", 6), ("train", "nofire", 8), ("test", "fire", 6),
                   ("test", "nofire", 8)}


def test_feeds_land_packed_and_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(hazards, "LANDED_ROWS", 10)
    shape = lambda spark, _: spark.range(25).coalesce(1).select(
        F.col("id").cast("string").alias("Year"), F.when(F.col("id") % 3 != 0, "a;b").alias("Country"))
    read = hazards._feed(spark, uuid.uuid4().hex, "volcano", shape)
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, shape(spark, None).collect()))
    per_file = read.groupBy(F.input_file_name().alias("file")).count().collect()
    assert sorted(r["count"] for r in per_file) == [5, 10, 10]
    assert all(r["file"].endswith(".csv.gz") for r in per_file)

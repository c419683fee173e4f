"""File scans: CSV, bronze landing zone, image trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fixed value: the widest header a feed may have.
MAX_COLUMNS = 20481


CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, sep: str = ",", schema: StructType | str | None = None,
             multi_line: bool = False, keep_corrupt: bool = False, **options) -> DataFrame:
    """CSV with a header. Without ``schema`` every column is text, named by the
    header, which costs a look at the first line and not a scan.

    Quotes inside quoted cells are doubled; ``multi_line`` allows line breaks in them (a file is
    then read by one task). A header whose names differ from the schema's, or come in
    another order, raises. With ``keep_corrupt`` rows that do not fit the schema come with their text in
    ``_corrupt_record``, which is NULL for all others; without, their bad cells are NULL.
    """
    if schema is not None:
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if keep_corrupt:
            schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.options(**{
        "header": True, "sep": sep, "maxColumns": MAX_COLUMNS, "mode": "PERMISSIVE", "quote": '"',
        "escape": '"', "multiLine": multi_line, "enforceSchema": False,
        "columnNameOfCorruptRecord": CORRUPT, **options})
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def quoted(names: Sequence[str]) -> list[Column]:
    """Columns by exact name, dots and blanks included."""
    return [F.col("`" + n.strip("`") + "`") for n in names]


def project(df: DataFrame, names: Sequence[str], renamed: Sequence[str] | None = None) -> DataFrame:
    """Select columns by name and rename them by position."""
    picked = df.select(*quoted(names))
    return picked.toDF(*renamed) if renamed else picked


def bronze_manifest(spark: SparkSession, root: str) -> DataFrame:
    """One row per landed file: ``dataset, relative_path, bytes``.

    Files lie under ``root/<dataset>/<relative path>``; contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(*_below(spark, root, F.col("path")), F.col("length").alias("bytes"))


def landed_lines(spark: SparkSession, root: str) -> DataFrame:
    """Text lines per landed file: ``dataset, relative_path, lines``."""
    # _metadata gives the path as a URI, the manifest as it is: blanks come as %20
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    lines = spark.read.option("recursiveFileLookup", True).text(root).select(
        *_below(spark, root, path))
    return lines.groupBy("dataset", "relative_path").agg(F.count(F.lit(1)).alias("lines"))


def _below(spark: SparkSession, root: str, path: Column) -> list[Column]:
    """``dataset, relative_path``: what follows the root, whose length is known once qualified."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = hadoop.getFileSystem(conf).makeQualified(hadoop).toUri().getPath().rstrip("/")
    # scheme and authority may be written with one slash or three
    plain = F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?(?=/)", "")
    below = F.split(F.substr(plain, F.lit(len(base) + 2)), "/", 2)
    return [below[0].alias("dataset"), F.get(below, 1).alias("relative_path")]


# Folders of the image tree.
TRAINING_FOLDER = "Training and Validation"
TESTING_FOLDER = "Testing"


def image_labels(path: Column) -> dict[str, Column]:
    """``split, label, file`` of an image path ``.../<split>/<label>/<file>``."""
    part = r"([^/]+)/([^/]+)/([^/]+)$"
    split = F.regexp_replace(F.regexp_extract(path, part, 1), "%20", " ")
    return {
        "split": F.when(split == TRAINING_FOLDER, F.lit("train"))
        .when(split == TESTING_FOLDER, F.lit("test")),
        "label": F.regexp_extract(path, part, 2),
        "file": F.regexp_extract(path, part, 3),
    }


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, content, split, label, file`` for every image below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", "length", "content").withColumns(image_labels(F.col("path")))

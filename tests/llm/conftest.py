import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_chars", IntegerType())])

# Columns named like those the operators use inside, with NULLs.
CLASHING = ["part", "ids", "fp", "anchor", "line", "epoch", "tokens", "start", "root", "label"]


def odd_rows():
    long = " ".join(f"w{k % 977}x" for k in range(30_000))
    same = "the same passage of many words that is found in more than one of the documents here"
    texts = [None, "", "   ", "\n\n", "one", "12 34 !!", same, same, same, long, long + " tail",
             "a  b   c\td  e", "don't <|endoftext|> stop", "É" * 50, "x" * 70_000,
             f"Page 3 of 9\n{same}", f"Page 4 of 9\n{same}"]
    rows = [(k, t, "en" if k % 3 else None, f"src{k % 4}" if k % 5 else None, len(t or ""))
            for k, t in enumerate(texts)]
    return rows + [rows[6], rows[6], (None, same, None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, clashing names."""
    df = spark.createDataFrame(odd_rows(), DOCS)
    return df.selectExpr("*", *[f"cast(null as string) AS {c}" for c in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

"""Token ids as Parquet list columns, in order of the document id.

Row groups and pages are kept small and every file has page indexes, so a reader
that wants some documents, or only the counts, reads those pages and columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberfold.llm.tokens import encoder
from emberfold.llm.worker import id_arrays, pieces, small_batches

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000


def write_tokens(df: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", keep: Sequence[str] = (), encoding: str = "dictionary",
                 row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
                 page_rows: int = PAGE_ROWS) -> None:
    """Encode every text, append ``end_id`` and write the files below ``path``.

    Columns: ``doc_id, part, start_in_part, n_tokens, ids`` and ``meta`` with the
    columns named in ``keep``. ``encoding`` is "dictionary" or "delta" for the ids.

    Rows are range-partitioned and sorted by the id, then by the text; a NULL id
    comes first, repeated ids stay separate rows, a NULL or empty text has the end
    id alone. An empty table writes no rows. ``part`` numbers the range.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding {encoding!r}")
    meta = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("string")
    rows = small_batches(df, "14m").select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.col(text_col).alias("text"), meta.alias("meta"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    kind = rows.schema["meta"].dataType.simpleString()

    def encode(batches):
        part, done = TaskContext.get().partitionId(), 0
        encode_all = encoder(tokenizer).encode
        end = np.array([end_id], dtype="<u4")
        for batch in pieces(batches, "text", 14 << 20):
            ids = [np.concatenate([i, end])
                   for i in encode_all(batch.column("text"))]
            n = np.array([len(i) for i in ids], dtype=np.int64)
            starts = done + np.cumsum(n) - n
            done += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(n), part, np.int32)),
                 pa.array(starts), pa.array(n.astype(np.int32)), id_arrays(ids),
                 batch.column("meta")],
                names=["doc_id", "part", "start_in_part", "n_tokens", "ids", "meta"])

    encoded = ordered.mapInArrow(
        encode, "doc_id bigint, part int, start_in_part bigint, n_tokens int, "
                f"ids array<int>, meta {kind}")
    (encoded.write
     .option("parquet.block.size", str(row_group_bytes))
     .option("parquet.page.size", str(page_bytes))
     .option("parquet.page.row.count.limit", str(page_rows))
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#ids.list.element", str(encoding == "dictionary").lower())
     .parquet(path))


def read_tokens(spark: SparkSession, path: str, columns: Sequence[str] = ("ids",)) -> DataFrame:
    """``doc_id, start, n_tokens`` and ``columns`` of written files.

    ``start`` counts the ids of all documents before: the place within the part
    plus the sizes of the parts before, from one row per part. Filters on
    ``doc_id`` and unused columns reach the scan.
    """
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per written part: a few bytes for each file, whatever the files hold
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return stored.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"),
        F.col("n_tokens").cast("bigint").alias("n_tokens"), *columns)

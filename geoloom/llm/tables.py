"""Reading the corpus tables, and small helpers that the operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows and bytes of an Arrow batch: what a Python worker holds of its input at a time.
BATCH_ROWS, BATCH_BYTES = 400, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, as texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(id_col: str = "doc_id", text_col: str = "text"):
    """64-bit key of a row: equal only for rows that repeat both the id and the text."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def wide_row_key(id_col: str = "doc_id", text_col: str = "text"):
    """128-bit key of a row, as two hashes from different states: rows are joined by it, so a chance meeting would mix them up."""
    both = F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))
    return F.struct(F.xxhash64(*both).alias("a"), F.xxhash64(F.lit(1), *both).alias("b"))


def texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string or binary column; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]

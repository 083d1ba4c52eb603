"""Input rows and batches shared by the text operators.

Every operator reads two columns, ``doc_id`` and ``text``, and selects them first, so that
further columns of any name cannot clash. Texts travel to Python in Arrow batches of a bounded
number of rows and bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 500
BATCH_BYTES = 64 << 20


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only; a null text stays null."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null stays null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def bounded_batches(spark: SparkSession) -> None:
    """Rows and bytes of one Arrow batch: a batch of long texts then stays within a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], dict | None],
    schema: str,
) -> DataFrame:
    """Apply a function from one Arrow batch to a dict of columns (None: no rows)."""
    bounded_batches(df.sparkSession)
    target = pa_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = function(batch)
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [as_array(columns[f.name], f.type) for f in target], schema=target
                )

    return df.mapInArrow(run, schema)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))

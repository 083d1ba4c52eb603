"""Cutting lineage through tables in shared storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_folder(spark: SparkSession) -> str:
    """The folder named by the session; a private one only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stage-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash the rows over the configured number of shuffle partitions.

    Used in front of steps whose work per input byte is high (rows that grow into vectors,
    matrix products). The explicit number keeps adaptive execution from merging the partitions
    because the input looks small.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)


ROWS_PER_PARTITION = 1_000_000


def split_rows(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Hash the rows by `keys` so that a partition holds about `ROWS_PER_PARTITION` of `rows` rows.

    `rows` is what the step behind it makes of them. The memory of a task then does not grow with the
    input, whatever the configured number of partitions; below that number the planner chooses.
    """
    partitions = -(-rows // ROWS_PER_PARTITION)
    return df.repartition(partitions, *keys) if partitions > 1 else df


def materialise(df: DataFrame) -> DataFrame:
    """Write the rows to a table in shared storage and read them back.

    Later stages start from files, so a lost executor changes nothing, and the planner knows
    the size of the table.
    """
    path = f"{stage_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

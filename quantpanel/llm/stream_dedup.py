"""Exact deduplication as a stream with keyed state that never expires.

Rows arrive in micro-batches. Each is reduced to a digest of its normalised text, its doc_id and
a content locator (the file that holds the text). The state keyed by digest lives on disk
(RocksDB) and keeps the largest doc_id, its locator and the number of rows. Equal digests of one task are added up before the
shuffle, so that a text held by a third of all rows reaches its key as one row per task.

Rows whose digest is hit more than once are then checked on full bytes against the text of the
row that stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise, stage_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # each state partition would set some MB of disk aside for its logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; the fast function where all characters are ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def normalised(text: Column) -> Column:
    """The text that is compared; null counts as empty."""
    return ascii_lower(F.coalesce(text.cast("string"), F.lit("")))


def sha256_digest(normal: Column) -> Column:
    return F.sha2(F.encode(normal, "UTF-8"), 256)


def digest_state(arriving: DataFrame) -> DataFrame:
    """Run the stream to its end and return the last state of each digest.

    ``arriving`` is a streaming DataFrame with doc_id, digest and locator. A batch writes the
    states that it changed to a folder in shared storage under its own number, so that a
    repeated batch replaces its rows; both values of a state only grow, so the largest is last.
    """
    spark = arriving.sparkSession
    base = f"{stage_folder(spark)}/exact-{uuid.uuid4().hex}"
    changes = (
        arriving.groupBy("digest")
        .agg(F.max(F.struct("doc_id", "locator")).alias("keep"), F.count("*").alias("group_size"))
        .select("digest", "keep.*", "group_size")
        .withColumnRenamed("doc_id", "keep_id")
    )

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/changes/batch={number}")

    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        (
            changes.writeStream.outputMode("update")
            .option("checkpointLocation", f"{base}/state")
            .trigger(availableNow=True)
            .foreachBatch(store)
            .start()
            .awaitTermination()
        )
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    empty = spark.createDataFrame([], changes.schema)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/changes")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return empty
    stored = spark.read.schema(changes.schema).parquet(f"{base}/changes/batch=*")
    return stored.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"),
        F.max_by("locator", "keep_id").alias("locator"),
        F.max("group_size").alias("group_size"),
    )


def exact_groups(
    docs: DataFrame,
    arriving: DataFrame,
    digest: Callable[[Column], Column] = sha256_digest,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    ``docs`` and ``arriving`` are the same rows, read as a table and as a stream. Texts are equal
    when they are after lower-casing A-Z; the row with the largest doc_id stays. A null text
    counts as empty, and empty texts are equal. Repeated rows of one doc_id are counted each
    and share one result. A null doc_id stays only if its whole group has none.

    Rows whose digest was hit before are compared byte by byte with the row that stays; rows that
    differ in spite of an equal digest form groups by their full text.
    """
    locator = F.col("_metadata.file_path") if _is_file_stream(arriving) else F.lit(None).cast("string")
    state = digest_state(
        arriving.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            digest(normalised(F.col("text"))).alias("digest"),
            locator.alias("locator"),
        )
    )
    # where the row that stays lies, if the table is read from files as the stream is
    place = _file_of(docs) if _is_file_stream(arriving) else None
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        normalised(F.col("text")).alias("normal"),
        (F.lit(None).cast("string") if place is None else place).alias("place"),
    )
    rows = rows.withColumn("digest", digest(F.col("normal")))
    sha = F.col("digest") if digest is sha256_digest else sha256_digest(F.col("normal"))
    found = materialise(
        rows.join(state, "digest").select(
            "doc_id",
            "digest",
            "keep_id",
            "group_size",
            sha.alias("text_sha256"),
            F.when(F.col("group_size") > 1, F.col("normal")).alias("normal"),
            (F.lit(True) if place is None else F.col("place") == F.col("locator")).alias("located"),
        )
    )
    hits = found.where("group_size > 1")
    kept_texts = (
        hits.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("digest")
        .agg(F.min(F.struct(~F.coalesce("located", F.lit(False)), F.xxhash64("normal"), "normal")).alias("first"))
        .select("digest", F.col("first.normal").alias("kept_normal"))
    )
    strays = materialise(
        hits.join(kept_texts, "digest").where("normal <> kept_normal").select("doc_id", "digest", "normal", "text_sha256")
    )
    size, kept = F.col("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id"))
    columns = ("doc_id", "keep_id", size.cast("long").alias("group_size"), kept.alias("kept"), "text_sha256")
    if strays.isEmpty():
        return found.select(*columns)
    away = strays.groupBy("digest").agg(F.count("*").alias("away"))
    groups = strays.groupBy("digest", "normal").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    stayed = (
        found.join(kept_texts, "digest", "left")
        .where("kept_normal is null or normal = kept_normal")
        .join(away, "digest", "left")
        .withColumn("group_size", F.expr("group_size - coalesce(away, 0)"))
    )
    return stayed.select(*columns).unionByName(strays.join(groups, ["digest", "normal"]).select(*columns))


def _file_of(docs: DataFrame) -> Column | None:
    try:
        docs.select("_metadata.file_path")
    except AnalysisException:
        return None
    return F.col("_metadata.file_path")


def _is_file_stream(arriving: DataFrame) -> bool:
    try:
        arriving.select("_metadata.file_path")
    except AnalysisException:
        return False
    return True

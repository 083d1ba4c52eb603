"""The corpus pipeline: stages that turn raw documents into packed training sequences.

Each stage reads all that its predecessor kept. The first four return the columns of documents.
Null ids, empty and null texts and repeated rows pass through; see the operators for what each
does with them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantpanel.functions.shipping import ship_package
from quantpanel.functions.storage import materialise
from quantpanel.llm.decontamination import contaminated
from quantpanel.llm.line_dedup import rows_without_repeats
from quantpanel.llm.packing import pack
from quantpanel.llm.rows import fold
from quantpanel.llm.simhash import similar_texts
from quantpanel.llm.toxicity import learn, toxicity_score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels outside its held fold, accepts."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 5) != 0)
    score = toxicity_score(learn(docs, labels), spark)
    return docs.where(score(docs["text"].cast("string")) < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows; n_chars follows the text."""
    found = rows_without_repeats(docs)
    own = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("left").cast("long")).otherwise(
            F.col("row.n_chars")
        )
    return found.select(*(own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the one with the smallest doc_id.

    Rows are told apart by doc_id and text, so of several texts under one id each has its own fate.
    Repeated rows stay or go together; rows without an id stay.
    """
    ship_package(spark)
    return _without(docs, similar_texts(docs).where("not kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Rows of one doc_id are told apart by their texts; a row without an id is never found and stays.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated(docs.withColumn("doc_id", _row_name(docs)), items)
    gone = materialise(found.select(F.col("doc_id").alias("gone")).distinct())
    return docs.join(gone, _row_name(docs) == F.col("gone"), "left_anti").select(*docs.columns)


def _row_name(docs: DataFrame) -> Column:
    """A number for each doc_id and text; null without a doc_id."""
    return F.when(docs["doc_id"].isNotNull(), F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string")))


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents whose doc_id and text are not among ``doc_id, text_name``."""
    gone = materialise(rows.select(F.col("doc_id").alias("gone_id"), F.col("text_name").alias("gone_name")).distinct())
    same = (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["gone_name"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    ship_package(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a trained classifier and fingerprints are no SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Benchmark decontamination: documents that contain a test item.

Items and documents are sets of five-word shingles. An item is found in a document when at
least 0.8 of its shingles are. Items are short and documents long, so similarity says little and
containment is searched for: each item is sketched by its shingles of least hash (MinHash), and
the documents' shingles are screened for them. Items are partitioned by size, which gives each
partition its sketch size and the least size of a document: of ``n`` shingles all but
``n - needed`` are in a containing document, so ``n - needed + 1`` of the least cannot all be missing
and the search loses nothing. Pairs that meet are verified on the shingles themselves.

All steps are DataFrame expressions. The sketch is broadcast only after it has been counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise
from quantpanel.llm.rows import texts

SHINGLE = 5
CONTAINMENT = 0.8
BROADCAST_ROWS = 1_000_000  # rows of 32 bytes


def words(text: Column) -> Column:
    """Lower-cased words between ASCII white space; no words of a null text."""
    plain = F.lower(F.coalesce(text, F.lit("")))
    for space in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def shingle_rows(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """The distinct shingles of each key as text; fewer words: all of them are one shingle."""
    listed = rows.select(*keys, words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return (
        listed.select(*keys, "w", F.explode_outer(starts).alias("i"))
        .where(F.size("w") > 0)
        .select(*keys, F.array_join(F.slice("w", F.col("i"), size), " ").alias("shingle"))
        .distinct()
    )


def hashed_shingles(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """A hash of each shingle of each key, repeats included, and the number of them.

    Words are hashed once; a shingle is the hash of its words' hashes, or of all where there
    are fewer.
    """
    listed = rows.select(*keys, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    total = F.greatest(F.size("h") - (size - 1), F.lit(1))
    parts = [F.get("h", F.col("i") + k) for k in range(size)]
    return (
        listed.select(*keys, "h", total.alias("total"), F.explode_outer(F.sequence(F.lit(0), total - 1)).alias("i"))
        .where(F.size("h") > 0)
        .select(*keys, "total", F.xxhash64(*parts).alias("hash"))
    )


def sketches(items: DataFrame, size: int, containment: float) -> DataFrame:
    """``item_id, hash, least``: sketch of each item, least number of shingles of a document.

    A partition holds the items whose number of shingles has the same power of two.
    """
    shingles = hashed_shingles(items, size, "item_id").select("item_id", "hash").distinct()
    counted = shingles.groupBy("item_id").agg(F.count("*").alias("n"))
    needed = F.ceil(F.col("n") * F.lit(containment) - 1e-9)
    planned = counted.select(
        "item_id",
        F.floor(F.log2("n")).alias("partition"),
        needed.alias("needed"),
        (F.col("n") - needed + 1).alias("take"),
    )
    bounds = planned.groupBy("partition").agg(F.min("needed").alias("least"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("hash"))
    return (
        shingles.withColumn("rank", rank)
        .join(planned.join(bounds, "partition"), "item_id")
        .where("rank <= take")
        .select("item_id", "hash", "least")
    )


def contaminated(
    docs: DataFrame, items: DataFrame, size: int = SHINGLE, containment: float = CONTAINMENT
) -> DataFrame:
    """``doc_id, item_id, n_shared, n_shingles`` of each document that contains a test item.

    ``n_shared`` of the ``n_shingles`` distinct shingles of the item are in the document. ``items``
    has item_id and text. Items without words are in no document; an item or document of fewer
    than ``size`` words is one shingle and matches its equal only. Rows of one doc_id, or of one
    item_id, count as one. Null ids take no part.
    """
    docs = texts(docs).where("doc_id is not null")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id is not null")
    sketch = materialise(sketches(items, size, containment))
    if sketch.count() <= BROADCAST_ROWS:
        sketch = F.broadcast(sketch)
    met = materialise(
        hashed_shingles(docs, size, "doc_id")
        .join(sketch, "hash")
        .where("total >= least")
        .select("doc_id", "item_id")
        .distinct()
    )
    texts_met = docs.join(met.select("doc_id").distinct(), "doc_id")
    found = shingle_rows(texts_met, size, "doc_id")
    wanted = shingle_rows(items, size, "item_id")
    numbers = wanted.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    shared = (
        found.join(wanted, "shingle")
        .groupBy("doc_id", "item_id")
        .agg(F.count("*").alias("n_shared"))
        .join(met, ["doc_id", "item_id"])
    )
    return shared.join(numbers, "item_id").where(
        F.col("n_shared") >= F.ceil(F.col("n_shingles") * F.lit(containment) - 1e-9)
    ).select("doc_id", "item_id", "n_shared", "n_shingles")

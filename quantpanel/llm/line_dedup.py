"""Removal of repeated runs of lines, by overlapping windows of three lines.

Three consecutive lines are hashed together. Of each window that occurs more than once, the first
occurrence, by doc_id and then by position, stays; the lines that later ones cover are merged and
removed. Everything is DataFrame expressions: arrays inside a document, sums and joins across
documents. A window that a third of all documents hold meets its key as one partial sum per task,
and the join that marks its later occurrences is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise
from quantpanel.llm.rows import texts

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(size: int) -> Column:
    """Position and 128-bit key of each window: two hashes with different seeds of its lines."""

    def at(line_hashes: Column, i: Column) -> Column:
        return F.xxhash64(*(F.get(line_hashes, i + k) for k in range(size)))

    def all_of(h: Column, g: Column) -> Column:
        last = F.size(h) - size
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(i.alias("pos"), at(h, i).alias("a"), at(g, i).alias("b")))

    return all_of(F.col("h"), F.col("g"))


def repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, version, starts``: where later occurrences of repeated windows begin.

    ``version`` is a hash of the text, which tells different texts under one doc_id apart.
    """
    rows = texts(docs).where("text is not null and doc_id is not null")
    hashed = rows.select(
        "doc_id",
        F.xxhash64("text").alias("version"),
        F.transform(_lines(F.col("text")), lambda x: F.xxhash64(x)).alias("h"),
        F.transform(_lines(F.col("text")), lambda x: F.xxhash64(F.lit("second"), x)).alias("g"),
    )
    keyed = materialise(hashed.select("doc_id", "version", F.inline(_windows(window))).distinct())
    place = F.struct("doc_id", "version", "pos")
    first = keyed.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = keyed.join(first.drop("n"), ["a", "b"]).where(place != F.col("first"))
    return later.groupBy("doc_id", "version").agg(F.collect_set("pos").alias("starts"))


def rows_without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row`` (all columns of the input, as a struct), ``n_lines``, ``n_removed``, ``left``.

    ``left`` is the text without the repeated lines.
    """
    marks = repeated_lines(docs, window)
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").alias("text"),
    ).withColumn("version", F.xxhash64("text"))
    lines = _lines(F.col("text"))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    covered = F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (window - 1))))
    marked = rows.join(marks, ["doc_id", "version"], "left").select(
        "row",
        "text",
        count.alias("n_lines"),
        F.when(
            F.col("starts").isNotNull(), F.array_except(F.sequence(F.lit(0), count - 1), covered)
        ).alias("kept"),
    )

    def chosen(all_lines: Column) -> Column:
        return F.array_join(F.transform(F.col("kept"), lambda i: F.get(all_lines, i)), "\n")

    # the lines are bound once per text: a lambda would split the text again for each of them
    rebuilt = F.transform(F.array(lines), chosen)[0]
    return marked.select(
        "row",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.when(F.col("kept").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_removed"),
        F.when(F.col("kept").isNull(), F.col("text")).otherwise(rebuilt).alias("left"),
    )


def remove_repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` of every row, without the repeated lines.

    Lines end at a line feed and are compared as they are, empty ones too. Texts of fewer than
    ``window`` lines, null texts (0 lines, text null) and rows without a doc_id stay as they are; a
    text all of whose lines repeat becomes empty. Repeated rows of one doc_id and text are one
    document; different texts under one doc_id are taken in the order of their hashes.
    """
    found = rows_without_repeats(texts(docs), window)
    return found.select("row.doc_id", "n_lines", "n_removed", F.col("left").alias("text"))

"""Audit of how filters interact: what every order of five filters removes, keeps and wastes.

Four filters look at a text alone. The fifth fails a text that a row with a smaller doc_id holds too,
and is answered by compressed radix tries: full texts are inserted, a terminal holds the least id, and
traversing the tries gives every row its flag. First each task inserts its own rows in tries of a
bounded size, so that a text that a third of all rows share goes on as one row per trie.
What is left is range-partitioned by text prefixes of adaptive length: a prefix that holds more than its
share of all bytes is made longer, until it is light or the whole text. Equal texts so meet in one
partition, and no partition gets much more than the others.

Flags become one mask per row, masks are counted by part, and all orders follow from the at most 32
counts of a part.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise
from quantpanel.llm.rows import bounded_batches, pa_schema

LETTERS = "ABCDE"
DUPLICATE = 1 << LETTERS.index("E")
LOCAL_BYTES = 16 << 20  # texts of one trie in front of the shuffle
LOCAL_ROWS = 50_000
PARTITION_BYTES = 32 << 20  # distinct texts that a partition's trie should hold
SHARES = 4  # a prefix may hold this part of an average partition
FIRST_PREFIX, LONGER = 32, 4  # bytes of the shortest prefix, and the factor to the next length
ROW_BYTES = 64  # weight of a row besides its text
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point


@dataclass(frozen=True)
class Limits:
    """Least words, least share of distinct words, largest share of capitals (percent), symbols that fail."""

    words: int = 200
    distinct: int = 50
    capitals: int = 2
    symbols: bytes = b"#$%&*|"


def own_mask(text: bytes, limits: Limits) -> int:
    """Bits of the filters A to D that a text fails; words end at ASCII white space."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, CONTINUATION))
    fails = (
        len(words) < limits.words,
        100 * len(set(words)) < limits.distinct * len(words),
        100 * capitals > limits.capitals * points,
        len(text.translate(None, limits.symbols)) < len(text),
    )
    return sum(1 << bit for bit, failed in enumerate(fails) if failed)


@dataclass(slots=True)
class Node:
    label: bytes = b""
    children: dict[int, Node] = field(default_factory=dict)
    least: int | None = None  # the least id of the text that ends here
    mask: int = 0
    parts: dict[str, int] = field(default_factory=dict)  # rows of the least id by part


def common_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed trie of whole texts; terminals hold the least id."""

    def __init__(self) -> None:
        self.root = Node()
        self.rows = self.bytes = 0

    def terminal(self, text: bytes) -> Node:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.bytes += len(child.label)
                return child
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = common_length(child.label, text[at : at + len(child.label)])
            middle = Node(child.label[:shared])
            child.label = child.label[shared:]
            middle.children[child.label[0]] = child
            node.children[text[at]] = middle
            node, at = middle, at + shared
        return node

    def insert(self, text: bytes, doc: int, part: str, mask: int, held: int) -> list[tuple]:
        """Rows ``(doc_id, part, mask, held)`` that are now known to repeat a smaller id's text."""
        self.rows += 1
        node = self.terminal(text)
        if node.least is not None and doc > node.least:
            return [(doc, part, mask | DUPLICATE, held)]
        known = []
        if node.least is None or doc < node.least:
            known = [(node.least, p, mask | DUPLICATE, n) for p, n in node.parts.items()]
            node.least, node.mask, node.parts = doc, mask, {}
        node.parts[part] = node.parts.get(part, 0) + held
        return known

    def firsts(self) -> Iterator[tuple]:
        """``(doc_id, part, mask, held, text)`` of the rows with the least id of their text."""
        below = [(self.root, b"")]
        while below:
            node, text = below.pop()
            text += node.label
            for part, held in node.parts.items():
                yield node.least, part, node.mask, held, text
            below.extend((child, text) for child in node.children.values())


LOCAL = "doc_id long, part string, mask int, held long, text binary"
FLAGGED = "doc_id long, part string, mask int, held long"


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, and of fewer where texts are long."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[4] or b"") if len(row) > 4 else 0
        if len(held) >= most or size > LOCAL_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, f.type) for values, f in zip(zip(*rows), schema)], schema=schema
    )


def local_flags(docs: DataFrame, limits: Limits) -> DataFrame:
    """Rows of ``LOCAL``: with a text where only the other tasks can tell whether it repeats one."""
    bounded_batches(docs.sparkSession)
    schema = pa_schema(docs.sparkSession, LOCAL)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = Trie()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc, part, text in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), texts):
                text = text.as_py()
                mask = own_mask(text, limits)
                if doc is None:
                    yield None, part, mask, 1, None
                    continue
                yield from ((*known, None) for known in trie.insert(text, doc, part, mask, 1))
                if trie.bytes > LOCAL_BYTES or trie.rows > LOCAL_ROWS:
                    yield from trie.firsts()
                    trie = Trie()
        yield from trie.firsts()

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return source.mapInArrow(lambda batches: _batches(rows(batches), schema), LOCAL)


def prefix_lengths(texts: DataFrame, partitions: int) -> DataFrame:
    """Adds ``prefix``, the bytes of a text's prefix that is light, or the whole text.

    Heavy prefixes are counted on Spark, one length after the other, among the texts whose shorter
    prefix is heavy. At most ``SHARES * partitions`` can be heavy, which bounds what is
    collected and broadcast: their hashes. Texts of one prefix always get the same length.
    """
    spark = texts.sparkSession
    size = F.octet_length("text")
    total, longest = texts.agg(F.sum(size + ROW_BYTES), F.max(size)).first()
    length = FIRST_PREFIX
    found = texts.withColumn("prefix", F.lit(length))
    while longest is not None and length < longest:
        name = F.xxhash64(F.substring("text", 1, length))
        weighed = found.where((F.col("prefix") == length) & (size > length))
        heavy = (
            weighed.groupBy(name.alias("name")).agg(F.sum(size + ROW_BYTES).alias("weight"))
            .where(F.col("weight") > total / (SHARES * partitions)).select("name").collect()
        )
        if not heavy:
            break
        table = spark.createDataFrame(heavy, "name long").withColumn("heavy", F.lit(True))
        longer = (F.col("prefix") == length) & (size > length) & F.col("heavy").isNotNull()
        found = (
            found.withColumn("name", name)
            .join(F.broadcast(table), "name", "left")
            .withColumn("prefix", F.when(longer, length * LONGER).otherwise(F.col("prefix")))
            .drop("name", "heavy")
        )
        length *= LONGER
    return found


def flagged(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id, part, mask, held``: how many rows of an id and part fail the filters of a mask."""
    first = materialise(local_flags(docs, limits))
    known = first.where("text is null").select("doc_id", "part", "mask", "held")
    texts = first.where("text is not null")
    spark = docs.sparkSession
    held = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(held / PARTITION_BYTES))
    prefix = F.substring(F.col("text"), F.lit(1), F.col("prefix"))
    # a sample of the keys goes to the driver, so a longer prefix is named by its hash
    ranged = prefix_lengths(texts, partitions).repartitionByRange(
        partitions, F.substring("text", 1, FIRST_PREFIX), F.xxhash64(prefix)
    )
    schema = pa_schema(spark, FLAGGED)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = Trie()
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("text", "doc_id", "part", "mask", "held"))
            for row in zip(*columns):
                yield from trie.insert(*row)
        yield from (row[:4] for row in trie.firsts())

    told = ranged.select("doc_id", "part", "mask", "held", "text").mapInArrow(
        lambda batches: _batches(rows(batches), schema), FLAGGED
    )
    return known.unionByName(told)


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, held, good, toxic``: rows of a mask, and those with quality 1 and toxic 1."""
    marks = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.bool_or(F.col("quality") == 1).alias("is_good"), F.bool_or(F.col("toxic") == 1).alias("is_toxic"))
    )
    ids = rows.groupBy("doc_id", "part", "mask").agg(F.sum("held").alias("held"))
    return (
        ids.join(marks, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("held").alias("held"),
            F.sum(F.when(F.col("is_good"), F.col("held")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("is_toxic"), F.col("held")).otherwise(0)).alias("toxic"),
        )
    )


def all_orders(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see ``filter_audit``."""
    spark = counts.sparkSession
    bits = range(len(LETTERS))
    orders = [
        ("".join(LETTERS[b] for b in order), step + 1, sum(1 << b for b in order[:step]), 1 << order[step])
        for order in itertools.permutations(bits)
        for step in bits
    ]
    table = spark.createDataFrame(orders, "filter_order string, step int, earlier int, own int")
    pairs = F.array(*(F.struct(F.lit(e).alias("earlier"), F.lit(o).alias("own")) for e, o in sorted({o[2:] for o in orders})))
    mask, earlier, own = F.col("mask"), F.col("earlier"), F.col("own")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(earlier) != 0
    removed = fails & ~gone

    def total(condition, value):
        return F.sum(F.when(condition, value).otherwise(F.lit(0))).cast("long")

    held = F.col("held")
    rotations = F.lit(math.factorial(len(LETTERS))) / F.greatest(F.bit_count(mask), F.lit(1))  # orders in which one of the failed filters is first
    steps = (
        counts.select("*", F.explode(pairs).alias("pair"))
        .select("part", "mask", "held", "good", "toxic", "pair.*")
        .groupBy("part", "earlier", "own")
        .agg(
            total(~fails & ~gone, held).alias("kept"),
            total(removed, held).alias("removed"),
            total(fails & gone, held).alias("redundant"),
            total(mask == own, held).alias("unique_fails"),
            total(removed, F.col("good")).alias("good_lost"),
            total(removed, F.col("toxic")).alias("toxic_lost"),
            total(fails, held * rotations.cast("long")).alias("shapley"),
        )
    )
    return steps.join(F.broadcast(table), ["earlier", "own"]).select(  # 600 rows
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """What each step of all 120 orders of the filters does, per part (source; null: empty string).

    A text fails A with fewer than ``limits.words`` words, B with too few distinct ones, C with too many
    capitals, D with a symbol, E if a row with a smaller doc_id holds the same text, removed or not.
    ``kept`` rows are left after the step; ``removed`` go in it; ``redundant`` fail its filter but were gone
    before; ``unique_fails`` fail no other; ``good_lost`` and ``toxic_lost`` are removed rows by label;
    ``shapley`` is the filter's ``removed`` summed over all orders.

    A null text counts as empty, and empty texts are equal. Rows of one doc_id don't repeat each other,
    and each is counted; a null doc_id has no label and never fails E. Several label rows of an id
    count as one with the largest marks. An empty table gives no rows.
    """
    return all_orders(mask_counts(flagged(docs, limits), labels))

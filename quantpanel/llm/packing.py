"""Packing of documents into sequences of a fixed length, as a cutting-stock problem.

A document is its token ids and an end id. Documents of more than a sequence are cut into whole
sequences and a rest. The histogram of the rests, which is bounded by the sequence length and not
by the corpus, goes to the driver. There column generation solves the linear program
"fewest sequences over patterns of lengths": its dual prices enter a knapsack over the lengths, by
dynamic programming, whose best pattern enters the program until none pays. Counts of
patterns are rounded down and the few lengths left over are packed first-fit.

Each class of lengths then has a list of pattern slots, and documents take them by their rank in
the class. Ranks are counted in parts of bounded size, so that a length that a third of all
documents share is no single task.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise
from quantpanel.llm.rows import map_batches, texts

LENGTH = 2048
END_ID = 1
QUANTUM = 8  # lengths are classed by this many tokens; at most QUANTUM - 1 are lost per document
RANK_PART = 50_000  # documents of one part of a ranking
TOLERANCE = 1e-4  # the linear program stops within this share of its optimum


class TextIds:
    """Ids of whole texts as little-endian 32-bit numbers, without added special tokens.

    If the ids of the vocabulary file are in the order of its merges, which makes them ranks,
    texts without special strings go through a rank encoder over the same vocabulary: the ids are
    the same, in less than half the time.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = rank_encoder(path)

    def text(self, text: str) -> bytes:
        if self.ranked is None or any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        return self.ranked(text).astype("<u4", copy=False).tobytes()


def rank_encoder(path: str):
    """A function from plain text to an array of ids, or None where ids are not in the order of merges."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split = spec["pre_tokenizer"]
    if spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"]:
        return None
    vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
    pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
    order = [vocabulary[a + b] for a, b in pairs]
    if order != sorted(order):
        return None
    special = {t["content"] for t in spec["added_tokens"]}
    shown = byte_letters()
    ranks = {bytes(shown[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    found = tiktoken.Encoding(
        "pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return lambda text: found.encode_to_numpy(text, disallowed_special=())


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes in their order for the
    characters from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


_encoders: dict[str, TextIds] = {}


def encoder(path: str) -> TextIds:
    if path not in _encoders:
        _encoders[path] = TextIds(path)
    return _encoders[path]


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Documents cut into pieces of at most ``length`` ids; null text: the end id alone."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> dict:
        ids = encoder(vocabulary)
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            encoded = memoryview(ids.text(text or "") + end)
            total = len(encoded) // 4
            for start in range(0, total, length):
                part = encoded[4 * start : 4 * (start + length)]
                rows.append((doc, start, len(part) // 4, zlib.crc32(part), total))
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
        return dict(zip(names, map(list, zip(*rows)))) if rows else dict.fromkeys(names, [])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return map_batches(texts(docs), cut, schema)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of sizes within the capacity."""
    value = np.zeros(capacity + 1)
    price = np.full(capacity + 1, -np.inf)
    price[sizes] = prices
    taken = np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        gains = price[1 : room + 1] + value[room - 1 :: -1]
        best = int(gains.argmax())
        if gains[best] > value[room - 1]:
            value[room], taken[room] = gains[best], best + 1
        else:
            value[room] = value[room - 1]
    counts = np.zeros(capacity + 1, np.int64)
    room = capacity
    while room > 0:
        if taken[room]:
            counts[taken[room]] += 1
            room -= taken[room]
        else:
            room -= 1
    return float(value[capacity]), counts[sizes]


def solve_patterns(demand: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(multiplicity, {size: count}) of patterns that hold each size exactly as often as asked.

    Sizes are 1 to capacity. The simplex basis starts with one pattern per size; each
    round prices a new pattern and pivots on it.
    """
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0), np.int64)
    if len(sizes) == 0:
        return []
    wanted = np.array([demand[s] for s in sizes.tolist()], float)
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    level = inverse @ wanted
    for _ in range(20 * len(sizes) + 100):
        value, column = best_pattern(inverse.sum(axis=0), sizes, capacity)
        if value <= 1 + TOLERANCE:
            break
        step = inverse @ column
        usable = step > 1e-9
        leave = int(np.argmin(np.where(usable, level / np.where(usable, step, 1), np.inf)))
        basis[:, leave] = column
        pivot = inverse[leave] / step[leave]
        inverse -= np.outer(step, pivot)
        inverse[leave] = pivot
        level = np.maximum(inverse @ wanted, 0)
    found: list[tuple[int, dict[int, int]]] = []
    left = wanted.astype(np.int64)
    for j in np.argsort(-level, kind="stable").tolist():
        column = basis[:, j].astype(np.int64)
        times = int(level[j] + 1e-6)
        with np.errstate(divide="ignore"):
            times = min([times, *(left[column > 0] // column[column > 0]).tolist()])
        if times > 0:
            left -= times * column
            found.append((times, _named(sizes, column)))
    while left.any():  # what rounding left over: the largest that fits, again and again
        column, room = np.zeros(len(sizes), np.int64), capacity
        for i in range(len(sizes) - 1, -1, -1):
            column[i] = min(left[i], room // sizes[i])
            room -= column[i] * sizes[i]
        times = int((left[column > 0] // column[column > 0]).min())
        left -= times * column
        found.append((times, _named(sizes, column)))
    return found


def _named(sizes: np.ndarray, column: np.ndarray) -> dict[int, int]:
    return {int(s): int(c) for s, c in zip(sizes, column) if c}


def slots(patterns: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """Per size rows (first rank, first sequence, multiplicity), ordered by first rank."""
    table: dict[int, list[tuple[int, int, int]]] = {}
    filled: dict[int, int] = {}
    sequence = 0
    for times, pattern in patterns:
        for size, count in pattern.items():
            table.setdefault(size, []).append((filled.get(size, 0), sequence, times))
            filled[size] = filled.get(size, 0) + count * times
        sequence += times
    return {size: np.array(rows, np.int64) for size, rows in table.items()}


def ranked(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """``rank`` from 0 among the rows of a key, counted in hashed parts of bounded size."""
    total = rows.count()
    part = F.pmod(F.xxhash64(*order), F.lit(1 + total // RANK_PART)).alias("part")
    rows = rows.withColumn("part", part)
    before = (
        rows.groupBy(key, "part")
        .agg(F.count("*").alias("held"))
        .withColumn(
            "before",
            F.sum("held").over(Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select(key, "part", F.coalesce("before", F.lit(0)).alias("before"))
    )
    number = F.row_number().over(Window.partitionBy(key, "part").orderBy(*order))
    return (
        rows.withColumn("number", number)
        .join(before, [key, "part"])
        .withColumn("rank", F.col("before") + F.col("number") - 1)
        .drop("part", "number", "before")
    )


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, end_id: int = END_ID, quantum: int = QUANTUM) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``start`` is the piece's place in its document, ``offset`` its place in the sequence, both in
    ids; pieces of a sequence follow each other without a gap. Null and empty texts hold the end id
    only. Each of repeated rows is packed.
    """
    cut = materialise(
        pieces(docs, vocabulary, length, end_id).withColumn(
            "size", F.least(F.ceil(F.col("length") / quantum), F.lit(length // quantum)).cast("long")
        )
    )
    histogram = {r["size"]: r["count"] for r in cut.groupBy("size").count().collect()}  # bounded by length / quantum
    table = slots(solve_patterns(histogram, length // quantum))

    def assign(batch: pa.RecordBatch) -> dict:
        size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
        sequence = np.empty(len(size), np.int64)
        for s in np.unique(size).tolist():
            at = np.flatnonzero(size == s)
            slot = table[s][np.searchsorted(table[s][:, 0], rank[at], side="right") - 1]
            sequence[at] = slot[:, 1] + (rank[at] - slot[:, 0]) % slot[:, 2]
        names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
        return {n: batch.column(n) for n in names} | {"sequence_id": sequence}

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long"
    placed = map_batches(ranked(cut, "size", "doc_id", "start", "length", "ids_crc32"), assign, schema)
    earlier = Window.partitionBy("sequence_id").orderBy(
        F.col("length").desc(), "doc_id", "start", "ids_crc32"
    )
    return placed.withColumn(
        "offset",
        F.coalesce(F.sum("length").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )

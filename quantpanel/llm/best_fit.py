"""Best-fit decreasing packing with a segment tree over remaining capacities.

Documents longer than a sequence are cut into whole sequences and a first, shorter piece. The shorter
pieces are dealt at random to groups of a bounded size, and each group packs its pieces by
descending length. A segment tree over the capacities 0 to ``length`` counts the open sequences
with so much room; descending it finds the tightest that a piece fits in, in logarithmic time. A group of
thousands of pieces has the length distribution of the whole table, so that groups lose little more than
one unfilled sequence each; sequences that a group leaves loosely filled are packed together once more.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise
from quantpanel.llm.packing import encoder
from quantpanel.llm.rows import map_batches, pa_schema, texts

LENGTH = 1024
END_ID = 2
GROUP_ROWS = 20_000  # pieces of a group


class Capacities:
    """Open sequences by the room that is left in them.

    Leaf ``room`` of the tree counts the sequences with that room, an inner node those below it.
    """

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the sequence with the least room of at least ``size``: its room and number."""
        node = size + self.leaves
        if not self.counts[node]:
            while not (node & 1 == 0 and self.counts[node + 1]):  # up to a node with sequences to its right
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:  # and down to the first of them
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.open[room].pop()

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += by
            node >>= 1


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, in the order given (descending for best-fit decreasing)."""
    rooms = Capacities(length)
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    opened = 0
    for i, size in enumerate(sizes.tolist()):
        found = rooms.tightest(size)
        if found is None:
            found = length, opened
            opened += 1
        room, number = found
        sequence[i], offset[i] = number, length - room
        rooms.add(room - size, number)
    return sequence, offset


def pieces(docs: DataFrame, vocabulary: str, length: int, end_id: int) -> DataFrame:
    """Documents as pieces of ``length`` ids behind a first one that may be shorter."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> dict:
        ids, rows = encoder(vocabulary), []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            encoded = memoryview(ids.text(text or "") + end)
            total = len(encoded) // 4
            bounds = [0, *range((total - 1) % length + 1, total + 1, length)]
            for number, (start, stop) in enumerate(zip(bounds, bounds[1:])):
                rows.append((doc, number, start, stop - start, zlib.crc32(encoded[4 * start : 4 * stop])))
        names = ("doc_id", "piece", "start", "length", "ids_crc32")
        return dict(zip(names, map(list, zip(*rows)))) if rows else dict.fromkeys(names, [])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return map_batches(texts(docs), cut, schema)


def grouped_fit(items: DataFrame, length: int, group_rows: int) -> DataFrame:
    """``item, bin, place``: best-fit decreasing of ``item, size`` within groups dealt by a hash of the item."""
    groups = 1 + items.count() // group_rows
    schema = "item long, bin long, place long"
    target = pa_schema(items.sparkSession, schema)

    def fit(table: pa.Table) -> pa.Table:
        item, size = table.column("item").to_numpy(), table.column("size").to_numpy()
        order = np.lexsort((item, -size))
        sequence, offset = best_fit(size[order], length)
        number = table.column("group")[0].as_py() + sequence * groups  # unique over groups
        return pa.table([pa.array(item[order]), pa.array(number), pa.array(offset)], schema=target)

    group = F.pmod(F.xxhash64("item"), F.lit(groups)).cast("long")
    return items.select("item", "size", group.alias("group")).groupBy("group").applyInArrow(fit, schema)


def pack_best_fit(
    docs: DataFrame,
    vocabulary: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Only documents of more than ``length`` ids (text and end id) are cut. Null and empty texts hold the end id
    only. Each of repeated rows is packed; ties in length go by the row's place in the input. An empty
    table gives no rows.
    """
    cut = materialise(
        pieces(docs, vocabulary, length, end_id).withColumn("item", F.monotonically_increasing_id())
    )
    fitted = materialise(
        grouped_fit(cut.where(F.col("length") < length).select("item", F.col("length").alias("size")), length, group_rows)
    )
    # bins of all groups as items of a second round: those that are loosely filled find each other
    filled = cut.join(fitted, "item").groupBy("bin").agg(F.sum("length").alias("size"))
    joined = grouped_fit(filled.select(F.col("bin").alias("item"), "size"), length, group_rows)
    moved = materialise(joined).select(F.col("item").alias("bin"), F.col("bin").alias("joint"), F.col("place").alias("shift"))
    placed = fitted.join(moved, "bin").select(
        "item", (2 * F.col("joint")).alias("sequence_id"), (F.col("place") + F.col("shift")).alias("offset")
    )
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    whole = cut.where(F.col("length") == length).select(
        *columns, (2 * F.col("item") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return cut.join(placed, "item").select(*columns, "sequence_id", "offset").unionByName(whole)

"""SimHash fingerprints and near-duplicate groups by pigeonhole blocks.

A fingerprint holds one bit per coordinate: the majority vote of the hashes of a text's word
shingles. Fingerprints are cut into blocks, chosen so that a close pair has equal blocks; pairs
that meet in a block are verified by Hamming distance, and links are closed to groups.

Two searches are built on that:

* ``close_fingerprints``: 64 bits at a small distance. By the pigeonhole principle nothing is
  missed, and every bucket that is compared in pairs is bounded in size by its construction.
* ``similar_texts``: a Jaccard similarity of shingle sets. Blocks of longer fingerprints join most of
  each group; an exact join on prefixes of the sets finds every pair that is left, and every
  link is verified by the sets.

Equal fingerprints, or equal sets, are one node throughout, so copies never meet each other.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise, spread
from quantpanel.llm.components import components
from quantpanel.llm.rows import bounded_batches, map_batches, texts

SEED = 42
PAIR_BUCKET = 256  # buckets up to this size are compared in pairs
PAIRED_MEMBERS = 32  # members of a bucket that similar_texts compares in pairs at once
FIRST_BLOCKS = 16  # blocks in which similar_texts compares with one member first
WIDESPREAD = 1 << 20  # shingles that similar_texts puts last
COUNTED = 1 << 21  # shingles, or sets, that a task remembers at once
PARTNERS = 500  # texts compared with one text in a task
FEW_ROWS = 1 << 20  # rows that are broadcast to find texts
RECALL = 0.99  # of a pair at the least similarity, by all the blocks of blocks_for


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words, in order, repeats included.

    A-Z are lower-cased; words are separated by ASCII white space. Fewer words: the whole
    sequence is the one shingle; none: no hash.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    runs = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(size))))
    digests = b"".join(map(xxhash.xxh64_digest, runs, itertools.repeat(SEED)))
    return np.frombuffer(digests, ">u8").astype(np.uint64)


def majority(hashes: np.ndarray, words: int) -> np.ndarray:
    """``words`` 64-bit words; a bit is 1 if it is set in over half of the hashes.

    The first word votes on the hashes themselves, each further one on a remix of them.
    """
    n = len(hashes)
    if n == 0:
        return np.zeros(words, np.uint64)
    counts = np.zeros(64 * words, np.int64)
    salts = np.arange(words, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for start in range(0, n, 255):
        part = hashes[start : start + 255, None]
        if words > 1:
            mixed = _mix(part + salts[None, :])
            mixed[:, 0] = part[:, 0]
            part = mixed
        bits = np.unpackbits(np.ascontiguousarray(part).astype(">u8").view(np.uint8), axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > n).view(">u8").astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, size: int = 3, words: int = 1, repeats: bool = True) -> DataFrame:
    """``doc_id, fingerprint``: an array of ``words`` longs per row; zero without any word."""

    def compute(batch: pa.RecordBatch) -> dict:
        out = []
        for text in batch.column("text").to_pylist():
            hashes = shingle_hashes(text, size)
            out.append(majority(hashes if repeats else np.unique(hashes), words).view(np.int64))
        return {"doc_id": batch.column("doc_id"), "fingerprint": out}

    return map_batches(texts(docs), compute, "doc_id long, fingerprint array<long>")


def close_fingerprints(prints: DataFrame) -> DataFrame:
    """Pairs of distinct 64-bit fingerprints (column ``p``, long) that differ in 1 or 2 bits.

    The 64 bits are four blocks. At most two blocks can differ, so a close pair agrees in two of
    them: six keys of 32 bits each. A bucket of more than ``PAIR_BUCKET`` fingerprints is split:
    of the eight 4-bit parts of its other 32 bits at most two differ, so its members get 28
    keys that leave out two parts each. Members of such a bucket differ in 8 given bits at
    most; it has 256 distinct members at most. No bucket is cut, and pairs per fingerprint are
    bounded however many fingerprints lie close together.
    """
    p = F.col("p")
    block = [F.shiftrightunsigned(p, 16 * i).bitwiseAND(0xFFFF) for i in range(4)]
    keys = []
    for table, (i, j) in enumerate(itertools.combinations(range(4), 2)):
        k, m = (x for x in range(4) if x not in (i, j))
        key = F.lit(table << 32) + F.shiftleft(block[i], 16) + block[j]
        keys.append(F.struct(key.alias("key"), (F.shiftleft(block[k], 16) + block[m]).alias("rest")))
    keyed = prints.select("p", F.explode(F.array(*keys)).alias("x")).select("p", "x.*")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(sizes, "key")
    subkeys = []
    for number, left_out in enumerate(itertools.combinations(range(8), 2)):
        mask = 0xFFFFFFFF
        for part in left_out:
            mask &= ~(0xF << (4 * part))
        subkeys.append(F.lit((number + 1) << 32) + F.col("rest").bitwiseAND(mask))
    small = met.where(F.col("n") <= PAIR_BUCKET).select("p", "key", F.lit(0).cast("long").alias("sub"))
    large = met.where(F.col("n") > PAIR_BUCKET).select("p", "key", F.explode(F.array(*subkeys)).alias("sub"))
    buckets = materialise(small.unionByName(large))
    other = buckets.withColumnRenamed("p", "q")
    return (
        buckets.join(other, ["key", "sub"])
        .where((F.col("p") < F.col("q")) & (F.bit_count(p.bitwiseXOR(F.col("q"))) <= 2))
        .select("p", "q")
        .distinct()
    )


def fingerprint_components(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Fingerprints link at two or fewer differing bits; the component is the smallest doc_id that
    can be reached. Repeated rows share one result; null and empty texts have fingerprint zero
    and link like any other. Of a null doc_id nothing is reached but its own fingerprint's.
    """
    rows = materialise(
        fingerprints(docs, size).select("doc_id", F.col("fingerprint")[0].alias("p"))
    )
    nodes = materialise(rows.groupBy("p").agg(F.min("doc_id").alias("node")))
    pairs = close_fingerprints(nodes.select("p"))
    links = pairs.join(nodes.withColumnRenamed("node", "a"), "p").join(
        nodes.select(F.col("p").alias("q"), F.col("node").alias("b")), "q"
    )
    groups = components(links.select("a", "b").na.drop())
    labels = nodes.join(groups, "node", "left").select(
        "p", F.coalesce("component", "node").alias("component_id")
    )
    return rows.join(labels, "p").select(
        "doc_id", F.lower(F.lpad(F.hex("p"), 16, "0")).alias("fingerprint"), "component_id"
    )


def blocks_for(rows: int, similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """Bits of a block (16 at least) and number of blocks of fingerprints of so many texts.

    Two sets of Jaccard similarity J differ in a bit with probability acos(2J / (1 + J)) / pi. A block
    has enough bits for few texts to meet another by chance, whatever the number
    of texts, and there are as many blocks as a pair at the least similarity needs to share one.
    """
    agree = 1 - bit_difference(similarity)
    bits = max(16, min(32, math.ceil(math.log2(max(rows, 2))) + 2))
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree**bits))


def bit_difference(similarity: float) -> float:
    return math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi


def similar_texts(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, text_name, component_id, kept`` of every row: groups of texts whose shingle sets are similar.

    ``text_name`` is the xxhash64 of the text, which tells rows of one doc_id apart. Texts with equal shingle
    sets (all texts without words, too) are one node. Links are looked for twice, and each one is verified by
    the shingle sets themselves:

    * SimHash joins most of every large group: in ``FIRST_BLOCKS`` blocks, a node is compared with the
      least node of the bucket that it shares most blocks with. What this misses or leaves out
      is only left to the second search.
    * The second search is exact. Of a set of ``n`` shingles in a common order, the first
      ``n - ceil(similarity * n) + 1`` are its prefix; two similar sets share a shingle of their prefixes.
      All pairs of different groups and near sizes that do so are compared, whatever the size of a bucket; a
      pair goes unverified only if its sizes, the shared part of the prefixes or the parities of the sets rule the
      similarity out. In buckets of more than ``PAIRED_MEMBERS`` members, each is first compared with the most central one.

    Widespread shingles come last in the common order, so that they are in few prefixes; which ones count as
    such changes the work but not the result. The row of least (doc_id, text_name) of a group is ``kept``,
    with all its repetitions. Rows without a doc_id are kept; they are grouped with equal sets only.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_name"),
        F.col("text").cast("string").alias("text"),
    )
    bits, _ = blocks_for(docs.count(), similarity)
    per_word = 64 // bits
    words = math.ceil(FIRST_BLOCKS / per_word)
    widespread = spark.sparkContext.broadcast(_widespread(docs, size))  # WIDESPREAD numbers at most
    rows = materialise(_sketches(docs, size, words))
    nodes = materialise(
        rows.where("doc_id is not null").groupBy("tag")
        .agg(
            F.min(F.struct("doc_id", "text_name")).alias("row"), F.max("fingerprint").alias("fingerprint"),
            F.max("n").alias("n"), F.max("parity").alias("parity"),
        )
    )
    places = nodes.select("tag", "row.doc_id", "row.text_name")

    def linked(pairs: DataFrame) -> DataFrame:
        return materialise(_verified(_possible(pairs, nodes, similarity), places, docs, size, similarity))

    def several_groups(members: DataFrame) -> DataFrame:
        """The members of the buckets that hold several groups, and the most central one of them; stored.

        That one has fewest shingles of its own before the shared one: of copies with few changes each,
        it is the text they come from, or the nearest to it. Both sides of the join need the same columns,
        so that they read one exchange.
        """
        dealt = members.repartition("key")
        sizes = dealt.groupBy("key").agg(
            F.count("*").alias("members"),
            F.min_by(F.struct("tag", "group"), F.struct("at", "tag")).alias("low"),
            F.min("group").alias("least"), F.max("group").alias("most"), F.max("n").alias("longest"), F.max("at").alias("last"),
        )
        sizes = sizes.where("least < most and longest >= 0 and last >= 0").select("key", "members", "low")
        return materialise(dealt.join(sizes, "key"))

    links = linked(_leaders(nodes, bits, per_word, words, similarity))
    named = _joined(places.select("tag", F.col("tag").alias("group")), links)
    prefixes = _prefixes(docs, size, similarity, widespread).groupBy("tag").agg(
        F.max("n").alias("n"), F.max("prefix").alias("prefix")
    )
    met = several_groups(
        prefixes.join(named, "tag").select("tag", "n", "group", F.posexplode("prefix").alias("at", "key"))
    )
    crowded = (
        met.where((F.col("members") > PAIRED_MEMBERS) & (F.col("group") != F.col("low.group")))
        .groupBy("tag", F.col("low.tag").alias("b"))
        .agg(F.count("*").alias("shared"))
        .groupBy(F.col("tag").alias("a"))
        .agg(F.max(F.struct("shared", "b")).alias("best"))
        .select("a", "best.b")
    )
    found = linked(crowded)
    if not found.isEmpty():
        links = links.unionByName(found)
        met = several_groups(met.select("tag", "n", "at", "key").join(_joined(named, found), "tag"))
    links = links.unionByName(linked(_prefix_pairs(met.drop("members", "low"), similarity)))
    groups = components(links).select(F.col("node").alias("tag"), F.col("component").alias("group"))
    all_rows = places.join(groups, "tag", "left").withColumn("group", F.coalesce("group", "tag"))
    least = all_rows.groupBy("group").agg(F.min(F.struct("doc_id", "text_name")).alias("stays"))
    labels = all_rows.join(least, "group").select("tag", "stays")
    kept = F.col("doc_id").isNull() | (F.struct("doc_id", "text_name") == F.col("stays"))
    return rows.select("doc_id", "text_name", "tag").join(labels, "tag", "left").select(
        "doc_id", "text_name", F.col("stays.doc_id").alias("component_id"), kept.alias("kept")
    )


def _joined(named: DataFrame, links: DataFrame) -> DataFrame:
    """``tag, group`` with linked groups joined to the least of those two links away; stored.

    All of a group are connected; connected groups may stay apart, which costs comparisons only.
    """
    ends = [named.select(F.col("tag").alias(x), F.col("group").alias(f"g_{x}")) for x in ("a", "b")]
    apart = links.join(ends[0], "a").join(ends[1], "b").where("g_a <> g_b").select("g_a", "g_b")
    both = materialise(apart.unionByName(apart.select(F.col("g_b").alias("g_a"), F.col("g_a").alias("g_b"))).distinct())
    near = both.groupBy("g_a").agg(F.min("g_b").alias("least")).select(
        F.col("g_a").alias("g_b"), F.least("g_a", "least").alias("least")
    )
    lowest = both.join(near, "g_b").groupBy(F.col("g_a").alias("group")).agg(F.min("least").alias("lowest"))
    return materialise(
        named.join(lowest, "group", "left").select("tag", F.coalesce("lowest", "group").alias("group"))
    )


def _prefix_pairs(left: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: tags of different groups that share a shingle of their prefixes and may be similar.

    Sizes of similar sets are at most one class apart, so a member meets its own class and the next one only,
    which holds larger sets. How far the prefixes go depends on the sizes of both: a crowd of near misses, whose own
    shingles come first, hardly meets however many shingles it has in common.
    """
    step = math.log(1 / (similarity - 1e-6))
    size_class = F.floor(F.ln(F.greatest("n", F.lit(1))) / step)
    own = left.withColumn("own", size_class)
    asks = own.withColumn("class", F.explode(F.array(F.col("own"), F.col("own") + 1))).where(
        (F.col("own") == F.col("class")) | (F.col("at") <= F.col("n") - F.ceil(F.lit(2 * similarity / (1 + similarity)) * F.col("n") - 1e-6))
    )
    right = own.withColumnsRenamed({"tag": "b", "n": "n_b", "group": "group_b", "at": "at_b", "own": "class"})
    once = (F.col("own") < F.col("class")) | (F.col("tag") < F.col("b"))
    sizes_fit = F.least("n", "n_b") >= F.lit(similarity) * F.greatest("n", "n_b") - 1e-9
    # similar sets share so many shingles, and the first of them no later than this leaves room for
    least = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("n") + F.col("n_b")) - 1e-6)
    early = (F.col("at") <= F.col("n") - least) & (F.col("at_b") <= F.col("n_b") - least)
    # shared ones up to the last early one, and no more than the shorter rest after it
    most = F.col("shared") + F.least(F.col("n") - F.col("at") - 1, F.col("n_b") - F.col("at_b") - 1)
    return (
        asks.join(right, ["key", "class"])
        .where(once & (F.col("group") != F.col("group_b")) & sizes_fit & early)
        .groupBy(F.col("tag").alias("a"), "b", "n", "n_b")
        .agg(F.count("*").alias("shared"), F.max("at").alias("at"), F.max("at_b").alias("at_b"))
        .where(most >= least)
        .select("a", "b")
    )


def shingle_set(text: str | None, size: int) -> tuple[np.ndarray, int]:
    """The distinct shingle hashes in order, and the tag of the set (a hash, as a signed long)."""
    found = np.sort(shingle_hashes(text, size))
    found = found[np.concatenate([found[:1] == found[:1], found[1:] != found[:-1]])]
    return found, int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64))


def prefix_length(n: int, similarity: float) -> int:
    return min(n, n - math.ceil(similarity * n - 1e-9) + 1)


def prefix_of(found: np.ndarray, widespread: np.ndarray, similarity: float) -> np.ndarray:
    """The prefix of a set: its shingles in order, those among ``widespread`` last. Both are sorted.

    Each shingle is looked up in the widespread ones, which number up to a million and are never gone through.
    """
    last = np.zeros(len(found), bool)
    if len(widespread):
        at = np.searchsorted(widespread, found)
        last = widespread[np.minimum(at, len(widespread) - 1)] == found
    return np.concatenate([found[~last], found[last]])[: prefix_length(len(found), similarity)]


def parity_of(found: np.ndarray) -> np.ndarray:
    """Bits in words of 64, as many as the set has members and less than twice that many, or 64.

    A bit tells if an odd number of members has its place as the low part of the hash. The places of half as many bits are the
    exclusive or of both halves.
    """
    bits = 64 << max(0, (len(found) - 1).bit_length() - 6)
    odd = np.bincount((found & np.uint64(bits - 1)).view(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(">u8").astype(np.uint64)


def _possible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` of tags whose sizes and parities leave the similarity possible.

    Two sets differ in at least as many members as their parities differ in bits, so no similar pair is lost.
    """
    ends = [nodes.select(F.col("tag").alias(x), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"parity_{x}")) for x in ("a", "b")]
    total = F.col("n_a") + F.col("n_b")
    most = total - 2 * F.ceil(F.lit(similarity / (1 + similarity)) * total - 1e-6)

    def folded(long: str, short: str) -> Column:
        half = F.size(short)
        both = F.zip_with(F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(long) > half, both).otherwise(F.col(long))

    bits = F.zip_with(folded("parity_a", "parity_b"), folded("parity_b", "parity_a"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(bits, F.lit(0), lambda x, y: x + y)
    sized = pairs.distinct().join(ends[0], "a").join(ends[1], "b").where(F.abs(F.col("n_a") - F.col("n_b")) <= most)
    return sized.where(apart <= most).select("a", "b")


def _widespread(docs: DataFrame, size: int) -> np.ndarray:
    """Hashes of shingles found to be in many texts, in order; at most ``WIDESPREAD`` of them.

    A task counts the shingles of its distinct sets in bounded memory (rare ones are forgotten when
    the table is full) and names those that three sets hold. They are added to the table in large lots, since
    each lot goes through the whole table.
    """

    def added(held: tuple[np.ndarray, np.ndarray], found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values = np.concatenate([held[0], np.sort(np.concatenate([held[0][:0], *found]))])
        if not len(values):
            return held
        order = np.argsort(values, kind="stable")  # merges the two runs
        values, times = values[order], np.concatenate([held[1], np.ones(len(values) - len(held[1]), np.int64)])[order]
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        values, times = values[first], np.add.reduceat(times, first)
        while len(values) > COUNTED:
            often = times > times.min()
            values, times = values[often], times[often]
        return values, times

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = set(), (np.empty(0, np.uint64), np.empty(0, np.int64))
        found, waiting = [], 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                shingles, tag = shingle_set(text, size)
                if tag not in seen:
                    _remember(seen, tag)
                    found.append(shingles)
                    waiting += len(shingles)
            if waiting > COUNTED // 2:
                held, found, waiting = added(held, found), [], 0
        held = added(held, found)
        often = held[1] > 2
        yield pa.RecordBatch.from_arrays([pa.array(held[0][often].view(np.int64)), pa.array(held[1][often])], ["shingle", "times"])

    bounded_batches(docs.sparkSession)
    found = docs.select("text").mapInArrow(compute, "shingle long, times long")
    often = found.groupBy("shingle").agg(F.sum("times").alias("times")).where(F.col("times") > PAIRED_MEMBERS)
    top = often.orderBy(F.desc("times"), "shingle").limit(WIDESPREAD).select("shingle").toArrow()
    return np.sort(top.column(0).to_numpy().view(np.uint64))


def _sketches(docs: DataFrame, size: int, words: int) -> DataFrame:
    """``doc_id, text_name, tag`` of every row; a task gives ``fingerprint, n, parity`` of a set once."""
    seen: set[int] = set()  # of the task: the function is sent to each one anew

    def compute(batch: pa.RecordBatch) -> dict:
        out = {"doc_id": batch.column("doc_id"), "text_name": batch.column("text_name"), "tag": [], "fingerprint": [], "n": [], "parity": []}
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            found, tag = shingle_set(text, size)
            first = doc is not None and tag not in seen
            out["tag"].append(tag)
            out["fingerprint"].append(majority(found, words).view(np.int64) if first else None)
            out["n"].append(len(found) if first else None)
            out["parity"].append(parity_of(found).view(np.int64) if first else None)
            if first:
                _remember(seen, tag)
        return out

    return map_batches(docs, compute, "doc_id long, text_name long, tag long, fingerprint array<long>, n int, parity array<long>")


def _prefixes(docs: DataFrame, size: int, similarity: float, widespread) -> DataFrame:
    """``tag, n, prefix`` of every shingle set, once or more often."""
    seen: set[int] = set()

    def compute(batch: pa.RecordBatch) -> dict:
        out = {"tag": [], "n": [], "prefix": []}
        for text in batch.column("text").to_pylist():
            found, tag = shingle_set(text, size)
            if tag in seen:
                continue
            _remember(seen, tag)
            out["tag"].append(tag)
            out["n"].append(len(found))
            out["prefix"].append(prefix_of(found, widespread.value, similarity).view(np.int64))
        return out

    return map_batches(docs.where("doc_id is not null"), compute, "tag long, n int, prefix array<long>")


def _remember(seen: set[int], tag: int) -> None:
    if len(seen) > COUNTED:
        seen.clear()
    seen.add(tag)


def _leaders(nodes: DataFrame, bits: int, per_word: int, words: int, similarity: float) -> DataFrame:
    """``a, b``: a node and the least node of the buckets it shares most blocks with, if near by Hamming distance."""
    mask = (1 << bits) - 1
    blocks = F.array(
        *(
            F.shiftrightunsigned(F.col("fingerprint")[j // per_word], bits * (j % per_word)).bitwiseAND(mask)
            for j in range(FIRST_BLOCKS)
        )
    )
    keyed = nodes.select("tag", F.posexplode(blocks).alias("block", "value")).select(
        "tag", F.xxhash64("block", "value").alias("key")
    )
    lows = keyed.groupBy("key").agg(F.count("*").alias("members"), F.min("tag").alias("low")).where("members > 1")
    best = (
        keyed.join(lows, "key")
        .where("tag <> low")
        .groupBy("tag", "low")
        .agg(F.count("*").alias("shared"))
        .groupBy("tag")
        .agg(F.max(F.struct("shared", "low")).alias("best"))
        .select(F.col("tag").alias("a"), F.col("best.low").alias("b"))
    )
    total, share = 64 * words, bit_difference(similarity)
    reach = int(total * share + 3 * math.sqrt(total * share * (1 - share)))
    apart = sum((F.bit_count(F.col("p")[w].bitwiseXOR(F.col("q")[w])) for w in range(words)), F.lit(0))
    return (
        best.join(nodes.select(F.col("tag").alias("a"), F.col("fingerprint").alias("p")), "a")
        .join(nodes.select(F.col("tag").alias("b"), F.col("fingerprint").alias("q")), "b")
        .where(apart <= reach)
        .select("a", "b")
    )


def _verified(pairs: DataFrame, places: DataFrame, docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs ``a, b`` of tags whose shingle sets are similar.

    The text of each ``a`` is sent once, to the text of its ``b``, which goes ahead of them; a ``b`` with
    many partners is sent to several tasks.
    """
    pairs = materialise(pairs)
    asked_by = pairs.groupBy("b").agg(F.ceil(F.count("*") / PARTNERS).alias("salts"))
    salted = pairs.join(asked_by, "b").select(
        F.col("a").alias("tag"), "b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"), F.lit(False).alias("ahead")
    )
    ahead = asked_by.select(
        F.col("b").alias("tag"), "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("ahead")
    )
    asked = materialise(salted.unionByName(ahead).join(places, "tag"))
    few = asked.count() <= FEW_ROWS  # a plan switch: about 50 bytes a row
    wanted = docs.join(F.broadcast(asked) if few else asked, ["doc_id", "text_name"]).drop("doc_id", "text_name")
    beside = spread(wanted, "b", "salt").sortWithinPartitions("b", "salt", F.desc("ahead"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = other = None
        for batch in batches:
            close = []
            for b, salt, first, tag, text in zip(*(batch.column(c).to_pylist() for c in ("b", "salt", "ahead", "tag", "text"))):
                if first:
                    if at != (b, salt):
                        at, other = (b, salt), shingle_set(text, size)[0]
                    continue
                found, _ = shingle_set(text, size)
                shared = len(np.intersect1d(found, other, assume_unique=True))
                union = len(found) + len(other) - shared
                if union == 0 or shared >= similarity * union - 1e-9:
                    close.append((tag, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in close], "int64") for i in (0, 1)], ["a", "b"])

    return beside.mapInArrow(compute, "a long, b long").distinct()

"""Removal of passages that repeat across documents, located by sharded phrase automata.

A window is ``window`` consecutive words. Its words are removed from a document if the same
window also starts in a document with a smaller doc_id.

1. *Confirm recurring passages.* Each window has an anchor, the least hash of the half-window
   phrases in it. Equal windows have equal anchors, and neighbouring windows mostly share theirs,
   so a document has few distinct anchors. Anchors that occur in one document only are left
   behind; the windows of the others are counted by hash, which gives each recurring window its
   leader, the smallest doc_id that holds it. All of these are sums with partial sums, so
   a passage that a third of all documents share meets its key as one row per task.
2. *Compile automata.* The recurring stretches of a leader are cut into consecutive phrases of
   half a window: each window of a stretch holds one of them whole. A shard takes the phrases of
   some leaders, a bounded number, and compiles them into an Aho-Corasick automaton.
3. *Stream the documents.* A document passes the automata of those leaders that step 1 names for
   it, and of no others, since it shares no window with them. Every occurrence of a phrase is
   found at any alignment and is widened word by word, at most half a window to each
   side, against the leader's words; at ``window`` equal words or more they are removed.
   Shards that many documents pass are dealt out to as many groups as their text needs.

The hashes only say where to look: what is removed was compared word by word.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise
from quantpanel.llm.rows import map_batches, texts

WINDOW = 50
SHARD_PHRASES = 4_000  # phrases of one automaton
GROUP_BYTES = 2_000_000  # text that passes one copy of an automaton

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD1342543DE82EF95 | 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 2**64))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word; words are separated by ASCII white space."""
    data = np.frombuffer(raw, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[1], space.view(np.int8), [1]]))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    power, back = _table(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


_tables: list[np.ndarray] = []


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte base and of its inverse, for texts of up to n bytes."""
    if not _tables or len(_tables[0]) < n:
        size = max(n, 1 << 17)
        _tables[:] = [_powers(_BASE, size), _powers(_inverse(_BASE), size)]
        if n > 1 << 22:  # a rare long text: don't keep its tables
            found = _tables[0], _tables[1]
            _tables.clear()
            return found
    return _tables[0], _tables[1]


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers(_STEP, len(words)), out=sums[1:])
    return _mix((sums[size:] - sums[:-size]) * _powers(_inverse(_STEP), n))


def window_anchors(words: np.ndarray, window: int) -> np.ndarray:
    """For each window the least hash of the half-window phrases in it."""
    half = window // 2
    least = run_hashes(words, half)
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    reach, want = 1, window - half + 1
    while reach < want:  # the minimum of twice as many phrases, and at last of all
        step = min(reach, want - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least[:n]


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each stretch of true values."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _raw(text: str | None) -> bytes:
    return (text or "").encode()


def _sha256(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _scan(rows: DataFrame, window: int) -> DataFrame:
    """Per row the distinct anchors, the number of words and the digest of all words."""

    def compute(batch: pa.RecordBatch) -> dict:
        out = {"anchors": [], "n_words": [], "words_sha256": []}
        for text in batch.column("text").to_pylist():
            raw = _raw(text)
            words = raw.split()
            out["anchors"].append(np.unique(window_anchors(word_hashes(raw), window)).view(np.int64))
            out["n_words"].append(len(words))
            out["words_sha256"].append(_sha256(words))
        return out | {"doc_id": batch.column("doc_id")}

    return map_batches(
        rows, compute, "doc_id long, anchors array<long>, n_words long, words_sha256 string"
    )


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """doc_id, hash of the windows whose anchor is listed, each once per document."""

    def compute(batch: pa.RecordBatch) -> dict:
        ids, parts = [], []
        for doc, text, listed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "anchors"))):
            words = word_hashes(_raw(text))
            kept = np.isin(window_anchors(words, window), np.array(listed, np.int64).view(np.uint64))
            found = np.unique(run_hashes(words, window)[kept])
            ids.append(np.full(len(found), doc, np.int64))
            parts.append(found.view(np.int64))
        none = np.empty(0, np.int64)
        return {"doc_id": np.concatenate([none, *ids]), "hash": np.concatenate([none, *parts])}

    return map_batches(rows, compute, "doc_id long, hash long")


def _stretches(rows: DataFrame, window: int) -> DataFrame:
    """The stretches of a document whose windows recur, cut where the leader changes.

    ``first`` is the position of the stretch among the document's words.
    """

    def compute(batch: pa.RecordBatch) -> dict:
        out = defaultdict(list)
        for doc, text, hashes, leaders in zip(
            *(batch.column(c).to_pylist() for c in ("doc_id", "text", "hashes", "leaders"))
        ):
            raw = _raw(text).split()
            found = run_hashes(word_hashes(_raw(text)), window).view(np.int64)
            order = np.argsort(np.array(hashes, np.int64))
            known, lead = np.array(hashes, np.int64)[order], np.array(leaders, np.int64)[order]
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            hit = known[at] == found
            for leader in np.unique(lead[at[hit]]).tolist():
                for a, b in runs(hit & (lead[at] == leader)):
                    out["doc_id"].append(doc)
                    out["leader"].append(leader)
                    out["first"].append(a)
                    out["words"].append(b" ".join(raw[a : b + window - 1]).decode())
        return {c: out[c] for c in ("doc_id", "leader", "first", "words")}

    return map_batches(rows, compute, "doc_id long, leader long, first long, words string")


def _automaton(phrases: pd.DataFrame):
    """An automaton of the phrases; each keeps the leaders and neighbouring words it stands in."""
    import ahocorasick

    places: dict[str, dict[int, set]] = defaultdict(lambda: defaultdict(set))
    for leader, before, phrase, after in zip(phrases.leader, phrases.before, phrases.phrase, phrases.after):
        places[phrase][leader].add((before, after))
    machine = ahocorasick.Automaton()
    for phrase, by_leader in places.items():
        split = {
            leader: [(b.split(" ") if b else [], a.split(" ") if a else []) for b, a in around]
            for leader, around in by_leader.items()
        }
        machine.add_word(f" {phrase} ", split)
    machine.make_automaton()
    return machine


def _same(a: list[str], b: list[str]) -> int:
    """Length of the common start of two lists."""
    if a == b:
        return len(a)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def _locate(phrases: pd.DataFrame, stretches: pd.DataFrame, window: int) -> pd.DataFrame:
    """Covered word ranges of the stretches that pass one automaton."""
    half = window // 2
    reach = window - half
    out = []
    if len(phrases) and len(stretches):
        machine = _automaton(phrases)
        for doc, leader, first, text in zip(
            stretches.doc_id, stretches.leader, stretches["first"], stretches.words
        ):
            words = text.split(" ")
            padded = f" {text} "
            ends = np.cumsum([0] + [len(w) + 1 for w in words])  # padded offset of the space before word i
            covered = np.zeros(len(words) + 1, np.int64)
            for end, places in machine.iter(padded):
                stop = int(np.searchsorted(ends, end))
                start = stop - half
                for before, after in places.get(leader, ()):
                    left = _same(before[::-1], words[max(0, start - reach) : start][::-1])
                    right = _same(after, words[stop : stop + reach])
                    if left + half + right >= window:
                        covered[start - left] += 1
                        covered[stop + right] -= 1
            for a, b in runs(np.cumsum(covered)[:-1] > 0):
                out.append((doc, first + a, first + b))
    return pd.DataFrame(out, columns=["doc_id", "start", "stop"]).astype("int64")


def _phrases(leading: DataFrame, window: int) -> DataFrame:
    """Stretches of the leaders, cut into phrases with the words around them."""
    half = window // 2
    reach = window - half

    def compute(batch: pa.RecordBatch) -> dict:
        out = defaultdict(list)
        for shard, doc, text in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "words"))):
            words = text.split(" ")
            for a in range(0, len(words) - half + 1, half):
                out["shard"].append(shard)
                out["leader"].append(doc)
                out["before"].append(" ".join(words[max(0, a - reach) : a]))
                out["phrase"].append(" ".join(words[a : a + half]))
                out["after"].append(" ".join(words[a + half : a + half + reach]))
        return {c: out[c] for c in ("shard", "leader", "before", "phrase", "after")}

    return map_batches(leading, compute, "shard long, leader long, before string, phrase string, after string")


def repeated_ranges(docs: DataFrame, scan: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) of the documents with recurring passages, and their covered word ranges.

    ``scan`` is the stored result of ``_scan`` on the same documents. The ranges are rows
    ``doc_id, ranges``: arrays of word positions (start, stop excluded), which may overlap.
    """
    half = window // 2
    rows = texts(docs).where("doc_id is not null and text is not null")
    anchors = scan.where("doc_id is not null").select("doc_id", F.explode("anchors").alias("anchor"))
    recurring = (
        anchors.groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high")
        .select("anchor")
    )
    listed = anchors.join(recurring, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    candidates = materialise(rows.join(listed, "doc_id"))
    windows = materialise(_windows(candidates, window))
    leaders = (
        windows.groupBy("hash")
        .agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("high"))
        .where("leader < high")
        .select("hash", "leader")
    )
    named = (
        windows.join(leaders, "hash")
        .groupBy("doc_id")
        .agg(F.collect_list("hash").alias("hashes"), F.collect_list("leader").alias("leaders"))
    )
    stretches = materialise(_stretches(candidates.select("doc_id", "text").join(named, "doc_id"), window))
    leading = stretches.where("doc_id = leader")
    load = leading.agg(F.sum(F.octet_length("words")), F.count("*")).first()
    shards = 1 + (load[0] or 0) // (SHARD_PHRASES * half * 6)
    shard = F.pmod(F.xxhash64("leader"), F.lit(shards)).alias("shard")
    phrases = materialise(_phrases(leading.select(shard, "doc_id", "words"), window))
    passing = stretches.where("doc_id > leader").select(shard, "doc_id", "leader", "first", "words")
    groups = passing.groupBy("shard").agg(
        F.ceil(F.sum(F.octet_length("words")) / GROUP_BYTES).alias("groups")
    )
    dealt = passing.join(groups, "shard").withColumn(
        "group", F.pmod(F.xxhash64("doc_id", "first"), F.col("groups"))
    )
    copied = phrases.join(groups, "shard").withColumn(
        "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))
    )

    def locate(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _locate(left, right, window)

    ranges = (
        copied.groupBy("shard", "group")
        .cogroup(dealt.select("shard", "group", "doc_id", "leader", "first", "words").groupBy("shard", "group"))
        .applyInPandas(locate, "doc_id long, start long, stop long")
    )
    cut = ranges.groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    return candidates.select("doc_id", "text"), materialise(cut)


def _without(raw: bytes, cuts: list[dict] | None) -> tuple[list[bytes], list[bytes]]:
    """All words, and those outside the ranges."""
    words = raw.split()
    if not cuts:
        return words, words
    gone = np.zeros(len(words), bool)
    for c in cuts:
        gone[c["start"] : c["stop"]] = True
    return words, [w for w, g in zip(words, gone.tolist()) if not g]


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the words that stay, joined by a space) of every row.

    Null and empty texts have no words. Documents of fewer than ``window`` words keep all.
    Repeated rows of one doc_id are one document: they share the smallest doc_id of their windows
    and do not remove each other; different texts under one doc_id should not occur: each then
    loses the ranges found in either. A null doc_id is never compared and keeps all words.
    """
    _, cut = repeated_ranges(docs, materialise(_scan(texts(docs), window)), window)

    def compute(batch: pa.RecordBatch) -> dict:
        out = {"n_words": [], "n_removed": [], "kept": []}
        for text, cuts in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            words, kept = _without(_raw(text), cuts)
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept"].append(b" ".join(kept).decode())
        return out | {"doc_id": batch.column("doc_id")}

    schema = "doc_id long, n_words long, n_removed long, kept string"
    return map_batches(texts(docs).join(cut, "doc_id", "left"), compute, schema)


def removal_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row, as ``remove_repeats`` leaves it.

    Only texts that lose words are read again; the digest of the others comes from the first pass.
    """
    scan = materialise(_scan(texts(docs), window))
    candidates, cut = repeated_ranges(docs, scan, window)

    def compute(batch: pa.RecordBatch) -> dict:
        out = {"words_sha256": [], "n_removed": [], "left_sha256": []}
        for text, cuts in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            words, kept = _without(_raw(text), cuts)
            out["words_sha256"].append(_sha256(words))
            out["n_removed"].append(len(words) - len(kept))
            out["left_sha256"].append(_sha256(kept))
        return out | {"doc_id": batch.column("doc_id")}

    schema = "doc_id long, words_sha256 string, n_removed long, left_sha256 string"
    changed = map_batches(candidates.join(cut, "doc_id"), compute, schema).distinct()
    return (
        scan.drop("anchors")
        .join(changed, ["doc_id", "words_sha256"], "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("left_sha256", "words_sha256").alias("kept_sha256"),
        )
    )

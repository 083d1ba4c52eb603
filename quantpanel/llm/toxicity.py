"""Toxicity by a convolutional text classifier, trained in numpy.

A word is the sum of hashed embeddings: one of the word and one of its beginning, so that inflected
forms share part of theirs. Filters of several widths run over the words; each filter's largest
response in the whole text goes into a logistic output. Filters are linear before the maximum, so
after training each bucket holds its share of every filter at every place, and a text costs one
look-up per word.

All labelled rows are learned from. They are dealt into shards of bounded size; each shard trains a copy
of the network for one epoch, the changes are averaged (those of an embedding over the shards that
touched it), and the next epoch starts from the average. One shard runs its epochs in one go.

Thresholds are calibrated by language, as the text shows it: the nearest language by word
frequencies, learned from the training rows. A language's threshold becomes the score 0.5.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantpanel.functions.storage import materialise, spread
from quantpanel.llm.rows import bounded_batches, fold, map_batches, texts

BUCKETS = 1 << 15
DIMENSIONS = 16
WIDTHS = (1, 2, 3)
FILTERS = 12  # of each width
PREFIX = 4  # letters of a word's beginning
SHARD_DOCUMENTS = 8_000  # labelled rows that one task trains on, about
MARKS = 1 << 25  # bits that tell whether an id may have a label
SLICES = 64  # of the embeddings, when changes are averaged
LOGIT_DIGITS = 3  # of the logits among which thresholds are chosen
PUNCTUATION = ".,;:!?\"'()[]{}<>*&%$#-_"
EPOCHS = 6
ENOUGH = 15  # rows of each class that a language's own threshold needs
SEED = 11


def tokens(text: str | None) -> list[str]:
    """Lower-cased words without punctuation at their ends."""
    return [w for w in (w.strip(PUNCTUATION) for w in (text or "").lower().split()) if w]


class Hasher:
    """Buckets of a word and of its beginning; remembers words as they stand in texts, up to a bound."""

    def __init__(self, entries: int = 300_000) -> None:
        self.seen: dict[str, int] = {}  # both buckets in one number; -1: nothing but punctuation
        self.entries = entries

    def buckets(self, text: str | None) -> np.ndarray:
        """Two bucket numbers per word of ``tokens``."""
        words = (text or "").lower().split()
        try:
            out = [self.seen[w] for w in words]
        except KeyError:
            out = [self._pair(w) for w in words]
        pairs = np.array(out, np.int64)
        pairs = pairs[pairs >= 0]
        return np.stack([pairs // BUCKETS, pairs % BUCKETS], axis=1)

    def _pair(self, word: str) -> int:
        pair = self.seen.get(word)
        if pair is None:
            bare, pair = word.strip(PUNCTUATION), -1
            if bare:
                pair = xxhash.xxh32_intdigest(bare) % BUCKETS * BUCKETS + xxhash.xxh32_intdigest("^" + bare[:PREFIX]) % BUCKETS
            if len(self.seen) >= self.entries:
                self.seen.clear()
            self.seen[word] = pair
        return pair


@dataclass
class Network:
    """Embeddings (buckets x dimensions), filters per width (width x dimensions x filters), output."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    output: np.ndarray
    intercept: float

    @staticmethod
    def start(seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda scale, *shape: (scale * rng.standard_normal(shape)).astype(np.float32)
        return Network(
            draw(0.1, BUCKETS, DIMENSIONS),
            [draw(0.3, w, DIMENSIONS, FILTERS) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            draw(0.3, len(WIDTHS) * FILTERS),
            -2.0,
        )

    def forward(self, buckets: np.ndarray):
        """Embedded words, the place of each filter's largest response, the responses, the logit.

        A text shorter than a filter is padded with empty words.
        """
        words = self.embedding[buckets].sum(axis=1)
        missing = max(WIDTHS) - len(words)
        if missing > 0:
            words = np.vstack([words, np.zeros((missing, DIMENSIONS), np.float32)])
        places, peaks = [], []
        for kernel, bias in zip(self.filters, self.bias):
            n = len(words) - len(kernel) + 1
            response = sum(words[k : k + n] @ kernel[k] for k in range(len(kernel))) + bias
            place = response.argmax(axis=0)
            places.append(place)
            peaks.append(response[place, np.arange(FILTERS)])
        peak = np.concatenate(peaks)
        return words, places, peak, float(np.maximum(peak, 0) @ self.output + self.intercept)


class Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.steps, self.state = rate, 0, {}

    def update(self, key, value: np.ndarray, gradient: np.ndarray, rows: np.ndarray | None = None) -> None:
        mean, spread = self.state.setdefault(key, (np.zeros_like(value), np.zeros_like(value)))
        at = slice(None) if rows is None else rows
        mean[at] = 0.9 * mean[at] + 0.1 * gradient
        spread[at] = 0.99 * spread[at] + 0.01 * gradient**2
        scale = np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        value[at] -= self.rate * scale * mean[at] / (np.sqrt(spread[at]) + 1e-6)


def train(
    samples: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED, batch: int = 16, net: Network | None = None
) -> Network:
    """Logistic loss with classes weighted to equal shares; only the places of maxima learn.

    ``net`` is the network to go on from; it is changed.
    """
    net, adam, rng = net or Network.start(seed), Adam(0.01), np.random.default_rng(seed)
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        for start in range(0, len(order), batch):
            adam.steps += 1
            kernels = [np.zeros_like(k) for k in net.filters]
            biases = [np.zeros_like(b) for b in net.bias]
            output, intercept = np.zeros_like(net.output), 0.0
            rows, steps = [], []
            chosen = order[start : start + batch]
            for i in chosen.tolist():
                buckets = samples[i]
                words, places, peak, logit = net.forward(buckets)
                slope = (1 / (1 + np.exp(-logit)) - labels[i]) * weight[i] / len(chosen)
                output += slope * np.maximum(peak, 0)
                intercept += slope
                back = slope * net.output * (peak > 0)
                for w, (kernel, place) in enumerate(zip(net.filters, places)):
                    part = back[w * FILTERS : (w + 1) * FILTERS].astype(np.float32)
                    biases[w] += part
                    for k in range(len(kernel)):
                        at = place + k
                        kernels[w][k] += words[at].T * part
                        inside = at < len(buckets)
                        change = (kernel[k] * part).T[inside]
                        rows.append(buckets[at[inside]].ravel())
                        steps.append(np.repeat(change, 2, axis=0))
            for w in range(len(WIDTHS)):
                adam.update(("k", w), net.filters[w], kernels[w])
                adam.update(("b", w), net.bias[w], biases[w])
            adam.update("o", net.output, output)
            net.intercept -= adam.rate * 10 * intercept
            touched, place = np.unique(np.concatenate(rows), return_inverse=True)
            gradient = np.zeros((len(touched), DIMENSIONS), np.float32)
            np.add.at(gradient, place, np.concatenate(steps))
            adam.update("e", net.embedding, gradient, touched)
    return net


@dataclass
class Scorer:
    """A trained network in look-up form, and thresholds (as logits) per language.

    ``shares`` holds, per bucket, its part in each filter at each place of the filter;
    ``profile`` the log-frequency of the bucket in each language.
    """

    shares: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    intercept: float
    profile: np.ndarray
    thresholds: np.ndarray

    def language(self, buckets: np.ndarray) -> int:
        return int(self.profile.take(buckets[:, 0], axis=0).sum(axis=0).argmax()) if len(buckets) else 0

    def logit(self, buckets: np.ndarray) -> float:
        n = max(len(buckets), max(WIDTHS))
        parts = np.zeros((n, self.shares.shape[1]), np.float32)
        for start in range(0, len(buckets), 50_000):
            some = buckets[start : start + 50_000]
            first, second = (self.shares.take(some[:, k], axis=0) for k in (0, 1))
            np.add(first, second, out=parts[start : start + len(some)])
        peaks, at = [], 0
        for width in WIDTHS:
            rows = n - width + 1
            response = parts[:rows, at : at + FILTERS]
            for k in range(1, width):
                response = response + parts[k : k + rows, at + k * FILTERS : at + (k + 1) * FILTERS]
            peaks.append(response.max(axis=0))
            at += width * FILTERS
        return float(np.maximum(np.concatenate(peaks) + self.bias, 0) @ self.output + self.intercept)

    def score(self, buckets: np.ndarray) -> float:
        """Probability, moved so that the language's threshold is 0.5."""
        x = self.logit(buckets) - float(self.thresholds[self.language(buckets)])
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def calibrated(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The logit between two values that makes the fewest errors; of equals, the widest gap.

    ``counts`` tells how many rows an entry stands for (1 if not given).
    """
    counts = np.ones(len(labels)) if counts is None else counts
    x, at = np.unique(logits, return_inverse=True)
    ones, zeros = (np.bincount(at, weights=counts * (labels == y), minlength=len(x)) for y in (1, 0))
    errors = np.concatenate([[0], np.cumsum(ones)]) + np.concatenate([np.cumsum(zeros[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    gaps = edges[1:] - edges[:-1]
    best = np.flatnonzero(errors == errors.min())
    i = int(best[np.argmax(gaps[best])])
    return float((edges[i] + edges[i + 1]) / 2)


def _marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose doc_id may be wanted: all that are, and others only where the marks of two ids coincide."""
    mark = F.xxhash64("doc_id")
    word = F.pmod(F.shiftrightunsigned(mark, 6), F.lit(MARKS // 64)).alias("word")
    one = F.expr("shiftleft(1L, cast(xxhash64(doc_id) & 63 as int))").alias("one")
    marks = wanted.select(word, one).groupBy("word").agg(F.bit_or("one").alias("ones"))
    found = rows.select("*", word, one).join(F.broadcast(marks), "word")  # MARKS / 64 rows at most
    return found.where("(ones & one) <> 0").select(*rows.columns)


def _labelled(docs: DataFrame, labels: DataFrame, shard: int) -> tuple[DataFrame, int]:
    """Rows with a label, as buckets, and the number of shards; every fifth row of a shard is ``rest``.

    Texts without a label are left out before the shuffle, which sends buckets only. The rows are kept by shard, so that an epoch
    shuffles none of them; a lost part is made again.
    """
    wanted = materialise(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    ).hint("merge")  # labels grow with the documents: the same plan for all sizes
    language = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), language.alias("lang")
    )
    shards = max(1, -(-rows.select("doc_id").join(wanted, "doc_id").count() // shard))

    def hashed(batch: pa.RecordBatch) -> dict:
        hasher = Hasher()
        return {
            "doc_id": batch.column("doc_id"),
            "lang": batch.column("lang"),
            "buckets": [hasher.buckets(t).astype(np.uint16).tobytes() for t in batch.column("text").to_pylist()],
        }

    near = map_batches(_marked(rows, wanted), hashed, "doc_id long, lang string, buckets binary")
    table = near.join(wanted, "doc_id").select("doc_id", "toxic", "lang", "buckets")
    own = F.pmod(F.xxhash64("doc_id", "buckets"), F.lit(shards)).cast("int")
    place = F.row_number().over(Window.partitionBy("shard").orderBy("doc_id", "toxic", "buckets"))
    dealt = spread(table.withColumn("shard", own), "shard").withColumn("rest", place % 5 == 0)
    return dealt.persist(StorageLevel.DISK_ONLY), shards


def _buckets(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(b, np.uint16).reshape(-1, 2) for b in column]


def _dense(net: Network) -> np.ndarray:
    """All parameters but the embeddings, behind each other."""
    return np.concatenate([*(k.ravel() for k in net.filters), *net.bias, net.output, [net.intercept]]).astype(np.float64)


def _changed(net: Network, embedding: np.ndarray, dense: np.ndarray) -> Network:
    """The network with changes of its embeddings and of its other parameters added."""
    parts = np.split(_dense(net) + dense, np.cumsum([*(k.size for k in net.filters), *(b.size for b in net.bias), net.output.size]))
    n, out = len(WIDTHS), [p.astype(np.float32) for p in parts[:-1]]
    filters = [p.reshape(k.shape) for p, k in zip(out, net.filters)]
    return Network(net.embedding + embedding, filters, out[n : 2 * n], out[2 * n], float(parts[-1][0]))


def _epoch(rows: DataFrame, start: Network, epochs: int, seed: int) -> Network:
    """The average of the networks that each shard makes of ``start``."""
    shared = rows.sparkSession.sparkContext.broadcast(pickle.dumps(start))  # bounded: buckets x dimensions

    def fitted(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["doc_id", "toxic", "buckets"], kind="stable")
        net, old = (pickle.loads(shared.value) for _ in range(2))
        train(_buckets(table["buckets"]), table["toxic"].to_numpy(), epochs, seed, net=net)
        change = net.embedding - old.embedding
        touched = change.any(axis=1, keepdims=True).astype(np.float32)
        parts = np.split(np.hstack([change, touched]), SLICES)
        parts.append(np.append(_dense(net) - _dense(old), 1.0))
        return pd.DataFrame({"slice": range(SLICES + 1), "change": [p.tobytes() for p in parts]})

    def added(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        kind = np.float64 if key[0] == SLICES else np.float32  # embeddings are sent as they are
        wide = sorted(np.frombuffer(b, kind).astype(np.float64).tobytes() for b in table["change"])
        total = sum(np.frombuffer(b) for b in wide)
        return pd.DataFrame({"slice": [key[0]], "change": [total.tobytes()]})

    learned = rows.where(~F.col("rest")).groupBy("shard").applyInPandas(fitted, "slice int, change binary")
    sums = {r["slice"]: np.frombuffer(r["change"]) for r in learned.groupBy("slice").applyInPandas(added, "slice int, change binary").collect()}
    if not sums:
        return start
    table = np.concatenate([sums[k] for k in range(SLICES)]).reshape(BUCKETS, DIMENSIONS + 1)
    embedding = (table[:, :-1] / np.maximum(table[:, -1:], 1)).astype(np.float32)
    return _changed(start, embedding, sums[SLICES][:-1] / sums[SLICES][-1])


def _profile(rows: DataFrame) -> np.ndarray:
    """Log-frequency of every bucket (rows) in every language (columns), from all rows."""
    names = sorted(r[0] for r in rows.select("lang").where("lang is not null").distinct().collect()) or [""]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, b in zip(batch["lang"], _buckets(batch["buckets"])):
                if len(b):
                    np.add.at(counts.setdefault(name, np.zeros(BUCKETS, np.int64)), b[:, 0].astype(np.int64), 1)
        for name, n in counts.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": name, "bucket": at.astype(np.int32), "n": n[at]})

    found = rows.where("lang is not null").select("lang", "buckets").mapInPandas(counted, "lang string, bucket int, n long")
    counts = np.full((BUCKETS, len(names)), 0.5)
    for r in found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():  # bounded: buckets x languages
        counts[r["bucket"], names.index(r["lang"])] += r["n"]
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def learn(docs: DataFrame, labels: DataFrame, shard: int = SHARD_DOCUMENTS) -> Scorer:
    """Fit on the whole texts of all labelled rows; only sums and the model reach the driver.

    Four fifths of a shard train, the rest calibrates. A language has a threshold of its own where both
    classes have ``ENOUGH`` rows of it there. ``labels`` has doc_id and toxic (0 or 1; other rows are left out).
    """
    rows, shards = _labelled(docs, labels, shard)
    net = Network.start()
    rounds = 1 if shards == 1 else EPOCHS
    for k in range(rounds):
        net = _epoch(rows, net, EPOCHS // rounds, SEED + k)
    shares = np.concatenate([(net.embedding @ k) for kernel in net.filters for k in kernel], axis=1)
    profile = _profile(rows)
    scorer = Scorer(shares, np.concatenate(net.bias), net.output, net.intercept, profile, np.zeros(profile.shape[1]))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            samples = _buckets(batch["buckets"])
            logits = np.array([shared.value.logit(b) for b in samples], float)
            spoken = np.array([shared.value.language(b) for b in samples], np.int32)
            yield pd.DataFrame({"spoken": spoken, "logit": logits.clip(-30, 30).round(LOGIT_DIGITS), "toxic": batch["toxic"]})

    kept = rows.where("rest").select("buckets", "toxic").mapInPandas(judged, "spoken int, logit double, toxic int")
    table = kept.groupBy("spoken", "logit", "toxic").count().toPandas()  # bounded: languages x steps of the logit
    rows.unpersist()

    def threshold(own: pd.DataFrame, least: int) -> float | None:
        sizes = [own.loc[own["toxic"] == y, "count"].sum() for y in (0, 1)]
        return calibrated(*(own[c].to_numpy() for c in ("logit", "toxic", "count"))) if min(sizes) >= least else None

    overall = threshold(table, 1) or 0.0
    for i in range(len(scorer.thresholds)):
        own = threshold(table[table["spoken"] == i], ENOUGH)
        scorer.thresholds[i] = overall if own is None else own
    return scorer


_hasher: list[Hasher] = []


def score_toxicity(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id, score, predicted`` of every row, from its whole text.

    A null or empty text has no words and gets the score of the empty filters. Repeated rows are
    scored each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # bounded: buckets x filters

    def run(batch: pa.RecordBatch) -> dict:
        if not _hasher:
            _hasher.append(Hasher())
        scores = [shared.value.score(_hasher[0].buckets(t)) for t in batch.column("text").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "score": scores,
            "predicted": [int(s >= 0.5) for s in scores],
        }

    return map_batches(texts(docs), run, "doc_id long, score double, predicted int")


def toxicity_score(scorer: Scorer, spark: SparkSession) -> Callable[[Column], Column]:
    """A function from a text column to its score, for filters that keep all other columns."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def run(text: pd.Series) -> pd.Series:
        if not _hasher:
            _hasher.append(Hasher())
        scores = [shared.value.score(_hasher[0].buckets(None if pd.isna(t) else t)) for t in text]
        return pd.Series(scores, dtype="float64")

    return run


def held_out_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted``: labels learned outside the held fold only.

    A row without a doc_id has no label and is not held out.
    """
    part = fold(F.col("doc_id"), folds)
    scorer = learn(docs, labels.where(part != held))
    found = score_toxicity(docs, scorer)
    return found.withColumn("held_out", F.coalesce(part == held, F.lit(False)))

"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram is the product of its letters' vectors, each
rotated by the letter's place (binding by permutation); a text is the sum of its n-grams'
vectors (bundling), a language the sum of its texts. A text gets the language whose profile has
the largest cosine with it.

Sums are linear, so profiles are built from n-gram counts per language, which Spark adds up, and a
text's vector from the counts of its n-grams.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantpanel.llm.rows import bounded_batches, fold, map_batches

DIMENSIONS = 1024
NGRAM = 3
SYMBOLS = 64  # symbol 0 stands for everything that is no letter
UNKNOWN = "und"
HELD_LANGUAGES = 64  # languages whose counts a task holds at once
KEPT_NGRAMS = 65_536  # n-grams whose vectors a worker keeps
BLOCK_NGRAMS = 8_192  # n-grams of one matrix product
SEED = 7


def symbols(text: str) -> np.ndarray:
    """A symbol per character: 0 between words, then letters; runs of 0 count once.

    Lower-case a-z have their own symbols; other letters share the rest by code point.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    small = points < 0x110000
    out = _table()[np.where(small, points, 0)]
    if len(out) > 1:
        keep = np.ones(len(out), bool)
        keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
        out = out[keep]
    return out


_known: list[np.ndarray] = []


def _table() -> np.ndarray:
    """Symbol of each code point."""
    if not _known:
        table = np.zeros(0x110000, np.uint8)
        first = ord("a")
        table[first : first + 26] = np.arange(1, 27)
        shared = SYMBOLS - 27
        for point in range(0x80, 0x110000):
            if chr(point).isalpha():
                table[point] = 27 + point % shared
        _known.append(table)
    return _known[0]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of a text, with a word boundary at both ends, and their counts."""
    found = symbols(f" {text or ''} ")
    n = len(found) - NGRAM + 1
    if n <= 0 or not found.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = np.zeros(n, np.int64)
    for k in range(NGRAM):
        code = code * SYMBOLS + found[k : k + n]
    if n > 20_000:
        counts = np.bincount(code, minlength=1)
        codes = np.flatnonzero(counts)
        return codes, counts[codes]
    return np.unique(code, return_counts=True)


class NgramVectors:
    """Vectors of n-grams; the ones met first are kept, up to a bound."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.letters = rng.choice(np.array([-1, 1], np.int8), (SYMBOLS, dimensions))
        self.place = np.full(SYMBOLS**NGRAM, -1, np.int32)
        self.kept = np.empty((0, dimensions), np.int8)

    def of(self, codes: np.ndarray) -> np.ndarray:
        new = codes[self.place[codes] < 0]
        if len(new) and len(self.kept) + len(new) <= KEPT_NGRAMS:
            self.place[new] = np.arange(len(self.kept), len(self.kept) + len(new))
            self.kept = np.concatenate([self.kept, self.bind(new)])
            new = new[:0]
        return self.kept[self.place[codes]] if len(new) == 0 else self.bind(codes)

    def bind(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones((len(codes), self.letters.shape[1]), np.int8)
        for k in range(NGRAM):
            letter = codes // SYMBOLS ** (NGRAM - 1 - k) % SYMBOLS
            out *= np.roll(self.letters, NGRAM - 1 - k, axis=1)[letter]
        return out

    def bundle(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One row per text: the sum of its n-grams' vectors, in products of bounded size."""
        codes = np.concatenate([c for c, _ in grams])
        counts = np.concatenate([n for _, n in grams]).astype(np.float32)
        row = np.repeat(np.arange(len(grams)), [len(c) for c, _ in grams])
        met, column = np.unique(codes, return_inverse=True)
        out = np.zeros((len(grams), self.letters.shape[1]), np.float32)
        for start in range(0, len(met), BLOCK_NGRAMS):
            part = met[start : start + BLOCK_NGRAMS]
            here = (column >= start) & (column < start + len(part))
            held = np.zeros((len(grams), len(part)), np.float32)
            held[row[here], column[here] - start] = counts[here]
            out += held @ self.of(part).astype(np.float32)
        return out


@dataclass(frozen=True)
class Profiles:
    """Languages and their unit vectors."""

    names: list[str]
    vectors: np.ndarray

    def dumps(self) -> str:
        return json.dumps({"names": self.names, "vectors": self.vectors.tolist()})

    @staticmethod
    def loads(text: str) -> Profiles:
        spec = json.loads(text)
        return Profiles(spec["names"], np.array(spec["vectors"], np.float32))


def fit_profiles(docs: DataFrame) -> Profiles:
    """Profiles of the languages in ``lang`` from all whole texts; null langs are left out.

    Counts of a language and n-gram are added up by task and summed by Spark; what reaches the driver is
    bounded by the numbers of languages and n-grams.
    """
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("lang is not null and text is not null")
    bounded_batches(docs.sparkSession)

    def sums_of(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, total in held.items():
            met = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(met), "string"), pa.array(met), pa.array(total[met])], ["lang", "code", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if lang not in held and len(held) == HELD_LANGUAGES:
                    yield from sums_of(held)
                    held = {}
                codes, counts = ngram_counts(text)
                held.setdefault(lang, np.zeros(SYMBOLS**NGRAM, np.int64))[codes] += counts
        yield from sums_of(held)

    table = (
        rows.mapInArrow(count, "lang string, code long, n long")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    makers = NgramVectors()
    names, vectors = [], []
    for lang, part in sorted(table.groupby("lang"), key=lambda x: x[0]):
        part = part.sort_values("code")
        vector = makers.bundle([(part["code"].to_numpy(), part["n"].to_numpy())])[0]
        names.append(str(lang))
        vectors.append(vector / max(float(np.linalg.norm(vector)), 1e-12))
    return Profiles(names, np.array(vectors, np.float32).reshape(len(names), DIMENSIONS))


_makers: list[NgramVectors] = []


def identify(
    texts: list[str | None], profiles: Profiles, makers: NgramVectors
) -> list[tuple[str, float]]:
    """Language and cosine (below 0: 0); ``und`` and 0 without a letter or a profile."""
    grams = [ngram_counts(t) for t in texts]
    if not texts or not profiles.names:
        return [(UNKNOWN, 0.0)] * len(texts)
    vectors = makers.bundle(grams)
    cosines = vectors @ profiles.vectors.T
    cosines /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    best = cosines.argmax(axis=1)
    return [
        (profiles.names[b], float(np.clip(cosines[i, b], 0, 1))) if len(grams[i][0]) else (UNKNOWN, 0.0)
        for i, b in enumerate(best.tolist())
    ]


def predict_languages(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its whole text.

    A text that is null or has no letter is ``und`` with score 0. Equal cosines give the first
    language by name. Repeated rows are predicted each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # bounded: languages x dimensions

    def predict(batch: pa.RecordBatch) -> dict:
        if not _makers:
            _makers.append(NgramVectors())
        found = identify(batch.column("text").to_pylist(), shared.value, _makers[0])
        return {
            "doc_id": batch.column("doc_id"),
            "lang_pred": [f[0] for f in found],
            "score": [f[1] for f in found],
        }

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, predict, "doc_id long, lang_pred string, score double")


def held_out_languages(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: profiles learned outside the held fold only.

    A row without a doc_id is in no fold: it is not learned from and not held out.
    """
    part = fold(F.col("doc_id"), folds)
    found = predict_languages(docs, fit_profiles(docs.where(part != held)))
    return found.withColumn("held_out", F.coalesce(part == held, F.lit(False)))

"""Token counts of whole texts by byte-pair merging.

The words of a text come from the normaliser and the pre-tokeniser that a vocabulary file
describes. Each distinct word is merged once per worker: its symbols form a linked list, a heap
holds the adjacent pairs by rank, and the lowest rank is merged until no ranked pair is left.
The number of tokens is the number of symbols minus the number of merges; no ids are made.

Counts are remembered per piece between spaces and line feeds, and per word, in tables of bounded
size, because no word of these vocabularies reaches over white space.
"""

from __future__ import annotations

import heapq
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from quantpanel.llm.rows import map_batches, texts

CACHE_ENTRIES = 400_000
TOKEN_LIMIT = 2048


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of tokens left when the lowest-rank adjacent pair is merged again and again.

    Equal ranks are merged from left to right.
    """
    total = len(symbols)
    parts: list[str | None] = list(symbols)
    before, after = list(range(-1, total - 1)), list(range(1, total + 1))
    heap = [
        (rank, i)
        for i in range(total - 1)
        if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None
    ]
    heapq.heapify(heap)
    left = total
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= total or ranks.get((parts[i], parts[j])) != rank:
            continue  # one of the two was merged meanwhile
        parts[i] += parts[j]
        parts[j] = None
        after[i] = after[j]
        if after[i] < total:
            before[after[i]] = i
        left -= 1
        for a in (before[i], i):
            b = after[a] if a >= 0 else total
            if b < total and (rank := ranks.get((parts[a], parts[b]))) is not None:
                heapq.heappush(heap, (rank, a))
    return left


class PairMerges:
    """The words and merge ranks of one vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.words: dict[str, int] = {}

    def word(self, word: str) -> int:
        count = self.words.get(word)
        if count is None:
            symbols = list(word)
            symbols[-1] += self.suffix
            count = merged_length(symbols, self.ranks)
            if len(word) <= 64:
                if len(self.words) >= CACHE_ENTRIES:
                    self.words.clear()
                self.words[word] = count
        return count

    def piece(self, text: str) -> int:
        """Tokens of any text; each special string in it is one token."""
        count, parts = 0, [text]
        if self.special and "<" in text:
            parts = self.special.split(text)
            count = len(parts) - 1
        for part in parts:
            if part:
                normal = self.normalizer.normalize_str(part) if self.normalizer else part
                count += sum(self.word(w) for w, _ in self.splitter.pre_tokenize_str(normal))
        return count


class CountCache(dict):
    """Counts per piece; when full, half of the memory is given up by age."""

    def __init__(self, merges: PairMerges, entries: int = CACHE_ENTRIES) -> None:
        self.merges, self.entries, self.old = merges, entries, {}

    def __missing__(self, piece: str) -> int:
        count = self.old.get(piece)
        if count is None:
            count = self.merges.piece(piece)
        if len(piece) <= 64:
            self[piece] = count
        return count

    def trim(self) -> None:
        if len(self) >= self.entries // 2:
            self.old = dict(self)
            self.clear()


_caches: dict[str, CountCache] = {}


def cache_of(path: str) -> CountCache:
    if path not in _caches:
        _caches[path] = CountCache(PairMerges(path))
    return _caches[path]


def count_text(text: str | None, cache: CountCache) -> int:
    return sum(map(cache.__getitem__, text.replace("\n", " ").split(" "))) if text else 0


def token_counts(docs: DataFrame, vocabulary: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``vocabulary`` names a tokenizers file whose words never hold white space and whose
    normaliser treats the parts between white space separately; it must be readable at the same
    path on every executor. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are
    counted each; a text of any length is counted whole.
    """

    def count(batch: pa.RecordBatch) -> dict:
        cache = cache_of(vocabulary)
        sizes, counts = [], []
        for text in batch.column("text").to_pylist():
            counts.append(count_text(text, cache))
            sizes.append(len(text.encode()) if text else 0)
            cache.trim()
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": sizes,
            "n_tokens": counts,
            "over_limit": [n > limit for n in counts],
        }

    return map_batches(
        texts(docs), count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )

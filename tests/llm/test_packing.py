import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quantpanel.llm import packing
from tests.llm.tables import awkward, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  b", "a   b", "\n", "a\n\n\nb", "x <|endoftext|> y", "<|endoftext|>", " lead", "trail ", "a\n b \nc", "a\tb\xa0c", "don't we'll 12 !!", "日本語 é ́x", "\x1c q\x85r", "a \n", "x\r\ny", "z" * 5000]


def test_ids_are_those_of_the_library():
    tokenizer, ids = Tokenizer.from_file(PATH), packing.encoder(PATH)
    for text in ODD:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.text(text), "<u4").tolist() == want, repr(text)


def check(frame, length, limit):
    tokenizer = Tokenizer.from_file(PATH)
    ids = {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1] for r in frame.collect()}
    rows = packing.pack(frame, PATH, length=length).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for doc, parts in by_doc.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == len(ids[doc])
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    used = sum(map(len, ids.values()))
    assert used >= limit * length * len(by_sequence)


def test_documents_are_packed_whole_and_tight(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), 2048, 0.97)


@pytest.mark.parametrize("length", [64, 100])
def test_other_lengths(spark, sf_dir, length):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40), length, 0.9)


def test_awkward_rows(spark):
    rows = packing.pack(awkward(spark), PATH).collect()
    assert sum(1 for r in rows if r.start == 0) == 13
    assert {r.length for r in rows if r.doc_id in (0, 1)} == {1}
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_ranks_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_PART", 7)
    rows = spark.createDataFrame([(i % 3, i) for i in range(100)], "k long, i long")
    got = defaultdict(list)
    for r in packing.ranked(rows, "k", "i").collect():
        got[r.k].append(r["rank"])
    assert {k: sorted(v) for k, v in got.items()} == {0: list(range(34)), 1: list(range(33)), 2: list(range(33))}


def test_patterns_reach_the_bound():
    rng = np.random.default_rng(1)
    demand = {int(s): int(n) for s, n in zip(rng.choice(np.arange(1, 64), 50, False), rng.integers(1, 5000, 50))}
    patterns = packing.solve_patterns(demand, 128)
    held = defaultdict(int)
    for times, pattern in patterns:
        assert sum(s * c for s, c in pattern.items()) <= 128
        for s, c in pattern.items():
            held[s] += times * c
    assert dict(held) == demand
    bound = sum(s * n for s, n in demand.items()) / 128
    assert sum(t for t, _ in patterns) <= bound * 1.001 + 50


def test_knapsack_against_enumeration():
    prices, sizes = np.array([0.2, 0.35, 0.9]), np.array([2, 3, 7])
    value, counts = packing.best_pattern(prices, sizes, 13)
    best = max(a * 0.2 + b * 0.35 + c * 0.9 for a in range(7) for b in range(5) for c in range(2) if 2 * a + 3 * b + 7 * c <= 13)
    assert value == pytest.approx(best) and float(counts @ prices) == pytest.approx(best)

import hashlib
import random
from collections import defaultdict

import pytest

from quantpanel.llm import phrases
from tests.llm.tables import awkward, documents


def brute(rows, window):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = defaultdict(lambda: 10**9)
    for i, ws in words.items():
        for a in range(len(ws) - window + 1):
            key = tuple(ws[a : a + window])
            first[key] = min(first[key], i)
    out = {}
    for i, ws in words.items():
        gone = set()
        for a in range(len(ws) - window + 1):
            if first[tuple(ws[a : a + window])] < i:
                gone.update(range(a, a + window))
        out[i] = (len(ws), len(gone), b" ".join(w for j, w in enumerate(ws) if j not in gone).decode())
    return out


def check(spark, rows, window):
    got = phrases.remove_repeats(documents(spark, rows), window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == brute(rows, window)
    digests = phrases.removal_digests(documents(spark, rows), window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in digests} == {
        i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, gone, kept) in brute(rows, window).items()
    }


@pytest.mark.parametrize("window,vocabulary,seed", [(6, 2, 1), (7, 3, 2), (8, 40, 3)])
def test_random_texts_with_shared_passages(spark, monkeypatch, window, vocabulary, seed):
    monkeypatch.setattr(phrases, "SHARD_PHRASES", 3)
    monkeypatch.setattr(phrases, "GROUP_BYTES", 200)
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    shared = [text(rng.randrange(window - 1, 4 * window)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [x for _ in range(3) for x in text(rng.randrange(5)) + rng.choice(shared)[rng.randrange(3) :]]
        rows.append((i * 3, rng.choice([" ", "\n", "\t "]).join(parts)))
    check(spark, rows, window)


def test_one_word_repeated_and_whole_copies(spark):
    rows = [(0, "a " * 300), (1, "a " * 120), (2, "b " + "a " * 60), (3, "x é\x85y " * 40), (4, "x é\x85y " * 30), (5, "")]
    check(spark, rows, 50)


def test_documents_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(spark, rows, 50)


def test_awkward_rows(spark):
    got = phrases.remove_repeats(awkward(spark)).collect()
    assert len(got) == 13
    by = {r.doc_id: r for r in got}
    assert by[6].n_removed == 0 and by[7].n_removed == by[7].n_words == 60_000 and by[7].kept == ""
    assert by[0].n_words == by[1].n_words == by[2].n_words == 0
    assert phrases.remove_repeats(documents(spark, [])).count() == 0
    digests = phrases.removal_digests(awkward(spark)).collect()
    assert sorted((r.n_words, r.n_removed) for r in digests) == sorted((r.n_words, r.n_removed) for r in got)
    assert phrases.removal_digests(documents(spark, [])).count() == 0

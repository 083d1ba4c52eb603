import time
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpus_pipeline import drop_near_copies
from quantpanel.llm import simhash
from quantpanel.llm.components import components
from tests.llm.tables import awkward, documents


def brute_print(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 200), (300, 299), (299, 301), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute_components({x for e in links for x in e}, links)
    assert got == {n: c for n, c in want.items() if n != 200}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in simhash.fingerprint_components(docs).collect()}
    prints = {r.doc_id: brute_print(r.text) for r in docs.collect()}
    linked = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = brute_components(list(prints), linked)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {
        i: (f"{prints[i]:016x}", want[i]) for i in prints
    }


@pytest.mark.parametrize("bucket", [256, 2])
def test_close_fingerprints_lose_no_pair(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "PAIR_BUCKET", bucket)
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 4).tolist() + [0, 2**64 - 1]
    values = set(centres)
    for c in centres:
        for _ in range(60):
            flips = rng.integers(0, 64, rng.integers(1, 5)).tolist()
            values.add(c ^ sum(1 << b for b in set(flips)))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    got = simhash.close_fingerprints(spark.createDataFrame([(v,) for v in signed], "p long"))
    want = {tuple(sorted(x)) for x in combinations(signed, 2) if ((x[0] ^ x[1]) % 2**64).bit_count() <= 2}
    assert {(r.p, r.q) for r in got.collect()} == want


def test_awkward_rows(spark):
    got = simhash.fingerprint_components(awkward(spark)).collect()
    assert len(got) == 13
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == by[0].fingerprint == "0" * 16
    assert by[0].component_id == by[2].component_id == 0
    assert by[5].component_id == by[4].component_id == 3
    assert by[7].component_id == 6
    assert simhash.fingerprint_components(documents(spark, [])).count() == 0


def test_majority_is_strict_and_words_differ():
    hashes = np.array([0b01, 0b11], np.uint64)
    assert simhash.majority(hashes, 1)[0] == 0b01
    wide = simhash.majority(np.arange(1, 600, dtype=np.uint64) * np.uint64(2654435761), 16)
    assert len(set(wide.tolist())) == 16


def near_copies(seed=5):
    """Texts, and copies of them with a growing share of words changed."""
    rng = np.random.default_rng(seed)
    word = lambda: f"w{rng.integers(5000)}"
    rows = []
    for g in range(25):
        base = [word() for _ in range(int(rng.integers(20, 400)))]
        for _ in range(8):
            copy = list(base)
            for _ in range(int(rng.integers(0, 1 + len(base) // 20))):
                copy[rng.integers(len(copy))] = word()
            rows.append(" ".join(copy))
    return list(enumerate(rows))


def jaccard_components(rows, size=5, similarity=0.8):
    sets = {i: set(simhash.shingle_hashes(t, size).tolist()) for i, t in rows}
    linked = []
    for a, b in combinations(sets, 2):
        shared, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if union == 0 or shared >= similarity * union - 1e-9:
            linked.append((a, b))
    return brute_components(list(sets), linked)


@pytest.mark.parametrize("bucket", [32, 4])
def test_similar_texts_against_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "PAIRED_MEMBERS", bucket)
    rows = near_copies() + [(500, ""), (501, None), (502, "one two"), (503, "ONE two")]
    got = {r.doc_id: r.component_id for r in simhash.similar_texts(documents(spark, rows)).collect()}
    want = jaccard_components(rows)
    assert {i: got[i] for i in want} == want
    assert got[501] == 500 and got[503] == 502


def test_similar_awkward_rows(spark):
    got = simhash.similar_texts(awkward(spark)).collect()
    assert len(got) == 13
    assert {r.component_id for r in got if r.doc_id in (6, 7)} == {6}
    assert simhash.similar_texts(documents(spark, [])).count() == 0


def test_blocks_reach_the_recall():
    for rows in (100, 10_000, 10**7, 10**11):
        bits, count = simhash.blocks_for(rows, 0.8)
        agree = 1 - simhash.bit_difference(0.8)
        assert 1 - (1 - agree**bits) ** count >= simhash.RECALL


def assert_equal_to_brute_force(spark, rows):
    got = {r.doc_id: r.component_id for r in simhash.similar_texts(documents(spark, rows)).collect()}
    assert got == jaccard_components(rows)


def test_no_link_of_a_crowded_family_is_lost(spark):
    """Copies around the least similarity: some pairs are links, most are near misses."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        copy = list(base)
        for at in rng.choice(120, int(rng.integers(1, 5)), replace=False):
            copy[at] = f"x{rng.integers(10**6)}"
        rows.append((i, " ".join(copy)))
    assert_equal_to_brute_force(spark, rows)


def test_short_texts_on_both_sides_of_the_limit(spark):
    """4 of 5 shingles are a link; 6 of 8 and 7 of 9 are none."""
    rows = []
    for g in range(60):
        for k, words in enumerate((8, 9)):
            rows.append((1000 + 2 * g + k, " ".join(f"a{g}x{i}" for i in range(words))))
        for k, words in enumerate((10, 12)):
            rows.append((2000 + 2 * g + k, " ".join(f"b{g}x{i}" for i in range(words))))
        for k, words in enumerate((11, 13)):
            rows.append((3000 + 2 * g + k, " ".join(f"c{g}x{i}" for i in range(words))))
    assert_equal_to_brute_force(spark, rows)


def test_texts_of_one_id_have_their_own_groups(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = c + " more"
    rows = [(3, a), (5, a), (5, b), (9, c), (9, near), (9, c), (None, a)]
    got = {(r.doc_id, r.kept) for r in simhash.similar_texts(documents(spark, rows)).collect()}
    assert (3, True) in got and (5, False) in got and (5, True) in got and (None, True) in got
    kept = drop_near_copies(spark, documents(spark, rows), "")
    left = sorted(((r.doc_id or 0, r.text) for r in kept.collect()))
    assert left in (sorted([(3, a), (5, b), (9, near), (0, a)]), sorted([(3, a), (5, b), (9, c), (9, c), (0, a)]))


def test_widespread_shingles_are_counted_in_bounded_memory(spark, monkeypatch):
    common = " ".join(f"c{i}" for i in range(30))
    rows = [(i, f"{common} " + " ".join(f"u{i}x{j}" for j in range(30))) for i in range(200)]
    frame = documents(spark, rows).repartition(2)
    everywhere = set(simhash.shingle_hashes(common, 5).tolist())
    for limit in (1 << 21, 500):
        monkeypatch.setattr(simhash, "COUNTED", limit)
        assert everywhere <= set(simhash._widespread(frame, 5).tolist())


def test_shingles_are_looked_up_among_a_million_widespread_ones(spark):
    """Going through them for every text took 0.1 s and more a text."""
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 60))) for i in range(400)]
    own = np.concatenate([simhash.shingle_set(t, 5)[0][::3] for _, t in rows])
    widespread = np.unique(np.concatenate([own, rng.integers(0, 2**64, 1 << 20, dtype=np.uint64)]))
    frame = documents(spark, rows).coalesce(1)
    sent = spark.sparkContext.broadcast(widespread)
    began = time.monotonic()
    got = {r.tag: (r.n, r.prefix) for r in simhash._prefixes(frame, 5, 0.8, sent).collect()}
    assert time.monotonic() - began < 15
    common = set(widespread.tolist())
    for _, text in rows:
        found, tag = simhash.shingle_set(text, 5)
        ordered = sorted(found.tolist(), key=lambda h: (h in common, h))
        want = np.array(ordered[: simhash.prefix_length(len(found), 0.8)], np.uint64).view(np.int64).tolist()
        assert got[tag] == (len(found), want)
    assert simhash.prefix_of(found, np.empty(0, np.uint64), 0.8).tolist() == found[: len(want)].tolist()


def test_parities_lose_no_similar_pair_and_leave_few_others(spark):
    """Sizes around the powers of two, where the longer parity is folded."""
    rng = np.random.default_rng(9)
    sets = {}
    for n in (1, 2, 5, 50, 62, 64, 66, 70, 125, 128, 130, 500, 520, 1030):
        base = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for share in (0, 0.05, 0.1, 0.111, 0.2, 0.25, 0.5, 1):
            kept = base[: n - round(n * share)]
            for extra in (0, round(n * share)):
                sets[len(sets)] = np.unique(np.concatenate([kept, rng.integers(0, 2**64, extra, dtype=np.uint64)]))
    nodes = spark.createDataFrame(
        [(i, len(s), simhash.parity_of(s).view(np.int64).tolist()) for i, s in sets.items()], "tag long, n int, parity array<long>"
    )
    pairs = nodes.select(F.col("tag").alias("a")).join(nodes.select(F.col("tag").alias("b")), F.col("a") < F.col("b"))
    got = {(r.a, r.b) for r in simhash._possible(pairs.unionByName(pairs), nodes, 0.8).collect()}
    similar, unlike = set(), set()
    for a, b in combinations(sets, 2):
        shared, union = len(np.intersect1d(sets[a], sets[b])), len(np.union1d(sets[a], sets[b]))
        if union == 0 or shared >= 0.8 * union - 1e-9:
            similar.add((a, b))
        elif shared < 0.4 * union and min(len(sets[a]), len(sets[b])) >= 50:
            unlike.add((a, b))
    assert similar <= got and len(similar) > 200
    assert len(unlike & got) < len(unlike) / 100


def test_few_texts_are_sent_for_pairs_that_share_a_shingle_only(spark, monkeypatch):
    """Texts of one size that share a line: they meet in the prefixes, but nothing is like them."""
    rng = np.random.default_rng(13)
    word = lambda: f"w{rng.integers(10**6)}"
    rows = [(i, " ".join(f"line{i // 4}x{j}" for j in range(30)) + " " + " ".join(word() for _ in range(90))) for i in range(200)]
    asked = []
    verified = simhash._verified
    monkeypatch.setattr(simhash, "_verified", lambda pairs, *rest: asked.append(pairs.count()) or verified(pairs, *rest))
    assert_equal_to_brute_force(spark, rows)
    assert sum(asked) < 10


def test_shingle_hashes_of_short_texts_and_odd_blanks():
    assert simhash.shingle_hashes(None, 5).tolist() == simhash.shingle_hashes(" \t\n", 5).tolist() == []
    for text in ("One", "a b c d e", "a\tB\x0b c\nd  e \x0cf", "\u00a0x \u00c4 b c d e f g", " ".join("abab" * 9)):
        words = text.encode().lower().split()
        want = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 5]), 42) for i in range(max(1, len(words) - 4))]
        assert simhash.shingle_hashes(text, 5).tolist() == want
        assert simhash.shingle_set(text, 5)[0].tolist() == sorted(set(want))

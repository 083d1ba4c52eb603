import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quantpanel.llm import merkle
from tests.llm.tables import awkward, documents

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves, arity):
    """Root and, per leaf, the (left, right) digests up to it."""
    paths, nodes = [[] for _ in leaves], [(d, [i]) for i, d in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for k, (_, below) in enumerate(run):
                sides = "".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])
                for i in below:
                    paths[i].append(sides)
            above.append((H("".join(d for d, _ in run)), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], paths


def expected(rows, arity=8):
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r.lang].append(r)
    order = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {}
    for lang in order:
        held = sorted(by_lang[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        built[lang] = held, *tree([leaf_of(r, r.text) for r in held], arity)
    root, upper = tree([built[lang][1] for lang in order], arity)
    found = []
    for lang, top in zip(order, upper):
        held, subroot, paths = built[lang]
        for r, path in zip(held, paths):
            path = path + top
            leaf, text = leaf_of(r, r.text), r.text
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and text is not None:
                text = text.translate(str.maketrans(UPPER, LOWER))
            digest = leaf_of(r, text)
            for left, right in path:
                digest = H(left + digest + right)
            found.append((r.doc_id, leaf, subroot, root, H("".join(a + b for a, b in path)), digest, digest == root))
    return found


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("langs", [1, 3, 70])
def test_against_brute_force(spark, langs):
    rows = [(i * 7 % 613 - 5, f"Text {i} Ä") for i in range(300)]
    frame = documents(spark, rows, [None if i % langs == 1 else f"l{i % langs}" for i in range(300)])
    assert ordered(merkle.audited(frame).collect()) == ordered(expected(frame.collect()))


def test_documents(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert ordered(merkle.audited(frame).collect()) == ordered(expected(frame.collect()))


@pytest.mark.parametrize("arity", [2, 3])
def test_other_arities(spark, arity):
    frame = documents(spark, [f"t{i}" for i in range(45)], [f"l{i % 4}" if i else "alone" for i in range(45)])
    got = merkle.manifest(frame, arity=arity).select(
        "doc_id", F.lower(F.hex("leaf")), F.lower(F.hex("root")),
        F.lower(F.hex(merkle.folded(F.col("leaf"), F.col("route")))),
    )
    assert ordered(got.collect()) == ordered((r[0], r[1], r[3], r[3]) for r in expected(frame.collect(), arity))


def test_sizes_around_a_full_run(spark):
    for n in (1, 8, 9, 65):
        frame = documents(spark, [f"A{i}" for i in range(n)], ["x"] * n)
        assert ordered(merkle.audited(frame).collect()) == ordered(expected(frame.collect())), n


def test_awkward_and_repeated_rows(spark):
    frame = awkward(spark).unionByName(awkward(spark)).withColumn("tree", F.lit("clash")).withColumn("index", F.lit("clash"))
    assert ordered(merkle.audited(frame).collect()) == ordered(expected(frame.collect()))
    same = documents(spark, [(4, "Same Text")] * 40)
    assert ordered(merkle.audited(same).collect()) == ordered(expected(same.collect()))
    none = merkle.audited(documents(spark, []))
    assert none.count() == 0 and none.columns[-1] == "verified"

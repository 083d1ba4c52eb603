import itertools
import random
import re
from collections import Counter

import pytest

from quantpanel.llm import filter_audit as audit
from tests.llm.tables import awkward, documents


def brute(rows, labels):
    least = {}
    for r in rows:
        text = r.text or ""
        if r.doc_id is not None:
            least[text] = min(least.get(text, r.doc_id), r.doc_id)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    told = []
    for r in rows:
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if r.doc_id is not None and r.doc_id > least[text] else set()
        told.append((r.source or "", fails, r.doc_id in good, r.doc_id in bad))
    found, removed_by = [], Counter()
    for order in itertools.permutations("ABCDE"):
        for part in {t[0] for t in told}:
            for step, own in enumerate(order, 1):
                rows_here = [t for t in told if t[0] == part]
                gone = [bool(t[1] & set(order[: step - 1])) for t in rows_here]
                removed = [t for t, g in zip(rows_here, gone) if own in t[1] and not g]
                removed_by[part, own] += len(removed)
                found.append([
                    part, "".join(order), step,
                    sum(not (t[1] & set(order[:step])) for t in rows_here), len(removed),
                    sum(own in t[1] and g for t, g in zip(rows_here, gone)),
                    sum(t[1] == {own} for t in rows_here),
                    sum(t[2] for t in removed), sum(t[3] for t in removed),
                ])
    return sorted((*f, removed_by[f[0], f[1][f[2] - 1]]) for f in found)


def run(spark, frame, labels):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(map(tuple, audit.filter_audit(frame, table).collect()))


def some_texts(n, seed):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        words = rng.choices(["alpha", "Beta", "c#", "délta", "EPSILON", "a", "b" * 40], k=rng.choice([0, 1, 3, 150, 199, 200, 230]))
        made.append((" \n"[rng.random() < 0.2]).join(w + str(rng.randrange(rng.choice([1, 400]))) for w in words))
    return made


@pytest.mark.parametrize("rows_per_trie", [7, 50_000])
def test_against_brute_force(spark, monkeypatch, rows_per_trie):
    monkeypatch.setattr(audit, "LOCAL_ROWS", rows_per_trie)
    texts = some_texts(60, 3)
    rng = random.Random(5)
    rows = [(rng.randrange(150), rng.choice(texts)) for _ in range(200)]
    frame = documents(spark, rows).selectExpr("doc_id", "text", "case doc_id % 3 when 0 then 'x' when 1 then '' end as source")
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in rng.choices(range(160), k=90)] + [(None, 1, 1)]
    assert run(spark, frame, labels) == brute(frame.collect(), labels)


def test_long_common_prefixes_are_made_longer(spark):
    head = "A shared header line. " * 200
    rows = [(i, head + f"tail {i % 40}") for i in range(400)] + [(1000 + i, head) for i in range(50)]
    frame = documents(spark, rows).repartition(5)
    first = audit.local_flags(frame, audit.Limits()).where("text is not null")
    lengths = {r.prefix for r in audit.prefix_lengths(first, 8).select("prefix").collect()}
    assert max(lengths) > len(head)
    labels = [(3, 1, 0), (41, 1, 1)]
    assert run(spark, frame, labels) == brute(frame.collect(), labels)


def test_trie_against_a_dictionary():
    rng = random.Random(2)
    trie, least = audit.Trie(), {}
    for _ in range(3000):
        text = bytes(rng.choices(b"ab", k=rng.randrange(9)))
        doc = rng.randrange(500)
        trie.insert(text, doc, "p", 0, 1)
        least[text] = min(least.get(text, doc), doc)
    assert {row[4]: row[0] for row in trie.firsts()} == least


def test_awkward_rows(spark):
    frame = awkward(spark).unionByName(awkward(spark))
    labels = [(5, 1, 1), (5, 0, 0), (None, 1, 1)]
    assert run(spark, frame, labels) == brute(frame.collect(), labels)
    assert run(spark, documents(spark, []), labels) == []
    assert run(spark, frame, []) == brute(frame.collect(), [])

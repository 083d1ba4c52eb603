import zlib

import numpy as np
import pytest
from xxhash import xxh32_intdigest

from quantpanel.llm import toxicity
from tests.llm.tables import awkward, documents


def slow_logit(net, buckets):
    """Convolution and maximum, place by place."""
    words = [net.embedding[a] + net.embedding[b] for a, b in buckets]
    while len(words) < max(toxicity.WIDTHS):
        words.append(np.zeros(toxicity.DIMENSIONS))
    total, at = net.intercept, 0
    for kernel, bias in zip(net.filters, net.bias):
        for f in range(toxicity.FILTERS):
            peak = max(
                sum(float(words[i + k] @ kernel[k][:, f]) for k in range(len(kernel)))
                for i in range(len(words) - len(kernel) + 1)
            )
            total += max(peak + bias[f], 0) * net.output[at]
            at += 1
    return total


@pytest.mark.parametrize("text", ["", "one", "one two", "some more words, with ends. And others"])
def test_look_up_form_equals_the_network(text):
    net = toxicity.Network.start()
    shares = np.concatenate([(net.embedding @ k) for kernel in net.filters for k in kernel], axis=1)
    profile = np.zeros((toxicity.BUCKETS, 1))
    scorer = toxicity.Scorer(shares, np.concatenate(net.bias), net.output, net.intercept, profile, np.zeros(1))
    buckets = toxicity.Hasher().buckets(text)
    assert scorer.logit(buckets) == pytest.approx(slow_logit(net, buckets), abs=1e-4)
    assert net.forward(buckets)[3] == pytest.approx(slow_logit(net, buckets), abs=1e-4)


def test_thresholds_make_the_fewest_errors():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=200), rng.integers(0, 2, 200)
    x[y == 1] += 1
    t = toxicity.calibrated(x, y)
    errors = ((x >= t) != y).sum()
    assert errors == min(((x >= c) != y).sum() for c in [*x, x.max() + 1])
    assert toxicity.calibrated(np.array([0.0, 1.0, 5.0, 6.0]), np.array([0, 0, 1, 1])) == 3.0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.held_out_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    hits = [p for _, p, t in held if t == 1]
    false = [p for _, p, t in held if t == 0]
    assert sum(hits) / len(hits) > 0.75 and sum(false) / len(false) < 0.015  # some labels are noise


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(3, 1), (4, 1), (6, 0), (7, 0), (None, 1), (9, None), (0, 0)], "doc_id long, toxic int")
    got = toxicity.held_out_toxicity(awkward(spark), labels).collect()
    assert len(got) == 13 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[0] == by[1] == by[2] == by[10]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert len(toxicity.held_out_toxicity(awkward(spark), none).collect()) == 13
    assert toxicity.held_out_toxicity(documents(spark, []), labels).count() == 0


@pytest.mark.parametrize("shard", [toxicity.SHARD_DOCUMENTS, 150])
def test_every_labelled_row_is_learned_from(spark, shard):
    """A rare word of one late row must reach the profile and the embeddings."""
    rows = [(i, "s", "en", f"{'bad' if i % 2 else 'good'} words {i % 7} follow", 0) for i in range(600)]
    docs = spark.createDataFrame([(i, text, lang) for i, _, lang, text, _ in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(600)], "doc_id long, toxic int")
    table, shards = toxicity._labelled(docs, labels, shard)
    assert table.count() == 600 and shards == -(-600 // shard)
    assert table.where("rest").count() in range(600 // 5 - shards, 600 // 5 + 1)
    scorer = toxicity.learn(docs, labels, shard)
    counts = np.exp(scorer.profile[toxicity.Hasher().buckets("bad")[0, 0], 0])
    assert counts == pytest.approx(300.5 / (600 * 4 + toxicity.BUCKETS * 0.5), rel=1e-3)
    hasher = toxicity.Hasher()
    assert scorer.score(hasher.buckets("bad words 3 follow")) > 0.5 > scorer.score(hasher.buckets("good words 3 follow"))


def test_texts_without_a_label_stay_behind_and_epochs_do_not_shuffle(spark, capsys):
    docs = spark.createDataFrame([(i if i % 50 else None, f"words {i} of it") for i in range(2000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 2000, 9)], "doc_id long, toxic int")
    wanted = {i for i in range(0, 2000, 9) if i % 50}
    near = [r.doc_id for r in toxicity._marked(docs, labels).collect()]
    assert wanted <= set(near) and len(near) < len(wanted) + 20
    rows, _ = toxicity._labelled(docs, labels, 40)
    assert {r.doc_id for r in rows.collect()} == wanted
    rows.where("not rest").groupBy("shard").applyInPandas(lambda t: t[["shard"]], "shard int").explain()
    plan = capsys.readouterr().out.split("InMemoryRelation")[0]
    rows.unpersist()
    assert "FlatMapGroupsInPandas" in plan and "Exchange" not in plan


def test_buckets_are_those_of_the_tokens():
    hasher = toxicity.Hasher(entries=5)
    for text in (None, "", "-- ...", "One, two (ONE) two. ??? three four five six seven -- one", "one two", "one -- new"):
        want = [(xxh32_intdigest(w) % toxicity.BUCKETS, xxh32_intdigest("^" + w[:4]) % toxicity.BUCKETS) for w in toxicity.tokens(text)]
        assert [tuple(p) for p in hasher.buckets(text).tolist()] == want

from collections import defaultdict

import pytest

import corpus_pipeline
from quantpanel.llm import toxicity
from tests.llm.tables import awkward
from tests.llm.test_simhash import jaccard_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGES = dict(corpus_pipeline.STAGES)


def fixture(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plain(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stage_names():
    assert list(STAGES) == ["toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing"]


def test_toxic_documents_go(spark, sf_dir):
    docs = fixture(spark, "/root/testdata/sf0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    kept = STAGES["toxicity"](spark, docs, "/root/testdata/sf0.1")
    assert kept.columns == COLUMNS
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    toxic, clean = ([i for i, t in labels.items() if t == x] for x in (1, 0))
    assert sum(i in ids for i in clean) / len(clean) > 0.99
    assert sum(i not in ids for i in toxic) / len(toxic) > 0.75


def test_line_dedup_against_brute_force(spark, sf_dir):
    docs = fixture(spark, sf_dir)
    kept = STAGES["line dedup"](spark, docs, sf_dir)
    assert kept.columns == COLUMNS
    seen, want = set(), {}
    for doc, text in sorted(plain(docs).items()):
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - 2):
            run = tuple(lines[i : i + 3])
            if run in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(run)
        want[doc] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    assert plain(kept) == want
    assert all(r.n_chars == len(r.text) for r in kept.collect() if len(r.text) < len(plain(docs)[r.doc_id]))


def test_one_of_each_group_stays(spark, sf_dir):
    docs = fixture(spark, sf_dir)
    kept = STAGES["SimHash near-dedup"](spark, docs, sf_dir)
    assert kept.columns == COLUMNS
    groups = jaccard_components(list(plain(docs).items()))
    assert sorted(plain(kept)) == sorted(set(groups.values()))


def test_contaminated_documents_go(spark, sf_dir):
    docs, items = fixture(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    kept = STAGES["benchmark decontamination"](spark, docs, sf_dir)
    assert kept.columns == COLUMNS

    def shingles(text):
        words = text.lower().encode().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    tests = [shingles(r.text) for r in items.collect()]
    want = {
        i for i, t in plain(docs).items() if not any(5 * len(shingles(t) & q) >= 4 * len(q) for q in tests)
    }
    assert set(plain(kept)) == want and len(want) < docs.count()


def test_whole_run_packs_what_is_left(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    by_sequence = defaultdict(int)
    for r in rows:
        by_sequence[r.sequence_id] += r.length
    assert max(by_sequence.values()) <= 2048
    assert {r.doc_id for r in rows} <= set(plain(fixture(spark, sf_dir)))


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_rows_pass_every_stage(spark, sf_dir, empty):
    docs = awkward(spark)
    docs = docs.where("false") if empty else docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns
        assert kept.count() == 0 if empty else kept.count() > 0
        docs = kept
    assert (corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == 0) == empty


def test_scores_of_the_filter_are_the_operator_s(spark, sf_dir):
    docs = fixture(spark, sf_dir)
    scorer = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = toxicity.toxicity_score(scorer, spark)
    a = {r.doc_id: r.s for r in docs.select("doc_id", score(docs.text).alias("s")).collect()}
    b = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, scorer).collect()}
    assert a == b

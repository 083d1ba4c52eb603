import zlib
from collections import Counter

import numpy as np

from quantpanel.llm import language
from tests.llm.tables import awkward, documents


def test_vectors_bind_rotated_letters_and_bundle_counts():
    makers = language.NgramVectors()
    codes, counts = language.ngram_counts("abc abc")
    grams = Counter()
    letters = {" ": 0, "a": 1, "b": 2, "c": 3}
    text = " abc abc "
    want = np.zeros(language.DIMENSIONS)
    for i in range(len(text) - 2):
        grams[text[i : i + 3]] += 1
        a, b, c = (makers.letters[letters[x]].astype(int) for x in text[i : i + 3])
        want += np.roll(a, 2) * np.roll(b, 1) * c
    assert counts.sum() == sum(grams.values()) and len(codes) == len(grams)
    assert np.array_equal(makers.bundle([(codes, counts)])[0], want)


def test_vectors_beyond_the_kept_ones(monkeypatch):
    grams = [language.ngram_counts("some words"), language.ngram_counts(""), language.ngram_counts("other text here")]
    whole = language.NgramVectors().bundle(grams)
    monkeypatch.setattr(language, "KEPT_NGRAMS", 3)
    monkeypatch.setattr(language, "BLOCK_NGRAMS", 4)
    assert np.array_equal(language.NgramVectors().bundle(grams), whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.held_out_languages(docs).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97


def test_labels_of_held_rows_are_not_used(spark):
    rows = [(i, "alpha beta" if i % 2 else "gamma delta") for i in range(60)]
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in rows]
    truth = ["one" if i % 2 else "two" for i, _ in rows]
    lies = ["zzz" if h else t for t, h in zip(truth, held)]
    got = {r.doc_id: r.lang_pred for r in language.held_out_languages(documents(spark, rows, lies)).collect()}
    assert got == {i: t for (i, _), t in zip(rows, truth)}


def test_awkward_rows(spark):
    got = language.held_out_languages(awkward(spark)).collect()
    assert len(got) == 13 and {r.lang_pred for r in got} == {"und"}  # nothing to learn from
    profiles = language.Profiles(["x"], np.ones((1, language.DIMENSIONS), np.float32))
    by = {r.doc_id: r for r in language.predict_languages(awkward(spark), profiles).collect()}
    assert by[0].lang_pred == by[1].lang_pred == by[2].lang_pred == by[10].lang_pred == "und"
    assert by[3].lang_pred == by[9].lang_pred == "x"
    assert language.held_out_languages(documents(spark, [])).count() == 0
    again = language.Profiles.loads(profiles.dumps())
    assert again.names == ["x"] and np.array_equal(again.vectors, profiles.vectors)


def test_rare_languages_and_heavy_copies_are_learned(spark):
    rng = np.random.default_rng(2)
    word = lambda letters: "".join(rng.choice(list(letters), 5))
    rows = [(" ".join(word("abcdef") for _ in range(20)), "large") for _ in range(600)]
    rows += [("the same text " * 5, "large")] * 400
    rows += [(" ".join(word("uvwxyz") for _ in range(20)), "rare") for _ in range(5)]
    frame = documents(spark, [(i, t) for i, (t, _) in enumerate(rows)], [lang for _, lang in rows])
    profiles = language.fit_profiles(frame)
    assert profiles.names == ["large", "rare"]
    got = language.predict_languages(frame, profiles).collect()
    assert all(r.lang_pred == rows[r.doc_id][1] for r in got)


def test_many_languages_are_counted_in_parts(spark, monkeypatch):
    rows = [(i, f"text{chr(97 + i % 7)} {'xyz'[i % 3]}") for i in range(70)]
    frame = documents(spark, rows, [f"l{i % 7}" for i in range(70)])
    whole = language.fit_profiles(frame)
    monkeypatch.setattr(language, "HELD_LANGUAGES", 2)
    parts = language.fit_profiles(frame)
    assert parts.names == whole.names and np.array_equal(parts.vectors, whole.vectors)

import public_tokenizers
from tokenizers import Tokenizer

from quantpanel.llm.token_counts import cache_of, count_text, merged_length, token_counts
from tests.llm.tables import awkward, documents

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "a", "<|endoftext|> x<|startoftext|>y", "ΑΣ ΣΑΣ", "İ é ́x \x1cq\x85r\xa0s", "don't 45a's !!!\n\n x", "日本語", "<|endof", "x" * 3000, "'S it'LL", "a ́b"]


def test_lowest_rank_first_and_from_the_left():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2}
    assert merged_length(list("abc"), ranks) == 1
    assert merged_length(list("aaa"), {("a", "a"): 0}) == 2
    assert merged_length(["a"], ranks) == 1


def test_counts_are_those_of_the_library(spark, sf_dir):
    tokenizer = Tokenizer.from_file(PATH)
    want = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for text in ODD:
        assert count_text(text, cache_of(PATH)) == want(text), repr(text)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, PATH).collect()}
    assert got == {
        r.doc_id: (len(r.text.encode()), want(r.text), want(r.text) > 2048) for r in docs.collect()
    }


def test_awkward_rows(spark):
    rows = token_counts(awkward(spark), PATH).collect()
    assert len(rows) == 13
    assert {(r.n_bytes, r.n_tokens) for r in rows if r.doc_id in (0, 1)} == {(0, 0)}
    assert token_counts(documents(spark, []), PATH).count() == 0

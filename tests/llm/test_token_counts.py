"""Token counts against the tokenizer library, text by text."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from watchledger.llm import queries, token_counts

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.TOKENIZER)
TEXTS = [
    None, "", " \t\n", "Hello, WORLD! it's 12345", "<|endoftext|>a<|startoftext|> b", "<|ENDOFTEXT|>",
    "x<|endoftext|><|endoftext|>y", "don't we'll I'M", "\x1c\x1d\x85\xa0a​b", "ſK İIı Σσς",
    "é é", "日本語 テスト", "😀 hi", "Привет, мир", "word " * 3000, "x" * 5000, " a　b",
]


def library(text):
    return len(token_counts.tokenizer(PATH).encode(text or "", add_special_tokens=False).ids)


def test_counts_match_the_library(documents):
    docs = documents(TEXTS)
    rows = token_counts.token_counts(docs.union(docs), PATH).collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        text = TEXTS[r.doc_id]
        assert (r.n_bytes, r.n_tokens) == (len((text or "").encode()), library(text)), text


def test_query_matches_the_library(spark):
    texts = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.QUERIES["op2_token_counts"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r.doc_id])
        assert (r.n_tokens, r.over_limit) == (n, n > 2048)


@pytest.mark.parametrize("first, last", token_counts._PLAIN)
def test_every_plain_character_is_cut_like_the_library(first, last):
    texts = [f"a{c}b 1{c}2 {c} {c}'s !{c}? A{c}{c}É{c}" for c in map(chr, range(first, last))]
    assert token_counts.count_tokens(texts, PATH, {}) == token_counts.lengths(texts, PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text_counts_like_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert token_counts.count_tokens([text], PATH, {}) == [library(text)]


def test_table_and_cache_change_nothing(monkeypatch):
    texts = ["the cat sat on the mat " * 5, "zyxqqv wvutsq the zyxqqv"]
    want = token_counts.lengths(texts, PATH)
    monkeypatch.setattr(token_counts, "CACHE_ROWS", 1)
    assert token_counts.count_tokens(texts, PATH, {}) == want
    assert token_counts.count_tokens(texts, PATH, {"the": 1}) == want
    assert token_counts.count_tokens(texts[::-1], PATH, {}) == want[::-1]


def test_frequent_lengths_are_the_most_frequent(documents, monkeypatch):
    monkeypatch.setattr(token_counts, "TABLE_ROWS", 2)
    found = token_counts.frequent_lengths(documents(["a a a bbb bbb zyxqqv", None, "a bbb"]), PATH)
    assert found == {"a": 1, "bbb": token_counts.lengths(["bbb"], PATH)[0]}


def test_empty_table_and_clashing_columns(documents):
    docs = documents(["a b"])
    assert token_counts.token_counts(docs.limit(0), PATH).collect() == []
    odd = docs.withColumn("_text", F.lit(1)).withColumn("n_tokens", F.lit(2))
    got = token_counts.token_counts(odd, PATH).collect()
    assert [tuple(r) for r in got] == [(0, 3, 2)]


def test_only_stretches_with_other_characters_go_to_the_library(monkeypatch):
    """The rest of their text is cut as usual, and what was seen is not encoded again."""
    text = "Plain words around 😀 and ΑΒΓ。δ <|endoftext|> more, plain!"
    special, found = token_counts.pretokens(text, PATH)
    assert special == 1 and {"😀", "ΑΒΓ。δ"} <= set(found)
    assert {"plain", "words", "more", "!"} <= set(found)
    token_counts._cache.clear()
    assert token_counts.count_tokens([text], PATH, {}) == [library(text)]
    asked = []
    monkeypatch.setattr(token_counts, "lengths", lambda texts, path: asked.extend(texts) or [0] * len(texts))
    assert token_counts.count_tokens([text, text], PATH, {}) == [library(text)] * 2 and asked == []

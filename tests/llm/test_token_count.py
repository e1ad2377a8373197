import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer as Library

from caselabel.llm import token_count as tc

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    loaded = Library.from_file(PATH)
    return lambda texts: [len(e.ids) for e in loaded.encode_batch(texts, add_special_tokens=False)]


ODD = [
    "", " ", "'", "''", "it's", "'s", "'re", "'r", "'rex", "'ve'll", "a'b", "!'s", "'!'s", "don't you'll we've I'm he'd they're", "1234 5",
    "a1b2", "É é é İstanbul ΣΑΣ Σ ß ẞ", "x<|endoftext|>y <|startoftext|>", "<|endoftext|><|endoftext|>", "<|END", "日本語テキスト 한국어",
    "👍🏽👨‍👩‍👧 a b c​d\x85e\x1cf\x00g", "a" * 300, "don''t 'L'L 'l 'll 'LLo", "ͅǅ ①²½ Ⅷ", "'v'e 'e 'l'l r've'",
]


def test_odd_texts(library):
    assert tc.Tokenizer(PATH).counts(ODD).tolist() == library(ODD)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aeinrstlmdv'  .!,0123éŁß\n\tÀxyz<|>endoft"), max_size=120), min_size=1, max_size=5))
def test_any_text(texts):
    library = Library.from_file(PATH)
    assert tc.compiled(PATH).counts(texts).tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_scan_equals_a_run_from_the_start():
    follow, _ = tc.splitter()
    rnd = random.Random(1)
    for n in (1, 5, 63, 64, 65, 500, 1000):
        kinds = tc.np.array([rnd.randrange(tc.CLASSES) for _ in range(n)], tc.np.uint8)
        state, want = tc.START, []
        for k in kinds:
            want.append(state)
            state = follow[k, state]
        assert tc.scan_states(kinds).tolist() == want


def test_small_tables_give_the_same(library, monkeypatch):
    monkeypatch.setattr(tc, "MAX_STATES", 5)
    monkeypatch.setattr(tc, "MAX_PIECES", 3)
    tokenizer = tc.Tokenizer(PATH)
    for text in ODD:
        assert tokenizer.counts([text]).tolist() == library([text])


def test_given_documents_and_odd_rows(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "word " * 50_000), (-4, "x y"), (-4, "x y"), (None, "one")], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(extra).selectExpr("*", "1 AS n_tokens", "'a' AS n_bytes")
    got = tc.token_counts(both, PATH).collect()
    texts = both.collect()
    assert len(got) == len(texts)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n, n > 2048) for r, n in zip(texts, library([r.text or "" for r in texts]), strict=True))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert tc.token_counts(both.limit(0), PATH).collect() == []


def test_other_kinds_of_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        tc.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))

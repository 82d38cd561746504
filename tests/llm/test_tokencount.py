"""Token counts against the tokenizer library's own unigram model."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from tidemark.llm import queries, tokencount

from .conftest import ODD, SF

M = tokencount.MARK


def library(vocab, unk=0):
    return Tokenizer(Unigram(list(zip(vocab.pieces, vocab.scores)), unk_id=unk,
                             byte_fallback=vocab.byte_fallback))


def marked(text):
    return M + text.replace(" ", M) if text else ""


@pytest.fixture(scope="module")
def vocab():
    return tokencount.load_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))


def test_given_table(spark, sf_rows, vocab):
    lib = library(vocab)
    want = {i: len(lib.encode(marked(t), add_special_tokens=False).ids) for i, t in sf_rows}
    rows = queries.op8_token_counts(spark, SF).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want


def test_odd_rows(odd, empty, vocab):
    lib = library(vocab)
    rows = tokencount.count_tokens(odd, vocab).collect()
    want = sorted((str(i), len(lib.encode(marked(t or ""), add_special_tokens=False).ids))
                  for i, t in ODD)
    assert sorted((str(r["row"]["doc_id"]), r["n_tokens"]) for r in rows) == want
    assert tokencount.count_tokens(empty, vocab).count() == 0


PIECES = ("<unk>", M, "a", "b", "ab", "ba", "aab", M + "a", M + "ab", "bb", M * 2, "abab")


@given(st.text(alphabet="abc é", max_size=14), st.lists(st.integers(-4, 0), min_size=12,
                                                        max_size=12))
@settings(max_examples=300, deadline=None)
def test_ties_follow_the_library(text, scores):
    """Whole-number scores make many ties; c and é are unknown."""
    vocab = tokencount.Vocabulary(PIECES, tuple(map(float, scores)), False, frozenset({"<unk>"}))
    want = len(library(vocab).encode(marked(text), add_special_tokens=False).ids)
    table = tokencount.counter(vocab)()
    assert list(table([text])[0]) == [want]


def test_pieces_across_words_are_refused():
    bad = tokencount.Vocabulary(("a" + M + "b",), (0.0,), False)
    with pytest.raises(ValueError):
        tokencount.counter(bad)

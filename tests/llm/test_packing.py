"""Packing: ids, pieces and places."""

import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, queries

from .conftest import ODD, SF

ARGS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(ARGS[0])


def check_pieces(rows, texts, tokenizer, size):
    """Every id in exactly one piece, sequences gapless and within the size."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = array("I", ids[at:at + r["length"]])
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in by_seq.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return by_seq


def test_given_table(spark, sf_rows, tokenizer):
    rows = queries.op6_packing(spark, SF).collect()
    seqs = check_pieces(rows, dict(sf_rows), tokenizer, 2048)
    used = sum(r["length"] for r in rows)
    assert used / (2048 * len(seqs)) > 0.98


def test_odd_rows(odd, empty, tokenizer):
    rows = [r for r in packing.pack(odd, *ARGS, size=64).collect()]
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    assert sum(r["length"] for r in rows) == total
    places = Counter()
    for r in rows:
        for k in range(r["offset"], r["offset"] + r["length"]):
            places[(r["sequence_id"], k)] += 1
    assert max(places.values()) == 1 and max(k for _, k in places) < 64
    assert packing.pack(empty, *ARGS).count() == 0


def test_ids_column(make_docs, tokenizer):
    text = "Some words, 12 numbers.\nAnd a line."
    rows = packing.pack(make_docs([(1, text)]), *ARGS, size=4, with_ids=True) \
        .orderBy("start").collect()
    assert [i for r in rows for i in r["ids"]] == tokenizer.encode(text).ids + [1]


def test_encoder_equals_tokenizer(tokenizer):
    enc = packing.Encoder(*ARGS)
    for text in ["", "a", " a", "a  b", "a\n\nb", "x\n y", "\t q", "it's we'll's", " a", "é 漢字 😀",
                 "a<|endoftext|>b", "a\r\nb", "  ", "\n", "1 2,3 !!", "a's 's"]:
        want = array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        assert enc.encode(text) == want, text


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
@settings(max_examples=60, deadline=None)
def test_plan_places_every_piece_once(histogram):
    plan = packing.shortest_pack_first(histogram, 64)
    fill = defaultdict(list)
    ranks = defaultdict(list)
    for p in plan:
        ranks[p.length] += range(p.lo, p.hi)
        for k in range(p.hi - p.lo):
            fill[p.seq + k // p.per].append((p.offset + k % p.per * p.length, p.length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in
                                                        histogram.items()}
    for parts in fill.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    if fill:  # sequence numbers have no gap
        assert sorted(fill) == list(range(len(fill)))


def test_hot_length_is_ranked_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    df = spark.range(1000).selectExpr("id AS doc_id", "0L AS start",
                                      "CASE WHEN id % 10 = 0 THEN 7L ELSE 1L END AS length")
    rows = packing.place_pieces(spark, df, ["doc_id", "start"], 10).collect()
    assert len(rows) == 1000
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 1000
    assert len({r["sequence_id"] for r in rows}) == -(-(900 + 700) // 10)


def test_very_long_blank_runs(tokenizer):
    enc = packing.Encoder(*ARGS)
    for text in ["\n" * 1_100_000, "w" + " " * 1_100_000 + "a", "\u3000" * 1_100_000]:
        want = array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        assert enc.encode(text) == want
    assert packing.long_blank("a" + " " * 100_000) and not packing.long_blank(" " * 99_999)
    assert not packing.long_blank("a " * 200_000)

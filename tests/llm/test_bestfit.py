"""Best-fit packing: ids, pieces, places, and the plan against placing one by one."""

import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bestfit, queries

from .conftest import ODD, SF

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def one_by_one(histogram, size):
    """Rooms of the sequences after best-fit decreasing, piece by piece."""
    rooms = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            at = bisect_left(rooms, length)
            room = rooms.pop(at) if at < len(rooms) else size
            insort(rooms, room - length)
    return rooms


def check(rows, texts, tokenizer, size):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        parts = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(-(-len(ids) // size)))
        for k, r in enumerate(parts):
            part = ids[size * k:size * (k + 1)]
            assert (r["start"], r["length"]) == (size * k, len(part))
            assert r["ids_crc32"] == zlib.crc32(array("I", part).tobytes())
    for parts in by_seq.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return by_seq


def test_given_table(spark, sf_rows, tokenizer):
    rows = queries.op12_best_fit_packing(spark, SF).collect()
    seqs = check(rows, dict(sf_rows), tokenizer, 4096)
    histogram = Counter(r["length"] for r in rows)
    assert len(seqs) == len(one_by_one(histogram, 4096))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 70).flatmap(lambda size: st.tuples(st.just(size), st.dictionaries(
    st.integers(1, size), st.integers(1, 30), max_size=25))))
def test_plan_is_best_fit_decreasing(case):
    size, histogram = case
    plan = bestfit.best_fit_decreasing(histogram, size)
    used, ranks = defaultdict(list), Counter()
    for p in plan:
        assert p.lo == ranks[p.length]
        ranks[p.length] = p.hi
        for k in range(p.hi - p.lo):
            used[p.seq + k // p.per].append((p.offset + k % p.per * p.length, p.length))
    assert ranks == Counter(histogram)
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    rooms = sorted(size - sum(n for _, n in parts) for parts in used.values())
    assert rooms == one_by_one(histogram, size)


def test_segment_tree():
    bins = bestfit.OpenBins(20)
    assert bins.tightest(1) is None
    for room in (3, 9, 9, 20):
        bins.push(room, 0, 1)
    assert [bins.tightest(k) for k in (1, 3, 4, 9, 10, 20)] == [3, 3, 9, 9, 20, 20]
    bins.pop(9)
    assert bins.tightest(4) == 9
    bins.pop(9)
    assert bins.tightest(4) == 20
    bins.pop(20)
    assert bins.tightest(4) is None and bins.tightest(3) == 3


def test_plan_is_bounded_by_the_size_alone():
    histogram = {n: 10 ** 12 // n for n in range(1, 4097)}
    plan = bestfit.best_fit_decreasing(histogram)
    assert len(plan) <= 4 * 4096 * 91
    assert sum(p.hi - p.lo for p in plan) == sum(histogram.values())


def test_odd_rows(odd, empty, tokenizer):
    rows = bestfit.pack(odd, FILE, size=64).collect()
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    places = Counter()
    for r in rows:
        for k in range(r["offset"], r["offset"] + r["length"]):
            places[(r["sequence_id"], k)] += 1
    assert sum(places.values()) == total and max(places.values()) == 1
    assert max(k for _, k in places) < 64
    assert bestfit.pack(empty, FILE).count() == 0


def test_ids_column_and_repeated_rows(make_docs, tokenizer):
    text = "Some words, 12 numbers.\nIt's A line."
    rows = bestfit.pack(make_docs([(3, text)] * 5), FILE, size=6, with_ids=True).collect()
    ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
    for k in range(0, len(ids), 6):
        assert [r["ids"] for r in rows if r["start"] == k] == [ids[k:k + 6]] * 5


TEXTS = ["İstanbul ΟΔΟΣ ΣΑΣ ﬁ é x́", "a b c　d\u0085e\x1cf", " ́x ̸= y",
         "<|endoftext|> x<|startoftext|>y", "it's 'tis 's 'S don'T we'LL 1234 ½ ²", "가각 각",
         "😀😀 👩‍👩‍👧 \x00 \x7f", "word​word ﻿bom", "q" * 5000, "\t\n\x0b\x0c\r "]


@pytest.mark.parametrize("text", TEXTS)
def test_parts_give_the_tokenizers_ids(tokenizer, text):
    got = bestfit.PartEncoder(FILE).encode(text)
    assert list(array("I", got)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_plain_sign(tokenizer):
    encoder = bestfit.PartEncoder(FILE)
    signs = [chr(c) for c in range(0x180)]
    for c in signs:
        for text in (c, f"a{c}", f"{c}b", f"7{c}{c}'s", f"x{c}\u0301y"):
            assert list(array("I", encoder.encode(text))) == \
                tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(st.characters(max_codepoint=0x17f), max_size=60)))
def test_random_texts(tokenizer, text):
    encoder = bestfit.PartEncoder(FILE, limit=1)
    for _ in range(2):
        assert list(array("I", encoder.encode(text))) == \
            tokenizer.encode(text, add_special_tokens=False).ids

"""Importance resampling against a plain version of the whole rule."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, resample

from .conftest import ODD, SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return words, [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]


def bucket(feature, k=10_000):
    return zlib.crc32(feature.encode()) % k


def plain(rows, target, percent=25, least=20):
    corpus, goal = Counter(), Counter()
    for _, t in rows:
        corpus.update(map(bucket, features(t)[1]))
    for t in target:
        goal.update(map(bucket, features(t)[1]))
    s_all, t_all = sum(corpus.values()) + 10_000, sum(goal.values()) + 10_000
    gain = {b: math.floor(1000 * math.log((goal[b] + 1) * s_all / ((corpus[b] + 1) * t_all)))
            for b in range(10_000)}
    out = []
    for i, t in rows:
        words, fs = features(t)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None, len(words)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return sorted(tuple(r[:5]) for r in out)


def test_given_table(spark, sf_rows):
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op11_importance_resampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(sf_rows, target)


def rows_of(out):
    return [(r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"])
            for r in out.select("row.doc_id", "n_words", "n_features", "weight", "score",
                                "rank").collect()]


def test_odd_rows(odd, empty, make_docs):
    out = resample.resample(odd, make_docs([(1, "filler word1 one")]))
    assert out.select("row.*").columns == odd.columns
    got = rows_of(out)
    assert len(got) == len(ODD)
    by_id = {r[0]: r for r in got}
    for i in (1, 2, 3, 9):
        assert by_id[i][1:4] == (0, 0, 0) and by_id[i][5] is None
    assert by_id[4][1] == 60_000 and by_id[4][2] == 119_999
    assert resample.resample(empty, odd).count() == 0
    assert len(rows_of(resample.resample(odd, empty))) == len(ODD)


def test_ties_repeated_rows_and_null_ids(make_docs):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(i % 4, text) for i in range(40)] + [(None, text)] * 8
    out = rows_of(resample.resample(make_docs(rows), make_docs([(1, "w1 w2")])))
    ranks = sorted(r[5] for r in out if r[5])
    assert ranks == list(range(1, 13))
    drawn = sorted((r for r in out if r[5]), key=lambda r: r[5])
    assert [r[4] for r in drawn] == sorted((r[4] for r in out), reverse=True)[:12]


def test_all_scores_equal_rank_by_id(spark):
    rows = [(i, 30, 59, 5, 77) for i in range(1000)]
    scored = spark.createDataFrame(rows, "id long, n_words long, n_features long, weight long, "
                                   "score long").selectExpr("struct(id as doc_id) as row", "n_words",
                                                            "n_features", "weight", "score")
    got = {r["row"]["doc_id"]: r["rank"] for r in resample.ranked(spark, scored).collect()}
    assert got == {i: i + 1 if i < 250 else None for i in range(1000)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abAB 09.é漢\x00\n", max_size=40), max_size=6), st.booleans())
def test_head_and_tail_give_the_same_buckets(texts, with_head):
    words = sorted({w for t in texts for w in resample.words_of(t)})
    half = tuple(words[::2])
    head = resample.Head(half, tuple((i, j) for i in range(len(half)) for j in range(len(half)))
                         if with_head else ())
    lens, uni, pairs = resample.Buckets(head, 10_000)(texts)
    want = [features(t) for t in texts]
    assert lens.tolist() == [len(w) for w, _ in want]
    assert uni.tolist() == [bucket(w) for ws, _ in want for w in ws]
    assert pairs.tolist() == [bucket(f) for ws, fs in want for f in fs[len(ws):]]


def test_head_holds_the_frequent_features(documents, sf_rows):
    head = resample.find_head(documents)
    counts = Counter(w for _, t in sf_rows for w in features(t)[0])
    top = [w.encode() for w, _ in counts.most_common(50)]
    assert set(top) <= set(head.words) and len(head.words) <= resample.HEAD
    assert head.pairs and max(map(max, head.pairs)) < len(head.words)


def test_gains_floor():
    got = resample.gains(np.array([3, 0]), np.array([0, 2]))
    assert got.tolist() == [math.floor(1000 * math.log(1 * 5 / (4 * 4))),
                            math.floor(1000 * math.log(3 * 5 / (1 * 4)))]

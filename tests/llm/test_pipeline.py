"""The corpus pipeline: stages on the given table, edge cases."""

import corpus_pipeline
import pytest

from tidemark.llm import decontam
from tidemark.llm.textmap import stored

from .conftest import SF
from .test_neardup import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, documents):
    """The input and the result of every stage."""
    out = [documents]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(spark, stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stage_columns(steps):
    assert all(df.columns == COLUMNS for df in steps[:-1])
    assert steps[1].schema == steps[4].schema


def test_quality_stage_keeps_good_documents(spark, steps, labels):
    kept = rows(steps[1])
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = [i for i, q in truth.items() if q == 1]
    bad = [i for i, q in truth.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_line_stage(steps):
    before, after = rows(steps[1]), rows(steps[2])
    assert before.keys() == after.keys()
    firsts = {}
    for i in sorted(before):
        for line in set(before[i]["text"].split("\n")):
            if line.count(" ") >= 5:
                firsts.setdefault(line, i)
        left = after[i]["text"].split("\n")
        assert all(firsts.get(x, i) == i for x in left if x.count(" ") >= 5)
        assert after[i]["n_chars"] == len(after[i]["text"])


def by_either_text(now, old):
    """Ids that stay, by brute force over the texts now and before."""
    both = sorted({(i, t) for i, t in [*now.items(), *((i, old[i]) for i in now if i in old)]})
    up = {i: i for i in now}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, _), (_, c) in zip(both, brute(both, 5)):
        a, b = sorted((find(i), find(c)))
        up[b] = a
    words = lambda t: len((t or "").encode().split())
    groups = {}
    for i in sorted(now):
        if words(now[i]):
            groups.setdefault(find(i), i)
    return set(groups.values()) | {i for i in now if not words(now[i]) and not words(old.get(i))}


def test_near_stage(steps, sf_rows):
    now = {i: r["text"] for i, r in rows(steps[2]).items()}
    kept = set(rows(steps[3]))
    assert kept == by_either_text(now, dict(sf_rows))
    # what the stage removes by its own input alone goes in any case
    alone = {i for (i, _), (_, c) in zip(now.items(), brute(list(now.items()), 5)) if c == i}
    assert kept <= alone
    # the groups that stood there before the line stage are reduced to one document
    first = {i: r["text"] for i, r in rows(steps[1]).items()}
    groups = {}
    for (i, _), (_, c) in zip(first.items(), brute(list(first.items()), 5)):
        groups.setdefault(c, set()).add(i)
    assert sum(len(g & kept) > 1 for g in groups.values()) == 0
    assert sum(len(g) > 1 for g in groups.values()) > 3


def test_near_stage_finds_copies_that_the_line_stage_took_apart(spark, make_docs):
    from tidemark.llm import linededup, neardup

    def line(k):
        return " ".join(f"w{'abcdefghij'[(k * 7 + j * j) % 10]}{'qrstuvwxyz'[(k + j) % 10]}{k % 9 * 'e'}"
                        for j in range(12))

    text = [line(k) for k in range(30)]
    near = [*text[:28], "an ending of its own that stands here only once", text[29]]
    old = make_docs([(1, "\n".join(text)), (2, "\n".join(near)), (3, "\n".join(text)),
                     (4, "a clean text that has nothing to do with any other one"), (5, ""),
                     (6, "\n".join(text[:6]))])
    now = linededup.drop_lines(old)
    texts = {r["doc_id"]: r["text"] for r in now.collect()}
    assert texts[3] == texts[6] == "" and "ending of its own" in texts[2]
    got = neardup.drop_duplicates(now, before=old.select("doc_id", "text"))
    assert got.columns == now.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 4, 5]


def test_leak_stage(spark, steps):
    items = [" ".join(decontam.tokens(r["text"]))
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = rows(steps[3]), rows(steps[4])
    leaks = {i for i, r in before.items()
             if any(f" {x} " in f" {' '.join(decontam.tokens(r['text']))} " for x in items)}
    assert set(after) == set(before) - leaks


def test_packing_stage(steps):
    kept, pieces = rows(steps[4]), steps[5].collect()
    assert {r["doc_id"] for r in pieces} == set(kept)


def test_run(spark, steps):
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*key).collect())) == \
        sorted(map(tuple, steps[5].select(*key).collect()))


def test_empty_and_odd_tables(spark, empty, odd):
    for df in (empty, odd):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF)
            assert out.columns == df.columns
            assert out.count() <= df.count()
            if name == "line_dedup":
                assert out.count() == df.count()

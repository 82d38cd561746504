"""Decontamination: tiling against a plain version, planted leaks."""

import random

import numpy as np

from tidemark.llm import decontam, queries

from .conftest import SF


def plain_tiles(doc, item, least):
    """Greedy string tiling by the book: the longest unmarked common run, the
    earliest in the item, then in the document."""
    used_d, used_i, tiles = set(), set(), []
    least = min(least, len(item))
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] \
                        and i + n not in used_i and j + n not in used_d:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least or not n:
            return tiles
        used_i |= set(range(i, i + n))
        used_d |= set(range(j, j + n))
        tiles.append((j, i, n))


def test_tiles_equal_the_plain_version():
    rng = random.Random(3)
    for _ in range(200):
        item = [rng.randrange(8) for _ in range(rng.randrange(1, 16))]
        doc = [rng.choice([-1, *range(8)]) for _ in range(rng.randrange(0, 50))]
        for least in (1, 3, 4):
            want = plain_tiles(doc, item, least)
            a, b = np.array(doc, np.int64), np.array(item, np.int64)
            assert decontam.tile(a, b, least) == want
            long = decontam.tile_long(a, b, decontam.Params(min_match=least))
            assert sorted(long) == sorted(want) or \
                sum(n for _, _, n in long) == sum(n for _, _, n in want)


def item_text(rng, n):
    return [f"b{rng.randrange(10 ** 6)}" for _ in range(n)]


def test_planted_leaks(spark, make_docs):
    rng = random.Random(9)
    items = {k: item_text(rng, 40) for k in range(6)}
    noise = lambda n: [f"n{rng.randrange(10 ** 6)}" for _ in range(n)]
    upper = " ".join(items[1]).upper().replace(" ", ", ")
    parts = [items[2][k:k + 8] for k in range(0, 40, 8)][::-1]
    mixed = " ".join(w for p in parts for w in p + noise(5))
    rows = [(1, " ".join(noise(500) + items[0] + noise(300))), (2, upper), (3, mixed),
            (4, " ".join(items[3][:12])), (5, " ".join(noise(100))), (6, None), (7, ""),
            (8, " ".join(items[4] + items[5])), (8, " ".join(items[4] + items[5])),
            (9, " ".join(noise(30_000) + items[0]))]
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()]
                                  + [(90, None), (91, ""), (92, "!!"), (93, "tiny item")],
                                  "item_id long, text string")
    docs = make_docs(rows)
    for p in (decontam.Params(), decontam.Params(block_tokens=100)):
        got = decontam.matches(docs, bench, p).collect()
        assert sorted((r["row"]["doc_id"], r["item_id"]) for r in got) == \
            [(1, 0), (2, 1), (3, 2), (8, 4), (8, 4), (8, 5), (8, 5), (9, 0)]
        by = {(r["row"]["doc_id"], r["item_id"]): r for r in got}
        assert by[(3, 2)]["n_tiles"] == 5 and by[(3, 2)]["n_covered"] == 40
        assert by[(1, 0)]["longest"] == 40 and by[(1, 0)]["coverage"] == 1.0
        clean = decontam.without_leaks(spark, docs, bench, p)
        assert clean.columns == docs.columns
        assert sorted(r["doc_id"] for r in clean.collect()) == [4, 5, 6, 7]


def test_short_items_and_empty_tables(spark, make_docs, empty, odd):
    bench = spark.createDataFrame([(1, "tiny item")], "item_id long, text string")
    docs = make_docs([(1, "a Tiny item here"), (2, "tiny other item")])
    assert [r["row"]["doc_id"] for r in decontam.matches(docs, bench).collect()] == [1]
    assert decontam.matches(empty, bench).count() == 0
    assert decontam.matches(odd, bench.where("false")).count() == 0
    assert decontam.without_leaks(spark, odd, bench).count() == odd.count()


def test_given_table(spark, sf_rows):
    """Documents that hold a whole item are found, and no others."""
    items = {r["item_id"]: " ".join(decontam.tokens(r["text"]))
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = {(i, k) for i, t in sf_rows for k, x in items.items()
            if f" {x} " in f" {' '.join(decontam.tokens(t))} "}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(spark, SF).collect()}
    assert want and got == want


def test_many_tiles_of_repeated_tokens_equal_the_plain_version():
    rng = random.Random(5)
    for _ in range(60):
        item = [rng.randrange(2) for _ in range(rng.randrange(1, 30))]
        doc = [rng.choice([-1, 0, 0, 1]) for _ in range(rng.randrange(0, 70))]
        for least in (1, 2, 4):
            assert decontam.tile(np.array(doc, np.int64), np.array(item, np.int64), least) == \
                plain_tiles(doc, item, least)


def test_a_million_equal_tokens():
    """One token over and over: seconds, not the product of the places."""
    p = decontam.Params()
    doc = np.zeros(1_000_000, np.int64)
    assert decontam.tile_long(doc, np.zeros(40, np.int64), p) == [(0, 0, 40)]
    doc[::11] = -1  # stretches of ten
    tiles = decontam.tile_long(doc, np.zeros(40, np.int64), p)
    assert [n for _, _, n in tiles] == [10] * 4
    assert [(j, i) for j, i, _ in tiles] == [(1, 0), (12, 10), (23, 20), (34, 30)]


def test_reach_never_leaves_out_a_leak():
    rng = random.Random(8)
    p = decontam.Params()
    for _ in range(300):
        item = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 20))], np.int64)
        doc = np.array([rng.choice([-1, *range(6)]) for _ in range(rng.randrange(0, 40))], np.int64)
        covered = sum(n for _, _, n in decontam.tile(doc, item, p.min_match))
        if covered >= p.coverage * len(item):
            assert decontam.within_reach(doc, item, p)


def test_repeated_token_documents(spark, make_docs):
    bench = spark.createDataFrame([(1, "ha " * 40), (2, "ha " * 30 + "ho " * 30)],
                                  "item_id long, text string")
    docs = make_docs([(1, "ha " * 200_000), (2, "ha ho " * 100_000), (3, "ho " * 35)])
    got = {(r["row"]["doc_id"], r["item_id"], r["n_covered"])
           for r in decontam.matches(docs, bench).collect()}
    assert got == {(1, 1, 40), (1, 2, 30), (3, 2, 30)}

"""Near-dedup against brute force over all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import neardup, queries

from .conftest import ODD, SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(low)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w \
        else frozenset()


def brute(rows, k, percent=80):
    """(n_shingles, component_id) of every row, in order."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in where[g] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None and (least.get(r) is None or doc < least[r]):
            least[r] = doc
    return [(len(s), least.get(find(i))) for i, s in enumerate(sets)]


def check(df, rows, k):
    want = brute(rows, k)
    got = neardup.near_duplicates(df, neardup.Params(words=k)).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                            for r in got))) == \
        sorted(map(str, ((i, n, c, i == c) for (i, _), (n, c) in zip(rows, want))))


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"edit{rng.random():.9f}"
    return " ".join(w)


def test_given_table(spark, sf_rows):
    want = {i: c for (i, _), c in zip(sf_rows, brute(sf_rows, 4))}
    rows = queries.op5_near_duplicates(spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_odd_rows(odd, empty):
    check(odd, ODD, 5)
    assert neardup.near_duplicates(empty).count() == 0
    assert neardup.drop_duplicates(empty).count() == 0


def test_groups_chains_and_thresholds(make_docs):
    rng = random.Random(5)
    rows, n = [], 0

    def add(text):
        nonlocal n
        n += 1
        rows.append((n, text))

    for _ in range(12):  # near copies around the threshold
        base = [f"w{rng.random():.9f}" for _ in range(rng.choice([8, 30, 120]))]
        for edits in (0, 0, 1, 2, 3, 4):
            add(edited(rng, base, edits))
    chain = [f"c{i}" for i in range(60)]
    for step in range(8):  # neighbours are linked, ends are not
        add(" ".join(chain[step * 4:] + [f"t{step}x{i}" for i in range(step * 4)]))
    common = " ".join(f"p{i}" for i in range(60))
    for _ in range(30):  # a shared passage that links nothing
        add(common + " " + " ".join(f"q{rng.random():.9f}" for _ in range(60)))
    hub = [f"h{i}" for i in range(100)]
    for _ in range(60):  # a large group of near copies
        add(edited(rng, hub, 2))
    rng.shuffle(rows)
    check(make_docs(rows), rows, 5)
    check(make_docs(rows), rows, 4)


def sections(k, common=300, each=50):
    """Texts of common words and two of ``k`` sections each: nothing is linked, and
    every element is shared."""
    top = " ".join(f"m{i}" for i in range(common))
    part = [" ".join(f"s{j}x{i}" for i in range(each)) for j in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i)]
    return [(n, f"{top} {part[i]} {part[j]}") for n, (i, j) in enumerate(pairs)]


@pytest.fixture
def verified(monkeypatch):
    """Numbers of pairs that were verified on full sets."""
    made, links = [], neardup._links

    def counted(pairs, sets, p):
        made.append(pairs.count())
        return links(pairs, sets, p)

    monkeypatch.setattr(neardup, "_links", counted)
    return made


@pytest.mark.parametrize("k", [20, 60])
def test_texts_of_common_sections_make_few_pairs(make_docs, verified, k):
    rows = sections(k)
    got = neardup.near_duplicates(make_docs(rows)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(i, i) for i, _ in rows}
    assert sum(verified) < 5 * len(rows)


def test_links_among_texts_of_common_sections(make_docs):
    rng = random.Random(11)
    rows = sections(14, 200, 40)  # with near copies of some, which must still be found
    rows += [(1000 + i, edited(rng, t.split(), rng.randrange(1, 8))) for i, t in rows[::3]]
    rows += [(2000 + i, " ".join(t.split()[:-e])) for e, (i, t) in enumerate(rows[:30], 1)]
    check(make_docs(rows), rows, 5)
    rows = sections(12, 400, 40)  # all are linked
    check(make_docs(rows), rows, 5)


def test_parities_bound_the_difference():
    rng = np.random.default_rng(3)
    for n, d in ((50, 3), (3000, 40), (3000, 900)):
        both = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        more = rng.integers(0, 2 ** 63, d).astype(np.uint64)
        x, y = neardup.parities(np.r_[both, both, more], np.array([n, n + d]))
        differ = np.unpackbits((x ^ y).view(np.uint8)).sum()
        assert differ <= d and (d > 40 or differ >= d - 6)


def test_one_of_each_group_stays(make_docs):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(3, base), (2, base.upper()), (2, base.upper()), (9, base + " end"), (5, "other text"),
            (6, ""), (6, ""), (7, None)]
    kept = neardup.drop_duplicates(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted((r["doc_id"], r["class"]) for r in kept.collect()) == \
        [(2, "c"), (5, "c"), (6, "c"), (6, "c"), (7, "c")]


@pytest.mark.parametrize("share", [0.5, 0.8, 0.95])
def test_sketches_estimate_similarity(share):
    rng = np.random.default_rng(7)
    t, got = 252, []
    for n in (10, 100, 1000):
        both = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        m = int(n * (1 - share) / (1 + share))
        a = np.r_[both[m:], rng.integers(0, 2 ** 63, m).astype(np.uint64)]
        s = neardup.sketch(np.r_[both, a], np.array([n, n]), t)
        assert (s != np.uint64(2 ** 64 - 1)).all()  # every coordinate is filled
        true = (n - m) / (n + m)
        got.append(abs((s[0] == s[1]).mean() - true))
    assert max(got) < 0.15


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (7, 3), (20, 21), (21, 22), (22, 23), (23, 24), (24, 25)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in neardup.components(spark, df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 10: 10, 11: 10, **{i: 20 for i in range(20, 26)}}
    assert neardup.components(spark, df.where("false")).count() == 0

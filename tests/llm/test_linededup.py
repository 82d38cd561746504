"""Line dedup: planted passages, templates with variable fields, edge cases, and
plain Python over the given table."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import xxhash

from tidemark.llm import linededup, queries

from .conftest import ODD, SF

PASSAGE = " ".join(f"passage{i}" for i in range(55))


def clean(df, p=linededup.Params()):
    out = linededup.drop_lines(df, p, removed="gone")
    return {r["doc_id"]: (r["text"], r["gone"]) for r in out.collect()}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def agreement(a, b):
    return sum(x == y and x != "<*>" for x, y in zip(a, b))


def common(lines, share):
    out = []
    for column in zip(*lines):
        n, token = max((k, t) for t, k in Counter(column).items())
        out.append(token if n > share * len(lines) else None)
    return out


def templates_of(leaf, p):
    """Clusters (sets of keys) of one leaf's ``{key: tokens}``, round by round."""
    groups, found = [(leaf, p.depth, 0)], []
    while groups:
        lines, depth, dry = groups.pop()
        if len(lines) < 2:
            continue
        mid = common(list(lines.values()), 0.0)
        _, _, seed = max((agreement(t, mid), k, t) for k, t in lines.items())
        enough = p.min_fixed * len(seed)
        near = [t for t in lines.values() if agreement(t, seed) >= enough]
        fixed = common(near, p.fixed_share) if near else [None] * len(seed)
        fits = {k for k, t in lines.items() if agreement(t, fixed) >= enough}
        if fits:
            found.append(fits)
        rest = {k: t for k, t in lines.items() if k not in fits}
        dry = 0 if len(fits) > 1 else dry + 1 if fits else p.leaf_rounds
        if dry >= (p.leaf_rounds if depth == p.depth else 1):
            parts = defaultdict(dict)
            for k, t in rest.items():
                parts[tuple(t[:2 * depth])][k] = t
            groups += [(x, 2 * depth, 0) for x in parts.values()]
        else:
            groups.append((rest, depth, dry))
    return found


def brute(rows, p=linededup.Params()):
    """Places ``(doc_id, text, pos)`` of the lines to drop, in plain Python."""
    docs, first, at = defaultdict(set), {}, defaultdict(set)
    for doc_id, text in rows:
        if doc_id is None or text is None:
            continue
        for pos, line in enumerate(text.split("\n")):
            if not re.search(r"[^ \t\n\x0b\f\r]", line):
                continue
            parts = line.count(" ") + 1
            form = re.sub("[^ ]*[0-9][^ ]*", "<*>", line)
            if form.count("<*>") > parts * (1 - p.min_fixed):
                form = line
            docs[form].add(doc_id)
            at[form].add((doc_id, text, pos))
    first = {f: min(d) for f, d in docs.items()}
    drop = {}
    for f, d in docs.items():
        n = f.count(" ") + 1
        if len(d) >= (p.min_docs if n >= p.min_tokens else (p.min_tokens - n) * p.short_docs):
            drop[f] = first[f]
    leaves = defaultdict(dict)
    for f in docs:
        tokens = f.split(" ")
        if len(tokens) >= p.min_tokens:
            key = signed(xxhash.xxh64(f.encode(), seed=42).intdigest())
            leaves[(len(tokens), *tokens[:p.depth])][key] = tokens
    for leaf in leaves.values():
        for keys in templates_of(leaf, p):
            forms = [" ".join(leaf[k]) for k in keys]
            firsts = [first[f] for f in forms]
            if len(keys) > 1 and (len(set(firsts)) > 1 or max(len(docs[f]) for f in forms)
                                  >= p.min_docs):
                for f in forms:
                    drop[f] = min(drop.get(f, min(firsts)), min(firsts))
    return {x for f, d in drop.items() for x in at[f] if x[0] != d}


def kept_text(doc_id, text, gone):
    if text is None:
        return None, 0
    lines = text.split("\n")
    keep = [x for k, x in enumerate(lines) if (doc_id, text, k) not in gone]
    return "\n".join(keep), len(lines) - len(keep)


def test_given_table_against_brute_force(spark, sf_rows):
    gone = brute(sf_rows)
    assert len(gone) > 100
    want = {i: kept_text(i, t, gone) for i, t in sf_rows}
    got = queries.op10_line_dedup(spark, SF).collect()
    assert {r["doc_id"]: (r["n_dropped"], r["n_chars"], r["text_md5"]) for r in got} == {
        i: (n, None if t is None else len(t), t and hashlib.md5(t.encode()).hexdigest()
            if t else (None if t is None else hashlib.md5(b"").hexdigest()))
        for i, (t, n) in want.items()}


def test_random_forms_against_brute_force(make_docs):
    rng = random.Random(7)
    words = [f"w{c}" for c in "abcdefghij"]
    for size in (6, 9, 14):
        forms = [[*rng.choices(words[:2], k=3), *rng.choices(words, k=size - 3)] for _ in range(6)]
        rows = []
        for i in range(70):
            text = []
            for _ in range(4):
                line = list(rng.choice(forms))
                for _ in range(rng.randrange(4)):
                    line[rng.randrange(size)] = rng.choice([*words, "7", "x9"])
                text.append(" ".join(line))
            rows.append((i % 60, "\n".join(text)))
        gone = brute(rows)
        got = sorted((r["doc_id"], r["text"], r["gone"]) for r in
                     linededup.drop_lines(make_docs(rows), removed="gone").collect())
        assert got == sorted((i, *kept_text(i, t, gone)) for i, t in rows)


def test_fourteen_templates_of_one_leaf(make_docs):
    rng = random.Random(4)
    rows = []
    for f in range(14):
        tail = [f"t{'abcdefghijklmnopqrst'[rng.randrange(20)]}{'qwertzuiopasdf'[f]}" for _ in range(7)]
        for v in range(2):
            line = ["All", "of", "the", *tail]
            line[5] = f"name{'xy'[v]}{'qwertzuiopasdf'[f]}"
            rows.append((10 * f + v, " ".join(line)))
    got = clean(make_docs(rows))
    assert [got[i][1] for i, _ in rows] == [0, 1] * 14


def crowd(rng, n):
    """Tails of ``n`` lines of a leaf that nearly agree with its commonest tokens, each
    by itself, and two tails beside them that differ at their first place only."""
    usual = [f"u{'abcdefg'[j]}" for j in range(7)]
    alone = []
    for i in range(n):
        tail = [f"o{'abcdefghijklmnopqrst'[i]}{'abcdefg'[j]}" for j in range(7)]
        for j in rng.sample(range(7), 2):
            tail[j] = usual[j]
        alone.append(tail)
    pair = [[first, *(f"p{'abcdefg'[j]}" for j in range(6))] for first in ("north", "south")]
    return alone, pair


def test_lines_that_a_split_takes_apart_are_one_template(make_docs):
    alone, pair = crowd(random.Random(3), 20)
    lines = [" ".join(["All", "of", "the", *tail]) for tail in [*alone, *pair]]
    # the rounds and the splits alone leave the two of the pair
    leaf = {i: line.split() for i, line in enumerate(lines)}
    assert all(len(x) < 2 for x in templates_of(leaf, linededup.Params()))
    got = clean(make_docs(list(enumerate(lines))))
    assert [got[i][1] for i in range(22)] == [0] * 21 + [1]


def rest_of(spark, lines, p=linededup.Params()):
    """Templates (sets of lines) of lines that no round has brought together."""
    rows = [("|".join([str(len(t)), *t[:p.depth]]), i, t) for i, t in enumerate(lines)]
    distinct = spark.createDataFrame(
        [(signed(xxhash.xxh64(leaf.encode()).intdigest()), i, t) for leaf, i, t in rows],
        "leaf long, key long, tokens array<string>")
    keyed = spark.createDataFrame([(i, i) for i in range(0, len(lines), 2)],
                                  "key long, template long")
    out = defaultdict(set)
    for r in linededup._rest_clusters(spark, distinct, keyed, p).collect():
        out[r["template"]].add(r["key"])
    return [r[0] for r in rows], list(out.values())


def test_no_two_lines_of_a_leaf_that_agree_are_left_alone(spark):
    rng = random.Random(11)
    for sizes, depth, n in (((6, 8, 11), 3, 300), ((40,), 3, 60), ((6,), 5, 40)):
        lines = set()
        for size in sizes:
            made = [rng.choices(["c", "d", "e", "f", "g", "<*>"], k=size - depth) for _ in range(n)]
            for tail in made if size < 40 else made * 2:
                for _ in range(0 if size < 40 else 5):
                    tail[rng.randrange(size - depth)] = rng.choice("cdefg")
                lines.add((*rng.choices(["a", "b"] if size < 40 else ["a"], k=depth), *tail))
        lines = sorted(lines)
        p = linededup.Params(depth=depth)
        leaf, found = rest_of(spark, lines, p)

        def agree(i, j):
            return leaf[i] == leaf[j] and \
                agreement(lines[i], lines[j]) >= p.min_fixed * len(lines[i])

        members = [k for keys in found for k in keys]
        assert len(members) == len(set(members))
        assert len(found) > 2 and all(len(keys) > 1 for keys in found)
        assert all(any(all(agree(c, k) for k in keys if k != c) for c in keys) for keys in found)
        left = sorted(set(range(len(lines))) - set(members))
        assert not any(agree(i, j) for i in left for j in left if i < j)


def test_many_lines_of_one_template_make_no_pairs_among_each_other(spark, monkeypatch):
    lines = [("All", "of", "the", f"n{i}x", "we", "sell", "come", "with", "long", "years")
             for i in range(2000)]
    compared = []
    plain = linededup._agreeing
    monkeypatch.setattr(linededup, "_agreeing", lambda pairs, *rest: (
        compared.append(pairs.distinct().count()), plain(pairs, *rest))[1])
    assert [len(x) for x in rest_of(spark, lines)[1]] == [2000]
    assert sum(compared) < 2000


def test_five_lines_and_footers_through_the_query_rule(make_docs):
    rows = [(i, f"All rights reserved.\nown {i}") for i in range(60)]
    got = clean(make_docs(rows))
    assert [got[i][1] for i in range(60)] == [0] + [1] * 59


def test_a_hot_line_is_joined_by_broadcast(spark, make_docs):
    line = "This line stands in every one of the documents here"
    rows = [(i, f"{line}\nown {i}") for i in range(400)]
    df = linededup.recurring(make_docs(rows))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    assert df.count() == 399


def test_recurring_lines_stay_in_the_first_document_only(make_docs):
    rng = random.Random(1)
    rows = []
    for i in range(20):
        own = [" ".join(f"w{rng.randrange(10 ** 8)}x" for _ in range(9)) for _ in range(4)]
        own.insert(rng.randrange(5), PASSAGE)
        rows.append((i, "\n".join(own)))
    got = clean(make_docs(rows))
    assert got[0] == (rows[0][1], 0)
    for i in range(1, 20):
        want = "\n".join(x for x in rows[i][1].split("\n") if x != PASSAGE)
        assert got[i] == (want, 1)


def test_variable_fields_are_one_template(make_docs):
    form = "Page {} of the printed annual report, see also {}"
    names = ["alpha", "beta", "gamma", "delta", "omega"]
    rows = [(i, f"own text {i}\n" + form.format(i, "appendix")) for i in range(3)]
    rows += [(10 + i, form.format("twelve", n)) for i, n in enumerate(names)]
    rows += [(30, "The cat sat on a mat today"), (31, "The cat sat by my door quietly then")]
    got = clean(make_docs(rows))
    assert [got[i][1] for i in range(3)] == [0, 1, 1]
    assert [got[10 + i][1] for i in range(5)] == [0, 1, 1, 1, 1]
    assert got[30][1] == got[31][1] == 0


def test_number_tables_are_no_template(make_docs):
    rng = random.Random(2)
    rows = [(i, " ".join(str(rng.randrange(1000)) for _ in range(9))) for i in range(10)]
    assert clean(make_docs(rows)) == {i: (t, 0) for i, t in rows}


def test_lines_of_one_document_and_short_lines_stay(make_docs):
    line = "the very same line again and again"
    rows = [(1, "\n".join([line] * 5)), (2, "Of the.\nYes."), (3, "Of the.\nYes."), (4, "Yes.")]
    assert clean(make_docs(rows)) == {i: (t, 0) for i, t in rows}


def test_copies_and_repeated_rows(make_docs):
    text = "one two three four five six\nseven eight nine ten eleven twelve"
    rows = [(4, text), (4, text), (2, text), (9, "keep\n" + text)]
    got = linededup.drop_lines(make_docs(rows), removed="gone").collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == \
        [(2, text), (4, ""), (4, ""), (9, "keep")]


def test_odd_rows(odd, empty):
    out = linededup.drop_lines(odd)
    assert out.columns == odd.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in out.collect()))) == \
        sorted(map(str, ODD))
    assert linededup.drop_lines(empty).count() == 0


def test_no_python_in_the_plan(odd):
    plan = linededup.drop_lines(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_lines_that_deviate_at_different_places_are_one_template(make_docs):
    base = "Please read the terms of our service before you go on".split()
    rows = [(1, " ".join(base))]
    for i, place in enumerate([6, 8, 10, 4], 2):
        rows.append((i, " ".join([*base[:place], f"word{'abcdef'[i]}", *base[place + 1:]])))
    rows += [(9, "Please read the book that lies here under some old lamp")]
    got = clean(make_docs(rows))
    assert [got[i][1] for i in (1, 2, 3, 4, 5, 9)] == [0, 1, 1, 1, 1, 0]


def test_a_template_of_two_variants(make_docs):
    rows = [(1, "Written by our staff writer Anna for the daily news"),
            (2, "Written by our staff writer Bert for the daily news"),
            (3, "Signed in the town of York on that day"),
            (4, "Signed in the presence of two men whom nobody")]
    got = clean(make_docs(rows))
    assert [got[i][1] for i in (1, 2, 3, 4)] == [0, 1, 0, 0]


def test_templates_of_one_leaf_do_not_hide_each_other(make_docs):
    forms = ["All of the {} shown here belong to their owners", "All of the {} we sell come with two years",
             "All of the {} you send us stay with nobody", "All of the {} that he wrote were lost early"]
    names = ["pictures", "names", "goods", "letters"]
    rows = [(10 * f + i, form.format(n)) for f, form in enumerate(forms) for i, n in enumerate(names)]
    got = clean(make_docs(rows))
    assert [got[i][1] for i, _ in rows] == [0, 1, 1, 1] * 4


def test_short_lines_recur_in_more_documents(make_docs):
    lines = {5: "Released under the MIT License.", 3: "All rights reserved.", 1: "Menu"}
    need = {5: 10, 3: 30, 1: 50}
    for n, line in lines.items():
        for docs in (need[n] - 1, need[n]):
            got = clean(make_docs([(i, f"{line}\n\nown text {i}") for i in range(docs)]))
            gone = int(docs >= need[n])
            assert [got[i][1] for i in range(docs)] == [0] + [gone] * (docs - 1)
            assert got[1][0] == ("\nown text 1" if gone else f"{line}\n\nown text 1")


def plans_of(docs, monkeypatch):
    """Plans of the tables that ``recurring`` stores, by name."""
    plans, plain = {}, linededup.stored

    def stored(spark, df, name):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return plain(spark, df, name)

    monkeypatch.setattr(linededup, "stored", stored)
    linededup.recurring(docs)
    return plans


def test_lines_are_counted_without_a_sort(make_docs, monkeypatch):
    plans = plans_of(make_docs([(i, f"one two three four five six\nown {i}") for i in range(4)]),
                     monkeypatch)
    assert "HashAggregate" in plans["counts"] and "SortAggregate" not in plans["counts"]


def test_texts_are_split_once_and_not_sorted(make_docs):
    rows = [(i, f"one two three four five six\nown {i}") for i in range(4)]
    df = linededup.drop_lines(make_docs(rows), removed="gone")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction(lines#" in plan and "lambdafunction(split(" not in plan
    join = next(x for x in plan.split("\n") if "Join LeftOuter" in x)
    assert "strategy=shuffle_hash" in join


def test_fixed_tokens_are_counted_once_for_each_line(spark):
    rest = spark.createDataFrame([(1, 2, ["a"] * 9)], "leaf long, key long, tokens array<string>")
    plan = linededup._buckets(rest, linededup.Params())._jdf.queryExecution() \
        .optimizedPlan().toString().split("\n")
    dealt = [i for i, line in enumerate(plan) if "Generate posexplode(tokens" in line]
    assert dealt
    for i in dealt:  # what stands right above takes the counts of the line as they are
        assert "Project" in plan[i - 1] or "Filter" in plan[i - 1]
        assert "lambda" not in plan[i - 1] + plan[i - 2]


def test_leaves_of_two_lines_take_one_comparison(make_docs, monkeypatch):
    rng = random.Random(5)
    rows, words = [], ["c", "d", "e", "<*>", "5x"]
    for leaf in range(60):
        size = rng.choice([6, 7, 12])
        line = [f"lead{'abcdefghij'[leaf // 10]}", f"lead{'abcdefghij'[leaf % 10]}", "of",
                *rng.choices(words, k=size - 3)]
        for v in range(2):
            for place in rng.sample(range(3, size), rng.randrange(3)):
                line[place] = rng.choice([*words, f"own{'xy'[v]}"])
            rows.append((2 * leaf + v, " ".join(line)))
    sizes, plain = [], linededup._clusters
    monkeypatch.setattr(linededup, "_clusters", lambda spark, distinct, p: (
        sizes.append(distinct.count()), plain(spark, distinct, p))[1])
    gone = brute(rows)
    assert 20 < len(gone) < 60
    got = clean(make_docs(rows))
    assert got == {i: kept_text(i, t, gone) for i, t in rows}
    assert sizes == [0]


def test_variable_forms_of_odd_tokens(spark):
    tokens = ["a", "7", "😀7", "7😀", "x\t9", "", "é1é2", "\r3", "漢", "<*>", "a0" * 50, "b" * 20_000]
    rng = random.Random(6)
    lines = [" ".join(rng.choices(tokens, k=rng.randrange(1, 12))) for _ in range(300)]
    got = linededup._masked(spark.createDataFrame([(x,) for x in lines], "line string"),
                            linededup.Params()).collect()
    p = linededup.Params()
    for r in got:
        form = " ".join("<*>" if re.search("[0-9]", t) else t for t in r["line"].split(" "))
        many = form.count("<*>") > (r["line"].count(" ") + 1) * (1 - p.min_fixed)
        assert r["masked"] == (r["line"] if many else form)

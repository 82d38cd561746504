"""Rule cascade: measures and verdict against plain Python, order of rules."""

import re
from collections import Counter

from tidemark.llm import queries, rules

from .conftest import ODD, SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1
               for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    m = {"n_words": len(words), "word_chars": sum(map(len, words)),
         "n_symbols": sum(c in "#*$%&|<>" for c in text),
         "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}
    base = m["n_words"] < 10 or 100 * len(covered) > 20 * m["n_words"]
    bad = base or 100 * m["n_symbols"] > 10 * m["n_words"] \
        or 100 * m["n_dup_lines"] > 30 * max(1, len(lines)) \
        or m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 20 * m["n_words"]
    return {**m, "base_failed": base, "kept": not bad}


def test_matches_plain_python(spark, sf_rows):
    want = {i: plain(t) for i, t in sf_rows}
    rows = queries.op4_quality_rules(spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert {k: r[k] for k in want[r["doc_id"]]} == want[r["doc_id"]], r["doc_id"]


def test_odd_rows_in_any_order(odd, empty):
    for order in (list(rules.RULES), list(rules.RULES)[::-1]):
        rows = rules.apply_rules(odd, order).collect()
        got = sorted((str(r["row"]["doc_id"]), r["n_words"], r["n_repeat_words"], r["word_chars"],
                      r["base_failed"], r["kept"]) for r in rows)
        want = sorted((str(i), p["n_words"], p["n_repeat_words"], p["word_chars"],
                       p["base_failed"], p["kept"]) for i, t in ODD for p in [plain(t)])
        assert got == want
        assert rules.apply_rules(empty, order).count() == 0


def test_cascade_order_is_rejection_per_cost(documents, empty):
    e = [rules.Estimate("too_few_words", 1.0, 0.2), rules.Estimate("symbols", 0.1, 0.1),
         rules.Estimate("long_words", 5.0, 0.0), rules.Estimate("short_words", 1.0, 0.0)]
    assert [r.name for r in rules.cascade_order(e)] == \
        ["symbols", "too_few_words", "long_words", "short_words"]
    seen = rules.estimate(documents)
    assert all(x.cost > 0 and 0 <= x.selectivity <= 1 for x in seen)
    assert len(rules.cascade_order(rules.estimate(empty))) == len(rules.RULES)


def test_short_circuit(odd):
    rows = rules.apply_rules(odd, list(rules.RULES), measures=()).collect()
    ran = {r["row"]["doc_id"]: r["n_rules"] for r in rows}
    assert ran[2] == 1 and ran[4] > 1

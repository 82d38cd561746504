"""Quotation linking: parsing, links, reply order, edge cases."""

import random

import duckdb

from tidemark.llm import queries, quoting

from .conftest import SF

COLS = "conv_id long, turn long, role string, text string"
A = "We meet on Monday at nine.\nPlease bring the printed plan."
B = "> We meet on Monday at nine.\n> Please bring the printed plan.\n\nMonday is fine for me."
C = ("On Tue, Ann wrote:\n> > we meet on MONDAY at nine\n> >  please bring the printed plan!\n"
     "> Monday is fine for me.\nThen it is settled.")
D = "> Please bring the printed plan.\nWhich plan?"


def run(spark, rows):
    out = quoting.conversations(spark.createDataFrame(rows, COLS)).collect()
    return out, {(r["conv_id"], r["turn"]): r for r in out}


def test_parse():
    assert quoting.parse(C) == ("Then it is settled.", [
        (2, ["we meet on MONDAY at nine", " please bring the printed plan!"]),
        (1, ["Monday is fine for me."])])
    assert quoting.parse("a > b\nc") == ("a > b\nc", [])
    assert quoting.parse(None) == ("", [])
    assert quoting.parse(">>> x")[1] == [(3, ["x"])]


def test_links_and_order(spark):
    rows = [(1, 0, "user", A), (1, 1, "assistant", B), (1, 2, "user", C), (1, 3, "user", D),
            (1, 4, "user", "No quote here."), (2, 0, "user", B), (2, 1, "user", "> unknown words"),
            (3, 0, "user", "Monday is fine for me.")]
    out, by = run(spark, rows)
    assert by[1, 1]["text"] == "Monday is fine for me." and by[1, 1]["parent_turn"] == 0
    # level 1 decides the parent, the nested quote is linked to its own source
    assert by[1, 2]["parent_turn"] == 1 and by[1, 2]["n_linked"] == 2 and by[1, 2]["depth"] == 2
    assert by[1, 3]["parent_turn"] == 0 and by[1, 3]["text"] == "Which plan?"
    assert by[1, 4]["parent_turn"] is None and by[1, 4]["path"] == [4]
    # a source in another conversation is no parent
    assert (by[2, 0]["parent_turn"], by[2, 0]["source_conv"], by[2, 0]["source_turn"]) == \
        (None, 1, 0)
    assert by[2, 1]["n_quotes"] == 1 and by[2, 1]["n_linked"] == 0
    assert [(r["conv_id"], r["turn"]) for r in out] == \
        [(1, 0), (1, 1), (1, 2), (1, 3), (1, 4), (2, 0), (2, 1), (3, 0)]
    assert [r["path"] for r in out[:3]] == [[0], [0, 1], [0, 1, 2]]


def test_reply_order_differs_from_turns(spark):
    rows = [(1, 0, "u", "first topic opened here"), (1, 1, "u", "second topic opened here"),
            (1, 2, "u", "> first topic opened here\nanswer to the first")]
    out, _ = run(spark, rows)
    assert [r["turn"] for r in out] == [0, 2, 1]


def test_common_passage_makes_no_pairs(spark):
    rows = [(c, 0, "u", "hello there my friends") for c in range(50)] + \
        [(c, 1, "u", "> hello there my friends\nhi") for c in range(50)]
    out, by = run(spark, rows)
    assert len(out) == 100 and all(by[c, 1]["parent_turn"] == 0 for c in range(50))


def test_long_chain(spark):
    rows = [(1, 0, "u", "message number zero")]
    for i in range(1, 20):
        rows.append((1, i, "u", f"> message number {'zero' if i == 1 else i - 1}\n"
                                f"message number {i}"))
    out, by = run(spark, rows)
    assert by[1, 19]["depth"] == 19 and by[1, 19]["path"] == list(range(20))


def test_odd_rows(spark):
    rows = [(None, 0, "u", A), (5, None, "u", B), (6, 0, None, None), (6, 1, "u", ""),
            (7, 0, "u", A), (7, 0, "u", A), (7, 1, "u", ">>>\n> \n"), (8, 0, "u", "x " * 50_000)]
    out, by = run(spark, rows)
    assert len(out) == 7
    assert by[None, 0]["n_linked"] == 0 and by[6, 0]["text"] == ""
    assert by[5, None]["parent_turn"] is None
    assert by[7, 1]["n_linked"] == 0
    extra = spark.createDataFrame([(1, 0, "u", A, "x", 1)],
                                  COLS + ", quotes string, key long")
    assert quoting.conversations(extra).count() == 1
    assert quoting.conversations(extra.where("false")).count() == 0


def test_given_table(spark):
    """The given conversations hold no quote: each message is its own root."""
    rows = queries.op2_quotation_linking(spark, SF).collect()
    con = duckdb.connect()
    want = con.sql(f"select distinct conv_id, turn, text from '{SF}/conversations.parquet'"
                   " order by 1, 2, 3").fetchall()
    assert [(r["conv_id"], r["turn"], r["text"]) for r in rows] == \
        [(c, t, x.strip("\n")) for c, t, x in want]
    assert {r["n_quotes"] for r in rows} == {0}


def test_rows_without_ids_and_roles_are_kept(spark):
    rows = [(None, 0, "u", "hi"), (None, 0, "a", "hi"), (None, 0, "u", "hi"), (4, None, "u", "hi"),
            (4, None, "u", "hi"), (5, 0, "u", "yo"), (5, 0, "assistant", "yo"), (5, 0, "u", "yo"),
            (5, 1, "u", "> yo\nyes"), (5, 1, None, "> yo\nyes"), (5, 1, "", "> yo\nyes")]
    out = quoting.conversations(spark.createDataFrame(rows, COLS)).collect()
    assert sorted((str(r["conv_id"]), str(r["turn"]), str(r["role"])) for r in out) == sorted(
        [("None", "0", "u"), ("None", "0", "a"), ("None", "0", "u"), ("4", "None", "u"),
         ("4", "None", "u"), ("5", "0", "u"), ("5", "0", "assistant"), ("5", "1", "u"),
         ("5", "1", "None"), ("5", "1", "")])
    assert {r["parent_turn"] for r in out if r["turn"] == 1} == {0}


def test_the_second_conversation_is_a_source(spark):
    passage = "the plan is printed on Monday"
    rows = [(1, 0, "u", f"> {passage}\nreally?"), (1, 1, "u", passage), (2, 3, "u", passage),
            (3, 0, "u", passage), (4, 0, "u", "Thanks"), (5, 0, "u", "> Thanks\nyou too")]
    _, by = run(spark, rows)
    assert (by[1, 0]["source_conv"], by[1, 0]["source_turn"]) == (2, 3)
    # a short line says nothing about another conversation
    assert by[5, 0]["n_quotes"] == 1 and by[5, 0]["source_conv"] is None


def plain_links(rows):
    """``(parent_turn, source_conv, source_turn, n_linked)`` per message by plain loops over
    all messages; texts of one conversation and turn are unique here."""
    parsed = {(c, t): quoting.parse(x) for c, t, _, x in rows}
    own = {k: set(quoting.own_keys(reply)) for k, (reply, _) in parsed.items()}
    out = {}
    for (c, t), (_, passages) in parsed.items():
        near, far, linked = [], [], 0
        for q, (level, lines) in enumerate(passages):
            votes = {}
            for text, whole in [("\n".join(lines), True), *((x, False) for x in lines)]:
                k = quoting.key(text)
                if k is None:
                    continue
                here = min((u for d, u in own if d == c and k in own[d, u]), default=None)
                other = min((m for m in own if m[0] != c and k in own[m]), default=None)
                if here is not None and here < t:
                    src = (True, (c, here))
                elif other and len(quoting.normal(text).split()) >= quoting.FAR_WORDS:
                    src = (False, other)
                else:
                    continue
                w, n = votes.get(src, (False, 0))
                votes[src] = (w or whole, n + 1)
            if votes:
                linked += 1
                same, src = max(votes, key=lambda s: (votes[s][0], s[0], votes[s][1], -s[1][1],
                                                      s[1]))
                (near if same else far).append((level, q, src))
        parent = max(near, key=lambda x: (-x[0], x[2][1]))[2][1] if near else None
        source = min(far)[2] if far else (None, None)
        out[c, t] = (parent, *source, linked)
    return out


def test_links_equal_brute_force(spark):
    rng = random.Random(12)
    words = "plan print monday nine bring check send agree late early note draft".split()
    said = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 4, 6])))
            for _ in range(60)]
    rows = []
    for c in range(25):
        turns = []
        for t in range(rng.randrange(1, 9)):
            lines = []
            for _ in range(rng.randrange(0, 3)):
                sign = rng.choice(["> ", "> ", ">> ", "> > "])
                old = rng.choice(turns) if turns and rng.random() < 0.6 else \
                    "\n".join(rng.sample(said, 2))
                kept = [x for x in old.split("\n") if rng.random() < 0.8]
                lines += [sign + (x.upper() if rng.random() < 0.3 else x) for x in kept]
                lines += [rng.choice(said), ""]
            lines += rng.sample(said, rng.randrange(1, 4))
            text = "\n".join(lines)
            turns.append(text)
            rows.append((c, t, "u", text))
    _, by = run(spark, rows)
    want = plain_links(rows)
    got = {k: (r["parent_turn"], r["source_conv"], r["source_turn"], r["n_linked"])
           for k, r in by.items()}
    assert got == want
    assert sum(w[0] is not None for w in want.values()) > 20
    assert sum(w[1] is not None for w in want.values()) > 20

"""CSV with line breaks in quoted values, read in splits of any size."""

import csv
import io
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.sources import csvsplit
from tidemark.sources.files import read_csv_strings


@pytest.fixture()
def split_bytes(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "134217728b", "spark.sql.files.openCostInBytes": "4194304b"}
    def use(n):
        for k in keys:
            spark.conf.set(k, f"{n}b")
    yield use
    for k, v in keys.items():
        spark.conf.set(k, v)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def plain(text):
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r and any(x.strip() for x in r)]
    return sorted((tuple(x or None for x in r) for r in rows[1:]), key=repr)


def read(spark, path, **kw):
    return sorted((tuple(x or None for x in r) for r in
                   read_csv_strings(spark, path, multi_line=True, **kw).collect()), key=repr)


def table(rows, line="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=line)
    w.writerow(["id", "text", "more"])
    w.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("size", [40, 300, 10 ** 6])
@pytest.mark.parametrize("line", ["\n", "\r\n"])
def test_breaks_across_split_borders(spark, tmp_dir, split_bytes, size, line):
    rng = random.Random(size)
    words = ["plain", "two\nlines", 'say "hi"', "a,b", "", "\n", '"', 'x"\n"y', "tail\n\n", " pad "]
    rows = [(i, "".join(rng.choices(words, k=rng.randrange(4))), rng.choice(words)) for i in range(120)]
    text = table(rows, line)
    path = write(f"{tmp_dir}/x.csv", text)
    split_bytes(size)
    assert read(spark, path) == plain(text)


def test_one_file_gives_many_tasks(spark, tmp_dir, split_bytes):
    rows = [(i, f"line one of {i}\nline two, with a comma", "z" * 40) for i in range(3000)]
    path = write(f"{tmp_dir}/big.csv", table(rows))
    split_bytes(20_000)
    borders = csvsplit.scan_borders(spark, [path])
    assert borders.breaks and not borders.unsplit
    assert borders.splits.count() > 8 and borders.crossing.count() >= 1
    df = csvsplit.read_records(spark, [path], borders)
    assert df.count() == 3000
    plan = df._jdf.queryExecution().executedPlan().toString()
    # only the table of splits is shuffled, never the lines
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    assert plan.count("Exchange hashpartitioning") <= 2
    assert read(spark, path) == plain(table(rows))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(alphabet='ab",\n ', max_size=9), st.text(alphabet='x"\n,', max_size=5)),
                min_size=1, max_size=14), st.integers(5, 60))
def test_random_tables(spark, tmp_dir, split_bytes, rows, size):
    text = table([(i, a, b) for i, (a, b) in enumerate(rows)])
    path = write(f"{tmp_dir}/r{abs(hash((text, size)))}.csv", text)
    split_bytes(size)
    assert read(spark, path) == plain(text)


def test_stray_quotes_do_not_open_a_value(spark, tmp_dir, split_bytes):
    path = write(f"{tmp_dir}/s.csv", 'id,text,more\n1,5" pipe,x\n2,"a\nb",6"\n3,"q"z,w\n4,"""",v\n')
    for size in (10, 1000):
        split_bytes(size)
        assert read(spark, path) == [("1", '5" pipe', "x"), ("2", "a\nb", '6"'), ("3", '"q"z', "w"),
                                     ("4", '"', "v")]


def test_no_breaks_need_no_gluing(spark, tmp_dir):
    path = write(f"{tmp_dir}/n.csv", 'id,text,more\n1,"a,b",5" pipe\n2,"c ""d""",z\n')
    borders = csvsplit.scan_borders(spark, [path])
    assert not borders.breaks
    assert read(spark, path) == [("1", "a,b", '5" pipe'), ("2", 'c "d"', "z")]


def test_a_record_that_fills_splits_is_read_whole(spark, tmp_dir, split_bytes, monkeypatch):
    text = table([(1, "x\n" * 500, "a"), (2, "y", "b")])
    path = write(f"{tmp_dir}/w.csv", text)
    split_bytes(100)
    assert csvsplit.scan_borders(spark, [path]).unsplit
    assert read(spark, path) == plain(text)


def test_headers_unclosed_quotes_wide_rows_and_empty_files(spark, tmp_dir, split_bytes):
    write(f"{tmp_dir}/h/a.csv", 'k,v\n1,"x\ny"\n')
    write(f"{tmp_dir}/h/b.csv", "v,k\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        read(spark, f"{tmp_dir}/h")
    with pytest.raises(csvsplit.UnclosedQuote):
        read(spark, write(f"{tmp_dir}/u.csv", 'k,v\n1,"x\n2,y\n'))
    with pytest.raises(Exception, match="more than 2 fields"):
        read(spark, write(f"{tmp_dir}/wide.csv", 'k,v\n1,"x\ny",3\n'))
    assert read(spark, write(f"{tmp_dir}/e.csv", '"k\n1",v\n')) == []
    short = write(f"{tmp_dir}/short.csv", 'k,v\n\n1\n"2\n3",x\n\n')
    assert read(spark, short) == [("1", None), ("2\n3", "x")]


def test_many_files_one_source(spark, tmp_dir, split_bytes):
    rows = [(i, f"t\n{i}", "m") for i in range(60)]
    for k in range(6):
        write(f"{tmp_dir}/f.csv/part-{k}.csv", table(rows[10 * k:10 * k + 10]))
    write(f"{tmp_dir}/f.csv/notes.txt", 'an "open quote')
    split_bytes(64)
    assert read(spark, f"{tmp_dir}/f.csv", glob="*.csv") == plain(table(rows))

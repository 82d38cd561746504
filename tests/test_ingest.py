"""CSV discovery, header clean-up and type inference."""

import os

import pytest

from tidemark.operators import ingest
from tidemark.operators.inference import infer_types, null_na_tokens, types_of
from tidemark.sources.files import discover_csv, read_csv_strings

EDGE_CSV = (" Id,user name,f,b,d,m\n"
            "1,x,1.5,true,2024-01-01,1\n"
            ",NA,2,False,2024-01-02,z\n"
            "3000000000,,3,True,2024-01-03,2\n")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_edge_csv_types_like_pandas(spark, tmp_dir):
    _write(f"{tmp_dir}/in/edge.csv", EDGE_CSV)
    raw = read_csv_strings(spark, f"{tmp_dir}/in/edge.csv")
    df = null_na_tokens(ingest.clean_headers(raw))
    assert df.columns == ["Id", "user_name", "f", "b", "d", "m"]
    types = types_of(infer_types(df))
    # pandas: float64, object, float64, bool, object, object
    assert types == {"Id": "REAL", "user_name": "TEXT", "f": "REAL",
                     "b": "BOOLEAN", "d": "TEXT", "m": "TEXT"}
    spark_types = types_of(infer_types(df, compat="spark"))
    assert spark_types["Id"] == "INTEGER"


def test_types_agree_with_pandas(spark, tmp_dir):
    pd = pytest.importorskip("pandas")
    text = "a,b,c,d\n1,1.0,True,x\n2,,False,\n-3,2e3,True,y\n"
    _write(f"{tmp_dir}/p.csv", text)
    want = {c: {"int64": "INTEGER", "float64": "REAL", "bool": "BOOLEAN"}.get(str(t), "TEXT")
            for c, t in pd.read_csv(f"{tmp_dir}/p.csv").dtypes.items()}
    df = null_na_tokens(read_csv_strings(spark, f"{tmp_dir}/p.csv"))
    assert types_of(infer_types(df)) == want


def test_colliding_headers_fail(spark):
    df = spark.createDataFrame([("1", "2")], ["a b", "a_b"])
    with pytest.raises(ValueError):
        ingest.clean_headers(df)


def test_discovery_sorted_capped_any_case(spark, tmp_dir):
    for name in ("b.CSV", "a.csv", "c.csv", "notes.txt"):
        _write(f"{tmp_dir}/d/{name}", "key,value\nx,y\n")
    got = [os.path.basename(r["path"]) for r in
           discover_csv(spark, f"{tmp_dir}/d", max_files=2).collect()]
    assert got == ["a.csv", "b.CSV"]


def test_empty_or_missing_dir(spark, tmp_dir):
    assert discover_csv(spark, f"{tmp_dir}/nope").count() == 0
    assert ingest.load_csv_tables(spark, f"{tmp_dir}/nope", f"{tmp_dir}/out") == {}


def test_load_tables_idempotent(spark, tmp_dir):
    _write(f"{tmp_dir}/d/data1.csv", "key,value\nasdf,ghjk\nsatuk,gamma\nble,bleble")
    _write(f"{tmp_dir}/d/data2.csv", "key,value\nzxcv,bnm\npizza,hut")
    for _ in range(2):
        types = ingest.load_csv_tables(spark, f"{tmp_dir}/d", f"{tmp_dir}/t")
    assert types == {"data1": {"key": "TEXT", "value": "TEXT"},
                     "data2": {"key": "TEXT", "value": "TEXT"}}
    assert spark.read.parquet(f"{tmp_dir}/t/data1").count() == 3
    assert spark.read.parquet(f"{tmp_dir}/t/data2").count() == 2


TOKENS = ["0", "7", "-12", "3000000000", "1.5", "-0.25", "2e3", "inf", "True",
          "false", "TRUE", "NA", "", "null", "n/a", "abc", "x1", "1x", "nan"]


def test_inference_agrees_with_pandas_property(spark, tmp_dir):
    """Random columns from a token vocabulary: the one-pass Spark inference
    gives the type pandas' reader would (reference type map)."""
    pd = pytest.importorskip("pandas")
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    counter = {"n": 0}

    @settings(max_examples=12, deadline=None,
              suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(st.lists(st.lists(st.sampled_from(TOKENS), min_size=3, max_size=3),
                    min_size=1, max_size=6))
    def check(rows):
        counter["n"] += 1
        path = f"{tmp_dir}/h{counter['n']}.csv"
        _write(path, "a,b,c\n" + "\n".join(",".join(r) for r in rows) + "\n")
        want = {c: {"int64": "INTEGER", "float64": "REAL", "bool": "BOOLEAN"}
                .get(str(t), "TEXT")
                for c, t in pd.read_csv(path).dtypes.items()}
        df = null_na_tokens(read_csv_strings(spark, path))
        assert types_of(infer_types(df)) == want, rows

    check()


INT_TOKENS = ["5", " 7", "8 ", "  -3 ", "98765432109876543210", "-98765432109876543210",
              "12345678901234567890", "9223372036854775807", "+4"]


def test_integers_agree_with_pandas_property(spark, tmp_dir):
    """Padded integers and integers beyond 64 bits, also with no row at all."""
    pd = pytest.importorskip("pandas")
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    counter = {"n": 0}

    @settings(max_examples=12, deadline=None,
              suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(st.lists(st.lists(st.sampled_from(INT_TOKENS), min_size=2, max_size=2),
                    min_size=0, max_size=4))
    def check(rows):
        counter["n"] += 1
        path = f"{tmp_dir}/i{counter['n']}.csv"
        _write(path, "a,b\n" + "".join(",".join(r) + "\n" for r in rows))
        want = {c: {"int64": "INTEGER", "float64": "REAL", "bool": "BOOLEAN"}
                .get(str(t), "TEXT") for c, t in pd.read_csv(path).dtypes.items()}
        df = null_na_tokens(read_csv_strings(spark, path))
        assert types_of(infer_types(df)) == want, rows

    check()


def test_padded_and_huge_numbers_keep_their_digits(spark, tmp_dir):
    _write(f"{tmp_dir}/n.csv", "a,b,c\n 1,98765432109876543210, 1.5\n2 ,1,2\n")
    df, types = ingest.typed_table(read_csv_strings(spark, f"{tmp_dir}/n.csv"))
    assert types == {"a": "INTEGER", "b": "TEXT", "c": "REAL"}
    assert [tuple(r) for r in df.collect()] == [(1, "98765432109876543210", 1.5), (2, "1", 2.0)]


def test_quotes_and_backslashes(spark, tmp_dir):
    pd = pytest.importorskip("pandas")
    text = 'k,v\n1,"say ""hi"", ok"\n2,"C:\\"\n3,5" pipe\n4,"""x"\n'
    _write(f"{tmp_dir}/q.csv", text)
    got = [tuple(r) for r in read_csv_strings(spark, f"{tmp_dir}/q.csv").collect()]
    want = [tuple(map(str, r)) for r in pd.read_csv(f"{tmp_dir}/q.csv").itertuples(index=False)]
    assert got == want


def test_line_breaks_in_quotes(spark, tmp_dir):
    _write(f"{tmp_dir}/m.csv", 'k,v\n1,"two\nlines"\n2,x\n')
    with pytest.raises(ValueError, match="multi_line"):
        read_csv_strings(spark, f"{tmp_dir}/m.csv")
    df, types = ingest.typed_table(read_csv_strings(spark, f"{tmp_dir}/m.csv", multi_line=True))
    assert types == {"k": "INTEGER", "v": "TEXT"}
    assert [tuple(r) for r in df.collect()] == [(1, "two\nlines"), (2, "x")]


def test_wide_rows_raise_and_short_rows_are_filled(spark, tmp_dir):
    _write(f"{tmp_dir}/w.csv", "a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="more than 2 fields"):
        read_csv_strings(spark, f"{tmp_dir}/w.csv").collect()
    _write(f"{tmp_dir}/s.csv", 'a,b\n1,2\n3\n"x,y",z\n')
    rows = read_csv_strings(spark, f"{tmp_dir}/s.csv").collect()
    assert [tuple(r) for r in rows] == [("1", "2"), ("3", None), ("x,y", "z")]


def test_same_table_from_files_with_other_column_order(spark, tmp_dir):
    _write(f"{tmp_dir}/d/x-1.csv", "key,value\nk1,v1\n")
    _write(f"{tmp_dir}/d/x 1.csv", "value,key\nv2,k2\n")
    ingest.load_csv_tables(spark, f"{tmp_dir}/d", f"{tmp_dir}/t")
    rows = spark.read.parquet(f"{tmp_dir}/t/x_1").select("key", "value").collect()
    assert sorted(map(tuple, rows)) == [("k1", "v1"), ("k2", "v2")]


def test_part_files_with_other_headers_raise(spark, tmp_dir):
    _write(f"{tmp_dir}/f.csv/p1.csv", "key,value\nk1,v1\n")
    _write(f"{tmp_dir}/f.csv/p2.csv", "value,key\nv2,k2\n")
    with pytest.raises(Exception, match="header"):
        read_csv_strings(spark, f"{tmp_dir}/f.csv").collect()

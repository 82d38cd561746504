"""The command-line jobs, run in-process on the test session."""

import os

from tidemark import cli
from tidemark.sources import lake


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_load_csv_dir_and_files(spark, tmp_dir, capsys):
    _write(f"{tmp_dir}/data/data1.csv", "key,value\nasdf,ghjk\nsatuk,gamma\nble,bleble")
    _write(f"{tmp_dir}/data/data2.csv", "key,value\nzxcv,bnm\npizza,hut")
    _write(f"{tmp_dir}/data/data3.csv", "key,value\nkng,gzzrd\nrtct,mnks\n")
    assert cli.main(["load-csv", "--data-dir", f"{tmp_dir}/data", "--out", f"{tmp_dir}/t"]) == 0
    counts = {n: spark.read.parquet(f"{tmp_dir}/t/{n}").count() for n in ("data1", "data2", "data3")}
    assert counts == {"data1": 3, "data2": 2, "data3": 2}
    assert cli.main(["load-csv", "--out", f"{tmp_dir}/t2", "--mode", "append",
                     f"{tmp_dir}/data/data2.csv", f"{tmp_dir}/notes.txt"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/t2/data2").count() == 2
    assert cli.main(["load-csv", "--data-dir", f"{tmp_dir}/none", "--out", f"{tmp_dir}/t3"]) == 0
    assert "no CSV files" in capsys.readouterr().out


def test_stream_lake_and_read(spark, tmp_dir, capsys):
    from tidemark.plans.common import records
    records(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_dir}/src")
    assert cli.main(["stream-lake", "--source-dir", f"{tmp_dir}/src", "--lake", f"{tmp_dir}/lake",
                     "--checkpoint", f"{tmp_dir}/ck", "--trigger", "available-now"]) == 0
    assert lake.read_lake(spark, f"{tmp_dir}/lake").count() == 1000
    assert cli.main(["stream-report", "--source-dir", f"{tmp_dir}/src", "--report",
                     f"{tmp_dir}/rep", "--checkpoint", f"{tmp_dir}/ck2",
                     "--trigger", "available-now"]) == 0
    assert spark.read.text(f"{tmp_dir}/rep").count() == 1002  # with the title
    assert cli.main(["read-lake", f"{tmp_dir}/lake"]) == 0
    out = capsys.readouterr().out
    assert "Total rows: 1000" in out


def test_load_csv_takes_all_files_and_says_what_it_leaves(spark, tmp_dir, capsys):
    for i in range(5):
        _write(f"{tmp_dir}/data/t{i}.csv", f"key,value\na{i},b\n")
    assert cli.main(["load-csv", "--data-dir", f"{tmp_dir}/data", "--out", f"{tmp_dir}/t"]) == 0
    assert [spark.read.parquet(f"{tmp_dir}/t/t{i}").count() for i in range(5)] == [1] * 5
    capsys.readouterr()
    cli.main(["load-csv", "--data-dir", f"{tmp_dir}/data", "--out", f"{tmp_dir}/u",
              "--max-files", "2"])
    assert "3 more CSV file(s) left out" in capsys.readouterr().out


def test_load_csv_files_of_one_table_are_one_load(spark, tmp_dir):
    _write(f"{tmp_dir}/a/x.csv", "key,value\nk1,v1\n")
    _write(f"{tmp_dir}/b/x.csv", "value,key\nv2,k2\n")
    assert cli.main(["load-csv", "--out", f"{tmp_dir}/t", f"{tmp_dir}/a/x.csv",
                     f"{tmp_dir}/b/x.csv"]) == 0
    rows = spark.read.parquet(f"{tmp_dir}/t/x").select("key", "value").collect()
    assert sorted(map(tuple, rows)) == [("k1", "v1"), ("k2", "v2")]


def test_consume(spark, tmp_dir, capsys):
    from tidemark.schemas import RECORD
    rows = [(b"k", v, "pg.public.t", 0, i, None, 0) for i, v in
            enumerate([b'{"a": 1}', b"no json"])]
    spark.createDataFrame(rows, RECORD).write.parquet(f"{tmp_dir}/src")
    assert cli.main(["consume", "--source-dir", f"{tmp_dir}/src", "--schema", "a long",
                     "--out", f"{tmp_dir}/good", "--errors", f"{tmp_dir}/bad",
                     "--checkpoint", f"{tmp_dir}/ck", "--trigger", "available-now"]) == 0
    assert "decoded: 1, failed: 1" in capsys.readouterr().out


def test_pack_lake(spark, tmp_dir, capsys):
    from tidemark.plans.common import records
    records(spark, "/root/testdata/sf0.001").repartition(3).write.parquet(f"{tmp_dir}/src")
    assert cli.main(["stream-lake", "--source-dir", f"{tmp_dir}/src", "--lake", f"{tmp_dir}/lake",
                     "--checkpoint", f"{tmp_dir}/ck", "--trigger", "available-now"]) == 0
    before = lake.history(spark, f"{tmp_dir}/lake").collect()
    args = ["pack-lake", f"{tmp_dir}/lake", "--checkpoint", f"{tmp_dir}/ck"]
    assert cli.main(args) == 0 and cli.main(args) == 0
    assert lake.history(spark, f"{tmp_dir}/lake").collect() == before
    assert not [n for n in os.listdir(f"{tmp_dir}/lake") if n.startswith("batch_id=")]
    out = capsys.readouterr().out
    assert "Packed batches 0 to" in out and "no closed batch" in out

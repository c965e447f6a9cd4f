"""CSV quarantine, row counts of jobs, and tables replaced without losing the old one."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tillroll.operators import clean as C
from tillroll.sources import files as IO

LINES = ["Product_ID,Product_Name,Category,Cost,Price", "1,a,X,1.5,2", "2,short", "3,too,long,1,2,3", '4,"open,X,1,2',
         '5,"quoted, ok",X,1,2', "", '6,"a ""b"" c",X,1,2', '7,"two', 'lines",X,1,2', "8,,,,", "Ä,é,ü,1,2"]
BAD = ["2,short", "3,too,long,1,2,3", '4,"open,X,1,2', '7,"two', 'lines",X,1,2']


@pytest.fixture()
def folder(tmp_path):
    path = tmp_path / "products.csv"
    path.mkdir()
    (path / "a.csv").write_text("\n".join(LINES) + "\n", encoding="utf-8")
    (path / "b.csv").write_text("\n".join([LINES[0], "9,z,Y,3,4"]) + "\n", encoding="utf-8")
    return str(path)


def test_no_record_is_lost(spark, folder):
    good, bad = IO.split_raw_csv(spark, folder, "products")
    assert sorted(r.record for r in bad.collect()) == sorted(BAD)
    assert {os.path.basename(r.file) for r in bad.collect()} == {"a.csv"}
    rows = {r.Product_ID: r for r in good.collect()}
    assert set(rows) == {"1", "5", "6", "8", "9", "Ä"}
    assert rows["5"].Product_Name == "quoted, ok" and rows["6"].Product_Name == 'a "b" c' and rows["8"].Price is None
    assert good.count() + bad.count() == len([x for x in LINES[1:] if x]) + 1
    assert good.select("Category").count() == 6              # pruning columns makes no record good or bad


def test_other_header_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("A,B,C,D,E\n1,2,3,4,5\n")
    with pytest.raises(Exception):
        IO.split_raw_csv(spark, str(tmp_path / "x.csv"), "products")[0].collect()


def test_five_tables_and_one_quarantine(spark, tmp_path):
    for name, cols in IO.RAW_COLUMNS.items():
        (tmp_path / f"{name}.csv").write_text("\n".join([",".join(cols), ",".join(["1"] * len(cols)), "bad"]) + "\n")
    tables, bad = IO.scan_raw_all(spark, str(tmp_path))
    assert {n: (t.count(), tuple(t.columns)) for n, t in tables.items()} == {n: (1, c) for n, c in IO.RAW_COLUMNS.items()}
    assert sorted((r.table_name, r.record) for r in bad.collect()) == sorted((n, "bad") for n in IO.RAW_COLUMNS)


def test_quotes_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "hi", twice', "c", "1", None)], ", ".join(f"{c} string" for c in IO.RAW_COLUMNS["products"]))
    path = IO.sink_clean_csv(df, str(tmp_path / "q"))
    assert [tuple(r) for r in IO.scan_raw_csv(spark, path, "products").collect()] == [tuple(r) for r in df.collect()]


def test_counts_come_with_the_work(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "id int, t string").repartition(3)
    rows, seen = C.deduplicated(df)
    assert seen == {"rows_before": 5, "rows_after": 3}
    assert sorted(map(str, rows.collect())) == sorted(map(str, df.distinct().collect()))
    assert IO.sink_csv_counted(rows, str(tmp_path / "out")) == 3
    empty, none = C.deduplicated(df.limit(0))
    assert none == {"rows_before": 0, "rows_after": 0} and empty.count() == 0
    assert IO.sink_csv_counted(empty, str(tmp_path / "none")) == 0


@pytest.fixture()
def name():
    return f"t_{uuid.uuid4().hex[:8]}"


def test_failed_write_keeps_the_former_rows(spark, tmp_path, name):
    IO.replace_table(spark.range(10), name, str(tmp_path))
    with pytest.raises(Exception):
        IO.replace_table(spark.range(100, numPartitions=4).select(
            F.when(F.col("id") == 99, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id")).alias("id")), name, str(tmp_path))
    assert spark.table(name).count() == 10


def test_reader_that_began_before_stays_whole(spark, tmp_path, name):
    IO.replace_table(spark.range(10), name, str(tmp_path))
    before = spark.table(name)
    IO.replace_table(spark.range(7).withColumn("new", F.lit(1)), name, str(tmp_path))
    assert before.count() == 10 and before.columns == ["id"]
    assert spark.table(name).columns == ["id", "new"] and spark.table(name).count() == 7


def test_a_table_replaced_by_its_own_rows(spark, tmp_path, name):
    IO.replace_table(spark.range(10), name, str(tmp_path))
    IO.replace_table(spark.table(name).where("id < 4"), name, str(tmp_path))
    assert spark.table(name).count() == 4


def test_old_versions_go_and_partitions_prune(spark, tmp_path, name):
    for n in range(4):
        IO.replace_table(spark.range(20).withColumn("k", F.col("id") % 3), name, str(tmp_path), ("k",), keep=2)
    assert len([x for x in os.listdir(tmp_path / name) if x.startswith("v")]) == 2
    plan = spark.table(name).where("k = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan

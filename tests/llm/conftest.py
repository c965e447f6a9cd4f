import os

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def same(duck):
    """Compare a query's rows with its SQL's, column by column name."""
    def compare(df, sql):
        cur = duck.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        want = sorted(map(repr, cur.fetchall()))
        got = sorted(repr(tuple(r)) for r in df.select(*names).collect())
        assert got == want
    return compare


@pytest.fixture()
def saved(spark, tmp_path):
    """Rows written as Parquet and read again, as operators meet them."""
    def save(rows, schema, parts=3):
        path = os.path.join(tmp_path, "rows")
        spark.createDataFrame(rows, schema).repartition(parts).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    return save

"""File sources and sinks: raw / cleaned CSVs, parquet tables, models.

Raw CSVs are read with fixed all-string schemas (PERMISSIVE), so type
coercion happens once, in the cleaning operators, with ANSI-safe casts.
Written tables go to a folder on shared storage: by default a sub-folder
of the session's reliable checkpoint folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import posixpath
import time
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ensure_checkpoint_dir

# Raw headers of the five source CSVs.
RAW_COLUMNS = {
    "products": ("Product_ID", "Product_Name", "Category", "Cost", "Price"),
    "suppliers": ("Supplier_ID", "Supplier_Name", "Lead_Time", "Location"),
    "inventory": ("Product_ID", "Warehouse", "Stock_Level", "Reorder_Level"),
    "orders": ("Order_ID", "Product_ID", "Order_Date", "Delivery_Date", "Quantity"),
    "sales": ("Sale_ID", "Product_ID", "Sale_Date", "Quantity", "Revenue"),
}
# date columns of the cleaned CSVs
CLEAN_DATE_COLUMNS = {"orders": ("order_date", "delivery_date"), "sales": ("sale_date",)}
CSV_DATE_FORMAT = "yyyy-MM-dd"
# column in which a reader keeps a record that does not fit
CORRUPT = "_record"


def raw_schema(name: str) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS[name]])


def output_root(spark: SparkSession, *parts: str) -> str:
    """A folder under the reliable checkpoint folder (shared storage)."""
    return posixpath.join(ensure_checkpoint_dir(spark), "tables", *parts)


def _csv(spark: SparkSession, header: bool = True) -> DataFrameReader:
    """A CSV reader that takes quotes inside quotes doubled, as the sinks write them."""
    return spark.read.option("header", header).option("mode", "PERMISSIVE").option("escape", '"')


def scan_raw_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read one raw CSV with its header; every column as text."""
    return _csv(spark).schema(raw_schema(name)).csv(path)


def split_raw_csv(spark: SparkSession, path: str, name: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """One raw CSV as (good, bad), both lazily read: records with the table's columns,
    and in quarantine the others, whole (``record``) and with their ``file``.

    A record is bad when it has too few or too many fields or a quote that does not
    close on its line; a line is a record, blank ones are none, so good and bad
    together are all of them.  A header with other names is an error.
    """
    schema = StructType([*raw_schema(name).fields, StructField(CORRUPT, StringType(), True)])
    read = (_csv(spark, header).schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
            .option("enforceSchema", not header).option("columnPruning", False).csv(path))
    fields = list(RAW_COLUMNS[name])
    # always true; Spark refuses scans that read nothing but the corrupt record
    read_on = F.length(F.coalesce(F.col(fields[0]), F.lit(""))) >= 0
    good = read.where(F.col(CORRUPT).isNull() & read_on).select(*fields)
    bad = read.where(F.col(CORRUPT).isNotNull() & read_on)
    return good, bad.select(F.col(CORRUPT).alias("record"), F.col("_metadata.file_path").alias("file"))


def scan_raw_all(spark: SparkSession, root: str, header: bool = True) -> tuple[dict[str, DataFrame], DataFrame]:
    """All five raw CSVs below ``root`` (``<table>.csv``): the good records of each, and one
    quarantine of the bad ones (table_name, record, file)."""
    parts = {n: split_raw_csv(spark, posixpath.join(root, f"{n}.csv"), n, header) for n in RAW_COLUMNS}
    bad = [b.select(F.lit(n).alias("table_name"), "record", "file") for n, (_, b) in parts.items()]
    return {n: g for n, (g, _) in parts.items()}, reduce(DataFrame.union, bad)


def scan_clean_all(spark: SparkSession, root: str, schemas: Mapping[str, StructType]) -> dict[str, DataFrame]:
    """All five cleaned CSVs below ``root`` (``<table>_clean.csv``), dates parsed."""
    return {n: scan_clean_csv(spark, posixpath.join(root, f"{n}_clean.csv"), n, schemas.get(n)) for n in RAW_COLUMNS}


def scan_clean_csv(spark: SparkSession, path: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Read a cleaned CSV; its date columns are parsed to DATE."""
    r = _csv(spark)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    dates = [c for c in CLEAN_DATE_COLUMNS.get(name, ()) if c in df.columns]
    return df.withColumns({c: F.to_date(F.col(c).cast("string"), CSV_DATE_FORMAT) for c in dates})


def sink_clean_csv(df: DataFrame, path: str) -> str:
    """Overwrite ``path`` with a header CSV (one part file per task)."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", CSV_DATE_FORMAT).option("escape", '"').csv(path)
    return path


def sink_csv_counted(df: DataFrame, path: str) -> int:
    """``sink_clean_csv``; returns the rows written, counted by the writing job itself."""
    watch = Observation()
    sink_clean_csv(df.observe(watch, F.count(F.lit(1)).alias("rows")), path)
    return watch.get["rows"]


def sink_replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Drop-and-recreate a table as parquet (overwrite), optionally partitioned.

    Facts partitioned by year/month get partition pruning on period filters.
    Write errors propagate (nothing is swallowed).
    """
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def replace_table(df: DataFrame, name: str, root: str, partition_by: tuple[str, ...] = (), keep: int = 2) -> str:
    """Replace the catalog's table ``name`` by ``df`` without ever losing the former one.

    The rows go to a new version folder below ``root``; only when all are written
    does the name (a view over that folder) point to it, in one catalog change.  A
    write that fails leaves the former rows readable, and who began to read before
    goes on reading the former version: the last ``keep`` versions stay on disk.
    """
    spark = df.sparkSession
    home = posixpath.join(root, name)
    version = posixpath.join(home, f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    w = df.write.partitionBy(*partition_by) if partition_by else df.write
    w.parquet(version)
    spark.sql(f"create or replace view `{name}` as select * from parquet.`{version}`")
    for old in _versions(spark, home)[:-keep]:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return version


def _versions(spark: SparkSession, home: str) -> list[str]:
    """Complete version folders of a table, the oldest first (a failed write has no success mark)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(home).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [x.getPath() for x in fs.listStatus(path(home))]
    return sorted(p.toString() for p in found if p.getName().startswith("v") and fs.exists(path(p, "_SUCCESS")))


def load_star(tables: Mapping[str, DataFrame], root: str, prefix: str = "") -> dict[str, str]:
    """Replace every star table (dimensions first, then facts): new versions under
    ``root``, names in the catalog with ``prefix``."""
    order = sorted(tables, key=lambda n: (not n.startswith("dim_"), n))
    out = {}
    for name in order:
        df = tables[name]
        parts: tuple[str, ...] = ()
        if name == "fact_sales":
            df = df.withColumns({"year": F.year("sale_date"), "month": F.month("sale_date")})
            parts = ("year", "month")
        out[name] = replace_table(df, prefix + name, root, parts)
    return out

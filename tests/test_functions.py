from pyspark.sql import functions as F

from tillroll.functions import clip, safe_divide, standardize_name, status_flag, str_title


def test_standardize_name():
    assert standardize_name(" Product-ID ") == "product_id"
    assert standardize_name("Unit  Price (Rs)") == "unit_price_rs"
    assert standardize_name("Sale-Date ") == "sale_date"


def test_str_title_matches_python(spark):
    words = ["hi-fi o'neil", "ELECTRONICS", "middle east", "a1b2 c", "", "x", "élan VITAL", "they're", "ÖL-straße"]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    got = {r.w: r.t for r in df.select("w", str_title("w").alias("t")).collect()}
    for w in words:
        assert got[w] == w.title(), w
    assert got[None] is None


def test_safe_divide_and_clip(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (4.0, None), (6.0, 3.0)], "a double, b double")
    r = df.select(safe_divide("a", "b", 0).alias("d"), safe_divide("a", "b").alias("n"),
                  clip("a", 2.0, 5.0).alias("c")).collect()
    assert [x.d for x in r] == [0, None, 0, 2.0]        # alt only for zero/blank denominators
    assert [x.n for x in r] == [None, None, None, 2.0]
    assert [x.c for x in r] == [2.0, None, 4.0, 5.0]    # NULL stays NULL


def test_status_flag(spark):
    df = spark.createDataFrame([(10.0,), (3.0,), (-1.0,), (None,)], "v double")
    hi = [r[0] for r in df.select(status_flag("v", 5, 0, True)).collect()]
    lo = [r[0] for r in df.select(status_flag("v", 7, 10, False)).collect()]
    assert hi == [1, 2, 3, 2]      # BLANK compares as 0
    assert lo == [2, 1, 1, 1]


def test_title_case_with_acronyms(spark):
    from tillroll.functions import str_title
    df = spark.createDataFrame([("usa east",), ("Usage of uSa-uk",), (None,)], "t string")
    assert [r[0] for r in df.select(str_title("t", ["USA", "UK"])).collect()] == ["USA East", "Usage Of USA-UK", None]
    assert [r[0] for r in df.select(str_title("t")).collect()] == ["Usa East", "Usage Of Usa-Uk", None]

from tillroll.llm import urls
from tillroll.llm.queries import op7_url_filter

from .conftest import SF

URLS = {1: "http://WWW.Example.com/en/1?x", 2: "https://a.example.com/en/2", 3: "http://b.com/", 4: "x://c.com",
        5: "http://q.net/es/3#t", 6: "http://q.net/de/3", 7: None, 8: "no address", 9: "http://", 10: "a://h.org?x://y/z",
        11: "http://xexample.com/en/4", 12: "http://Example.com/EN/4"}


def judged(spark, labels=(), more=()):
    pages = spark.createDataFrame([*URLS.items(), *more], "page_id long, url string").withColumn("host", urls.F.lit("x"))
    return {r.page_id: r for r in urls.judge(
        pages, spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")).collect()}


def test_hosts_paths_and_rules(spark):
    r = judged(spark)
    assert len(r) == len(URLS)
    assert (r[1].host, r[1].path, r[1].rule, r[1].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert (r[2].rule, r[2].verdict) == ("example.com/en/", "block")
    assert (r[3].rule, r[3].path) == ("com/", "/") and (r[4].host, r[4].path, r[4].rule) == ("c.com", "", None)
    assert (r[5].rule, r[5].verdict) == ("net/es/", "block") and r[6].rule is None
    for k in (7, 8, 9):
        assert (r[k].host, r[k].path, r[k].rule, r[k].verdict) == ("", "", None, "allow")
    assert (r[10].host, r[10].path) == ("h.org", "") and r[11].rule == "com/" and r[12].rule == "com/"


def test_reputation_shrinks_and_blocks(spark):
    more = [(100 + k, f"http://bad.org/en/{k}") for k in range(60)] + [
        (200 + k, f"http://good.org/en/{1000 + k}.html") for k in range(60)] + [(300, "http://few.org/en/5000/")]
    labels = [(k, 0, 0) for k in range(60)] + [(1000 + k, 1, 0) for k in range(60)] + [
        (5000, 0, 1), (5000, 1, 0), (None, 0, 0), (7, None, None)]
    r = judged(spark, labels, more)
    assert r[100].verdict == "block" and r[200].verdict == "allow" and r[300].verdict == "allow"
    assert r[100].bad_mean > r[300].bad_mean > r[200].bad_mean


def test_query_matches_sql(spark, same):
    same(op7_url_filter(spark, SF), urls.SQL)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(pages, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0

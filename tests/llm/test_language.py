import math

import numpy as np
import pytest

from tillroll.llm import language as L
from tillroll.llm.queries import op1_language_id

from .conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, likely string"


def test_query_judges_every_document_and_page(spark, docs):
    rows = op1_language_id(spark, SF).collect()
    pages = spark.read.parquet(f"{SF}/pages.parquet").count()
    told = {r.doc_id: r.lang for r in docs.collect()}
    own = [r for r in rows if r.doc_id is not None]
    assert len(own) == len(told) and len(rows) == len(told) + pages
    assert all(r.kept and r.lang == told[r.doc_id] for r in own)
    assert sum(r.lang == r.declared for r in rows if r.page_id is not None) >= 0.95 * pages
    assert all(abs(sum((r.p_de, r.p_en, r.p_es, r.p_fr, r.p_und)) - 1) < 1e-9 for r in rows)


def plain(model, text):
    total, n = np.zeros(model.shape[1]), 0
    for b in L.buckets(text):
        for x in b:
            total += model[x]
            n += 1
    return n, total * min(1.0, L.TEMPER / n) if n else total


def test_posterior_matches_plain_bayes(spark, docs):
    """The fused posterior against a plain Python version, host by host."""
    some = docs.limit(60)
    records = L.documents_evidence(some).withColumn("domain", L.F.substring("host", 1, 4)).withColumn(
        "suffix", L.F.substring("host", 1, 3))
    model = L.train(records).astype(np.float32)
    rows = records.collect()
    names = [*L.LANGUAGES, L.UND]
    seen = {r.id: plain(model.astype(float), r.text) for r in rows}
    vote = {i: names[int(np.argmax(x[1]))] for i, x in seen.items()}
    tags = [*L.LANGUAGES, "other", "none"]

    def shares(keys):  # counts by level
        return [sum(vote[r.id] == x for r in rows if all(r[k] == v for k, v in keys.items())) for x in names]

    top = [(n + 1) / (len(rows) + len(names)) for n in shares({})]
    got = {r.id: r for r in L.identify(records).collect()}
    for r in rows:
        up = top
        for keys in ({"suffix": r.suffix}, {"suffix": r.suffix, "domain": r.domain}):
            n = shares(keys)
            up = [(a + L.SHRINK * p) / (sum(n) + L.SHRINK) for a, p in zip(n, up, strict=True)]
        host = [a - (vote[r.id] == x) + L.SHRINK * p
                for a, p, x in zip(shares({"host": r.host, "domain": r.domain}), up, names, strict=True)][:-1]
        logs = []
        for k, x in enumerate(L.LANGUAGES):
            told = [sum(vote[o.id] == x and o.declared == t and seen[o.id][0] > 0 for o in rows) for t in tags]
            says = math.log((told[tags.index(r.declared)] + 1) / (sum(told) + len(tags)))
            logs.append(math.log(host[k] / sum(host) * (1 - L.UND_PRIOR)) + says + seen[r.id][1][k])
        logs.append(math.log(L.UND_PRIOR) - math.log(len(tags)) + seen[r.id][1][-1])
        odds = np.exp(np.array(logs) - max(logs))
        assert got[r.id].p_en == pytest.approx(odds[1] / odds.sum(), rel=1e-4, abs=1e-9)


def test_odd_rows(spark, docs, saved):
    odd = [(10_001, "Это совсем другой язык, которого здесь нет вовсе", "ru", "s", ""), (10_002, None, "en", "s", ""),
           (10_003, "12345 !!! 678", "en", None, ""), (10_004, "", None, "s", ""), (None, "", None, None, ""),
           (10_005, "the the and of the with", None, "src1", ""), (10_005, "the the and of the with", None, "src1", "")]
    some = docs.limit(150).select("doc_id", "text", "lang", "source", L.F.lit("x").alias("likely"))
    df = some.union(spark.createDataFrame(odd, SCHEMA))
    kept = L.drop_unknown(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == 150 + 3 and None in ids and ids.count(10_005) == 2
    judged = {r.id: r for r in L.identify(L.documents_evidence(df)).collect()}
    assert judged[10_005].lang == "en" and judged[10_001].lang == "und" and not judged[10_002].kept


def test_host_prior_decides_what_the_text_leaves_open(spark, docs):
    base = docs.limit(150)
    hosts = [(10_000 + k, r.text, r.lang, "germans", 0) for k, r in
             enumerate(docs.filter("lang = 'de'").limit(15).collect())] + [(20_000, "Ein.", None, "germans", 0)]
    df = base.union(spark.createDataFrame(hosts, "doc_id long, text string, lang string, source string, n_chars long"))
    judged = {r.id: r for r in L.identify(L.documents_evidence(df)).collect()}
    assert judged[20_000].lang == "de"


def test_pages_markup_and_address(spark):
    rows = [(1, "http://A.example.de/x", "<html lang='DE-at'><script>var x = 'the and';</script><p>Der Text<br>hier</p>")]
    r = L.pages_evidence(spark.createDataFrame(rows, "page_id long, url string, html string")).first()
    assert (r.declared, r.host, r.domain, r.suffix) == ("de", "a.example.de", "example.de", "de")
    assert r.text.split() == ["Der", "Text", "hier"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert L.identify(L.documents_evidence(df)).count() == 0 and L.drop_unknown(df).count() == 0


def test_rare_languages_and_hot_texts_leave_the_sample_whole(spark):
    rows = [(f"common word {k}", "en") for k in range(300)] + [("hot text", "de")] * 300 + [
        (f"selten {w}", "de") for w in ("baum", "haus", "wald")] + [("mot rare", "fr")]
    records = spark.createDataFrame(rows, "text string, declared string")
    model = L.train(records, sample_texts=5)
    each = {x: model[:, k] for k, x in enumerate(L.LANGUAGES)}
    bucket = {t: next(L.buckets(t)) for t, _ in rows}
    assert all((each["fr"][b] > each["es"][b]).all() for b in [bucket["mot rare"]])
    for t in ("hot text", "selten baum", "selten haus", "selten wald"):
        assert (each["de"][bucket[t]] > each["es"][bucket[t]]).all()
    assert len(set(each["en"].tolist())) > 1 and len(set(each["es"].tolist())) == 1
    # each text counts once, however often it is repeated
    assert (model == L.train(records.distinct(), sample_texts=5)).all()


def test_broken_markup_takes_linear_time(spark):
    """Openings that never close: twice the page, less than three times the work."""
    import time
    for piece in ("<!-- ", "<script ", "<", "<html lang", "<style></"):
        took = []
        for n in (200_000, 400_000):
            page = spark.createDataFrame([(1, "http://a.b/", piece * (n // len(piece)))], "page_id long, url string, html string")
            L.pages_evidence(page).collect()
            t = time.perf_counter()
            L.pages_evidence(page).collect()
            took.append(time.perf_counter() - t)
        assert took[1] < 3 * max(took[0], 0.3), (piece, took)


def test_unclosed_markup(spark):
    rows = [(1, "a <b>c</b> d < e"), (2, "x <!-- y <p> z"), (3, "u <script> v </script > w <style> t")]
    df = spark.createDataFrame([(i, "http://h/", h) for i, h in rows], "page_id long, url string, html string")
    assert [" ".join(r.text.split()) for r in L.pages_evidence(df).orderBy("id").collect()] == ["a c d < e", "x", "u w"]

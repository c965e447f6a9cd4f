"""The pipeline against plain Python, stage by stage."""

import hashlib

import corpus_pipeline
import public_tokenizers as P
from tokenizers import Tokenizer

from .conftest import SF
from .test_decontaminate import distance
from .test_exact_dedup import digest
from .test_jaccard_join import brute


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_match_plain_python(spark, docs, tmp_path):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    item = bench[0].text
    planted = [(90_001, "Совсем другой язык, которого в корпусе нет.", "ru", "src1", 0), (90_002, "123 456", "en", "src2", 0),
               (90_003, docs.first().text.upper(), "en", "src3", 0),
               (90_004, "Before it. " + item[:60] + "x" + item[60:] + " After it.", "en", "src4", 0)]
    start = docs.union(spark.createDataFrame(planted, docs.schema))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join",
                                                      "benchmark decontamination", "BPE"]
    frames = [start]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, frames[-1], SF).write.parquet(path)
        frames.append(spark.read.parquet(path))
        assert k == 4 or sorted(frames[-1].columns) == sorted(docs.columns)
    texts = [rows_of(f) for f in frames[:5]]

    assert set(texts[0]) - set(texts[1]) == {90_001, 90_002}
    last = {}
    for i, t in texts[1].items():
        last[digest(t)] = max(i, last.get(digest(t), i))
    assert set(texts[2]) == set(last.values())
    low = {c if n else i for i, n, c in brute(sorted(texts[2].items()))}
    assert set(texts[3]) == low
    gone = set(texts[3]) - set(texts[4])
    exact = {i for i, t in texts[3].items() if any(b.text in t for b in bench)}
    assert exact <= gone and 90_004 in gone
    for i in gone - exact:
        assert any(distance(b.text[k:k + 100], texts[3][i]) <= 10 for b in bench for k in (0, max(0, len(b.text) - 100)))
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    final = frames[5].collect()
    assert {r.doc_id for r in final} == set(texts[4])
    for r in final:
        ids = tok.encode(texts[4][r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[4][r.doc_id].encode()).hexdigest()


def test_run_applies_every_stage(spark, docs):
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() < docs.count() and "n_tokens" in out.columns


def test_stages_take_empty_tables(spark, docs):
    df = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df, SF).count() == 0


def test_a_column_named_like_a_helper_column(spark):
    from tillroll.llm.common import without_ids
    docs = spark.createDataFrame([(1, "a", 7), (2, "b", 8), (None, "c", 9)], "doc_id long, text string, gone_id int")
    out = without_ids(docs, spark.createDataFrame([(2,), (None,)], "doc_id long"), "doc_id")
    assert out.columns == docs.columns and sorted(r.text for r in out.collect()) == ["a", "c"]

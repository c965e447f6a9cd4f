"""Language identification by Bayesian evidence fusion.

Four pieces of evidence meet in one posterior over LANGUAGES and "und" (none of
them):

* the text: multinomial likelihood of its letter trigrams, tempered to the
  weight of TEMPER trigrams, because overlapping trigrams repeat themselves;
* the language that the markup or the table declares: how often each language
  is declared as what, counted over the whole corpus;
* the address suffix and the host: the share of each language among the host's
  other texts, shrunk towards its registered domain, that towards its suffix,
  and that towards the whole corpus, all by grouped aggregation.

The trigram model is fitted on a bounded sample of texts with a declared
language; every count of the corpus covers all rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import urls
from .common import cut, ship_code, tidy, without_ids

LANGUAGES = ("de", "en", "es", "fr")
UND = "und"
#: Distinct texts of each declared language that the trigram model is fitted on (the bound of its sample).
SAMPLE_TEXTS = 4000
#: Trigrams are counted in 2 ** BUCKET_BITS buckets.
BUCKET_BITS = 15
#: Most trigrams that a text's likelihood weighs; share of a model's mass spread evenly.
TEMPER, SPREAD = 300.0, 0.02
#: Weight, in texts, of the level above in a host's, domain's or suffix's prior.
SHRINK = 10.0
#: Prior share of "und", and the posterior a language must reach.
UND_PRIOR, LEAST_POSTERIOR = 0.02, 0.5
#: Texts and characters handled together in a task.
CHUNK, PIECE = 256, 1 << 20

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def buckets(text: str) -> Iterator[np.ndarray]:
    """The buckets of a text's letter trigrams, word borders included, a bounded
    piece at a time."""
    for at in range(0, len(text), PIECE):
        flat = " " + _NOT_LETTERS.sub(" ", text[at:at + PIECE].lower()).strip() + " "
        if len(flat) < 3:
            continue
        c = np.frombuffer(flat.encode("utf-32-le"), dtype=np.uint32)
        h = (c[:-2] * np.uint32(0x9E3779B1) + c[1:-1]) * np.uint32(0x85EBCA6B) + c[2:]
        yield ((h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BUCKET_BITS)


def declared_language(c: Column, languages: Sequence[str] = LANGUAGES) -> Column:
    """A declared tag as one of ``languages``, "other", or "none"."""
    tag = F.lower(F.regexp_extract(F.trim(F.coalesce(c, F.lit(""))), "^[A-Za-z]+", 0))
    return F.when(tag.isin(*languages), tag).when(tag == "", "none").otherwise("other")


def documents_evidence(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang",
                       host_col: str = "source") -> DataFrame:
    """Documents as records: id, text, declared, host, domain, suffix.  A source is
    a host of its own, under no domain."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       declared_language(F.col(declared_col)).alias("declared"),
                       F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                       F.lit("").alias("domain"), F.lit("").alias("suffix"))


def pages_evidence(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Web pages as records; the markup is taken off the text."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    # an opening that never closes takes the rest with it (a plain < does not): no position is scanned twice
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>", " ")
    tag = F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    host, _ = urls.parts(F.col(url_col))
    labels = F.split(host, r"\.")
    return pages.select(F.col(id_col).alias("id"), text.alias("text"), declared_language(tag).alias("declared"),
                        host.alias("host"),
                        F.array_join(F.slice(labels, -F.least(F.lit(2), F.size(labels)), 2), ".").alias("domain"),
                        F.element_at(labels, -1).alias("suffix"))


def train(records: DataFrame, languages: Sequence[str] = LANGUAGES, sample_texts: int = SAMPLE_TEXTS) -> np.ndarray:
    """Log-probability of each bucket (rows) in each language and in "und" (columns),
    from at most ``sample_texts`` distinct texts declared in each language, those
    of the smallest hashes."""
    ship_code(__name__, "tillroll.llm.urls")
    size = 1 << BUCKET_BITS
    known = records.filter(F.col("declared").isin(*languages)).select("text", "declared", F.xxhash64("text").alias("hash"))
    hashes = cut(known.select("declared", "hash").distinct())  # a hot text is one row a task
    drawn = [hashes.filter(F.col("declared") == x).orderBy("hash").limit(sample_texts) for x in languages]
    picked = known.join(F.broadcast(reduce(DataFrame.union, drawn)), ["declared", "hash"]).groupBy(
        "declared", "hash").agg(F.min("text").alias("text"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {x: np.zeros(size, dtype=np.int64) for x in languages}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for b in buckets(text):
                    sums[lang] += np.bincount(b, minlength=size)
        for lang, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()),
                                              pa.array(s[at], pa.int64())], ["lang", "bucket", "n"])

    counted = picked.select("text", "declared").mapInArrow(tidy(tally), "lang string, bucket long, n long")
    model = np.zeros((size, len(languages) + 1))
    for r in counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():  # languages * buckets at most
        model[r.bucket, languages.index(r.lang)] = r.n
    total = model.sum(axis=0)
    model = np.divide(model, total, out=np.full_like(model, 1 / size), where=total > 0)
    return np.log((1 - SPREAD) * model + SPREAD / size)


def text_evidence(records: DataFrame, model: np.ndarray) -> DataFrame:
    """``records`` with ``weight`` (trigrams weighed) and ``likely``, the tempered
    log-likelihoods, instead of the text."""
    ship_code(__name__, "tillroll.llm.urls")
    sent = records.sparkSession.sparkContext.broadcast(model.astype(np.float32))  # buckets * languages

    @F.arrow_udf("array<double>")
    def likely(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def run(batches):
            table = sent.value
            for batch in batches:
                out: list[list[float]] = []
                for at in range(0, len(batch), CHUNK):
                    for text in batch.slice(at, CHUNK).to_pylist():
                        total, n = np.zeros(table.shape[1]), 0
                        for b in buckets(text or ""):
                            total += table[b].sum(axis=0, dtype=np.float64)
                            n += len(b)
                        weight = min(1.0, TEMPER / n) if n else 0.0
                        out.append([float(n), *(total * weight).tolist()])
                yield pa.array(out, pa.list_(pa.float64()))

        yield from tidy(run)(batches)

    return records.withColumn("likely", likely("text")).drop("text")


def _rates(level: DataFrame, up: list[str], names: Sequence[str], k: int) -> DataFrame:
    """The level's shares of each language, shrunk towards those above (``up``)."""
    total = sum((F.col(f"n_{x}") for x in names), F.lit(0))
    return level.select("*", *[((F.col(f"n_{x}") + SHRINK * F.col(u)) / (total + SHRINK)).alias(f"p{k}_{x}")
                               for x, u in zip(names, up, strict=True)])


def host_priors(voted: DataFrame, names: Sequence[str]) -> DataFrame:
    """For each host its count of texts by language (n_) and its domain's shrunk
    shares (d_).  ``voted``: host, domain, suffix, vote."""
    votes = [F.count(F.when(F.col("vote") == x, 1)).alias(f"n_{x}") for x in names]
    hosts = cut(voted.groupBy("host", "domain", "suffix").agg(*votes))  # summed map-side: a hot host is one row a task
    sums = [F.sum(f"n_{x}").alias(f"n_{x}") for x in names]
    total = sum((F.col(f"n_{x}") for x in names), F.lit(0))
    top = hosts.agg(*sums).select(*[
        ((F.coalesce(F.col(f"n_{x}"), F.lit(0)) + 1) / (F.coalesce(total, F.lit(0)) + len(names))).alias(f"a_{x}")
        for x in names])
    suffixes = _rates(hosts.groupBy("suffix").agg(*sums).crossJoin(F.broadcast(top)),  # one row
                      [f"a_{x}" for x in names], names, 1).select("suffix", *[f"p1_{x}" for x in names])
    domains = _rates(hosts.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix"),
                     [f"p1_{x}" for x in names], names, 2)
    domains = domains.select("domain", "suffix", *[F.col(f"p2_{x}").alias(f"d_{x}") for x in names])
    return cut(hosts.join(domains, ["domain", "suffix"]))


def identify(records: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """One row per record (id, text, declared, host, domain, suffix): id, lang,
    posterior, text_lang, declared, kept, and for each language its posterior.

    ``kept`` is false, and ``lang`` "und", where no language reaches
    LEAST_POSTERIOR or the text has no letter.  On ties the first language in
    order wins.  Null ids and repeated rows are judged like others; an empty
    table gives an empty result.
    """
    names = [*languages, UND]
    likely = F.col("likely")
    texts = F.slice(likely, 2, len(names))
    vote = F.element_at(F.array(*map(F.lit, names)), F.array_position(texts, F.array_max(texts)).cast("int"))
    seen = cut(text_evidence(records, train(records, languages)).withColumn("vote", vote))
    # how each language is declared: at most (languages + 2) * (languages + 1) rows
    told = {(r.vote, r.declared): r.n for r in
            seen.filter(F.element_at("likely", 1) > 0).groupBy("vote", "declared").agg(F.count(F.lit(1)).alias("n")).collect()}
    tags = [*languages, "other", "none"]
    priors = host_priors(seen, names)
    joined = seen.join(priors, ["host", "domain", "suffix"])  # plain exchanges: AQE splits a hot host

    def says(x: str) -> Column:
        if x == UND:
            return F.lit(-math.log(len(tags)))
        row = sum(told.get((x, t), 0) for t in tags)
        return F.element_at(F.create_map(*[F.lit(v) for t in tags for v in (
            t, math.log((told.get((x, t), 0) + 1) / (row + len(tags))))]), F.col("declared"))

    # a text is no evidence for itself: its own vote is taken off its host's count
    weights = F.array(*[F.col(f"n_{x}") - F.when(F.col("vote") == x, 1).otherwise(0) + SHRINK * F.col(f"d_{x}")
                        for x in languages])
    scored = joined.select("id", "declared", "likely", "vote", weights.alias("weights")).select(
        "*", F.aggregate("weights", F.lit(0.0), lambda s, w: s + w).alias("all"))
    logs = F.array(*[F.log(F.element_at("weights", i + 1) / F.col("all") * (1 - UND_PRIOR)) + says(x)
                     + F.element_at(likely, i + 2) for i, x in enumerate(languages)],
                   F.lit(math.log(UND_PRIOR)) + says(UND) + F.element_at(likely, len(names) + 1))
    logged = scored.select("id", "declared", "vote", F.element_at(likely, 1).alias("letters"), logs.alias("logs"))
    raised = logged.select("*", F.transform("logs", lambda x: F.exp(x - F.array_max("logs"))).alias("odds"))
    shared = raised.select("id", "declared", "vote", "letters", F.transform(
        "odds", lambda x: x / F.aggregate("odds", F.lit(0.0), lambda s, y: s + y)).alias("shares"))
    # the best language: its number is the first place of the highest share
    best = shared.select("*", F.array_max(F.slice("shares", 1, len(languages))).alias("posterior"))
    named = best.select("*", F.element_at(F.array(*map(F.lit, languages)),
                                          F.array_position("shares", F.col("posterior")).cast("int")).alias("first"),
                        ((F.col("posterior") >= LEAST_POSTERIOR) & (F.col("letters") > 0)).alias("kept"))
    return named.select("id", F.when(F.col("kept"), F.col("first")).otherwise(UND).alias("lang"), "posterior",
                        F.col("vote").alias("text_lang"), "declared", "kept",
                        *[F.element_at("shares", i + 1).alias(f"p_{x}") for i, x in enumerate(names)])


def drop_unknown(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang",
                 host_col: str = "source") -> DataFrame:
    """``docs`` without the documents whose language is none of LANGUAGES; rows and
    columns of the others stay as they are.  Only the ids of rejected documents
    move; a document without an id is kept."""
    judged = cut(identify(documents_evidence(docs, id_col, text_col, declared_col, host_col)).select("id", "kept"))
    return without_ids(docs, judged.filter(~F.col("kept")).select(F.col("id").alias(id_col)), id_col)

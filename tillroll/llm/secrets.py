"""Secret scans with a trigram inverted index.

Every rule's regular expression is compiled into a Boolean query over the
trigrams that any match must contain (an OR of ANDs, in lower case).  Texts are
indexed a segment at a time (one Arrow batch of a partition): for each trigram
that some rule asks for, the posting list of the segment's texts that contain
it.  A rule intersects and unites its postings and its regular expression runs
over the candidates' whole texts only.  Rules without mandatory trigrams, such
as bare hexadecimal runs, scan every text.  Segments are independent: no
shuffle, and a lost task is simply run again.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_code

#: An exact set of strings that grows past these is broken off; the query stays sound, only weaker.
MAX_STRINGS, MAX_CHOICES = 64, 8


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least
    ``least`` characters.  Base rules come first in span order.  ``linear`` gives
    the same matches, as its group 1, where searching ``pattern`` itself would
    scan a run anew from many starts."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False
    linear: str = ""


#: In the order in which spans with the same start are listed.  The first three are the base.
RULES = (
    Rule("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 36,
         # a run is entered at its start only, and only if all that must follow it does
         linear=r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-])[A-Za-z0-9_-]*?"
                r"(eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]+", 0, 24),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("login", r"://[^/\s:@]{1,256}:[^/\s:@]{1,256}@"),
)

ANY = frozenset([frozenset()])  # the query that every text passes
Query = frozenset  # an OR of ANDs: a set of sets of trigrams


def _fold(s: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in s)


def _both(a: Query, b: Query) -> Query:
    if a == ANY or b == ANY:
        return b if a == ANY else a
    if len(a) * len(b) > MAX_STRINGS:
        return min(a, b, key=len)
    return frozenset(x | y for x, y in product(a, b))


def _of_strings(strings: set[str]) -> Query:
    """The query of texts that contain one of ``strings``."""
    if any(len(s) < 3 for s in strings):
        return ANY
    return frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def _node(op, arg) -> tuple[set[str] | None, Query]:
    """The exact strings (folded) that a node matches, or None, and its query."""
    if op is sre.LITERAL:
        return {_fold(chr(arg))}, ANY
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= MAX_CHOICES:
        return {_fold(chr(c)) for _, c in arg}, ANY
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        if all(s is not None for s, _ in parts) and sum(len(s) for s, _ in parts) <= MAX_STRINGS:
            return set().union(*(s for s, _ in parts)), ANY
        queries = [_of_strings(s) if s is not None else q for s, q in parts]
        return None, ANY if ANY in queries else frozenset().union(*queries)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, body = arg
        strings, query = _sequence(body)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, ANY
        if least == 0:
            return None, ANY
        if strings is not None and least == most and len(strings) ** least <= MAX_STRINGS:
            return {"".join(p) for p in product(strings, repeat=least)}, ANY
        return None, _of_strings(strings) if strings is not None else query
    if op is sre.AT:
        return {""}, ANY
    return None, ANY


def _sequence(parsed) -> tuple[set[str] | None, Query]:
    query, run, whole = ANY, {""}, True
    for op, arg in parsed:
        strings, inner = _node(op, arg)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        query, whole = _both(query, _of_strings(run)), False
        run = strings if strings is not None else {""}
        query = _both(query, inner)
    if whole:
        return run, ANY
    return None, _both(query, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """The Boolean query over lower-case trigrams that every match of
    ``pattern`` satisfies; ``ANY`` if no trigram is mandatory."""
    strings, query = _sequence(sre_parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


class Index:
    """Postings of one segment of texts for the trigrams that the rules ask for."""

    def __init__(self, texts: Sequence[str], trigrams: Sequence[str]):
        self.size = len(texts)
        folded = [t.lower() for t in texts]
        self.postings = {g: np.array([i for i, t in enumerate(folded) if g in t], dtype=np.int64) for g in trigrams}

    def candidates(self, query: Query) -> np.ndarray:
        found = np.zeros(0, dtype=np.int64)
        for grams in query:
            hits = np.arange(self.size)
            for posting in sorted((self.postings[g] for g in grams), key=len):
                hits = np.intersect1d(hits, posting, assume_unique=True)
            found = np.union1d(found, hits)
        return found


def scan_segment(texts: Sequence[str], rules: Sequence[Rule]) -> list[list[tuple[int, int, int]]]:
    """Spans (start, rule number, end) of each text, in order."""
    queries = [trigram_query(r.pattern) for r in rules]
    index = Index(texts, sorted(set().union(*(g for q in queries for g in q))))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        regex, whole, group = re.compile(rule.linear or rule.pattern), int(bool(rule.linear)), 1 if rule.linear else rule.group
        for i in index.candidates(query):
            for m in regex.finditer(texts[i]):
                if m.end(group) - m.start(group) >= rule.least:
                    out[i].append((m.start(whole), k, m.end(whole)))
    return [sorted(x) for x in out]


SPAN = "struct<start:int,kind:string,end:int>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per input row: ``id_col`` and ``spans``, structs (start, kind,
    end) ordered by start, then rule order.

    Offsets are code points, end exclusive; matches of one rule don't overlap.
    Null or empty text has no spans.  Null ids and repeated rows pass through;
    an empty table gives an empty result; other columns are not read.
    """
    ship_code(__name__)
    rules = tuple(rules)
    span = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scan_segment([t or "" for t in batch.column(1).to_pylist()], rules)
            spans = [[{"start": a, "kind": rules[k].name, "end": b} for a, k, b in x] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], ["id", "spans"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(segments, f"id {kind}, spans array<{SPAN}>").withColumnRenamed("id", id_col)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts, hash and text form of the spans that ``scan`` returned."""
    base = [r.name for r in rules if r.base]

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")

    return found.select(
        id_col,
        *[count(n).alias(f"n_{n}") for n in base],
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))


def _sql(rules: Sequence[Rule]) -> str:
    """The digest in DuckDB: pieces before each match and matches alternate, so
    their lengths add up to the offsets."""
    def plain(pattern: str) -> str:  # case folding spelled out, as RE2 folds beyond ASCII
        body = re.sub(r"\(\?ai:([^)]*)\)", lambda m: re.sub(
            "[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[1]), pattern)
        return body.replace("'", "''")

    parts = []
    for k, r in enumerate(rules):
        hits = f"regexp_extract_all(text, '{plain(r.pattern)}', 0)"
        part = f"regexp_extract_all(text, '{plain(r.pattern)}', {r.group})"
        gaps = f"string_split_regex(text, '{plain(r.pattern)}')"
        parts.append(
            f"select doc_id, {k} ord, '{r.name}' kind, hits, kept, gaps, unnest(range(1, len(hits) + 1)) i "
            f"from (select doc_id, {hits} hits, {part} kept, {gaps} gaps from t) where len(hits) > 0")
    base = ", ".join(f"'{r.name}'" for r in rules if r.base)
    least = " ".join(f"when '{r.name}' then {r.least}" for r in rules)
    counts = ", ".join(f"count(*) filter (kind = '{r.name}') n_{r.name}" for r in rules if r.base)
    one = "kind || ':' || s || ':' || (s + len(hits[i]))"
    return f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
m as ({" union all ".join(parts)}),
s as (select *, list_sum(list_transform(gaps[1:i], lambda x: len(x)))::bigint
             + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: len(x))), 0)::bigint s
      from m where len(kept[i]) >= case kind {least} end),
g as (select doc_id, {counts},
             string_agg({one}, ',' order by s, ord) filter (kind in ({base})) b,
             string_agg({one}, ',' order by s, ord) a
      from s group by doc_id)
select t.doc_id, {", ".join(f"coalesce(n_{r.name}, 0) n_{r.name}" for r in rules if r.base)},
       sha256(coalesce(b, '')) base_sha256, coalesce(a, '') spans
from t left join g using (doc_id)
"""


#: What the query returns, in DuckDB (doc_id is unique there).
SQL = _sql(RULES)

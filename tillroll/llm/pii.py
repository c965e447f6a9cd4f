"""Personal data (native DataFrame code): regular expressions propose spans,
checksum and range validators confirm them, context words adjust a score.

Positions come from cutting the text at the matches: the pieces between
matches and the matches alternate, so their lengths add up to the offsets (in
code points) in two linear passes.  Every expression is written so that Java's
matcher stays linear on long runs: a run is only entered at its start or where
the last match ended, and repetitions are possessive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``pattern`` is a Java regex that has no capturing groups; ``need`` a cheap
    test that every text with a match passes; ``valid`` the validator over the
    matched text; ``words`` raise the score when one is near, before or after.
    """

    name: str
    pattern: str
    need: str
    valid: object
    score: float
    words: str
    base: bool = True


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """12 to 19 digits whose Luhn sum is a multiple of ten."""
    d = F.reverse(_digits(m))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(d)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substring(d, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         F.substring(d, i, F.lit(1)).cast("int") + 1)))
    return F.when(F.length(d).between(12, 19), total % 10 == 0).otherwise(F.lit(False))


def mod97(m: Column) -> Column:
    """IBAN check: the four leading characters go last, letters count 10 to 35,
    and the number leaves 1 when divided by 97."""
    flat = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, 1, 4))
    rest = F.aggregate(
        F.sequence(F.lit(1), F.length(turned)), F.lit(0),
        lambda acc, i: (lambda v: F.when(v < 10, acc * 10 + v).otherwise(acc * 100 + v) % 97)(
            F.conv(F.substring(turned, i, F.lit(1)), 36, 10).cast("int")))
    return F.when(F.length(flat).between(15, 34), rest == 1).otherwise(F.lit(False))


def octets(m: Column) -> Column:
    """Every part is at most 255, however many zeros lead."""
    return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3)
                    & (F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255))


def phone_digits(m: Column) -> Column:
    return F.length(_digits(m)).between(9, 15)


_LOCAL = "[A-Za-z0-9._%+-]"

#: In the order in which kinds with the same start are listed; the first four are the base.
KINDS = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')",
         lambda m: F.lit(True), 0.8, "mail|contact|write to|correo|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"text rlike '[0-9]\\.[0-9]'",
         octets, 0.5, "address|host|server|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", "text rlike '[0-9][ -]?[0-9]'",
         luhn, 0.6, "card|visa|credit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')",
         phone_digits, 0.6, "phone|call|mobile|fax|telefon|llame"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
         "text rlike '[A-Z][A-Z][0-9][0-9]'", mod97, 0.9, "iban|account|bank|konto|cuenta|compte", base=False),
)

#: Characters before and after a span in which a context word counts, and what it adds to the score.
CONTEXT_CHARS, CONTEXT_BONUS = 48, 0.15
#: Matches folded over at a time.
FOLD = 128


def _cut_text(kind: Kind) -> tuple[Column, Column]:
    """The matches of a kind, and the pieces of text before each."""
    text, need = F.col("text"), F.expr(kind.need)
    none = F.array().cast("array<string>")
    return (F.when(need, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(none),
            F.when(need, F.split(text, kind.pattern)).otherwise(none))


def _folded(items: Column, state: dict[str, Column], step: Callable[[Column, Column], Column], kind: str) -> Column:
    """The array that a fold over ``items`` appends to.

    An array that grows inside a fold is copied at every step, so it is built in
    blocks of ``FOLD``, and the blocks are gathered and flattened: many matches in
    one text cost little more each than few.  ``step`` gets and returns a struct of
    the fields of ``state`` and ``out``, an array of type ``kind``.
    """
    none = F.array().cast(f"array<{kind}>")
    kept = lambda s: [s.getField(f).alias(f) for f in state]

    def block(acc: Column, first: Column) -> Column:
        one = F.aggregate(F.slice(items, first, FOLD), F.struct(*kept(acc), none.alias("out")), step)
        # as a lambda's argument the block is worked out once, not once for each field
        return F.transform(F.array(one), lambda x: F.struct(
            *kept(x), F.array_append(acc.getField("done"), x.getField("out")).alias("done")))[0]

    size = F.size(items)
    firsts = F.when(size > 0, F.sequence(F.lit(1), size, F.lit(FOLD))).otherwise(F.array().cast("array<int>"))
    begin = F.struct(*[c.alias(f) for f, c in state.items()], F.array().cast(f"array<array<{kind}>>").alias("done"))
    return F.flatten(F.aggregate(firsts, begin, block, lambda acc: acc.getField("done")))


SPAN = "struct<start:int,ord:int,kind:string,end:int,score:double>"


def _spans(kind: Kind, order: int) -> Column:
    """Spans (start, order, kind, end, score) of a kind, failing matches dropped."""
    hits = F.col(f"hit_{kind.name}")
    numbers = F.when(F.size(hits) > 0, F.sequence(F.lit(1), F.size(hits))).otherwise(F.array().cast("array<int>"))
    return _folded(numbers, {"at": F.lit(0), "tail": F.lit("")}, lambda acc, i: _step(kind, order, acc, i), SPAN)


def _blank(hit: Column) -> Column:
    """A match as context of its neighbours: it takes its place and holds no word."""
    return F.repeat(F.lit(" "), F.least(F.length(hit), F.lit(CONTEXT_CHARS)))


def _step(kind: Kind, order: int, acc: Column, i: Column) -> Column:
    hits, gaps = F.col(f"hit_{kind.name}"), F.col(f"gap_{kind.name}")
    hit, gap = F.element_at(hits, i), F.element_at(gaps, i)
    begin = acc.getField("at") + F.length(gap)
    end = begin + F.length(hit)
    before = F.right(F.concat(acc.getField("tail"), F.right(gap, F.lit(CONTEXT_CHARS))), F.lit(CONTEXT_CHARS))
    # so many pieces reach CONTEXT_CHARS, as a match has five characters at least
    after = F.substring(F.array_join(F.zip_with(
        F.slice(gaps, i + 1, CONTEXT_CHARS // 5 + 2), F.slice(hits, i + 1, CONTEXT_CHARS // 5 + 2),
        lambda g, h: F.concat(F.substring(g, 1, CONTEXT_CHARS), F.coalesce(_blank(h), F.lit("")))), ""), 1, CONTEXT_CHARS)
    near = F.lower(before).rlike(kind.words) | F.lower(after).rlike(kind.words)
    score = F.lit(kind.score) + F.when(near, CONTEXT_BONUS).otherwise(0.0)
    span = F.struct(begin.alias("start"), F.lit(order).alias("ord"), F.lit(kind.name).alias("kind"),
                    end.alias("end"), score.cast("double").alias("score"))
    return F.struct(end.alias("at"), F.concat(before, _blank(hit)).alias("tail"),
                    F.when(kind.valid(hit), F.array_append(acc.getField("out"), span))
                    .otherwise(acc.getField("out")).alias("out"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col`` and ``spans``, an array of structs
    (start, ord, kind, end, score) ordered by start, then kind.

    A context word within CONTEXT_CHARS before or after a span raises its score,
    also beyond other matches of the kind, whose own text holds no context.
    Offsets are code points, end exclusive.  Matches of one kind don't overlap;
    matches of two kinds may.  Null or empty text has no spans; null ids and
    repeated rows pass through as they are; an empty table gives an empty result;
    other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = {k: _cut_text(k) for k in KINDS}
    rows = rows.select("id", *[c.alias(f"{p}_{k.name}") for k, (h, g) in pieces.items()
                               for p, c in (("hit", h), ("gap", g))])
    spans = F.concat(*[_spans(k, i) for i, k in enumerate(KINDS)])
    return rows.select(F.col("id").alias(id_col), F.array_sort(spans).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, hash and text form of the spans that ``find`` returned."""
    base = [k.name for k in KINDS if k.base]
    of = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")
    return found.select(
        id_col, *[of(n).alias(f"n_{n}") for n in base],
        F.sha2(_joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        of("iban").alias("n_iban"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("max_score"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.0) -> DataFrame:
    """``docs`` with every span of at least ``min_score`` replaced by its kind in
    angle brackets.  Spans that begin inside an earlier one go with it.  Native
    and row-wise: no shuffle, columns keep their names."""
    text = F.coalesce(docs[text_col], F.lit(""))
    work = docs.select(F.struct(*docs.columns).alias("row"), text.alias("text"))
    found = find(work, "row", "text").select("row", F.filter("spans", lambda s: s["score"] >= min_score).alias("spans"))
    body = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    # the spans that begin in no earlier one, then the text before each with its kind, then the rest
    kept = _folded(F.col("spans"), {"at": F.lit(0)}, lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(
        s["end"].alias("at"), F.array_append(a["out"], F.struct(a["at"].alias("from"), s["start"].alias("to"), s["end"], s["kind"]))
        .alias("out"))), "struct<from:int,to:int,end:int,kind:string>")
    found = found.withColumn("kept", kept)
    pieces = F.transform("kept", lambda k: F.concat(F.substring(body, k["from"] + 1, k["to"] - k["from"]), F.lit("<"), k["kind"], F.lit(">")))
    rest = F.coalesce(F.element_at(F.transform("kept", lambda k: k["end"]), F.when(F.size("kept") > 0, -1)), F.lit(0))
    out = F.concat(F.array_join(pieces, ""), F.substring(body, rest + 1, F.length(body)))
    return found.select(F.col("row"), out.alias("new")).select(
        *[(F.col("new") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])

"""Chat formatting by perspective rotation (native DataFrame code).

For every participant of a dialogue the dialogue is rendered once with that
speaker as the assistant and all others as named users; the mask lists the
stretches that the assistant says, on which a model would be trained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Turns rendered as one row.  Longer dialogues become consecutive parts, so that
#: no task gathers an unbounded dialogue; no turn is left out.
PART_TURNS = 512
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
UNKNOWN = "unknown"


def _clean(c: Column) -> Column:
    """Text cannot forge a marker."""
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def _parted(rows: DataFrame, part_turns: int) -> DataFrame:
    """``rows`` with the part each is in, by its place in the dialogue.  Rows of long
    dialogues are dealt out in ranges of their order, and counted by range before
    they are numbered, so that no task meets a whole one of them."""
    sizes = rows.filter(F.col("conv").isNotNull()).groupBy("conv").agg(F.count(F.lit(1)).alias("size"))
    long = cut(sizes.filter(F.col("size") > part_turns).select("conv"))
    if long.isEmpty():
        return rows.withColumn("part", F.lit(0).cast("long"))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    short = rows.join(long, "conv", "left_anti").withColumn("part", F.lit(0).cast("long"))
    dealt = cut(rows.join(long, "conv", "left_semi").repartitionByRange("conv", *order).withColumn(
        "range", F.spark_partition_id()))
    ranges = dealt.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n")).select("conv", "range", F.coalesce(F.sum(
        "n").over(Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("conv", "range").orderBy(*order)) - 1
    numbered = dealt.withColumn("place", place).join(ranges, ["conv", "range"])
    parted = numbered.withColumn("part", F.floor((F.col("before") + F.col("place")) / part_turns).cast("long"))
    return short.unionByName(parted.select(*short.columns))


def _perspectives(rows: DataFrame) -> DataFrame:
    """For dialogues of several parts: conv, part, speaker, and ``before``, the code
    points of the speaker's rendering before that part.  Counts by part and
    participant stand for the turns."""
    spoken = rows.filter(F.col("conv").isNotNull()).groupBy("conv", "part", "role").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text") + len(CLOSE)).alias("chars"))
    dialogue = Window.partitionBy("conv")
    spoken = spoken.select("*", F.min("part").over(dialogue).alias("first"), F.max("part").over(dialogue).alias("last")
                           ).filter("first < last")
    named = F.length("role") + len(OPEN + "user name=\n")
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spoken.groupBy("conv", "part").agg(F.sum(F.col("chars") + F.col("n") * named).alias("chars")).select(
        "conv", "part", F.sum("chars").over(so_far.partitionBy("conv")).alias("all"))
    pairs = parts.join(spoken.select("conv", "role").distinct(), "conv").join(
        spoken.select("conv", "part", "role", "n"), ["conv", "part", "role"], "left")
    own = F.sum("n").over(so_far.partitionBy("conv", "role"))  # turns headed as the assistant's instead
    return pairs.select("conv", "part", F.col("role").alias("speaker"), (
        F.coalesce("all", F.lit(0)) + F.coalesce(own, F.lit(0)) * (len(OPEN + "assistant\n") - named)
    ).cast("long").alias("before"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """One row for each part of a dialogue and each participant of the whole
    dialogue: ``conv_id``, part, speaker, n_turns, n_spoken, dialogue, mask.

    A speaker's parts, joined in order, are the whole dialogue from their
    perspective.  ``mask`` lists start:end of the speaker's own words with their
    end marker, comma-joined, in code points of that whole dialogue: offsets
    continue over the parts.  A participant who says nothing in a part has an
    empty mask there.  A part has ``part_turns`` rows, whatever their turn
    numbers, the last one the rest.  Turns go by turn number (a null one first), then role,
    then text.  Repeated rows count once.  A null role speaks as "unknown", a
    null text is empty, and a row without a conversation is a dialogue of its
    own.  An empty table gives an empty result; other columns are not read.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.translate(_clean(F.coalesce(F.col(role_col), F.lit(UNKNOWN))), "\n", " ").alias("role"),
        _clean(F.coalesce(F.col(text_col), F.lit(""))).alias("text")).distinct()
    rows = _parted(rows, part_turns).withColumn("alone", F.when(F.col("conv").isNull(), F.xxhash64("turn", "role", "text")))
    parts = rows.groupBy("conv", "part", "alone").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(1 << 63)).cast("long")).alias("turn"),
                                             "role", "text"))).alias("said"))
    # a dialogue in one part has its speakers at hand; the others' come from all of its parts
    here = F.transform(F.array_distinct(F.transform("said", lambda t: t["role"])),
                       lambda r: F.struct(r.alias("speaker"), F.lit(0).cast("long").alias("before")))
    each = parts.join(_perspectives(rows), ["conv", "part"], "left").select(
        "conv", "part", "said", F.explode(F.when(F.col("speaker").isNull(), here).otherwise(
            F.array(F.struct("speaker", "before")))).alias("as")).select("conv", "part", "said", "as.*")

    def head(t: Column) -> Column:
        return F.when(t["role"] == F.col("speaker"), F.lit(OPEN + "assistant\n")).otherwise(
            F.concat(F.lit(OPEN + "user name="), t["role"], F.lit("\n")))

    pieces = each.withColumn("pieces", F.transform("said", lambda t: F.struct(
        head(t).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"),
        (t["role"] == F.col("speaker")).alias("own"))))
    empty = F.array().cast("array<string>")
    mask = F.aggregate(
        "pieces", F.struct(F.col("before").alias("at"), empty.alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
            F.when(p["own"], F.array_append(a["spans"], F.concat_ws(
                ":", (a["at"] + F.length(p["head"])).cast("string"),
                (a["at"] + F.length(p["head"]) + F.length(p["body"])).cast("string")))
            ).otherwise(a["spans"]).alias("spans")))
    return pieces.select(
        F.col("conv").alias(conv_col), "part", "speaker", F.size("said").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_spoken"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("dialogue"),
        F.array_join(mask.getField("spans"), ",").alias("mask"))


#: What the query returns, in DuckDB.
SQL = f"""
with r as (
  select distinct conv_id, turn, replace(replace(coalesce(role, '{UNKNOWN}'), '<|', '< |'), chr(10), ' ') as role,
         replace(coalesce(text, ''), '<|', '< |') as text
  from conversations),
d as (select *, case when conv_id is null then hash(turn, role, text) end as alone from r),
p as (select *, (row_number() over (partition by conv_id, alone order by turn nulls first, role, text) - 1) // {PART_TURNS} as part
      from d),
s as (select distinct conv_id, alone, role as speaker from p),
h as (
  select p.*, s.speaker, p.role = s.speaker as own,
         case when p.role = s.speaker then '{OPEN}assistant' || chr(10)
              else '{OPEN}user name=' || p.role || chr(10) end as head,
         p.text || '{CLOSE.strip()}' || chr(10) as body
  from p join s on p.conv_id is not distinct from s.conv_id and p.alone is not distinct from s.alone),
o as (
  select *, sum(len(head) + len(body)) over (
           partition by conv_id, alone, speaker order by turn nulls first, role, text) as upto
  from h)
select conv_id, part, speaker, count(*) as n_turns, count(*) filter (own) as n_spoken,
       string_agg(head || body, '' order by turn nulls first, role, text) as dialogue,
       coalesce(string_agg(cast(upto - len(body) as bigint) || ':' || cast(upto as bigint), ','
                           order by turn nulls first, role, text) filter (own), '') as mask
from o group by conv_id, part, alone, speaker
"""

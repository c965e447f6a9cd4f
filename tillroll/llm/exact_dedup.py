"""Exact deduplication by two-pass Bloom filtering (native DataFrame code).

Pass 1 hashes every normalised text and builds a blocked Bloom filter of the
hashes that were hit at least twice: each hash sets two bits inside one
32,768-bit block, a bit enters the filter when two rows or more set it.  Only
bit numbers are shuffled, summed map-side first.  Pass 2 probes every row
against that filter (a broadcast whose size is ``filter_bits / 8`` bytes, a
bound fixed before it is built).  A row whose two bits are not both set is the
only one with its text and passes straight through; only the other rows
shuffle, keyed by the SHA-256 of the text, so false positives cost time and
never change a result.

Beyond ``MAX_FILTER_BITS / BITS_PER_ROW`` rows the filter lets more and more
unique rows into the shuffle; results stay whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut

#: Bits per row of the filter; two bits set per row give about 1.5 % false positives at worst.
BITS_PER_ROW = 16
#: Upper bound of the filter, 64 MB as a broadcast.
MAX_FILTER_BITS = 1 << 29
#: Bits in one block: what bitmap_construct_agg gathers in one 4 KB bitmap.
BLOCK_BITS = 32768


def normalise(text: Column) -> Column:
    """Null counts as the empty text; A-Z are lower-cased, nothing else changes."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def filter_blocks(rows: int, max_bits: int = MAX_FILTER_BITS) -> int:
    """Blocks of a filter for ``rows`` rows."""
    return max(1, min(max_bits, rows * BITS_PER_ROW) // BLOCK_BITS)


def _slots(digest: DataFrame, blocks: int) -> DataFrame:
    """Add the block and the two bits of each row's hash, from three separate
    stretches of its SHA-256 (column sha)."""
    word = lambda at, n: F.conv(F.substring(F.col("sha"), at, n), 16, 10).cast("long")
    return (digest.withColumn("block", word(1, 12) % F.lit(blocks))
                  .withColumn("bit1", (word(13, 8) % F.lit(BLOCK_BITS)).cast("int"))
                  .withColumn("bit2", (word(21, 8) % F.lit(BLOCK_BITS)).cast("int")))


def repeated_filter(hashes: DataFrame, blocks: int) -> DataFrame:
    """Pass 1 over the hashes (column sha): one 4 KB bitmap for each block, with
    the bits that two rows or more set.  Cut, because pass 2 broadcasts it."""
    bits = _slots(hashes, blocks).select("block", F.explode(F.array("bit1", "bit2")).alias("bit"))
    twice = bits.groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return cut(twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bitmap")))


def probe(rows: DataFrame, bitmaps: DataFrame, blocks: int) -> DataFrame:
    """Pass 2: add boolean ``possible`` to ``rows`` (which has column sha); it is
    false only where no other row has the same hash."""
    is_set = ("cast(conv(hex(substring(bitmap, shiftright({0}, 3) + 1, 1)), 16, 10) as int)"
              " & shiftleft(1, {0} & 7) != 0")
    joined = _slots(rows, blocks).join(F.broadcast(bitmaps), "block", "left")  # blocks * 4 KB at most
    both = F.expr(f"({is_set.format('bit1')}) and ({is_set.format('bit2')})")
    return joined.select(*rows.columns, F.coalesce(both, F.lit(False)).alias("possible"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     max_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    The largest id of equal texts is kept.  Null text equals the empty text.
    A null id is smaller than any other; a group of null ids only has keep_id
    null.  Rows that repeat the kept id are all marked kept, as they are one
    document.  An empty table gives an empty result; other columns of ``docs``
    are not read, whatever their names.
    """
    digest = cut(docs.select(F.col(id_col).alias("id"), F.sha2(normalise(F.col(text_col)), 256).alias("sha")))
    blocks = filter_blocks(digest.count(), max_bits)
    marked = cut(probe(digest, repeated_filter(digest.select("sha"), blocks), blocks))
    alone = marked.filter("not possible").select("id", F.col("id").alias("keep"),
                                                 F.lit(1).cast("long").alias("n"), "sha")
    again = marked.filter("possible").select("id", "sha")
    # map-side sums leave one row per hash and task of a hot group; the join back has
    # plain exchanges on both sides, so AQE can split a hot hash over many tasks
    groups = cut(again.groupBy("sha").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n")))
    shared = again.join(groups, "sha").select("id", "keep", "n", "sha")
    return alone.union(shared).select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``docs`` with one row for each normalised text: the one with the largest id
    (any one of them on a tie; a null id is smaller than any other).  All
    columns are kept, whatever their names.

    Rows pass straight through unless the filter marks them; marked rows are
    reduced map-side before they shuffle.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"),
                       F.sha2(normalise(docs[text_col]), 256).alias("sha"))
    hashes = cut(rows.select("sha"))
    blocks = filter_blocks(hashes.count(), max_bits)
    marked = probe(rows, repeated_filter(hashes, blocks), blocks)
    alone = marked.filter("not possible").select("row.*")
    order = F.struct(F.col("row").getField(id_col))
    best = marked.filter("possible").groupBy("sha").agg(F.max_by("row", order).alias("row"))
    return alone.union(best.select("row.*"))


#: What the query returns, in DuckDB.
SQL = """
with t as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) as text_sha256
  from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by text_sha256)
select t.doc_id, g.keep_id, g.group_size, t.doc_id is not distinct from g.keep_id as kept, t.text_sha256
from t join g using (text_sha256)
"""

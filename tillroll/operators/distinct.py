"""Exact distinct counts of integer ids that add up over any slice.

The state of a slice is a bitmap for each bucket of 32,768 neighbouring ids, 4 KB
however many ids it holds.  The ids are dealt by bucket before bitmaps are built: each
task has whole buckets, so a slice has one state a bucket in all, not one in every task
that saw an id of it, and states are merged without another shuffle.  They come sorted
by bucket, then by the columns of the slice, so slices by the first of these columns
are merged as the states stream by; only others sort them.  Every grouping is counted
by itself: no task holds copies of the states for several groupings.

Meant for ids that are numbers given one after another; ids scattered over all
longs would take a bitmap each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "_bucket", "_bits"


def distinct_states(df: DataFrame, id_col: str, by: Sequence[str] = ()) -> DataFrame:
    """One row for each slice and bucket: ``by``, _bucket, _bits.  NULL ids are not counted."""
    x = F.col(id_col).cast("bigint")
    ids = df.where(F.col(id_col).isNotNull()).select(
        *by, F.bitmap_bucket_number(x).alias(BUCKET), F.bitmap_bit_position(x).alias("_bit"))
    states = ids.repartition(BUCKET).groupBy(BUCKET, *by).agg(F.bitmap_construct_agg(F.col("_bit")).alias(BITS))
    return states.select(*by, BUCKET, BITS)


def merged_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of coarser slices."""
    return states.groupBy(BUCKET, *by).agg(F.bitmap_or_agg(F.col(BITS)).alias(BITS)).select(*by, BUCKET, BITS)


def distinct_count(states: DataFrame, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ids of each slice of ``by`` (one row without ``by``)."""
    count = F.coalesce(F.sum(F.bitmap_count(F.col(BITS))), F.lit(0)).cast("bigint").alias(out)
    return merged_states(states, by).groupBy(*by).agg(count)


def distinct_grouping_sets(states: DataFrame, out: str, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Distinct ids under each of several groupings at once: the columns of all sets, NULL
    where a set does not have them, _set (the position of the set) and ``out``."""
    cols = list(dict.fromkeys(c for s in sets for c in s))
    parts = [distinct_count(states, out, list(s)).where(F.col(out) > 0).select(F.lit(i).alias("_set"), *[
        F.col(c) if c in s else F.lit(None).cast(states.schema[c].dataType).alias(c) for c in cols], out)
        for i, s in enumerate(sets)]
    return reduce(DataFrame.union, parts)

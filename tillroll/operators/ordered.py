"""Order-dependent primitives that stay distributed.

A window with an ``orderBy`` but no ``partitionBy`` (global running sum,
global rank) and Spark's exact ``percentile`` aggregate both pull a whole
column into one task.  The helpers here compute the same exact results with
bounded per-task state:

* ``prefix_sum``    range-partition on the sort key, materialise the
                    partition id with a reliable checkpoint, add the totals of
                    earlier partitions (a table with one row per partition,
                    broadcast) to a window that runs inside each partition.
* ``global_rank``   RANK / DENSE_RANK over the whole frame in ranges of values,
                    ranked inside, offsets added (``row_number_global`` for
                    ROW_NUMBER).
* ``exact_quantiles`` linear-interpolated quantiles (pandas / DuckDB
                    ``quantile_cont``): brackets narrowed pass by pass, then counts.
* ``top_k``         ORDER BY ... LIMIT k with a deterministic tie-break
                    (``TakeOrderedAndProject``: k rows per task, merged).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import ensure_checkpoint_dir

_P = "__part"
# Fixed value: 1 / rank error of the sketch that brackets a quantile.
SKETCH_ACCURACY = 10_000
# Parts into which one pass cuts a bracket, and distinct values that a window may see for a position.
PIECES = 200
VALUES_LEFT = 100_000
# Groups whose brackets may be broadcast (a few MB), so that no group's rows meet in one task.
BROADCAST_GROUPS = 10_000


def _num_ranges(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL, so a NULL group keeps its
    rows; the left keys are returned once."""
    r = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys]
    return left.join(r, on, how).drop(*[f"__r_{k}" for k in keys])


def prefix_sum(df: DataFrame, order: Sequence[Column | str], sums: Sequence[str],
               partition_by: Sequence[str] = (), suffix: str = "_cum",
               inclusive: bool = True) -> DataFrame:
    """Running sums of ``sums`` in ``order``; see ``prefix_sum_totals``."""
    return prefix_sum_totals(df, order, sums, partition_by, suffix, inclusive)[0]


def prefix_sum_totals(df: DataFrame, order: Sequence[Column | str], sums: Sequence[str],
                      partition_by: Sequence[str] = (), suffix: str = "_cum",
                      inclusive: bool = True) -> tuple[DataFrame, DataFrame]:
    """Running sums of ``sums`` in ``order`` (ROWS frame), optionally per group.

    ``order`` must be a total order (add a unique key as the last tie-break)
    for the result to be repeatable.  The frame is range-partitioned once and
    checkpointed to the session's reliable checkpoint folder, so partition
    ids survive executor loss and are read consistently by both branches.

    Returns the rows with running sums and the grand totals per group.
    """
    ensure_checkpoint_dir(df.sparkSession)
    by = list(partition_by)
    keys = [F.col(c) for c in by] + _sort_cols(order)
    ranged = (df.repartitionByRange(_num_ranges(df), *keys)
                .withColumn(_P, F.spark_partition_id())
                .checkpoint(eager=True))
    tot = ranged.groupBy(_P, *by).agg(*[F.sum(c).alias(f"__t_{c}") for c in sums])
    w_prev = Window.partitionBy(*by).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    parts = tot.select(_P, *by, *[F.col(f"__t_{c}") for c in sums], *[
        F.coalesce(F.sum(f"__t_{c}").over(w_prev), F.lit(0)).alias(f"__o_{c}") for c in sums])
    # grand totals per group, from the per-partition sums of the checkpoint
    totals = tot.groupBy(*by).agg(*[F.sum(f"__t_{c}").alias(f"{c}_total") for c in sums])
    offsets = parts.drop(*[f"__t_{c}" for c in sums])
    if not by:
        # one row per range partition: bounded by the partition count
        offsets = F.broadcast(offsets)
    frame_end = Window.currentRow if inclusive else -1
    w_in = (Window.partitionBy(_P, *by).orderBy(*_sort_cols(order))
            .rowsBetween(Window.unboundedPreceding, frame_end))
    out = null_safe_join(ranged, offsets, [_P, *by])
    for c in sums:
        within = F.sum(c).over(w_in)
        if not inclusive:
            within = F.coalesce(within, F.lit(0))
        out = out.withColumn(f"{c}{suffix}", F.col(f"__o_{c}") + within)
    return out.drop(_P, *[f"__o_{c}" for c in sums]), totals


def global_rank(df: DataFrame, value: str, out: str = "rank", method: str = "rank",
                descending: bool = True, partition_by: Sequence[str] = ()) -> DataFrame:
    """SQL RANK / DENSE_RANK of ``value`` in ranges of values; NULL ranks last.

    rank  = 1 + number of rows with a strictly better value
    dense = number of distinct values at least as good
    The rows are checkpointed once (``df`` is evaluated once).  A sketch of the
    values (for other than numbers: some distinct values, picked by hash) gives the
    borders: every border value is a range of its own, what lies
    between two borders is another, so a value never straddles ranges.  Rows of a
    border value share their rank, however many there are; the rows between two
    borders, a small share of all, are ranked by a window, and the numbers of rows
    and values in earlier ranges are added.  Nothing is joined on the value.
    """
    if method not in ("rank", "dense"):
        raise ValueError(method)
    by = list(partition_by)
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.checkpoint(eager=True)
    pieces, v = min(_num_ranges(df) + 1, SKETCH_ACCURACY), F.col(value)
    if isinstance(df.schema[value].dataType, NumericType):
        drawn = F.percentile_approx(value, F.array(*[F.lit(i / pieces) for i in range(pieces + 1)]), F.lit(SKETCH_ACCURACY))
    else:
        drawn = F.array_compact(F.array(*[F.min_by(v, F.when(v.isNotNull(), F.xxhash64(v, F.lit(i)))) for i in range(min(pieces, 32))]))
    cuts = rows.groupBy(*by).agg(F.array_sort(F.array_distinct(drawn)).alias("__cuts"))
    j = null_safe_join(rows, cuts, by) if by else with_scalars(rows, cuts)
    # range number: borders below the value, doubled, and one more for a border itself
    on = F.array_contains("__cuts", v)
    below = F.size(F.filter("__cuts", lambda c: c < v))
    last = 2 * F.size("__cuts") + 2
    number = F.when(v.isNull(), F.coalesce(last, F.lit(0))).otherwise(
        2 * F.when(F.lit(descending), F.size("__cuts") - below - on.cast("int")).otherwise(below) + on.cast("int"))
    placed = j.withColumn("__range", number).withColumn("__alone", F.coalesce(on, F.lit(True))).drop("__cuts")
    sizes = placed.groupBy(*by, "__range", "__alone").agg(
        F.count(F.lit(1)).alias("__n"), *([] if method == "rank" else [_distinct_between(value)]))
    counted = "__n" if method == "rank" else "__d"
    # two rows a border: as many as there are borders, not rows
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "__range", F.coalesce(F.sum(counted).over(before), F.lit(0)).alias("__before"))
    order = v.desc_nulls_last() if descending else v.asc_nulls_last()
    inside = Window.partitionBy(*by, "__range").orderBy(order)
    within = (F.rank() if method == "rank" else F.dense_rank()).over(inside)
    # rows of a border value need no window: they keep out of the sort
    offsets = offsets if by else F.broadcast(offsets)
    alone = placed.where("__alone").withColumn("__r", F.lit(1))
    between = placed.where(~F.col("__alone")).withColumn("__r", within)
    both = null_safe_join(alone.unionByName(between), offsets, [*by, "__range"])
    return both.withColumn(out, (F.col("__before") + F.col("__r")).cast("int")).select(*df.columns, out)


def _distinct_between(value: str) -> Column:
    """Distinct values of a range (NULL is one)."""
    return (F.count_distinct(value) + F.max(F.col(value).isNull().cast("int"))).alias("__d")


def row_number_global(df: DataFrame, order: Sequence[Column | str], out: str = "row_number") -> DataFrame:
    """ROW_NUMBER over the whole frame (``order`` must be total)."""
    return (prefix_sum(df.withColumn("__one", F.lit(1)), order, ["__one"])
            .withColumnRenamed("__one_cum", out).drop("__one"))


def _lower(n: Column, p: float) -> tuple[Column, Column, Column]:
    """0-based positions next to the wanted one among ``n`` rows, and its fraction."""
    h = (n - 1) * F.lit(float(p))
    return F.floor(h), F.ceil(h), h - F.floor(h)


def _brackets(base: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    """Per group: __n, and for each position i a bracket [__lo{i}, __hi{i}] that surely holds
    it, with __most{i}, a bound on the distinct values inside."""
    slack = 2.0 / SKETCH_ACCURACY
    wanted = [q for p in probs for q in (max(0.0, p - slack), min(1.0, p + slack))]
    b = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__x", F.array(*map(F.lit, wanted)), F.lit(SKETCH_ACCURACY)).alias("__b"))
    # in a small group a position's neighbour can lie outside the slack: take it whole
    small, inf = F.col("__n") <= 2 * SKETCH_ACCURACY, F.lit(float("inf"))
    cols = []
    for i in range(len(probs)):
        cols += [F.when(small, -inf).otherwise(F.col("__b")[2 * i]).alias(f"__lo{i}"),
                 F.when(small, inf).otherwise(F.col("__b")[2 * i + 1]).alias(f"__hi{i}"),
                 F.when(small, F.col("__n")).otherwise(F.ceil(F.col("__n") * (3 * slack)) + 2).alias(f"__most{i}")]
    return b.select(*by, "__n", *cols)


def _attach(base: DataFrame, brackets: DataFrame, by: list[str], bounded_by: bool) -> DataFrame:
    if not by:
        return with_scalars(base, brackets)
    return null_safe_join(base, F.broadcast(brackets) if bounded_by else brackets, by)


def _narrower(base: DataFrame, brackets: DataFrame, by: list[str], probs: Sequence[float], bounded_by: bool) -> DataFrame:
    """One pass: the rows strictly inside a bracket are cut into ``PIECES`` parts at a sketch
    of theirs and the parts around the position are kept; a position on an end of the
    bracket, where any number of rows may tie, leaves that value alone."""
    j, x, aggs = _attach(base, brackets, by, bounded_by), F.col("__x"), []
    grid = F.array(*[F.lit(g / PIECES) for g in range(PIECES + 1)])
    for i in range(len(probs)):
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        strict = (x > lo) & (x < hi)
        aggs += [F.count_if(x <= lo).alias(f"__upto{i}"), F.count_if(strict).alias(f"__in{i}"),
                 F.percentile_approx(F.when(strict, x), grid, F.lit(SKETCH_ACCURACY)).alias(f"__grid{i}"),
                 F.max(lo).alias(f"__lo{i}"), F.max(hi).alias(f"__hi{i}")]
    got = j.groupBy(*by).agg(F.max("__n").alias("__n"), *aggs)
    out = []
    for i, p in enumerate(probs):
        old_lo, old_hi, inside = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.col(f"__in{i}")
        ends = [pos - F.col(f"__upto{i}") for pos in _lower(F.col("__n"), p)[:2]]   # 0-based among those inside
        slack, some = 2.0 / SKETCH_ACCURACY, F.nullif(inside, F.lit(0))
        first = F.greatest(F.floor((ends[0] / some - slack) * PIECES), F.lit(0))
        last = F.least(F.ceil(((ends[1] + 1) / some + slack) * PIECES), F.lit(PIECES))
        cut = lambda k: F.element_at(f"__grid{i}", (k + 1).cast("int"))  # noqa: B023, E731
        edge = lambda r, k, whole, old: (F.when(r < 0, old_lo).when(r >= inside, old_hi)  # noqa: B023, E731
                                         .when(k == whole, old).otherwise(cut(k)))
        out += [edge(ends[0], first, 0, old_lo).alias(f"__lo{i}"), edge(ends[1], last, PIECES, old_hi).alias(f"__hi{i}"),
                F.when((inside == 0) | (ends[1] < 0) | (ends[0] >= inside), 2).otherwise(
                    F.ceil(inside * ((last - first) / PIECES + slack)) + 2).alias(f"__most{i}")]
    return got.select(*by, "__n", *out)


def _selected(base: DataFrame, by: list[str], probs: Sequence[float], bounded_by: bool, left: int) -> DataFrame:
    """Brackets that hold at most ``left`` distinct values each, found in as many passes as it takes."""
    ensure_checkpoint_dir(base.sparkSession)
    brackets = _brackets(base, by, probs).checkpoint(eager=True)
    most = [F.max(f"__most{i}") for i in range(len(probs))]
    widest = brackets.agg(F.greatest(*most) if len(most) > 1 else most[0]).first()[0] or 0
    while widest > max(left, 10):
        brackets = _narrower(base, brackets, by, probs, bounded_by or _few(brackets)).checkpoint(eager=True)
        widest = brackets.agg(F.greatest(*most) if len(most) > 1 else most[0]).first()[0]
    return brackets


def _few(brackets: DataFrame) -> bool:
    """Whether the brackets (materialised) may be broadcast."""
    return brackets.count() <= BROADCAST_GROUPS


def _counted(base: DataFrame, brackets: DataFrame, by: list[str], count: int, bounded_by: bool) -> DataFrame:
    """Rows per distinct value inside a bracket, and per gap between brackets."""
    j, x = _attach(base, brackets, by, bounded_by), F.col("__x")
    ends = [(F.col(f"__lo{i}"), F.col(f"__hi{i}")) for i in range(count)]
    inside = F.lit(False)
    for lo, hi in ends:
        inside = inside | x.between(lo, hi)
    # a row outside every bracket counts for the gap above the last bracket below it
    below = F.greatest(F.lit(float("-inf")), *[F.when(x > hi, hi) for _, hi in ends])
    return j.groupBy(*by, F.when(inside, x).otherwise(below).alias("__y"), (~inside).alias("__gap")).agg(
        F.count(F.lit(1)).alias("__c"), F.max("__n").alias("__n"))


def exact_quantiles(df: DataFrame, value: str | Column, probs: Sequence[float],
                    by: Sequence[str] = (), names: Sequence[str] | None = None,
                    bounded_by: bool = False, left: int = VALUES_LEFT) -> DataFrame:
    """Exact linear-interpolation quantiles per group (one row per group).

    Matches pandas ``Series.quantile`` / DuckDB ``quantile_cont`` on doubles:
    position h = (n-1)p, result lo + (hi-lo)(h-floor h).

    Selection in passes, all groups and positions together.  A sketch
    (``percentile_approx``, rank error at most 1 / SKETCH_ACCURACY of the rows)
    gives two values between which each position surely lies; while a bracket
    may hold more than ``left`` distinct values, a further pass cuts it at a
    sketch of the rows inside.  The last pass counts the rows per distinct value
    inside the brackets and per gap between them, map-side first, so nothing is
    sorted or stored, and the running count that finds the positions sees ``left``
    values a position at most, however many rows there are and however they tie.
    A position outside its bracket is an error, never a NULL.
    Brackets of up to ``BROADCAST_GROUPS`` groups are broadcast, so few large groups stay
    dealt over all tasks; ``bounded_by`` says that the number of groups is bounded
    (column names, say) without counting them.
    """
    by = list(by)
    names = list(names) if names else [f"q{int(round(p * 100)):02d}" for p in probs]
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    base = df.select(*by, v.alias("__x")).where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    brackets = _selected(base, by, probs, bounded_by, left)
    counted = _counted(base, brackets, by, len(probs), bounded_by or not by or _few(brackets))
    w = Window.partitionBy(*by).orderBy("__y", "__gap").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("__upto", F.sum("__c").over(w))
    start = F.when(~F.col("__gap"), F.col("__upto") - F.col("__c"))  # first 0-based position of this value
    aggs = []
    for i, p in enumerate(probs):
        lo, hi, part = _lower(F.col("__n"), p)
        aggs += [F.max(F.when((start <= lo) & (lo < F.col("__upto")), F.col("__y"))).alias(f"__lo{i}"),
                 F.max(F.when((start <= hi) & (hi < F.col("__upto")), F.col("__y"))).alias(f"__hi{i}"),
                 F.max(part).alias(f"__f{i}")]

    def found(c: str) -> Column:                   # no row at all (no group) gives NULL, a row gives a value
        lost = F.raise_error(F.lit("a quantile's position lies outside its bracket")).cast("double")
        return F.when(F.col("__some") > 0, F.coalesce(F.col(c), lost))

    outs = [(found(f"__lo{i}") + (found(f"__hi{i}") - found(f"__lo{i}")) * F.col(f"__f{i}")).alias(nm)
            for i, nm in enumerate(names)]
    return placed.groupBy(*by).agg(F.count(F.lit(1)).alias("__some"), *aggs).select(*by, *outs)


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float], names: Sequence[str],
                   by: Sequence[str] = ()) -> DataFrame:
    """Quantiles of several columns in one pass: one row per group with
    columns ``{col}__{name}``.  The columns are unpivoted to
    ``(column, value)`` and counted together, so k columns cost the two passes
    of one."""
    by = list(by)
    cols = list(cols)
    d = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    long = d.unpivot(by, cols, "__col", "__val")
    q = exact_quantiles(long, "__val", probs, by=[*by, "__col"], names=list(names), bounded_by=not by)
    # pivot over the (known, bounded) column names back to one row per group
    wide = q.groupBy(*by).pivot("__col", cols).agg(*[F.first(n).alias(n) for n in names])
    if len(names) == 1:  # Spark names single-aggregate pivot columns by value only
        wide = wide.select(*by, *[F.col(c).alias(f"{c}__{names[0]}") for c in cols])
    else:
        wide = wide.select(*by, *[F.col(f"{c}_{n}").alias(f"{c}__{n}") for c in cols for n in names])
    return wide


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df``.

    The one-row side has a proven size bound, so it is broadcast; Catalyst plans
    a nested-loop join against that single row (no shuffle of ``df``).
    """
    return df.crossJoin(F.broadcast(one_row))


def top_k(df: DataFrame, k: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``k`` rows in ``order``; include a unique key last for ties."""
    return df.orderBy(*_sort_cols(order)).limit(k)

"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

import re
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value: str | int, precision: int = 38, scale: int | None = None) -> Column:
    """Exact decimal literal (``F.lit(0.01)`` would be a double)."""
    d = Decimal(str(value))
    if scale is None:
        scale = max(0, -d.as_tuple().exponent)
    return F.lit(d).cast(f"decimal({precision},{scale})")


def safe_divide(num: ColumnOrName, den: ColumnOrName, alt=None) -> Column:
    """DAX ``DIVIDE(a, b, alt)``: ``alt`` only when the denominator is 0 or blank.

    A blank numerator stays blank.  Without ``alt`` a zero denominator gives
    NULL (ANSI-safe ``try_divide``).
    """
    n, d = col(num), col(den)
    q = F.try_divide(n, d)
    if alt is None:
        return q
    alt_c = alt if isinstance(alt, Column) else F.lit(alt)
    return F.when(d.isNull() | (d == 0), alt_c).otherwise(q)


def clip(c: ColumnOrName, lower=None, upper=None) -> Column:
    """pandas ``clip``: a NULL input stays NULL (``greatest``/``least`` skip nulls)."""
    x = col(c)
    out = x
    if lower is not None:
        lo = lower if isinstance(lower, Column) else F.lit(lower)
        out = F.greatest(out, lo)
    if upper is not None:
        hi = upper if isinstance(upper, Column) else F.lit(upper)
        out = F.least(out, hi)
    return F.when(x.isNotNull(), out)


def null_false(pred: Column) -> Column:
    """Comparison with pandas semantics: NULL operand -> False."""
    return F.coalesce(pred, F.lit(False))


def str_title(c: ColumnOrName, acronyms: Iterable[str] = ()) -> Column:
    """Python ``str.title()``: every letter run that follows a non-letter
    starts upper case, the rest lower (``hi-fi o'neil`` -> ``Hi-Fi O'Neil``).
    ``initcap`` only splits on spaces, so split into letter / non-letter runs
    (Unicode letters, ``\\p{L}``) and capitalise each run.  A run that is one of
    ``acronyms``, in whatever case, is written as it is listed (``usa`` -> ``USA``)."""
    parts = F.regexp_extract_all(F.lower(col(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    known = {a.lower(): a for a in acronyms}

    def written(y: Column) -> Column:
        title = F.concat(F.upper(F.substring(y, 1, 1)), F.substring(y, 2, 1 << 30))
        out = title
        for low, own in known.items():
            out = F.when(y == low, own).otherwise(out)
        return out

    return F.when(col(c).isNotNull(), F.array_join(F.transform(parts, written), ""))


def standardize_name(name: str) -> str:
    """Column-name rule of the cleaning step: strip, lower, runs of
    whitespace/hyphen -> ``_``, then drop every non-word character."""
    s = name.strip().lower()
    s = re.sub(r"[\s\-]+", "_", s)
    return re.sub(r"[^\w]", "", s)


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns (metadata only, no data is touched)."""
    return df.toDF(*[standardize_name(c) for c in df.columns])


def date_attrs(d: ColumnOrName, prefix: str = "") -> dict[str, Column]:
    """Calendar attributes of the date dimension, keyed by column name."""
    x = col(d)
    return {
        f"{prefix}date_key": F.date_format(x, "yyyyMMdd").cast("int"),
        f"{prefix}year": F.year(x),
        f"{prefix}quarter": F.quarter(x),
        f"{prefix}month": F.month(x),
        f"{prefix}month_name": F.date_format(x, "MMMM"),
        f"{prefix}week_of_year": F.weekofyear(x),  # ISO week
        f"{prefix}day_of_month": F.dayofmonth(x),
        f"{prefix}day_name": F.date_format(x, "EEEE"),
        f"{prefix}is_weekend": F.weekday(x) >= 5,  # Monday = 0
    }


def status_flag(value: ColumnOrName, green: float, amber: float,
                higher_is_better: bool = True) -> Column:
    """Traffic-light code 1 (green) / 2 (amber) / 3 (red) from two thresholds.

    ``higher_is_better``: green when value >= green, amber when >= amber.
    Otherwise green when value <= green, amber when <= amber.  A blank value
    compares as 0, as BLANK does in a DAX comparison.
    """
    v = F.coalesce(col(value), F.lit(0))
    if higher_is_better:
        return F.when(v >= green, 1).when(v >= amber, 2).otherwise(3)
    return F.when(v <= green, 1).when(v <= amber, 2).otherwise(3)


def money(c: ColumnOrName, scale: int = 2) -> Column:
    """Round an exact (decimal) money aggregate and hand it out as double."""
    return F.round(col(c), scale).cast("double")


def as_double(c: ColumnOrName) -> Column:
    return col(c).cast("double")


def first_non_null(cols: Iterable[ColumnOrName]) -> Column:
    return F.coalesce(*[col(c) for c in cols])


def date_spine(facts: DataFrame, date_col: str) -> DataFrame:
    """Daily calendar with the ten date-dimension columns, from the first day of
    the earliest year in ``date_col`` to the last day of the latest.  No dates,
    no days.  Its size is bounded by the days in that range.
    """
    d = F.col(date_col)
    span = facts.agg(F.year(F.min(d)).alias("a"), F.year(F.max(d)).alias("b"))
    days = span.select(F.explode(F.sequence(F.make_date("a", F.lit(1), F.lit(1)), F.make_date("b", F.lit(12), F.lit(31)),
                                            F.expr("interval 1 day"))).alias("full_date"))
    return days.select("full_date", *[c.alias(n) for n, c in date_attrs("full_date").items()])

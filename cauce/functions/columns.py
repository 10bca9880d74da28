from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def elapsed_days(start: Column, end: Column, dtype: T.DataType) -> Column:
    """Whole days elapsed from ``start`` to ``end`` (floor of the duration),
    BIGINT. Dates subtract exactly; timestamps count complete 24h periods,
    so 23:00 -> 01:00 next day is 0, not 1."""
    if isinstance(dtype, T.DateType):
        return F.datediff(end, start).cast("bigint")
    return F.timestamp_diff("DAY", start, end)


def minus_days(col: Column, days: int, dtype: T.DataType | None = None) -> Column:
    """``col - n days``. With ``dtype`` DATE stays DATE (no session time zone
    enters); a timestamp keeps its type."""
    if isinstance(dtype, T.DateType):
        return F.date_sub(col, days)
    return col - F.make_dt_interval(F.lit(days))


def number(col: Column) -> Column:
    """DOUBLE image of a numeric column in which NaN counts as missing."""
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))


def minus_months(col: Column, months: int) -> Column:
    """``col - n months`` with month-end clamping (Mar 31 - 1 month = Feb 29)."""
    return col - F.make_ym_interval(F.lit(0), F.lit(months))


def ratio(num: Column, den: Column, default=None) -> Column:
    """num / den that yields ``default`` (null if None) instead of raising
    under ANSI mode when den is 0 or null."""
    r = F.try_divide(num.cast("double"), den.cast("double"))
    return r if default is None else F.coalesce(r, F.lit(default).cast("double"))


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def last_non_null(value: Column, order: Column, cond: Column | None = None) -> Column:
    """Aggregate: the non-null ``value`` with the largest ``order`` (rows
    outside ``cond`` ignored). Nulling the ordering key makes ``max_by``
    skip the row, which is the per-column "last non-null" rule."""
    keep = value.isNotNull() if cond is None else (cond & value.isNotNull())
    return F.max_by(value, F.when(keep, order))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE/FLOAT column (for value comparisons across engines)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)

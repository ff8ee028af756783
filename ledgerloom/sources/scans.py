"""Source scans.

Date conditions are written as half-open ranges on the stored column wherever
the column is stored as a date or timestamp, so the Parquet reader can skip
row groups; a function around the column would hide it from the reader.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import MONEY, ci_equals, ci_in, col
from ledgerloom.functions.scalars import business_date, date_from_yyyymmdd, yyyymmdd


#: First and last business date, inclusive.
Days = tuple[dt.date, dt.date]


def scan_filter(df: DataFrame, *conditions: Column) -> DataFrame:
    """Full scan narrowed by every condition."""
    for condition in conditions:
        df = df.filter(condition)
    return df


def cleared(status: Column | str) -> Column:
    """Status 'cleared', or no status at all."""
    return ci_equals(status, "cleared") | col(status).isNull()


def file_date(file_name: Column | str) -> Column:
    """Delivery date in the first eight characters of a file name."""
    return date_from_yyyymmdd(F.left(col(file_name), F.lit(8)))


def scan_file_prefix(
    df: DataFrame,
    file_name: str = "file_name",
    lag_days: int = 1,
    activity: str | None = None,
    days: Days | None = None,
) -> DataFrame:
    """Rows delivered ``lag_days`` after the business date, as ``business_date``.

    With ``activity`` the row must also carry an activity timestamp on that
    business date. With ``days`` only those days are read, by a range of file
    names that reaches the Parquet reader. Files whose name begins with no
    date have no business date; ``rejected_rows`` counts them.
    """
    if days is not None:
        low, high = (d + dt.timedelta(days=lag_days) for d in (days[0], days[1] + dt.timedelta(days=1)))
        df = df.filter((F.col(file_name) >= low.strftime("%Y%m%d")) & (F.col(file_name) < high.strftime("%Y%m%d")))
    out = df.withColumn("business_date", F.date_sub(file_date(file_name), lag_days))
    if activity is not None:
        out = out.filter(F.to_date(activity) == F.col("business_date"))
    return out


def statement_file_name(day: Column | str, head: str = "STL-", tail: str = ".01.009.CSV") -> Column:
    return F.concat(F.lit(head), yyyymmdd(day), F.lit(tail))


def scan_file_exact(
    df: DataFrame,
    file_name: str = "file_name",
    record_type: str = "ch",
    wanted: str = "SB",
    head: str = "STL-",
    tail: str = ".01.009.CSV",
    days: Days | None = None,
) -> DataFrame:
    """Rows of one record type from files named exactly ``head + yyyyMMdd + tail``, without case.

    With ``days`` only names in the range of those days are read, in every case of the head: one range each reaches
    the Parquet reader; a head of more than five letters is compared without case instead.
    """
    if days is not None:
        first, after = (d.strftime("%Y%m%d") for d in (days[0], days[1] + dt.timedelta(days=1)))
        if sum(c.upper() != c.lower() for c in head) > 5:
            name, heads = F.upper(file_name), [head.upper()]
        else:
            name, heads = F.col(file_name), sorted({"".join(h) for h in product(*({c.upper(), c.lower()} for c in head))})
        near = [(name >= h + first) & (name < h + after) for h in heads]
        df = df.filter(reduce(lambda a, b: a | b, near))
    day = F.try_to_date(F.substring(F.col(file_name), len(head) + 1, 8), "yyyyMMdd")
    out = df.filter(ci_equals(record_type, wanted)).withColumn("business_date", day)
    return out.filter(F.upper(file_name) == F.upper(statement_file_name("business_date", head, tail)))


def scan_business_day(
    df: DataFrame, ts: str = "ts", channel: str = "settled_by", cutoff_channel: str = "Dlocal", cutoff_hour: int = 21,
    days: Days | None = None,
) -> DataFrame:
    """Business days: adds ``business_date`` and drops rows of no channel.

    All days at once, or those from ``days[0]`` to ``days[1]``, read through a
    range of the stored time that also holds the evening before the first.
    """
    if days is not None:
        low = dt.datetime.combine(days[0] - dt.timedelta(days=1), dt.time())
        df = scan_range(df, ts, low, dt.datetime.combine(days[1] + dt.timedelta(days=1), dt.time()))
    rows = df.filter(F.col(ts).isNotNull() & F.col(channel).isNotNull())
    rows = rows.withColumn("business_date", business_date(ts, channel, cutoff_channel, cutoff_hour))
    return rows if days is None else rows.filter(F.col("business_date").between(F.lit(days[0]), F.lit(days[1])))


def one_business_day(df: DataFrame, day: dt.date, **named) -> DataFrame:
    return scan_business_day(df, days=(day, day), **named)


def scan_calendar_day(df: DataFrame, day: dt.date, date: str) -> DataFrame:
    start = dt.datetime.combine(day, dt.time())
    return scan_range(df, date, start, start + dt.timedelta(days=1))


def scan_range(df: DataFrame, column: str, low: dt.datetime, high: dt.datetime | None = None) -> DataFrame:
    """``low <= column < high``; open above when ``high`` is None."""
    out = df.filter(F.col(column) >= F.lit(low))
    return out if high is None else out.filter(F.col(column) < F.lit(high))


def scan_date_range(df: DataFrame, date: str, after: dt.date | None = None, between: tuple | None = None) -> DataFrame:
    """Days strictly after one date, or between two dates inclusive."""
    if between is not None:
        first, last = between
        low = dt.datetime.combine(first, dt.time())
        return scan_range(df, date, low, dt.datetime.combine(last, dt.time()) + dt.timedelta(days=1))
    low = dt.datetime.combine(after + dt.timedelta(days=1), dt.time())
    return scan_range(df, date, low)


def rejected_rows(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Per reason the number of rows for which its test is true: what a scan leaves out or reads as no amount, counted."""
    counts = df.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(reason) for reason, t in tests.items()])
    pairs = F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("n")) for r in tests])
    return counts.select(F.inline(pairs))


def is_no_amount(value: Column | str, amount_type: str = MONEY) -> Column:
    """A text that is there but is no amount: a sum would silently leave it out."""
    return col(value).isNotNull() & (F.trim(col(value)) != "") & col(value).try_cast(amount_type).isNull()


def scan_approved(df: DataFrame, updated: str, status: str, wanted: Sequence[str] = ("APPROVED",)) -> DataFrame:
    """Approved rows, with the update timestamp's day as ``business_date``."""
    return df.filter(ci_in(status, wanted)).withColumn("business_date", F.to_date(updated))

"""Capture times and the month window of monthly sitemaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: names of monthly sitemaps.
PERIOD = r"sitemap-product-(\d{4})-(\d{1,2})"


def local_time_text(ts: Column) -> Column:
    """Capture time as ``yyyy-MM-dd HH:mm:ss`` in UTC+7, whatever the session's zone.

    An instant is taken as it is; a time without zone is read as UTC.
    """
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    utc = F.when(
        F.typeof(ts) == "timestamp",
        F.make_dt_interval(secs=F.unix_seconds(ts.cast("timestamp")).cast("decimal(18,6)")) + epoch,
    ).otherwise(ts.cast("timestamp_ntz"))
    return F.date_format(utc + F.make_dt_interval(hours=F.lit(7)), "yyyy-MM-dd HH:mm:ss")


def parse_local_time(text: Column) -> Column:
    """Inverse of :func:`local_time_text`, as an instant; unreadable text gives null."""
    return F.try_to_timestamp(F.concat(text, F.lit(" +07:00")), F.lit("yyyy-MM-dd HH:mm:ss XXX"))


def period_month(name: Column, pattern: str = PERIOD) -> Column:
    """Months since year 0 of a monthly sitemap name; null without a period."""
    year = F.regexp_extract(name, pattern, 1).try_cast("int")
    month = F.regexp_extract(name, pattern, 2).try_cast("int")
    return year * 12 + month


def cutoff_month(as_of: Column | dt.date, months: int = 3) -> Column:
    day = F.add_months(F.lit(as_of) if isinstance(as_of, dt.date) else as_of, -months)
    return F.year(day) * 12 + F.month(day)

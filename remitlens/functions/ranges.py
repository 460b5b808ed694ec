"""Period labels → closed timestamp ranges (day, ISO week, month, quarter, year).

Labels: 'yyyy-MM-dd', 'YYYY-Www' (ISO week), 'yyyy-MM', 'yyyy-Qn', 'yyyy'.
The range is [start, next period start − 1 second], i.e. it ends at 23:59:59
of the last day, as the history screens build it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_start_of_label(label: Column, granularity: str) -> Column:
    g = granularity.lower()
    if g == "day":
        return F.to_timestamp_ntz(label, F.lit("yyyy-MM-dd"))
    if g == "week":
        year = F.substring(label, 1, 4).cast("int")
        week = F.substring(label, 7, 2).cast("int")
        # ISO week 1 is the week holding January 4th; weeks start on Monday.
        monday1 = F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4)))
        return F.to_timestamp_ntz(F.date_add(monday1.cast("date"), (week - 1) * 7).cast("string"))
    if g == "month":
        return F.to_timestamp_ntz(F.concat(label, F.lit("-01")), F.lit("yyyy-MM-dd"))
    if g == "quarter":
        year = F.substring(label, 1, 4).cast("int")
        q = F.substring(label, 7, 1).cast("int")
        return F.to_timestamp_ntz(F.make_date(year, (q - 1) * 3 + 1, F.lit(1)).cast("string"))
    if g == "year":
        return F.to_timestamp_ntz(F.concat(label, F.lit("-01-01")), F.lit("yyyy-MM-dd"))
    raise ValueError(f"unknown granularity {granularity}")


_STEP = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}


def range_by_granularity(label: Column, granularity: str) -> tuple[Column, Column]:
    """(start, end) of the period named by ``label``; end = next start − 1 s."""
    start = period_start_of_label(label, granularity)
    end = start + F.expr(f"INTERVAL {_STEP[granularity.lower()]}") - F.expr("INTERVAL 1 second")
    return start, end


def label_of(ts: Column, granularity: str) -> Column:
    """The label of the period containing ``ts`` (inverse of the parser)."""
    g = granularity.lower()
    if g == "day":
        return F.date_format(ts, "yyyy-MM-dd")
    if g == "week":
        monday = F.date_trunc("week", ts)
        iso_year = F.year(F.date_add(monday.cast("date"), 3))
        return F.format_string("%d-W%02d", iso_year, F.weekofyear(ts))
    if g == "month":
        return F.date_format(ts, "yyyy-MM")
    if g == "quarter":
        return F.format_string("%d-Q%d", F.year(ts), F.quarter(ts))
    return F.date_format(ts, "yyyy")

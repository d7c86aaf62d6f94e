"""Month-end arithmetic (driver-side dates and Spark column forms).

Spark 3+ ``add_months`` keeps the day of month (clamped), so shifting a
month end by -1 does not land on the previous month end
(2020-04-30 -> 2020-03-30).  Every month shift here is therefore
``last_day(add_months(x, k))``.
"""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_date(d) -> date:
    if isinstance(d, datetime):
        return d.date()
    if isinstance(d, date):
        return d
    return date.fromisoformat(str(d))


def add_months_date(d, k: int) -> date:
    """Driver-side ``d + k months`` with the day clamped to the month length."""
    d = _as_date(d)
    idx = d.year * 12 + (d.month - 1) + k
    y, m = divmod(idx, 12)
    last = calendar.monthrange(y, m + 1)[1]
    return date(y, m + 1, min(d.day, last))


def month_start(as_of, k: int = 0) -> date:
    """First day of the month ``k`` months before ``as_of``."""
    return add_months_date(as_of, -k).replace(day=1)


def month_end(as_of, k: int = 0) -> date:
    """Last day of the month ``k`` months before ``as_of``."""
    d = add_months_date(as_of, -k)
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def shift_month_end(col: Column | str, k: int) -> Column:
    """Month end of ``col`` shifted by ``k`` months (k < 0 = earlier)."""
    return F.last_day(F.add_months(F.col(col) if isinstance(col, str) else col, k))


def shift_month_start(col: Column | str, k: int) -> Column:
    """First day of the month of ``col`` shifted by ``k`` months."""
    return F.trunc(F.add_months(F.col(col) if isinstance(col, str) else col, k), "month")


def yyyymm(col: Column | str) -> Column:
    """``yyyyMM`` text of a date (dated output names)."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyyMM")


def date_range_filter(col: Column | str, begin, end, closed_end: bool = False) -> Column:
    """Predicate for ``begin <= col <= end`` over whole days.

    With the default ``closed_end=False`` the bound is half-open on the day
    after ``end``, so a timestamp at 10:00 on the last day is kept; with
    ``closed_end=True`` the comparison is against ``end`` itself (midnight
    for timestamps), which is what a plain date bound does.  Both forms are
    literal comparisons, so they reach the Parquet scan as pushed filters.
    """
    c = F.col(col) if isinstance(col, str) else col
    begin, end = _as_date(begin), _as_date(end)
    if closed_end:
        return (c >= F.lit(begin)) & (c <= F.lit(end))
    return (c >= F.lit(begin)) & (c < F.lit(end + timedelta(days=1)))

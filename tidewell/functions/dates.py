"""Date columns and run-date arithmetic.

Run dates are plain values (``date`` or ISO text). Everything that depends on the run date
only is worked out before planning, so filters reach the scan as literals.
"""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = date | datetime | str
ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(value: DateLike) -> date:
    """A ``date`` from a date, a datetime or ISO text."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value[:10])


def day_shift(value: DateLike, days: int) -> date:
    return day(value) + timedelta(days=days)


def month_shift(value: DateLike, months: int) -> date:
    """Same day ``months`` later, cut to the last day of a shorter month."""
    d = day(value)
    index = d.year * 12 + d.month - 1 + months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(d.day, last))


def month_end(value: DateLike, months: int = 0) -> date:
    """Last day of the month ``months`` away."""
    d = month_shift(value, months)
    return d.replace(day=calendar.monthrange(d.year, d.month)[1])


def month_number(value: DateLike) -> int:
    """Months counted from year 0, the scale of :func:`month_index`."""
    d = day(value)
    return d.year * 12 + d.month


def month_index(c: ColumnLike) -> Column:
    """Calendar months as one integer, so that differences count month borders."""
    return F.year(col(c)) * 12 + F.month(col(c))


def months_apart(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Month borders between two dates, days ignored."""
    return month_index(later) - month_index(earlier)


def whole_months(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Completed months; two month ends count as whole months apart."""
    return F.floor(F.months_between(col(later), col(earlier))).cast("int")


def whole_years(later: ColumnLike, earlier: ColumnLike) -> Column:
    return F.floor(F.months_between(col(later), col(earlier)) / 12).cast("int")


def month_end_of(c: ColumnLike, months: int = 0) -> Column:
    return F.last_day(F.add_months(col(c), months)) if months else F.last_day(col(c))


def same_month(a: ColumnLike, b: ColumnLike) -> Column:
    return F.last_day(col(a)) == F.last_day(col(b))


def same_quarter(a: ColumnLike, b: ColumnLike) -> Column:
    return F.trunc(col(a), "quarter") == F.trunc(col(b), "quarter")


def same_year(a: ColumnLike, b: ColumnLike) -> Column:
    return F.year(col(a)) == F.year(col(b))


def quarter_label(c: ColumnLike, lag_quarters: int = 2) -> Column:
    """``'2022 Q3'`` of the quarter ``lag_quarters`` before the date."""
    shifted = F.add_months(col(c), -3 * lag_quarters)
    return F.concat(F.year(shifted).cast("string"), F.lit(" Q"), F.quarter(shifted).cast("string"))


def year_month(c: ColumnLike) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def first_day_from_yyyymm(c: ColumnLike) -> Column:
    """First of the month from ``yyyyMM`` text; anything else becomes null."""
    return F.try_to_date(col(c).cast("string"), "yyyyMM")


def parse_mixed_ts(c: ColumnLike) -> Column:
    """Date from a text column that holds ISO dates or epoch milliseconds; junk is null."""
    text = col(c)
    iso = F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
    seconds = F.floor(text.try_cast("bigint") / 1000).cast("bigint")
    return F.when(F.instr(text, "-") > 0, iso).otherwise(F.timestamp_seconds(seconds).cast("date"))


def week_number(later: ColumnLike, start: ColumnLike) -> Column:
    """Weeks since ``start``, the first week being 1; part weeks are cut toward zero."""
    return (F.datediff(col(later), col(start)) / 7).cast("int") + 1


def tenure_text(months: ColumnLike) -> Column:
    """``'3 y 4 m'`` from a month count."""
    m = col(months).cast("int")
    return F.concat(
        F.floor(m / 12).cast("string"), F.lit(" y "), F.pmod(m, F.lit(12)).cast("string"), F.lit(" m")
    )


def since(c: ColumnLike, as_of: DateLike, *, days: int | None = None, months: int | None = None) -> Column:
    """Rows dated within ``days`` of the run date, or after the month end ``months`` back.

    ``days`` counts back from the run date, inclusive. ``months`` keeps dates on or after the
    last day of the month that many months before it.
    """
    if (days is None) == (months is None):
        raise ValueError("give days or months")
    bound = day_shift(as_of, -days) if days is not None else month_end(as_of, -months)
    return col(c) >= F.lit(bound)

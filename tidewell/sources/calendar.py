"""The report calendar: which month end a run reports on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from ..functions.dates import DateLike, day, month_end, month_shift


@dataclass(frozen=True)
class ReportCalendar:
    """Dates of one run, all plain values."""

    as_of: date
    month_start: date
    report_date: date
    previous_report_date: date
    token: str


def report_calendar(as_of: DateLike, months_back: int = 0) -> ReportCalendar:
    """Calendar of the run: the month end before ``as_of``, ``months_back`` further back.

    ``month_start`` is the first day after the report date, ``token`` its ``yyMM`` text.
    """
    run = day(as_of)
    start = month_shift(run.replace(day=1), -months_back)
    report = month_end(start, -1)
    return ReportCalendar(run, start, report, month_end(start, -2), report.strftime("%y%m"))

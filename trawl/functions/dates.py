"""Page dates: header dates, precedence, display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trawl.functions.expr import let

# Month names as mail and web headers write them.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

_DAY_FIRST = (
    r"^\s*(?:[A-Za-z]+,?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*[\s-]+(\d{2,4})"
    r"\s+(\d{1,2}):(\d{2})(?::(\d{2}))?"
)
_MONTH_FIRST = (
    r"^\s*(?:[A-Za-z]+,?\s+)?([A-Za-z]{3})[A-Za-z]*\s+(\d{1,2})"
    r"\s+(\d{1,2}):(\d{2}):(\d{2})\s+(\d{4})"
)


def _read(pattern: str, year: int, month: int, day: int, hour: int, minute: int, second: int) -> str:
    """SQL text that reads ``h`` with the numbered groups of ``pattern``."""

    def part(group):
        return f"nullif(regexp_extract(h, r'{pattern}', {group}), '')"

    def number(group):
        return f"cast({part(group)} as int)"

    short_year = f"if({number(year)} < 69, 2000, 1900)"
    century = f"if(length({part(year)}) = 2, {short_year}, 0)"
    month_at = f"instr('{MONTHS}', lower({part(month)}))"
    return (
        f"try_make_timestamp_ntz({century} + {number(year)}, "
        f"if({month_at} % 3 = 1, cast(({month_at} + 2) / 3 as int), null), {number(day)}, "
        f"{number(hour)}, {number(minute)}, "
        f"cast(coalesce({number(second)}, 0) as decimal(16, 6)))"
    )


_HTTP_DATE = (
    f"coalesce({_read(_DAY_FIRST, 3, 2, 1, 4, 5, 6)}, {_read(_MONTH_FIRST, 6, 1, 2, 3, 4, 5)})"
)


def http_date(header: Column) -> Column:
    """Date of a web header as written, whatever zone it names; null if unreadable.

    Takes the three forms in use: ``Sun, 06 Nov 1994 08:49:37 GMT``,
    ``Sunday, 06-Nov-94 08:49:37 GMT`` and ``Sun Nov  6 08:49:37 1994``.
    """
    return let(header, f"h -> {_HTTP_DATE}")


def modified(in_page: Column, last_modified: Column, date: Column) -> Column:
    """The in-page date, else the ``last-modified`` header, else ``date``, else null."""
    return F.coalesce(in_page, http_date(last_modified), http_date(date))


def display_date(timestamp: Column) -> Column:
    """``Saturday 07, March 2015``; null stays null."""
    return F.date_format(timestamp.cast("date"), "EEEE dd, MMMM yyyy")

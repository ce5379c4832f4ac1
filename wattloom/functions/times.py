"""Timestamp parsing and calendar parts, all as built-in Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattloom.schema import EVENT_TIME_FORMAT

# Year first: whatever Spark itself reads, with or without time, fraction and zone.
ISO = "ISO"


class Dated(str):
    """A date format; no time follows it, or one on the 24- or 12-hour clock."""


CLOCK_24, CLOCK_12 = "[ H:m[:s]]", " h:m[:s] a"

# No two of these can read the same text differently.
PLAIN_FORMATS = [Dated(f) for f in ("yyyy/M/d", "yyyyMMdd", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy")]
MONTH_FIRST_FORMATS = [Dated(f) for f in ("M-d-yyyy", "M/d/yyyy", "M.d.yyyy")]
DAY_FIRST_FORMATS = [Dated(f) for f in ("d-M-yyyy", "d/M/yyyy", "d.M.yyyy")]

MIXED_FORMATS = [ISO, *MONTH_FIRST_FORMATS, *DAY_FIRST_FORMATS, *PLAIN_FORMATS]
MIXED_FORMATS_DAY_FIRST = [ISO, *DAY_FIRST_FORMATS, *MONTH_FIRST_FORMATS, *PLAIN_FORMATS]

# What each format letter can match; a single letter takes one or two digits.
_LETTERS = {
    "yyyy": r"\d{4}",
    "MMM": r"(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)",
    "a": r"(?i:am|pm)",
    "h": r"(0?[1-9]|1[0-2])",
    "MM": r"(0[1-9]|1[0-2])",
    "M": r"(0?[1-9]|1[0-2])",
    "dd": r"(0[1-9]|[12]\d|3[01])",
    "d": r"(0?[1-9]|[12]\d|3[01])",
    "HH": r"([01]\d|2[0-3])",
    "H": r"([01]?\d|2[0-3])",
    "mm": r"[0-5]\d",
    "m": r"[0-5]?\d",
    "ss": r"[0-5]\d",
    "s": r"[0-5]?\d",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(c: Column | str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Timestamp in one fixed format; text that does not match becomes null."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))


def _shape(fmt: str) -> str | None:
    """Regular expression for text the format may accept; None if that is not known."""
    parts = []
    for match in re.finditer(r"'([^']*)'|(([A-Za-z])\3*)|([^A-Za-z'])", fmt):
        quoted, letters, _, other = match.groups()
        if letters is not None:
            if letters not in _LETTERS:
                return None
            parts.append(_LETTERS[letters])
        elif other in ("[", "]"):
            parts.append("(?:" if other == "[" else ")?")
        else:
            parts.append(re.escape(quoted if quoted is not None else other))
    return "^" + "".join(parts) + "$"


def _dated_case(text: Column, fmt: str) -> tuple[Column, Column]:
    """Test and parse of a date with a 24-hour clock or none, or with a 12-hour clock."""
    date, late, early = (_shape(f)[1:-1] for f in (fmt, CLOCK_24, CLOCK_12))
    of_day, of_half = (F.try_to_timestamp(text, F.lit(fmt + c)) for c in (CLOCK_24, CLOCK_12))
    parsed = F.when(text.rlike("[mM]$"), of_half).otherwise(of_day)
    return text.rlike(f"^{date}({late}|{early})$"), parsed


def _tries(text: Column, formats: Sequence[str]) -> list[Column]:
    """One chain of shape tests for each run of formats of known shape, one parse for any other format.

    The shape of the text says which format of a run can read it.  A failed parse costs an
    exception per row; the shape tests are far cheaper, and a format that is the same for all
    rows is prepared once.
    """
    tries: list[Column] = []
    for dated, run in groupby(formats, lambda f: isinstance(f, Dated)):
        if dated:
            cases = [_dated_case(text, f) for f in run]
            tries.append(reduce(lambda rest, case: F.when(*case).otherwise(rest), reversed(cases), F.lit(None)))
            continue
        for fmt in run:
            if fmt == ISO:
                # A bare time of day would be read as today's.
                shape, parsed = r"^\d{4}-\d{1,2}-\d{1,2}", F.try_to_timestamp(text)
            else:
                shape, parsed = _shape(fmt), F.try_to_timestamp(text, F.lit(fmt))
            tries.append(parsed if shape is None else F.when(text.rlike(shape), parsed))
    return tries


def parse_mixed_timestamp(
    c: Column | str,
    formats: Sequence[str] = MIXED_FORMATS,
    errors: str = "null",
) -> Column:
    """Timestamp from text whose format differs from row to row.

    A format is a pattern, or ``ISO`` for year-first text in any detail.  Formats are
    tried in order, so the default reads an ambiguous ``01-06-2020`` as January 6 and
    takes day-first only where month-first is impossible.  Pass
    ``MIXED_FORMATS_DAY_FIRST`` for day-first data.  ``errors="raise"`` fails the
    query on text no format matches; :func:`unreadable` finds such rows.
    """
    text = F.trim(_col(c))
    parsed = F.coalesce(*_tries(text, formats))
    if errors == "null":
        return parsed
    if errors != "raise":
        raise ValueError("errors must be 'null' or 'raise'")
    failure = F.raise_error(F.concat(F.lit("unreadable timestamp: "), text)).cast("timestamp")
    return F.coalesce(parsed, F.when(text.isNotNull(), failure))


def unreadable(c: Column | str, formats: Sequence[str] = MIXED_FORMATS) -> Column:
    """True for text that no format reads; a missing text is not unreadable."""
    return _col(c).isNotNull() & parse_mixed_timestamp(c, formats).isNull()


def floor_hour(c: Column | str) -> Column:
    """Start of the hour that holds the timestamp."""
    return F.date_trunc("hour", _col(c))


def day_name(c: Column | str) -> Column:
    """English name of the weekday."""
    return F.date_format(_col(c), "EEEE")


def weekend_flag(c: Column | str) -> Column:
    """1 on Saturday and Sunday, else 0 (also 0 for a missing date)."""
    on_weekend = day_name(c).isin("Saturday", "Sunday")
    return F.coalesce(on_weekend, F.lit(False)).cast("int")

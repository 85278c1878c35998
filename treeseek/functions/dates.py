"""Dates: the wire form with offset, and relative dates in ranges."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: wire form of a date, seconds and offset, no milliseconds.
WIRE_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxxx"

# Units of relative dates.
UNITS = {"y": "years", "M": "months", "w": "weeks", "d": "days", "h": "hours", "H": "hours",
         "m": "mins", "s": "secs"}
TRUNCATIONS = {"y": "year", "M": "month", "w": "week", "d": "day", "h": "hour", "H": "hour",
               "m": "minute", "s": "second"}

_STEP = re.compile(r"([+-])(\d+)([yMwdhHms])|/([yMwdhHms])")


def to_wire(value: Column) -> Column:
    """Timestamp as text; null stays null."""
    return F.date_format(value, WIRE_FORMAT)


def from_wire(value: Column) -> Column:
    return F.to_timestamp(value, WIRE_FORMAT)


def is_relative(value: object) -> bool:
    return isinstance(value, str) and (value == "now" or bool(re.match(r"now[+\-/]", value)))


def relative(expression: str, now: Column | datetime | None = None) -> Column:
    """``now``, ``now+1d``, ``now-2h/d`` as a Column; folded once per query."""
    if now is None:
        moment = F.current_timestamp()
    else:
        moment = F.lit(now) if isinstance(now, datetime) else now
    rest = expression[len("now"):]
    consumed = 0
    for step in _STEP.finditer(rest):
        if step.start() != consumed:
            break
        consumed = step.end()
        if step[4]:
            moment = F.date_trunc(TRUNCATIONS[step[4]], moment)
        else:
            amount = int(step[2]) * (1 if step[1] == "+" else -1)
            moment = moment + F.make_interval(**{UNITS[step[3]]: F.lit(amount)})
    if consumed != len(rest):
        raise ValueError(f"not a relative date: {expression}")
    return moment

"""Calendar and duration expressions (built-in Spark expressions only).

Functions take column names and return Columns (built from SQL text: one
parse instead of many JVM calls), so they stay inside whole-stage codegen.
Timestamps are wall-clock (``timestamp_ntz``); nothing here depends on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col, q


def minutes_crossed_sql(start: str, end: str) -> str:
    s, e = q(start), q(end)
    return (f"(CAST(datediff(to_date({e}), to_date({s})) AS BIGINT) * 1440"
            f" + (hour({e}) - hour({s})) * 60 + (minute({e}) - minute({s})))")


def minutes_crossed(start: str, end: str) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``end``.

    10:00:59 -> 10:02:01 is 2 (not the 1 whole elapsed minute).  Built from
    date and clock fields, so it is exact for wall-clock timestamps and
    independent of the session zone.
    """
    return F.expr(minutes_crossed_sql(start, end))


def days_crossed(start: str, end: str) -> Column:
    """Day boundaries crossed between two dates/timestamps."""
    return F.expr(f"datediff(to_date({q(end)}), to_date({q(start)}))")


def elapsed_micros_sql(start: str, end: str) -> str:
    return f"timestampdiff(MICROSECOND, {q(start)}, {q(end)})"


def elapsed_micros(start: str, end: str) -> Column:
    return F.expr(elapsed_micros_sql(start, end))


def elapsed_seconds(start: str, end: str) -> Column:
    """Elapsed time in (fractional) seconds, microsecond exact."""
    return F.expr(f"{elapsed_micros_sql(start, end)} / 1000000.0D")


def trip_date(ts: str) -> Column:
    return F.expr(f"to_date({q(ts)})")


def iso_dow_sql(ts: str) -> str:
    return f"(weekday({q(ts)}) + 1)"


def iso_day_of_week(ts: str) -> Column:
    """Monday=1 .. Sunday=7 (``dayofweek`` would give Sunday=1)."""
    return F.expr(iso_dow_sql(ts))


def year_month_sql(ts: str) -> str:
    return f"CAST(year({q(ts)}) * 100 + month({q(ts)}) AS INT)"


def year_month(ts: str) -> Column:
    """yyyyMM as an integer, e.g. 202401."""
    return F.expr(year_month_sql(ts))


def date_parts_sql(ts: str) -> dict[str, str]:
    c = q(ts)
    return {
        "ride_date": f"to_date({c})",
        "ride_hour": f"hour({c})",
        "day_of_week": iso_dow_sql(ts),
        "ride_month": f"month({c})",
        "ride_year": f"year({c})",
    }


def date_parts(ts: str) -> dict[str, Column]:
    """The calendar labels the staged trips carry, keyed by output name."""
    return {k: F.expr(v) for k, v in date_parts_sql(ts).items()}


def add_seconds(ts, seconds) -> Column:
    return F.timestamp_add("SECOND", col(seconds), col(ts))


def within_last(ts, as_of, interval: str = "1 DAY") -> Column:
    """``ts > as_of - INTERVAL interval`` with an explicit reference time."""
    return col(ts) > (col(as_of) - F.expr(f"INTERVAL {interval}"))

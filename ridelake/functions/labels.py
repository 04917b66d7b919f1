"""Ordered-bucket labels (searched CASE with fall-through)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import q, sql_str

# --- Fixed values: labels and bucket edges of the trip model ---------------
DAYPART_BUCKETS = [  # (first hour, last hour, label), inclusive
    (6, 9, "Morning Rush"),
    (10, 15, "Midday"),
    (16, 19, "Evening Rush"),
    (20, 23, "Evening"),
]
DAYPART_ELSE = "Night"
WEEKEND_DAYS = (6, 7)  # ISO Saturday, Sunday
WEEKEND_LABEL, WEEKDAY_LABEL = "Weekend", "Weekday"
LENGTH_BUCKETS = [  # (upper bound in minutes, inclusive, label)
    (30, "Short (0-30 min)"),
    (60, "Medium (30-60 min)"),
    (120, "Long (1-2 hours)"),
]
LENGTH_ELSE = "Very Long (2+ hours)"
DISTANCE_NULL = "Unknown"
DISTANCE_BUCKETS = [  # (upper bound in km, inclusive, label)
    (2, "Short (0-2 km)"),
    (5, "Medium (2-5 km)"),
    (10, "Long (5-10 km)"),
]
DISTANCE_ELSE = "Very Long (10+ km)"
# ---------------------------------------------------------------------------


def _lit(v) -> str:
    return sql_str(v) if isinstance(v, str) else repr(v)


def upper_bound_label_sql(c: str, buckets: Sequence[tuple], otherwise: str,
                          null_label: str | None = None) -> str:
    x = q(c)
    whens = [f"WHEN {x} IS NULL THEN {sql_str(null_label)}"] if null_label is not None else []
    whens += [f"WHEN {x} <= {_lit(upper)} THEN {sql_str(label)}" for upper, label in buckets]
    return f"CASE {' '.join(whens)} ELSE {sql_str(otherwise)} END"


def upper_bound_label(c: str, buckets: Sequence[tuple], otherwise: str,
                      null_label: str | None = None) -> Column:
    """First bucket whose inclusive upper bound holds ``c``; else ``otherwise``.

    With ``null_label`` a NULL input gets that label (tested first);
    without it a NULL falls through to ``otherwise`` like a SQL CASE.
    """
    return F.expr(upper_bound_label_sql(c, buckets, otherwise, null_label))


def range_label_sql(c: str, buckets: Sequence[tuple], otherwise: str) -> str:
    x = q(c)
    whens = [f"WHEN {x} BETWEEN {_lit(lo)} AND {_lit(hi)} THEN {sql_str(label)}" for lo, hi, label in buckets]
    return f"CASE {' '.join(whens)} ELSE {sql_str(otherwise)} END"


def range_label(c: str, buckets: Sequence[tuple], otherwise: str) -> Column:
    """First bucket whose inclusive [low, high] range holds ``c``."""
    return F.expr(range_label_sql(c, buckets, otherwise))


def daypart(hour: str = "ride_hour") -> Column:
    return range_label(hour, DAYPART_BUCKETS, DAYPART_ELSE)


def is_weekend_day_sql(iso_dow: str) -> str:
    return f"({q(iso_dow)} IN ({', '.join(map(str, WEEKEND_DAYS))}))"


def is_weekend_day(iso_dow: str = "day_of_week") -> Column:
    """Boolean: ISO day in (6, 7)."""
    return F.expr(is_weekend_day_sql(iso_dow))


def weekend_label(iso_dow: str = "day_of_week") -> Column:
    return F.expr(f"CASE WHEN {is_weekend_day_sql(iso_dow)} THEN {sql_str(WEEKEND_LABEL)} "
                  f"ELSE {sql_str(WEEKDAY_LABEL)} END")


def length_category(minutes: str = "ride_duration_minutes") -> Column:
    return upper_bound_label(minutes, LENGTH_BUCKETS, LENGTH_ELSE)


def distance_category(km: str = "distance_km") -> Column:
    return upper_bound_label(km, DISTANCE_BUCKETS, DISTANCE_ELSE, null_label=DISTANCE_NULL)

"""Row cleaning: lenient typing and validity rules as one narrow stage.

Every step is a projection or a filter over built-in expressions, so the
whole cleaner fuses into a single whole-stage-codegen span with no shuffle.
Steps run in the reference order: strings, types, required, order, bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import q, sql_str
from ..functions.timefn import elapsed_micros_sql
from ..schema import (COORD_COLUMNS, MAX_SECONDS, MIN_SECONDS, REQUIRED_COLUMNS,
                      STRING_COLUMNS, TIMESTAMP_COLUMNS)

# Extra wall-clock layouts tried after the ISO form (month/day/year first).
EXTRA_TIMESTAMP_FORMATS = ["M/d/yyyy H:mm:ss", "M/d/yyyy H:mm"]


def _replace(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    return df.withColumns(exprs) if exprs else df


def clean_strings(df: DataFrame, columns: Sequence[str] = STRING_COLUMNS) -> DataFrame:
    """Missing text becomes ''; values are cast to text; absent columns skipped."""
    return _replace(df, {c: F.expr(f"coalesce(CAST({q(c)} AS STRING), '')")
                         for c in columns if c in df.columns})


def parse_timestamp_sql(c: str, formats: Sequence[str] = EXTRA_TIMESTAMP_FORMATS) -> str:
    text = f"CAST({q(c)} AS STRING)"
    attempts = [f"try_cast({text} AS TIMESTAMP_NTZ)"]
    attempts += [f"CAST(try_to_timestamp({text}, {sql_str(fmt)}) AS TIMESTAMP_NTZ)" for fmt in formats]
    return f"coalesce({', '.join(attempts)})"


def parse_timestamp(c: str, formats: Sequence[str] = EXTRA_TIMESTAMP_FORMATS) -> Column:
    """Lenient wall-clock parse: unparseable text becomes NULL."""
    return F.expr(parse_timestamp_sql(c, formats))


def parse_double(c: str, nan_as_null: bool = True) -> Column:
    """Lenient numeric parse: unparseable text becomes NULL; 'NaN' too by default."""
    x = f"try_cast({q(c)} AS DOUBLE)"
    return F.expr(f"nanvl({x}, CAST(NULL AS DOUBLE))" if nan_as_null else x)


def clean_types(df: DataFrame, timestamp_columns: Sequence[str] = TIMESTAMP_COLUMNS,
                numeric_columns: Sequence[str] = COORD_COLUMNS, nan_as_null: bool = True,
                formats: Sequence[str] = EXTRA_TIMESTAMP_FORMATS) -> DataFrame:
    exprs = {c: parse_timestamp(c, formats) for c in timestamp_columns if c in df.columns}
    exprs.update({c: parse_double(c, nan_as_null) for c in numeric_columns if c in df.columns})
    return _replace(df, exprs)


def missing_required_sql(columns_present: Sequence[str], columns: Sequence[str] = REQUIRED_COLUMNS,
                         empty_as_missing: bool = False) -> str:
    terms = []
    for c in columns:
        if c in columns_present:
            terms.append(f"{q(c)} IS NULL")
            if empty_as_missing and c in STRING_COLUMNS:
                terms.append(f"{q(c)} = ''")
    return "(" + (" OR ".join(terms) or "false") + ")"


def missing_required(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS,
                     empty_as_missing: bool = False) -> Column:
    """True when any present required column is NULL (or '' if asked)."""
    return F.expr(missing_required_sql(df.columns, columns, empty_as_missing))


def clean_required(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS,
                   empty_as_missing: bool = False) -> DataFrame:
    return df.filter(~missing_required(df, columns, empty_as_missing))


def in_order_sql(start: str = "started_at", end: str = "ended_at") -> str:
    return f"({q(start)} < {q(end)})"


def in_order(start: str = "started_at", end: str = "ended_at") -> Column:
    return F.expr(in_order_sql(start, end))


def in_bounds_sql(start: str = "started_at", end: str = "ended_at",
                  min_seconds: int = MIN_SECONDS, max_seconds: int = MAX_SECONDS) -> str:
    return (f"({elapsed_micros_sql(start, end)} BETWEEN {int(min_seconds) * 1_000_000} "
            f"AND {int(max_seconds) * 1_000_000})")


def in_bounds(start: str = "started_at", end: str = "ended_at",
              min_seconds: int = MIN_SECONDS, max_seconds: int = MAX_SECONDS) -> Column:
    """Elapsed seconds within [min, max], inclusive, microsecond exact."""
    return F.expr(in_bounds_sql(start, end, min_seconds, max_seconds))


def clean_bounds(df: DataFrame, start: str = "started_at", end: str = "ended_at",
                 min_seconds: int = MIN_SECONDS, max_seconds: int = MAX_SECONDS) -> DataFrame:
    if start not in df.columns or end not in df.columns:
        return df
    return df.filter(F.expr(f"{in_order_sql(start, end)} AND "
                            f"{in_bounds_sql(start, end, min_seconds, max_seconds)}"))


def clean_trips(df: DataFrame, empty_as_missing: bool = False, nan_as_null: bool = True) -> DataFrame:
    """The whole cleaner: strings -> types -> required -> order -> bounds."""
    df = clean_types(clean_strings(df), nan_as_null=nan_as_null)
    return clean_bounds(clean_required(df, empty_as_missing=empty_as_missing))


def drop_reason(df: DataFrame, empty_as_missing: bool = False) -> Column:
    """First rule a *typed* row fails ('missing', 'order', 'bounds') or NULL."""
    whens = [f"WHEN {missing_required_sql(df.columns, empty_as_missing=empty_as_missing)} THEN 'missing'"]
    if all(c in df.columns for c in ("started_at", "ended_at")):
        whens += [f"WHEN NOT {in_order_sql()} THEN 'order'", f"WHEN NOT {in_bounds_sql()} THEN 'bounds'"]
    return F.expr(f"CASE {' '.join(whens)} END")


def drop_report(text: DataFrame, empty_as_missing: bool = False) -> DataFrame:
    """One row: input rows, rows dropped per rule, rows kept (one aggregate)."""
    typed = clean_types(clean_strings(text))
    r = drop_reason(typed, empty_as_missing)
    return typed.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(r == "missing").alias("dropped_missing"),
        F.count_if(r == "order").alias("dropped_order"),
        F.count_if(r == "bounds").alias("dropped_bounds"),
        F.count_if(r.isNull()).alias("kept_rows"),
    )


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill NULLs with column defaults; a missing column becomes the default."""
    exprs = {}
    for c, v in defaults.items():
        lit = v if isinstance(v, Column) else F.lit(v)
        exprs[c] = F.coalesce(F.col(c), lit) if c in df.columns else lit
    return df.withColumns(exprs)

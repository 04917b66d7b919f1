"""Human-readable size / quantity strings and rounding helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col, q

# --- Fixed values: unit suffixes, smallest first ----------------------------
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB", "ZiB", "YiB"]
SIZE_BASE = 1024
QUANTITY_UNITS = ["", "thousand", "million", "billion", "trillion", "quadrillion",
                  "quintillion", "sextillion", "septillion"]
QUANTITY_BASE = 1000
# ---------------------------------------------------------------------------


def round_half_up(c, decimals: int = 2) -> Column:
    return F.round(col(c), decimals)


def round_half_even(c, decimals: int = 2) -> Column:
    return F.bround(col(c), decimals)


def fixed2_sql(x: str) -> str:
    """Round half-up to two decimals and render as text with both digits."""
    return f"CAST(CAST(round(CAST({x} AS DOUBLE), 2) AS DECIMAL(38,2)) AS STRING)"


def fixed2(c: str) -> Column:
    return F.expr(fixed2_sql(q(c)))


def _readable_sql(c: str, base: int, units: list[str]) -> str:
    x = f"CAST({q(c)} AS DOUBLE)"
    whens = []
    for i in range(len(units) - 1, 0, -1):
        p = f"{float(base) ** i!r}D"
        whens.append(f"WHEN abs({x}) >= {p} THEN concat({fixed2_sql(f'{x} / {p}')}, ' {units[i]}')")
    return f"CASE WHEN {x} IS NULL THEN CAST(NULL AS STRING) {' '.join(whens)} ELSE {fixed2_sql(x)}" + (
        f" || ' {units[0]}'" if units[0] else "") + " END"


def human_size(c: str) -> Column:
    """Bytes with binary units: 1536 -> '1.50 KiB', 1000 -> '1000.00 B'."""
    return F.expr(_readable_sql(c, SIZE_BASE, SIZE_UNITS))


def human_quantity(c: str) -> Column:
    """Counts with word units: 950000 -> '950.00 thousand', 12 -> '12.00'."""
    return F.expr(_readable_sql(c, QUANTITY_BASE, QUANTITY_UNITS))

"""All levels of the member x bike x date rollup from one scan.

The finest level is aggregated once from the raw rows; every coarser one is
a grouping set over those few rows (counts and minute sums add up), so the
raw rows are neither read again nor copied per level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rollups import member_rollup_rows

KEYS = ["member_casual", "rideable_type", "ride_date"]
# finest first; every level is a subset of the keys
LEVELS = (KEYS, ["member_casual", "ride_date"], ["rideable_type", "ride_date"], ["ride_date"],
          ["member_casual", "rideable_type"], ["member_casual"], ["rideable_type"], [])


def rollup_lattice(raw: DataFrame, levels: Sequence[Sequence[str]] = LEVELS) -> DataFrame:
    """(keys, level, total_rides, avg_duration): ``level`` is the grouping id,
    a bit per key (first key highest) that is set where the key is rolled up."""
    return lattice_of(member_rollup_rows(raw), levels)


def lattice_of(finest: DataFrame, levels: Sequence[Sequence[str]] = LEVELS) -> DataFrame:
    """The same from the stored finest level (``rollups``)."""
    unknown = {k for level in levels for k in level} - set(KEYS)
    if unknown:
        raise ValueError(f"levels of unknown keys: {sorted(unknown)}")
    sets = [[F.col(k) for k in level] for level in levels]
    out = finest.groupingSets(sets, *[F.col(k) for k in KEYS]).agg(
        F.grouping_id().cast("int").alias("level"), F.sum("total_rides").alias("total_rides"), F.sum("total_minutes").alias("_minutes"))
    return out.select(*KEYS, "level", "total_rides", (F.col("_minutes") / F.col("total_rides")).alias("avg_duration"))

"""Declared schemas and the fixed column lists of the trip data model.

The raw table has a fixed schema; CSV input is read as text and coerced
into it (see ``ridelake.operators.clean``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must equal the reference's data model) -------------------
# CSV columns, in the order the raw table declares them.
CSV_COLUMNS = [
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
]
# Columns a row may not miss.
REQUIRED_COLUMNS = ["ride_id", "rideable_type", "started_at", "ended_at", "member_casual"]
# Text columns whose missing values become the empty string.
STRING_COLUMNS = [
    "ride_id",
    "rideable_type",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "member_casual",
    "source_file",
]
TIMESTAMP_COLUMNS = ["started_at", "ended_at"]
COORD_COLUMNS = ["start_lat", "start_lng", "end_lat", "end_lng"]
MEMBER_VALUES = ["member", "casual"]
BIKE_VALUES = ["electric_bike", "classic_bike"]
# Trip bounds: strict start < end, then 60..86400 elapsed seconds (cleaner)
# and 1..1440 crossed minutes (staging).
MIN_SECONDS, MAX_SECONDS = 60, 86400
MIN_MINUTES, MAX_MINUTES = 1, 1440
# ---------------------------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [
        T.StructField("ride_id", T.StringType(), False),
        T.StructField("rideable_type", T.StringType(), False),
        T.StructField("started_at", T.TimestampNTZType(), True),
        T.StructField("ended_at", T.TimestampNTZType(), True),
        T.StructField("start_station_name", T.StringType(), False),
        T.StructField("start_station_id", T.StringType(), False),
        T.StructField("end_station_name", T.StringType(), False),
        T.StructField("end_station_id", T.StringType(), False),
        T.StructField("start_lat", T.DoubleType(), True),
        T.StructField("start_lng", T.DoubleType(), True),
        T.StructField("end_lat", T.DoubleType(), True),
        T.StructField("end_lng", T.DoubleType(), True),
        T.StructField("member_casual", T.StringType(), False),
        T.StructField("source_file", T.StringType(), False),
        T.StructField("loaded_at", T.TimestampNTZType(), True),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CSV_COLUMNS])


def missing_columns(columns, required=REQUIRED_COLUMNS) -> list[str]:
    """Required names absent from ``columns``, in declared order."""
    present = set(columns)
    return [c for c in required if c not in present]


def require_columns(df, required=REQUIRED_COLUMNS) -> None:
    """Raise ``ValueError`` listing every required column the frame lacks."""
    missing = missing_columns(df.columns, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")

"""Trip records derived from the driver's ``events`` table.

The test tables carry no trip data, so every trip query reads ``events``
through this deterministic adapter (one narrow projection, no shuffle).
The same formulas exist as SQL in ``ridelake.oracle`` so DuckDB can check
the results.  Work grows with ``events``: one trip per event.

Rules (event columns -> raw trip columns):
  ride_id        'R' || (event_id, less 1 when event_id % 10 = 9)  -> duplicate keys
  rideable_type  electric_bike when event_id % 3 = 0 else classic_bike
  started_at     ts
  ended_at       ts + floor(value * 60) s, or value * 600 for type 'error'
  start station  '' when user_id % 50 = 0 else 'S' || user_id % 50
  end station    'S' || (user_id * 7 + event_id) % 50
  names          'Station ' || n, plus ' (new)' when event_id % 7 > 3
  start lat/lng  40.7 + n*0.001 / -74.08 + n*0.001 (0 for the missing station)
  end lat/lng    40.7 + k*0.0013 / -74.08 + k*0.0017
  member_casual  member for view and click, else casual
  source_file    'f' || event_id % 3 || '.csv'
  loaded_at      2024-02-01 00:00 + event_id % 7 hours
Dirty text variants (for the cleaner) are listed in ``raw_text_from_events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CSV_COLUMNS

LOADED_BASE = "2024-02-01 00:00:00"
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_NEW = "CASE WHEN event_id % 7 > 3 THEN ' (new)' ELSE '' END"
_SNUM = "(user_id % 50)"
_ENUM = "((user_id * 7 + event_id) % 50)"
_HAS_START = f"{_SNUM} != 0"
RAW_EXPRS = {
    "ride_id": "concat('R', CAST(event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END AS STRING))",
    "rideable_type": "CASE WHEN event_id % 3 = 0 THEN 'electric_bike' ELSE 'classic_bike' END",
    "started_at": "ts",
    "ended_at": "timestampadd(SECOND, floor(value * CASE WHEN event_type = 'error' THEN 600.0D ELSE 60.0D END), ts)",
    "start_station_name": f"CASE WHEN {_HAS_START} THEN concat('Station ', CAST({_SNUM} AS STRING), {_NEW}) ELSE '' END",
    "start_station_id": f"CASE WHEN {_HAS_START} THEN concat('S', CAST({_SNUM} AS STRING)) ELSE '' END",
    "end_station_name": f"concat('Station ', CAST({_ENUM} AS STRING), {_NEW})",
    "end_station_id": f"concat('S', CAST({_ENUM} AS STRING))",
    "start_lat": f"CASE WHEN {_HAS_START} THEN 40.7D + CAST({_SNUM} AS DOUBLE) * 0.001D ELSE 0.0D END",
    "start_lng": f"CASE WHEN {_HAS_START} THEN -74.08D + CAST({_SNUM} AS DOUBLE) * 0.001D ELSE 0.0D END",
    "end_lat": f"40.7D + CAST({_ENUM} AS DOUBLE) * 0.0013D",
    "end_lng": f"-74.08D + CAST({_ENUM} AS DOUBLE) * 0.0017D",
    "member_casual": "CASE WHEN event_type IN ('view', 'click') THEN 'member' ELSE 'casual' END",
    "source_file": "concat('f', CAST(event_id % 3 AS STRING), '.csv')",
    "loaded_at": f"timestampadd(HOUR, event_id % 7, TIMESTAMP_NTZ '{LOADED_BASE}')",
}


def raw_trips_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed raw trips (the raw-table schema) from ``events``.

    ``keep`` names event columns carried through after the trip columns.
    """
    return events.select(*[F.expr(e).alias(n) for n, e in RAW_EXPRS.items()], *keep)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips_from_events(read_table(spark, sf_dir, "events"))


def raw_text_from_events(events: DataFrame, with_source: bool = True) -> DataFrame:
    """The raw trips as CSV text (all strings), with dirty variants.

    Dirty rules, keyed on event_id:
      % 101 = 0  ride_id missing (NULL)
      % 97 = 0   started_at unparseable ('not a time')
      % 89 = 0   start_lat is the literal 'NaN'
      % 83 = 0   end_lng unparseable ('x')
      % 79 = 0   member_casual missing (NULL)
      start_station_id missing (NULL) instead of '' for the missing station
    Timestamps are written as ``yyyy-MM-dd HH:mm:ss.SSSSSS``.
    """
    t = raw_trips_from_events(events, keep=("event_id",))
    fmt = f"'{TS_TEXT_FORMAT}'"
    out = {
        "ride_id": "CASE WHEN event_id % 101 = 0 THEN NULL ELSE ride_id END",
        "rideable_type": "rideable_type",
        "started_at": f"CASE WHEN event_id % 97 = 0 THEN 'not a time' ELSE date_format(started_at, {fmt}) END",
        "ended_at": f"date_format(ended_at, {fmt})",
        "start_station_name": "start_station_name",
        "start_station_id": "CASE WHEN start_station_id = '' THEN NULL ELSE start_station_id END",
        "end_station_name": "end_station_name",
        "end_station_id": "end_station_id",
        "start_lat": "CASE WHEN event_id % 89 = 0 THEN 'NaN' ELSE CAST(start_lat AS STRING) END",
        "start_lng": "CAST(start_lng AS STRING)",
        "end_lat": "CAST(end_lat AS STRING)",
        "end_lng": "CASE WHEN event_id % 83 = 0 THEN 'x' ELSE CAST(end_lng AS STRING) END",
        "member_casual": "CASE WHEN event_id % 79 = 0 THEN NULL ELSE member_casual END",
    }
    cols = [F.expr(out[c]).alias(c) for c in CSV_COLUMNS]
    if with_source:
        cols += [F.col("source_file"), F.col("loaded_at")]
    return t.select(*cols)

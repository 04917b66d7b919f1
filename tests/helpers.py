import datetime as dt

from pyspark.sql import types as T

from ridelake.schema import RAW_SCHEMA

BASE = dt.datetime(2024, 1, 5, 10, 0, 0)  # a Friday


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def raw_rows(spark, rows):
    """Build raw trips from dicts; unspecified columns get simple defaults."""
    defaults = dict(rideable_type="classic_bike", start_station_name="Station 1", start_station_id="S1",
                    end_station_name="Station 2", end_station_id="S2", start_lat=40.71, start_lng=-74.0,
                    end_lat=40.72, end_lng=-74.01, member_casual="member", source_file="f.csv",
                    loaded_at=ts("2024-02-01 00:00:00"))
    out = []
    for r in rows:
        d = {**defaults, **r}
        out.append(tuple(d.get(f.name) for f in RAW_SCHEMA.fields))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW_SCHEMA.fields])
    return spark.createDataFrame(out, schema)

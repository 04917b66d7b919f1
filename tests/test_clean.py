import pytest
from pyspark.sql import functions as F

from ridelake.operators.clean import clean_strings, clean_trips, clean_types, drop_report
from ridelake.schema import CSV_COLUMNS, require_columns


def text_frame(spark, rows):
    cols = CSV_COLUMNS + ["source_file"]
    full = []
    for r in rows:
        base = {c: None for c in cols}
        base.update({"ride_id": "R1", "rideable_type": "classic_bike", "started_at": "2024-01-05 10:00:00",
                     "ended_at": "2024-01-05 10:10:00", "member_casual": "member", "start_lat": "40.7",
                     "start_lng": "-74.0", "end_lat": "40.71", "end_lng": "-74.01", "source_file": "a.csv"})
        base.update(r)
        full.append(tuple(base[c] for c in cols))
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in cols))


def test_bounds_are_inclusive_and_strict(spark):
    rows = [
        {"ride_id": "exact60", "ended_at": "2024-01-05 10:01:00"},
        {"ride_id": "short", "ended_at": "2024-01-05 10:00:59.999"},
        {"ride_id": "exact1d", "ended_at": "2024-01-06 10:00:00"},
        {"ride_id": "long", "ended_at": "2024-01-06 10:00:01"},
        {"ride_id": "same", "ended_at": "2024-01-05 10:00:00"},
        {"ride_id": "reversed", "ended_at": "2024-01-05 09:00:00"},
    ]
    kept = {r[0] for r in clean_trips(text_frame(spark, rows)).select("ride_id").collect()}
    assert kept == {"exact60", "exact1d"}
    rep = drop_report(text_frame(spark, rows)).first().asDict()
    assert rep == {"input_rows": 6, "dropped_missing": 0, "dropped_order": 2, "dropped_bounds": 2, "kept_rows": 2}


def test_lenient_parsing(spark):
    rows = [{"ride_id": "bad_ts", "started_at": "garbage"},
            {"ride_id": "nan", "start_lat": "NaN", "end_lng": "x"},
            {"ride_id": "us", "started_at": "1/5/2024 10:00", "ended_at": "1/5/2024 10:05:30"}]
    typed = {r["ride_id"]: r for r in clean_types(clean_strings(text_frame(spark, rows))).collect()}
    assert typed["bad_ts"]["started_at"] is None
    assert typed["nan"]["start_lat"] is None and typed["nan"]["end_lng"] is None
    assert str(typed["us"]["ended_at"]) == "2024-01-05 10:05:30"


def test_missing_text_policy(spark):
    rows = [{"ride_id": None}, {"ride_id": "R2", "member_casual": None}, {"ride_id": "R3", "start_station_id": None}]
    parity = clean_trips(text_frame(spark, rows))
    assert sorted(r[0] for r in parity.select("ride_id").collect()) == ["", "R2", "R3"]
    assert parity.filter(F.col("ride_id") == "R3").first()["start_station_id"] == ""
    strict = clean_trips(text_frame(spark, rows), empty_as_missing=True)
    assert [r[0] for r in strict.select("ride_id").collect()] == ["R3"]


def test_station_id_kept_verbatim(spark):
    out = clean_trips(text_frame(spark, [{"start_station_id": "0012"}]))
    assert out.first()["start_station_id"] == "0012"


def test_require_columns_raises_with_list(spark):
    df = spark.createDataFrame([("x",)], "ride_id string")
    with pytest.raises(ValueError, match="started_at"):
        require_columns(df)

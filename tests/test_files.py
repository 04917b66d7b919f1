import io
import os
import tempfile
import zipfile

from pyspark import TaskContext
from pyspark.sql import functions as F

from ridelake.operators.reports import file_report
from ridelake.operators.sinks import read_raw, write_raw
from ridelake.schema import CSV_COLUMNS
from ridelake.sources.files import list_files, read_zipped_csv, select_files

from helpers import raw_rows, ts


def _touch(d, names):
    for n in names:
        with open(os.path.join(d, n), "w") as fh:
            fh.write("x\n")


def test_file_select(spark):
    d = tempfile.mkdtemp(prefix="ridelake-sel-")
    _touch(d, ["TR-202401.zip", "TR-202402.zip", "TR-202403.zip", "XX-202401.zip", "TR-202401.csv"])
    listing = list_files(spark, d, pattern=None)
    names = lambda df: [r[0] for r in df.select("name").collect()]
    assert names(select_files(listing, "TR", ".zip")) == ["TR-202401.zip", "TR-202402.zip", "TR-202403.zip"]
    assert names(select_files(listing, "TR", ".zip", start_from="TR-202402.zip")) == ["TR-202402.zip", "TR-202403.zip"]
    assert names(select_files(listing, "TR", ".zip", start_from="TR-209901.zip")) == []
    assert names(select_files(listing, "TR", ".zip", limit=2)) == ["TR-202401.zip", "TR-202402.zip"]
    assert names(select_files(listing, "TR", ".zip", limit=0)) == ["TR-202401.zip", "TR-202402.zip", "TR-202403.zip"]


def test_zip_scan_binds_by_header(spark):
    d = tempfile.mkdtemp(prefix="ridelake-zip-")
    rows = [["R1", "classic_bike", "2024-01-05 10:00:00", "2024-01-05 10:10:00", "A", "S1", "B", "S2",
             "40.7", "-74.0", "40.71", "-74.01", "member"]]
    for name, cols in (("TR-1.zip", CSV_COLUMNS), ("TR-2.zip", list(reversed(CSV_COLUMNS)))):
        buf = io.StringIO()
        buf.write(",".join(cols) + "\n")
        for r in rows:
            rec = dict(zip(CSV_COLUMNS, r))
            buf.write(",".join(rec[c] for c in cols) + "\n")
        with zipfile.ZipFile(os.path.join(d, name), "w") as z:
            z.writestr("__MACOSX/._trips.csv", "junk")
            z.writestr("trips.csv", buf.getvalue())
    out = read_zipped_csv(spark, d).orderBy("source_file").collect()
    assert [r["source_file"] for r in out] == ["TR-1.zip", "TR-2.zip"]
    assert all(r["ride_id"] == "R1" and r["member_casual"] == "member" and r["start_lat"] == "40.7" for r in out)


def test_file_report_and_partition_pruning(spark):
    root = tempfile.mkdtemp(prefix="ridelake-raw-") + "/raw"
    raw = raw_rows(spark, [
        dict(ride_id="1", started_at=ts("2024-01-05 10:00:00"), ended_at=ts("2024-01-05 10:30:00"), source_file="a.csv"),
        dict(ride_id="2", started_at=ts("2024-02-05 10:00:00"), ended_at=ts("2024-02-05 10:30:00"), source_file="a.csv"),
        dict(ride_id="3", started_at=ts("2024-02-06 10:00:00"), ended_at=ts("2024-02-06 10:30:00"), source_file="b.csv"),
    ])
    write_raw(raw, root)
    rep = {(r.year_month, r.source_file): r for r in file_report(read_raw(spark, root), ["year_month", "source_file"]).collect()}
    assert {k: v.total_rows for k, v in rep.items()} == {(202401, "a.csv"): 1, (202402, "a.csv"): 1, (202402, "b.csv"): 1}
    assert all(v.files_count >= 1 and v.bytes_on_disk > 0 and v.size_on_disk.endswith("B") for v in rep.values())
    plan = read_raw(spark, root, months=[202402])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "202402" in plan
    # replaying a file rewrites its leaves only
    write_raw(raw.filter(F.col("source_file") == "b.csv"), root)
    assert read_raw(spark, root).count() == 3


def test_named_csv_is_written_by_all_tasks(spark):
    """Each file's rows are formatted by the tasks that read them: one file, one header, rows in the order of the input."""
    from ridelake.sources.files import write_named_csv
    d = tempfile.mkdtemp(prefix="ridelake-named-")
    note = F.when(F.col("id") % 5 == 0, F.lit('a "q", b')).when(F.col("id") % 7 == 0, F.lit("")).otherwise(F.lit("ä"))
    rows = spark.range(0, 1000, 1, 6).select("id", F.when(F.col("id") % 3 > 0, note).alias("note"),
                                             F.concat(F.lit("f"), (F.col("id") % 2).cast("string"), F.lit(".csv")).alias("source_file"))
    # a name whose rows lie in the last partition only
    rows = rows.withColumn("source_file", F.when(F.col("id") > 990, "late.csv").otherwise(F.col("source_file")))
    seen = spark.sparkContext.accumulator(0)  # sum of the numbers of the tasks that made rows
    counted = rows.rdd.mapPartitions(lambda it: (seen.add(TaskContext.get().partitionId()), it)[1]).toDF(rows.schema)
    paths = write_named_csv(counted, d, header_order={"f1.csv": ["note", "id"]})
    assert [os.path.basename(p) for p in paths] == ["f0.csv", "f1.csv", "late.csv"] and sorted(f for f in os.listdir(d) if f[0] != ".") == ["f0.csv", "f1.csv", "late.csv"]
    assert seen.value == sum(range(6)) * (1 + 3)  # names once, then each file by all tasks
    whole = tempfile.mkdtemp(prefix="ridelake-whole-")
    for name, cols in (("f0.csv", ["id", "note"]), ("f1.csv", ["note", "id"]), ("late.csv", ["id", "note"])):
        one = rows.where(F.col("source_file") == name).select(*cols)
        one.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{whole}/{name}")
        part = next(p for p in os.listdir(f"{whole}/{name}") if p.startswith("part-"))
        with open(f"{whole}/{name}/{part}", "rb") as a, open(f"{d}/{name}", "rb") as b:
            assert a.read() == b.read()
        parts = spark.read.option("header", True).option("escape", '"').csv(f"{d}/{name}")
        assert parts.count() == one.count()


def test_zip_scan_has_more_archives_for_more_rows(spark, monkeypatch):
    """An archive is written by one task and read by one, so their number follows the rows."""
    from ridelake.operators import sinks
    from ridelake.plans import registry, registry_spans
    from conftest import SF_SMOKE
    reports = []
    load = sinks.load_trip_files
    monkeypatch.setattr(sinks, "load_trip_files", lambda *a, **k: (reports.append(load(*a, **k)), reports[-1])[1])
    monkeypatch.setattr(registry_spans, "ARCHIVE_ROWS", 70)  # 334 and 333 rows a source file
    few = registry.QUERIES["zip_scan"](spark, SF_SMOKE)
    assert len(reports[0]["loaded"]) == 2 * 5
    monkeypatch.undo()
    whole = registry.QUERIES["zip_scan"](spark, SF_SMOKE)
    assert sorted(map(str, few.collect())) == sorted(map(str, whole.collect()))

"""File sources: listing and selection, CSV by header name, zipped CSV.

Listing uses the ``binaryFile`` source with the content column pruned, so
only file metadata is read.  CSV files are grouped by header line and read
one scan per group (each scan binds by position to *its* header), then the
groups are aligned by name; files lacking a required column are rejected
instead of silently shifting columns.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Sequence
from functools import partial, reduce
from itertools import chain
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition,
                                    WriterCommitMessage)

from ..schema import CSV_COLUMNS, REQUIRED_COLUMNS, missing_columns
from ..session import concurrently


def plain_path(path: str) -> str:
    """A path without its scheme."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/", path)


def source_id(path: str, landing: str | None = None) -> str:
    """What a file is known by: its path below ``landing``, else its base name."""
    path = plain_path(path)
    base = plain_path(landing).rstrip("/") + "/" if landing else None
    return path[len(base):] if base and path.startswith(base) else path.rsplit("/", 1)[-1]


def source_file(landing: str | None = None) -> Column:
    """``source_id`` of the file a row was read from (the metadata path is URL-encoded)."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    name = F.element_at(F.split(path, "/"), -1)
    if not landing:
        return name
    base = plain_path(landing).rstrip("/") + "/"
    at = F.locate(base, path)
    return F.when(at > 0, F.substr(path, at + len(base))).otherwise(name)


def file_name(path_col: str = "path") -> Column:
    return F.element_at(F.split(F.col(path_col), "/"), -1)


def list_files(spark: SparkSession, root: str, pattern: str | None = "*.csv",
               recursive: bool = False) -> DataFrame:
    """(path, name, length, modificationTime) of the files under ``root``."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(root).select("path", "length", "modificationTime")
    return df.withColumn("name", file_name("path")).select("path", "name", "length", "modificationTime")


def select_files(listing: DataFrame, prefix: str = "", suffix: str = "", start_from: str | None = None,
                 limit: int = 0) -> DataFrame:
    """Names with ``prefix``/``suffix``, from ``start_from`` (inclusive, name
    order) onwards -- none at all if that name is absent -- then the first
    ``limit`` (0 = all)."""
    df = listing.filter(F.col("name").startswith(prefix) & F.col("name").endswith(suffix))
    if start_from is not None:
        # one-row existence probe: an absent start name selects nothing
        if not df.filter(F.col("name") == start_from).limit(1).collect():
            return df.limit(0)
        df = df.filter(F.col("name") >= start_from)
    df = df.orderBy("name")
    return df.limit(limit) if limit else df


def header_columns(line: str | None) -> tuple[str, ...]:
    """Column names of a header line."""
    line = (line or "").lstrip("\ufeff")
    return tuple(c.strip().strip('"') for c in line.split(",")) if line else ()


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Header of every path, () where there is none to read.

    The first line of a file is read by a task of its own, by a limit, which
    ends the scan there; the driver opens no file and gets one line per file.
    (A Python function that returns early does not end it: Spark reads on.)
    """
    from pyspark.errors import AnalysisException

    def read(path: str) -> tuple[str, ...]:
        text = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
        try:
            lines = text.text(path).where("_metadata.file_block_start = 0").select("value").limit(1).collect()
        except AnalysisException:  # the path does not exist
            return ()
        return header_columns(lines[0][0]) if lines else ()

    paths = list(dict.fromkeys(paths))
    return dict(zip(paths, concurrently(spark, *[partial(read, p) for p in paths], width=8)))


def group_by_header(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by header; a file that cannot be read has an empty one."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, header in headers(spark, list(paths)).items():
        groups[header].append(path)
    return dict(groups)


class Rejected(dict):
    """Paths that cannot be loaded, with the reason."""


CORRUPT = "_corrupt_record"


def read_csv_by_name(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = CSV_COLUMNS,
                     required: Sequence[str] = REQUIRED_COLUMNS, with_file: bool = True,
                     landing: str | None = None, multiline: bool = False, with_malformed: bool = False,
                     ) -> tuple[DataFrame | None, list[str]]:
    """Read CSV files as text bound **by header name**.

    Returns (frame with ``columns`` [+ ``source_file``], rejected paths).
    Unknown extra columns are dropped; a missing optional column is NULL.
    Quotes inside quoted fields are doubled.  ``multiline`` allows line
    breaks in quoted fields, at the price that a file is read by one task;
    without it such a record is malformed.  ``with_malformed`` adds the flag
    ``_malformed``: the record has other fields than its header.
    """
    rejected = Rejected()
    frame = _csv_frame(spark, paths, columns, required, with_file, landing, multiline, with_malformed, rejected)
    return frame, list(rejected)


def _csv_frame(spark, paths, columns, required, with_file, landing, multiline, with_malformed, rejected: Rejected) -> DataFrame | None:
    frames = []
    for header, files in group_by_header(spark, paths).items():
        if missing := missing_columns(header, required):
            why = f"missing columns: {', '.join(missing)}" if header else "no header can be read"
            rejected.update(dict.fromkeys(files, why))
            continue
        schema = T.StructType([T.StructField(h, T.StringType(), True) for h in (*header, CORRUPT)])
        df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
              .option("escape", '"').option("multiLine", multiline).option("columnNameOfCorruptRecord", CORRUPT)
              .csv(list(files)))
        cols = [F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c) for c in columns]
        if with_file:
            cols.append(source_file(landing).alias("source_file"))
        if with_malformed:
            cols.append(F.col(CORRUPT).isNotNull().alias("_malformed"))
        frames.append(df.select(*cols))
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def read_trip_files(spark: SparkSession, paths: Sequence[str], landing: str | None = None, multiline: bool = False,
                    rejected: Rejected | None = None) -> DataFrame | None:
    """Plain, gzipped and zipped CSV files as one frame: the CSV columns, source_file, _malformed.

    Paths that cannot be loaded are entered in ``rejected``; None when no path is left."""
    rejected = Rejected() if rejected is None else rejected
    zips = [p for p in paths if p.lower().endswith(".zip")]
    plain = [p for p in paths if p not in set(zips)]
    text = _csv_frame(spark, plain, CSV_COLUMNS, REQUIRED_COLUMNS, True, landing, multiline, True, rejected) if plain else None
    if zips:
        rejected.update(rejected_archives(spark, zips))
        good = [p for p in zips if p not in rejected]
        if good:
            more = read_zipped_csv(spark, good, landing=landing)
            text = more if text is None else text.unionByName(more)
    return text


def write_named_csv(df: DataFrame, out_dir: str, name_col: str = "source_file",
                    header_order: dict[str, Sequence[str]] | None = None) -> list[str]:
    """Write one CSV file per distinct ``name_col`` value, named by the value
    (e.g. trip files named like their source).  ``header_order`` may give a
    per-file column list (reordered or missing columns).  Returns the paths.

    Used to stage test inputs from the driver tables.  All tasks of the scan
    write parts of a file; one task per file then only copies their bytes, in
    part order, and the rename is a metadata operation.
    """
    spark = df.sparkSession
    names = sorted(r[0] for r in df.select(name_col).distinct().collect())  # one per file
    if not names:
        return []
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()

    def folder(name: str):
        path = jvm.org.apache.hadoop.fs.Path(f"{out_dir}/_tmp_{name}")
        return path, path.getFileSystem(conf)

    def write(name: str) -> tuple[str, str, list[str]]:
        cols = list((header_order or {}).get(name, [c for c in df.columns if c != name_col]))
        tmp = f"{out_dir}/_tmp_{name}"
        df.filter(F.col(name_col) == name).select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').csv(tmp)
        path, fs = folder(name)
        return name, tmp, sorted(n for s in fs.listStatus(path) if (n := s.getPath().getName()).startswith("part-"))

    _by_value()
    written = concurrently(spark, *[partial(write, n) for n in names])
    listed = spark.createDataFrame(written, "name string, folder string, parts array<string>").repartitionByRange(len(names), "name")
    out = []
    for r in listed.mapInArrow(_joined_parts(), "name string, joined string").collect():  # one row per file
        path, fs = folder(r.name)
        fs.rename(jvm.org.apache.hadoop.fs.Path(path, r.joined), jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{r.name}"))
        fs.delete(path, True)
        out.append(f"{out_dir}/{r.name}")
    return sorted(out)


def _joined_parts():
    """mapInArrow body: the parts of a CSV file as one, with the first one's header; (name, joined file in the folder)."""
    def join(batches):
        import io
        import shutil

        import pyarrow as pa
        from pyspark import TaskContext

        for batch in batches:
            for name, folder, parts in zip(*(batch.column(c).to_pylist() for c in ("name", "folder", "parts"))):
                draft = f"_joined-{TaskContext.get().taskAttemptId()}"  # of this attempt alone
                system, path = _system(folder)
                with system.open_output_stream(f"{path}/{draft}") as out:
                    headed = False
                    for part in parts:
                        with io.BufferedReader(system.open_input_stream(f"{path}/{part}"), 8 << 20) as source:
                            header = source.readline()
                            if not headed:
                                out.write(header)
                            headed = headed or bool(header)
                            shutil.copyfileobj(source, out, 8 << 20)
                yield pa.RecordBatch.from_pylist([{"name": name, "joined": draft}])
    return join


# --- zipped CSV -------------------------------------------------------------

def _by_value() -> None:
    # ship the task functions by value: executors need not have this package installed
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _system(path: str):
    """The file system of a path, any that Arrow knows (local, HDFS, object stores), and the path in it."""
    from pyarrow import fs

    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def _opened(path: str):
    """A seekable stream of a file."""
    system, path = _system(path)
    return system.open_input_file(path)


def _member(archive):
    """The first .csv member (not under __MACOSX) of an archive as a text stream, decompressed as it is read."""
    import io
    import zipfile

    z = zipfile.ZipFile(archive)
    members = [n for n in z.namelist() if n.endswith(".csv") and not n.startswith("__MACOSX")]
    return io.TextIOWrapper(z.open(members[0]), encoding="utf-8-sig", errors="replace", newline="") if members else None


class _ArchiveReader(DataSourceReader):
    """One partition per archive; a task holds one piece of the member at a time."""

    def __init__(self, schema: T.StructType, options: dict):
        self.columns = [f.name for f in schema if f.name not in ("source_file", "_malformed")]
        self.paths = json.loads(options["paths"])

    def partitions(self):
        return [InputPartition((path, name)) for path, name in self.paths]

    def read(self, partition):
        import csv

        import pyarrow as pa

        path, name = partition.value
        with _opened(path) as archive:
            stream = _member(archive)
            reader = csv.reader(stream or ())
            header = [c.strip() for c in next(reader, [])]
            at = [header.index(c) if c in header else -1 for c in self.columns]

            def piece(rows: list):
                columns = [pa.array([(r[i] or None) if 0 <= i < len(r) else None for r in rows], pa.string()) for i in at]
                columns += [pa.array([name] * len(rows), pa.string()), pa.array([len(r) != len(header) for r in rows], pa.bool_())]
                return pa.RecordBatch.from_arrays(columns, [*self.columns, "source_file", "_malformed"])

            rows = []
            for record in reader:
                if record:
                    rows.append(record)
                if len(rows) == ZIP_PIECE:
                    yield piece(rows)
                    rows = []
            if rows:
                yield piece(rows)


class _ArchiveWriter(DataSourceArrowWriter):
    """One archive per task, written batch by batch as rows come."""

    def __init__(self, schema: T.StructType, options: dict):
        self.columns, self.folder = [f.name for f in schema], options["path"]

    def write(self, batches):
        import csv
        import io
        import zipfile

        from pyarrow import fs
        from pyspark import TaskContext

        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return WriterCommitMessage()
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}"
        system, folder = fs.FileSystem.from_uri(re.sub(r"^(file:)?/+", "file:///", self.folder))
        system.create_dir(folder, recursive=True)
        draft = f"{folder}/_{name}-{context.taskAttemptId()}"
        with system.open_output_stream(draft) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open(f"{name}.csv", "w") as member:
            text = io.TextIOWrapper(member, encoding="utf-8", newline="")
            writer = csv.writer(text)
            writer.writerow(self.columns)
            for batch in chain([first], batches):
                writer.writerows(zip(*(column.to_pylist() for column in batch.columns)))
            text.flush()
            text.detach()
        system.move(draft, f"{folder}/{name}.zip")  # a repeated attempt replaces the same archive
        return WriterCommitMessage()


ZIP_PIECE = 20_000  # records held at a time


class ZippedCsv(DataSource):
    """Zipped CSV as a Spark format: ``spark.read.format("zipped_csv")`` through ``read_zipped_csv``,
    ``df.write.format("zipped_csv").mode("append").save(folder)`` for one archive per task."""

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def schema(self) -> T.StructType:
        columns = json.loads(self.options.get("columns", json.dumps(CSV_COLUMNS)))
        return T.StructType([*[T.StructField(c, T.StringType()) for c in (*columns, "source_file")], T.StructField("_malformed", T.BooleanType())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ArchiveReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return _ArchiveWriter(schema, self.options)


def register_zipped_csv(spark: SparkSession) -> None:
    _by_value()
    spark.dataSource.register(ZippedCsv)


def _archive_headers():
    """mapInPandas body: (path, header or NULL) of archives, reading only their directory and first line."""
    def lines(batches):
        import csv

        for pdf in batches:
            out = []
            for path in pdf["path"]:
                try:
                    with _opened(path) as archive:
                        stream = _member(archive)
                        out.append([c.strip() for c in next(csv.reader(stream), [])] if stream else [])
                except Exception:  # any archive that cannot be opened is rejected
                    out.append(None)
            yield pdf.assign(header=out)
    return lines


def rejected_archives(spark: SparkSession, paths: Sequence[str], required: Sequence[str] = REQUIRED_COLUMNS) -> dict[str, str]:
    """Those of the given archives that cannot be loaded: unreadable, or without a required column; with the reason."""
    _by_value()
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 200))
    found = listed.mapInPandas(_archive_headers(), "path string, header array<string>").collect()  # one row per archive
    out = {}
    for r in found:
        if r.header is None:
            out[r.path] = "no zip archive"
        elif not r.header:
            out[r.path] = "no CSV member with a header"
        elif missing := missing_columns(r.header, required):
            out[r.path] = f"missing columns: {', '.join(missing)}"
    return out


def read_zipped_csv(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.zip",
                    columns: Sequence[str] = CSV_COLUMNS, landing: str | None = None) -> DataFrame:
    """Zipped CSV archives (a folder or a list) as text columns bound by header
    name, one task per archive, read once; plus ``source_file`` and ``_malformed``."""
    if isinstance(paths, str):
        paths = [unquote(r[0]) for r in list_files(spark, paths, pattern).select("path").collect()]
    register_zipped_csv(spark)
    return (spark.read.format("zipped_csv").option("columns", json.dumps(list(columns)))
            .option("paths", json.dumps([(p, source_id(p, landing)) for p in paths])).load())

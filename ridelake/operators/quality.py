"""Declarative data-quality checks and load reports.

Checks fold into as few passes as possible: every not_null and
accepted_values check on one table is a single aggregate; each unique check
is one grouped aggregate (partial aggregation absorbs hot values).
Results are small DataFrames (one row per check); only ``raise_on_failure``
collects, and then only the failing check rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of ``not_null(column)``."""
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values occurring more than once, with their counts."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def accepted_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside ``values`` (NULL passes)."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))


@dataclass
class TableChecks:
    """Checks on one table: ``not_null`` columns, ``unique`` columns and
    ``accepted`` {column: values}."""
    name: str
    df: DataFrame
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)


def _row(table: str, column: str, check: str, failures: Column) -> Column:
    return F.struct(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                    F.lit(check).alias("check_name"), failures.cast("long").alias("failures"))


def table_check_rows(t: TableChecks) -> list[DataFrame]:
    parts = []
    rows = [_row(t.name, c, "not_null", F.count_if(F.col(c).isNull())) for c in t.not_null]
    rows += [_row(t.name, c, "accepted_values",
                  F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*vals)))
             for c, vals in t.accepted.items()]
    if rows:
        parts.append(t.df.agg(F.array(*rows).alias("r")).select(F.inline("r")))
    for c in t.unique:
        failing = unique_failures(t.df.select(c), c)
        parts.append(failing.agg(_row(t.name, c, "unique", F.count(F.lit(1))).alias("r"))
                     .select("r.*"))
    return parts


def suite(tables: Iterable[TableChecks]) -> DataFrame:
    """One row per check: (table_name, column_name, check_name, failures)."""
    parts = [p for t in tables for p in table_check_rows(t)]
    return reduce(DataFrame.unionByName, parts)


QUARANTINED = "_quarantined"


def write_checked(df: DataFrame, path: str, not_null: list[str] = (), accepted: dict[str, list] | None = None,
                  name: str = "table") -> DataFrame:
    """Write ``df`` with its row checks made on the way: the failing rows go to quarantine.

    One pass: the failures are observed while the rows are written, and the
    flag that tells good rows from failing ones is the folder they are
    written to (``read_checked``, ``read_quarantine``).  Returns one row per
    check as ``suite`` does; no second scan.
    """
    from pyspark.sql import Observation

    fails = {(c, "not_null"): F.col(c).isNull() for c in not_null}
    fails |= {(c, "accepted_values"): F.coalesce(~F.col(c).isin(*values), F.lit(False)) for c, values in (accepted or {}).items()}
    bad = reduce(lambda a, b: a | b, fails.values(), F.lit(False))
    obs = Observation(f"checks-{name}")
    counts = [F.count_if(f).alias(f"c{i}") for i, f in enumerate(fails.values())] or [F.count(F.lit(1)).alias("n")]
    (df.observe(obs, *counts).withColumn(QUARANTINED, bad).write.mode("overwrite").option("compression", "zstd")
     .partitionBy(QUARANTINED).parquet(path))
    rows = [(name, column, check, obs.get[f"c{i}"]) for i, (column, check) in enumerate(fails)]
    return df.sparkSession.createDataFrame(rows, "table_name string, column_name string, check_name string, failures long")


def _checked(df: DataFrame, path: str, bad: bool) -> DataFrame:
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, T.StructField(QUARANTINED, T.BooleanType())])
    return spark.read.schema(schema).parquet(path).where(F.col(QUARANTINED) == bad).drop(QUARANTINED)


def read_checked(df: DataFrame, path: str) -> DataFrame:
    """The rows of ``write_checked`` that passed; ``df`` gives their schema."""
    return _checked(df, path, False)


def read_quarantine(df: DataFrame, path: str) -> DataFrame:
    """The rows of ``write_checked`` that failed a check."""
    return _checked(df, path, True)


def failed(results: DataFrame) -> DataFrame:
    return results.filter(F.col("failures") > 0)


class ChecksFailed(Exception):
    pass


def raise_on_failure(results: DataFrame) -> DataFrame:
    """Suite runner: raise listing every failing check (one row per check
    reaches the driver), else return the results."""
    bad = failed(results).collect()
    if bad:
        raise ChecksFailed("; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in bad))
    return results


def quality_report(raw: DataFrame, epoch: str = "1970-01-01 00:00:00") -> DataFrame:
    """Load report: total rows, start-time range, empty / default counts."""
    started = F.col("started_at")
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(started).alias("min_started_at"),
        F.max(started).alias("max_started_at"),
        F.count_if(F.col("ride_id") == "").alias("empty_ride_id"),
        F.count_if(started.isNull() | (started == F.lit(epoch).cast("timestamp_ntz"))).alias("default_started_at"),
        F.count_if(F.col("start_station_id") == "").alias("empty_start_station"),
        F.count_if(F.col("end_station_id") == "").alias("empty_end_station"),
    )


def file_summary(raw: DataFrame) -> DataFrame:
    """Per source file: rows and first load time (files with a name only)."""
    return (raw.filter(F.col("source_file") != "").groupBy("source_file")
            .agg(F.count(F.lit(1)).alias("row_count"), F.min("loaded_at").alias("first_load")))


def smoke_summary(raw: DataFrame) -> DataFrame:
    """Row count, start-time range and two distinct counts."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_rides"),
        F.min("started_at").alias("earliest_ride"),
        F.max("started_at").alias("latest_ride"),
        F.count_distinct("member_casual").alias("user_types"),
        F.count_distinct("rideable_type").alias("bike_types"),
    )

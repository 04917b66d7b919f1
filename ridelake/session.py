"""Session construction and shared-storage scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every ridelake job relies on: text timestamps in other layouts
# are parsed in UTC (no daylight-saving gaps), AQE re-plans joins and
# partition counts from runtime sizes.  A join side is broadcast only when
# AQE has *measured* it (shuffle statistics) below the adaptive threshold;
# the static planner's size estimates never trigger a broadcast.  Write
# options (dynamic partition overwrite, zstd) are passed per write.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
}


def build_session(master: str | None = None, app: str = "ridelake", **conf) -> SparkSession:
    """Create (or reuse) a session with the settings ridelake expects."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime (SQL) settings to an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session; only a local session that has none gets a private
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ridelake-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/ridelake/{label}-{uuid.uuid4().hex[:12]}"


def concurrently(spark: SparkSession, *steps, width: int = 4) -> list:
    """Run independent steps (each of a few jobs) at the same time; their results, or the first error.

    Many steps of an increment are too small to fill a cluster one after the other.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    wrap = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=width) as pool:
        running = [pool.submit(wrap(step)) for step in steps]
        return [r.result() for r in running]

"""Session construction and lineage cutting.

On a cluster the session is created by the platform; ``configure`` only adds
what the library relies on (UTC session zone, AQE with skew handling, no UI)
and never overrides a value the cluster already set.
"""

from __future__ import annotations

import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE measures the materialized shuffle output before choosing a broadcast
    # join; this is the only broadcast path the library uses (see PLANNER).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# No broadcast from file-size estimates unless the session asks for it: a side is
# broadcast only after AQE has measured its shuffle output, otherwise the join
# stays sort-merge (with skew splitting).
PLANNER = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def get_session(master: str | None = None, app_name: str = "daygrid", **conf: str) -> SparkSession:
    """Get or create a session; ``master``/``conf`` are for local runs and tests."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # single JVM: the driver heap is the executors' heap
            builder = builder.config("spark.driver.memory", os.environ.get("DAYGRID_DRIVER_MEMORY", "8g"))
    builder = builder.config("spark.sql.ui.retainedExecutions", "50").config(
        "spark.cleaner.referenceTracking.cleanCheckpoints", "true"
    )
    for k, v in {**DEFAULTS, **PLANNER, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply library defaults where unset and make sure a checkpoint dir exists."""
    for k, v in {**DEFAULTS, **PLANNER}.items():
        try:
            current = spark.conf.get(k, None)
        except Exception:  # pragma: no cover - static confs
            current = None
        if current is None:
            try:
                spark.conf.set(k, v)
            except Exception:  # pragma: no cover - static confs
                pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session names none (local runs, tests) a private folder is
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (lineage cuts are written there)")
        configured = tempfile.mkdtemp(prefix="daygrid-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_all(*frames: DataFrame | None) -> list[DataFrame | None]:
    """``cut_lineage`` of independent frames at the same time (None stays None), so that
    each one's source is read once, whatever is built from it."""
    with ThreadPoolExecutor(max(1, len(frames))) as pool:
        return list(pool.map(lambda f: None if f is None else cut_lineage(f), frames))

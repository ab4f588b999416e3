"""Session helpers.

Library code never creates a session; it receives one.  ``build_session`` is for
tests, the benchmark and local runs.  On a cluster the platform's session is
used as is, and the only thing we may add is a checkpoint directory when the
cluster names none (``ensure_checkpoint_dir``).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


# checkpoint folders made here because none was named: gone with the machine, so nothing lasting goes there
TEMPORARY: set[str] = set()


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "geoindicators", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("GEO_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of materialized indicator rows are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's checkpoint directory; set a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is kept; without it this is an
    error there, because executors don't see the driver's folders.  The fallback (a fresh temporary
    folder) is for a local master only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return named
    if not fallback and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = fallback or tempfile.mkdtemp(prefix="geo-ckpt-")
    if not fallback:
        TEMPORARY.add(path)
    sc.setCheckpointDir(path)
    return path


def materialize(df):
    """Write ``df`` to the checkpoint folder and continue from there (lineage cut).

    Used at the point where big facts have become small indicator rows (years x
    geographies): everything downstream (alignment, scale, several document
    membership passes, scalar subqueries) then reads those rows instead of
    re-running the fact scan and roll-up once per consumer.  Reliable
    checkpoints live in the shared folder named by ``spark.checkpoint.dir``, so
    they survive the loss of an executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scale_conf(total_cores: int) -> dict[str, str]:
    """SQL settings for a large cluster (runtime-settable; see ``apply_unset``).

    Shuffles start with ~3 partitions per core and AQE coalesces them to
    ~256 MB each, which keeps each task's sort/aggregation buffers within executor
    memory; AQE also splits skewed join partitions (a key holding a third of the
    rows) and turns joins into broadcasts when a side turns out to be small.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def apply_unset(spark: SparkSession, conf: dict[str, str]) -> dict[str, str]:
    """Set the given SQL settings only where the session has no value of its own."""
    applied = {}
    for key, value in conf.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
            applied[key] = value
    return applied

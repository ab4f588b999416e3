"""Shared helpers: scratch tables in the cluster's shared folder, row ids, bounded driver reads."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, else the context's checkpoint folder.

    Only where both are unset (local runs and tests) a temporary folder is made; on a cluster
    without the setting this raises, because a machine-local folder is not visible to executors.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="corpus-shared-")
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, survives executor loss.

    by: columns whose values get folders of their own, so that a filter on them reads no others.
    The write's own shuffle files go once it has ended, as nothing else reads them; else they stay until the driver's garbage collection.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path, partitionBy=[*by] or None)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name: str = "_rid") -> DataFrame:
    """Add a row id; stable only once the result is written (``table``)."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def numbered(docs: DataFrame) -> DataFrame:
    """(_rid, _doc): the rows as structs, with a written row id; verdicts go by it, as ids may repeat or be null."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"))
    return table(with_row_id(rows), "numbered")


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents of ``numbered`` rows whose row id isn't in ``gone`` (_rid)."""
    return rows.join(gone.select("_rid"), "_rid", "left_anti").select("_doc.*")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package where they can't by themselves: added once per context as a zip, as with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    known = [os.path.abspath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    if root in known or any(f.endswith("geoindicators-package.zip") for f in sc.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "geoindicators-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "geoindicators")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), root))
    sc.addPyFile(path)

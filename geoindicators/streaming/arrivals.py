"""File arrivals: new snapshots in the landing directories recompute their dependents.

Each landing directory is watched by a Structured Streaming file source.  ``watch``
hands every micro-batch (the rows of the files that arrived since the last one) to a
callback.  ``recompute_available`` is the scheduled form: it waits until the landing
area has been quiet for a while, lets every stream process what has landed, gathers the
sources that had files and publishes each dataset that reads one of them once, one
after the other, so two sources of one dataset never write its folder at the same time.

State under ``checkpoint_root``: the file sources' logs of processed files, and a log of
arrivals (``pending``) and of arrivals that have been published (``done``).  A run that
dies between the two publishes again next time.  Published outputs are overwritten, so
that is idempotent.  The root must outlive the driver; there is no temporary default.
"""

from __future__ import annotations

import datetime
import time
import uuid
from typing import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geoindicators.session import TEMPORARY


def dependents() -> dict[str, list[str]]:
    """Which datasets each landing source feeds, from the datasets' own source lists."""
    from geoindicators import datasets
    out: dict[str, list[str]] = {}
    for name, spec in sorted(datasets.registry().items()):
        for source in spec.sources:
            out.setdefault(source, []).append(name)
    return out


def arrivals_stream(spark: SparkSession, landing_dir: str, schema, fmt: str = "csv", sep: str = ";") -> DataFrame:
    """Streaming DataFrame of the rows of newly arrived files, with their file name."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("sep", sep).option("header", True)
    return reader.load(landing_dir).withColumn("_file", F.col("_metadata.file_path"))


def watch(spark: SparkSession, landing_root: str, schemas: Mapping[str, object],
          on_arrival: Callable[[str, list[str], DataFrame, int], None], trigger: str = "available_now",
          checkpoint_root: str | None = None, fmt: str = "csv",
          feeds: Mapping[str, list[str]] | None = None) -> list[StreamingQuery]:
    """Start one file-source stream per landing source in ``schemas``.

    ``on_arrival(source, dependent_datasets, new_rows, batch_id)`` runs once per
    micro-batch that received files.  ``trigger`` is ``"available_now"`` or a time between
    batches ("60 seconds").  ``checkpoint_root`` defaults to the folder that
    ``spark.checkpoint.dir`` names; without either this is an error, and so is a source that feeds nothing.
    """
    root = checkpoint_root or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root or any(root.removeprefix("file:").startswith(t) for t in TEMPORARY):
        raise ValueError("file arrivals need a lasting checkpoint_root (or spark.checkpoint.dir)")
    feeds = dependents() if feeds is None else feeds
    if unknown := [s for s in schemas if not feeds.get(s)]:
        raise ValueError(f"No dataset reads these sources: {unknown}")
    queries = []
    for source, schema in schemas.items():
        deps = list(feeds[source])

        def handler(batch: DataFrame, batch_id: int, source=source, deps=deps):
            if not batch.isEmpty():
                on_arrival(source, deps, batch, batch_id)

        w = (arrivals_stream(spark, f"{landing_root}/{source}", schema, fmt).writeStream
             .option("checkpointLocation", f"{root}/arrivals/{source}")
             .foreachBatch(handler).queryName(f"arrivals_{source.replace('-', '_')}"))
        w = w.trigger(availableNow=True) if trigger == "available_now" else w.trigger(processingTime=trigger)
        queries.append(w.start())
    return queries


def run_available(spark: SparkSession, landing_root: str, schemas: Mapping[str, object],
                  on_arrival: Callable[[str, list[str], DataFrame, int], None], **kw) -> None:
    """Process every file that has landed, then return."""
    for q in watch(spark, landing_root, schemas, on_arrival, trigger="available_now", **kw):
        q.awaitTermination()


_ARRIVAL = "source string, token string"


def _arrivals(spark: SparkSession, log: str, source: str) -> DataFrame:
    try:
        return spark.read.schema(_ARRIVAL).parquet(f"{log}/{source}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ARRIVAL)


def _note(spark: SparkSession, log: str, source: str, tokens: list[str]) -> None:
    """Each source has a folder of its own, so streams that run at the same time don't share a writer's."""
    rows = spark.createDataFrame([(source, t) for t in tokens], _ARRIVAL)
    rows.coalesce(1).write.mode("append").parquet(f"{log}/{source}")


def wait_quiet(spark: SparkSession, landing_root: str, sources, seconds: float, poll: float = 1.0) -> None:
    """Return once no file of the sources has changed for ``seconds``."""
    from geoindicators.sources.snapshots import list_snapshots
    while seconds > 0:
        newest = max((t for s in sources if (t := list_snapshots(spark, f"{landing_root}/{s}").agg(F.max("modificationTime")).first()[0])), default=None)
        if newest is None or (datetime.datetime.now() - newest).total_seconds() >= seconds:
            return
        time.sleep(poll)


def recompute_available(spark: SparkSession, landing_root: str, schemas: Mapping[str, object],
                        publish: Callable[[str], None], checkpoint_root: str, fmt: str = "csv",
                        quiet_seconds: float = 0, feeds: Mapping[str, list[str]] | None = None) -> list[str]:
    """Publish each dataset that reads a source with new files once; returns the names."""
    feeds = dependents() if feeds is None else feeds
    pending, done = f"{checkpoint_root}/arrivals-log/pending", f"{checkpoint_root}/arrivals-log/done"
    wait_quiet(spark, landing_root, schemas, quiet_seconds)

    def note(source, deps, batch, batch_id):
        _note(spark, pending, source, [uuid.uuid4().hex])

    run_available(spark, landing_root, schemas, note, checkpoint_root=checkpoint_root, fmt=fmt, feeds=feeds)
    # one row per arrival not yet published: as many as files have landed since the last run
    new = {s: [r["token"] for r in _arrivals(spark, pending, s).join(_arrivals(spark, done, s), ["source", "token"], "left_anti").collect()] for s in schemas}
    names = sorted({d for s, tokens in new.items() if tokens for d in feeds[s]})
    for name in names:
        publish(name)
    for s, tokens in new.items():
        if tokens:
            _note(spark, done, s, tokens)
    return names

"""Running datasets over the storage layout: landing -> intermediate -> published.

``Layout`` names the three roots.  ``publish`` reads the newest snapshot of
every source the dataset needs from ``landing/<source>/``, optionally writes the
resolved canonical rows to ``intermediate/<dataset>/<source>/`` (Parquet by year; two
datasets may resolve one source by different rules), builds the variants' documents
and commits them as a new version under ``published/<dataset>/`` (``publish.commit``).  ``recompute_arrived`` does so for
every dataset that reads a source with new files (``streaming.arrivals``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from geoindicators import datasets
from geoindicators.datasets.spec import normalise, run_all
from geoindicators.geo.dim import Geography
from geoindicators.publish import commit
from geoindicators.publish.observe import Watch
from geoindicators.sources import sinks, snapshots
from geoindicators.streaming import arrivals


class Published(dict):
    """Variant -> directory of its documents; ``counts``: what was observed on the way (``publish.observe``), by source and rows."""

    def __init__(self, folders: Mapping[str, str], counts: dict[str, dict[str, int]]):
        super().__init__(folders)
        self.counts = counts


@dataclass(frozen=True)
class Layout:
    landing: str
    intermediate: str
    published: str
    fmt: str = "csv"                  # snapshot format in the landing area
    pattern: str = "*.csv"
    # per-source reader options (e.g. the year column's header); default: no renaming on read
    read_options: Mapping[str, dict] = field(default_factory=dict)

    def source_dir(self, source: str) -> str:
        return f"{self.landing}/{source}"


def read_sources(spark: SparkSession, layout: Layout, sources) -> dict[str, DataFrame]:
    out = {}
    for s in sources:
        opts = {"fmt": layout.fmt, "date_column": None, **layout.read_options.get(s, {})}
        out[s] = snapshots.read_latest(spark, layout.source_dir(s), layout.pattern, **opts)
    return out


def publish_dataset(spark: SparkSession, layout: Layout, dataset: str, geo: Geography, published_date: str | None = None,
                    write_intermediate: bool = False, variants: Sequence[str] | None = None,
                    on_invalid: str = "error") -> Published:
    """Build a dataset's variants (default: all) from one pass over its sources and publish them at once; returns their
    directories, with what the pass has counted.

    Variants that are not asked for stay as the current version has them.  A failing one leaves all as it was.  The geography's integrity is checked first: an alias that maps to two geographies would fan out rows.
    """
    geo.check()
    spec = datasets.get(dataset)
    raw = read_sources(spark, layout, spec.sources)
    if write_intermediate and spec.intermediate:
        for source, df in normalise(spec, raw, geo).items():
            sinks.write_intermediate(df, f"{layout.intermediate}/{dataset}/{source}")
    watch = Watch()
    docs = run_all(spec, raw, geo, published_date, True, variants, on_invalid, watch)
    return Published(commit.publish_documents(docs, f"{layout.published}/{dataset}"), watch.counts())


def publish(spark: SparkSession, layout: Layout, dataset: str, variant: str, geo: Geography,
            published_date: str | None = None, write_intermediate: bool = False) -> str:
    """Build and write one variant; returns the output directory."""
    return publish_dataset(spark, layout, dataset, geo, published_date, write_intermediate, [variant])[variant]


def recompute_arrived(spark: SparkSession, layout: Layout, geo: Geography, schemas: Mapping[str, object],
                      checkpoint_root: str, published_date: str | None = None, quiet_seconds: float = 0) -> list[str]:
    """Publish every dataset that reads a source with new files, each once, one after the other; returns their names."""
    def publish_one(dataset: str) -> None:
        publish_dataset(spark, layout, dataset, geo, published_date, write_intermediate=True)

    return arrivals.recompute_available(spark, layout.landing, schemas, publish_one, checkpoint_root,
                                        fmt=layout.fmt, quiet_seconds=quiet_seconds)

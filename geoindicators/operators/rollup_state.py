"""Mergeable roll-up state: base aggregates by year that a new snapshot updates only where it differs.

The state holds, per year, the sums at the finest key (``base/date=<year>``) and the years' fingerprints (``years/version=<n>``): the number
of rows and a sum of row hashes, which don't depend on the order of rows.  A refresh fingerprints the snapshot in one pass, aggregates the
years whose fingerprint is new or different and overwrites just their partitions; then it writes the next version of the fingerprints.
A run that dies in between leaves the old fingerprints, so those years are aggregated again.  Sums of sums are the
sums, so the three levels rolled up from the state equal those of a full run over the snapshot.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoindicators.functions.nulls import coalesced_sum
from geoindicators.keys import Keys
from geoindicators.operators import rollup

_YEARS = "date bigint, n bigint, h decimal(38,0)"


class RollupState:
    """The state of one source's measures under ``path`` (a lasting folder that all executors share)."""

    def __init__(self, spark: SparkSession, path: str, measures: Iterable[str], keys: Keys = Keys(), extra: Iterable[str] = ()):
        self.spark, self.path, self.measures, self.keys, self.extra = spark, path.rstrip("/"), list(measures), keys, list(extra)

    def _known(self) -> tuple[int, dict]:
        """(version, {year: fingerprint}) of the newest complete version; (0, {}) without a state."""
        try:
            versions = self.spark.read.parquet(f"{self.path}/years")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        newest = versions.agg(F.max("version")).first()[0]
        rows = versions.where(F.col("version") == newest).collect()  # a row a year
        return newest, {r["date"]: (r["n"], r["h"]) for r in rows if r["date"] is not None}

    def _fingerprints(self, df: DataFrame) -> dict:
        columns = [*self.keys.all(), *self.extra, *self.measures]
        rows = df.groupBy(F.col(self.keys.date).cast("bigint").alias("date")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h"))
        return {r["date"]: (r["n"], r["h"]) for r in rows.where("date is not null").collect()}  # a row a year

    def refresh(self, snapshot: DataFrame) -> list[int]:
        """Bring the state up to the snapshot; returns the years that were aggregated anew (a year that is gone just leaves).

        Rows without a year take no part, as in every roll-up; an empty snapshot empties the state.
        """
        version, known = self._known()
        now = self._fingerprints(snapshot)
        changed = sorted(y for y, f in now.items() if known.get(y) != f)
        if changed:
            rows = snapshot.where(F.col(self.keys.date).isin(changed))
            group = [*self.keys.all(), *self.extra]
            base = rows.groupBy(*group).agg(*[coalesced_sum(m).alias(m) for m in self.measures])
            base.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.keys.date).parquet(f"{self.path}/base")
        if now != known or not version:
            years = [(y, n, h) for y, (n, h) in sorted(now.items())] or [(None, 0, None)]
            self.spark.createDataFrame(years, _YEARS).coalesce(1).write.parquet(f"{self.path}/years/version={version + 1}")
        return changed

    def base(self) -> DataFrame:
        """The base aggregates of the years in the state; partitions of years that have left are not read."""
        _, known = self._known()
        if not known:
            raise ValueError(f"no years in the roll-up state {self.path}")
        rows = self.spark.read.parquet(f"{self.path}/base")
        years = rows.where(F.col(self.keys.date).isin(sorted(known)))
        names = [*self.keys.all(), *self.extra, *self.measures]
        return years.withColumn(self.keys.date, F.col(self.keys.date).cast("bigint")).select(*names)

    def rolled_up(self) -> DataFrame:
        """Sub-district, district and city sums, as ``rollup.aggregate(snapshot, "sum")`` gives them."""
        return rollup.aggregate(self.base(), "sum", self.keys, extra=self.extra) if self.extra else rollup.aggregate(self.base(), "sum", self.keys)

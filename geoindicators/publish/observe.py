"""Checks as observed metrics: counts that come with the pass that publishes, without a job of their own.

``Watch.on`` adds an observation to a plan (``DataFrame.observe``); Spark fills it in while that plan runs.  ``Watch.counts`` returns what
has been seen so far.  An observed plan that never ran (a source that no asked variant reads) has no entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoindicators.keys import Keys
from geoindicators.publish.validate import _non_finite


class Watch:
    """Named observations of one run."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}
        self._spark: SparkSession | None = None

    def on(self, df: DataFrame, name: str, **counts: Column) -> DataFrame:
        """``df`` with the counts observed under ``name``; a name is observed once."""
        if name in self._seen:
            raise ValueError(f"{name!r} is observed already")
        self._seen[name], self._spark = Observation(name), df.sparkSession
        return df.observe(self._seen[name], *[c.cast("long").alias(n) for n, c in counts.items()])

    def counts(self) -> dict[str, dict[str, int]]:
        out = {}
        if self._spark is not None:  # the metrics of finished actions come through the listener bus
            self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        for name, seen in self._seen.items():
            if seen._jo.getRowOrEmpty().isDefined():  # ``get`` alone would wait for an action that may never come
                out[name] = {k: v or 0 for k, v in seen.get.items()}
        return out


def unresolved(df: DataFrame, keys: Keys) -> dict[str, Column]:
    """Rows, and rows whose year, district or sub-district is missing (P13), of resolved source rows."""
    found = {"rows": F.count(F.lit(1))}
    for name, column in (("no_date", keys.date), ("no_district", keys.district_id), ("no_sub_district", keys.sub_id)):
        if column in df.columns:
            found[name] = F.count_if(F.col(column).isNull())
    return found


def invalid(df: DataFrame, keys: Keys) -> dict[str, Column]:
    """Rows, non-finite numbers (V6), and values whose ratio is missing, of indicator rows."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    total = F.lit(0)
    for c in numbers:
        total = total + F.count_if(F.coalesce(_non_finite(F.col(f"`{c}`")), F.lit(False)))
    ratios = F.lit(0)
    for c in df.columns:
        if f"{c}_ratio" in df.columns:
            ratios = ratios + F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}_ratio`").isNull())
    found = {"rows": F.count(F.lit(1)), "non_finite": total, "no_ratio": ratios}
    if keys.district_id in df.columns and keys.district_name in df.columns:
        # V5: more names than ids means that some id has several
        named = F.when(F.col(keys.district_id).isNotNull(), F.struct(keys.district_id, keys.district_name))
        found["extra_names"] = F.size(F.collect_set(named)) - F.size(F.collect_set(keys.district_id))
    return found

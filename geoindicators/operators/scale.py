"""Chart scale: min and max of a measure and its ratio on the newest year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.keys import Keys
from geoindicators.operators.align import newest_of
from geoindicators.operators.filters import drop_non_residential


def scale_min_max(df: DataFrame, column: str, keys: Keys = Keys()) -> DataFrame:
    """One row: ``value_min, value_max, ratio_min, ratio_max`` (doubles).

    Non-residential districts are dropped first, then the newest year is taken;
    city and sub-district rows count.  A column that does not exist gives 0, 0.
    """
    rows = drop_non_residential(df, keys)

    names = {f"{kind}_{end}": (c, end) for kind, c in (("value", column), ("ratio", f"{column}_ratio")) for end in ("min", "max")}
    there = {out: getattr(F, end)(c).cast("double").alias(out) for out, (c, end) in names.items() if c in df.columns}
    newest = newest_of(rows, F.count(F.lit(1)).alias("_n"), *there.values(), date=keys.date)
    return newest.select(*[F.col(out) if out in there else F.lit(0.0).alias(out) for out in names])


def scale_struct(df: DataFrame, column: str, keys: Keys = Keys()) -> DataFrame:
    """The same as ``{"value": [min, max], "ratio": [min, max]}``."""
    mm = scale_min_max(df, column, keys)
    return mm.select(F.struct(
        F.array("value_min", "value_max").alias("value"),
        F.array("ratio_min", "ratio_max").alias("ratio"),
    ).alias("scale"))

"""Top-N categories per district on the district's latest year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoindicators.keys import Keys


def top_n_categories(df: DataFrame, category: str, total: str, n: int = 10,
                     keys: Keys = Keys(), rank_col: str = "rank") -> DataFrame:
    """Rows of the ``n`` categories with the largest ``total`` per district.

    Only the district's own newest year counts.  Ties are broken by category
    ascending so the result is deterministic.  The newest year per district is
    a partial aggregate (skew-proof); the ranking is a ``row_number`` filter that
    Spark turns into a per-partition group limit before the shuffle, so a hot
    district ships at most ``n`` rows per task.
    """
    k = keys
    newest = df.groupBy(k.district_id).agg(F.max(k.date).alias("_newest"))
    latest = (df.join(newest, [k.district_id])
              .filter(F.col(k.date) == F.col("_newest")).drop("_newest"))
    w = Window.partitionBy(k.district_id).orderBy(F.col(total).desc_nulls_last(), F.col(category).asc())
    return latest.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)

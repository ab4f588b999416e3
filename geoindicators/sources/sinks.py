"""Sinks: intermediate tables and published documents.

* ``write_intermediate``: the resolved, canonical source table as Parquet partitioned
  by year, so later reads prune by year, or as ";"-separated CSV with header
  (``fmt="csv"``, ``partition_by=()`` for plain files).
* ``write_documents``: one JSON document per district (plus the city), each in
  its own ``name=<id>`` partition directory (``publish.commit`` writes them as ``<id>.json`` files
  of one committed version).  ``build_documents`` rejects non-finite numbers on the typed columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.publish.document import to_json_documents


def write_intermediate(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ";",
                       partition_by: tuple[str, ...] = ("date",)) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("sep", sep).option("header", True).option("encoding", "UTF-8").csv(path)
    else:
        w.format(fmt).save(path)


def write_documents(docs: DataFrame, output_dir: str) -> None:
    """One UTF-8 JSON text per document, under ``output_dir/name=<id or district>/``."""
    js = to_json_documents(docs)
    js.repartition("name").write.mode("overwrite").partitionBy("name").text(output_dir)


def read_documents(spark, output_dir: str) -> DataFrame:
    """(name, json) of published documents; the name is taken from the file or directory as
    written (no type inference, so "01" stays "01")."""
    df = spark.read.text(output_dir)
    path = F.col("_metadata.file_path")
    name = F.when(path.endswith(".json"), F.url_decode(F.regexp_replace(F.regexp_extract(path, r"([^/]+)\.json$", 1), r"\+", "%2B"))).otherwise(
        F.regexp_extract(path, r"name=([^/]+)/[^/]*$", 1))
    return df.select(name.alias("name"), F.col("value").alias("json"))

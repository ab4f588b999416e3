"""Landing-area snapshots: pick the newest file, read it with a fixed schema.

A landing directory receives a new snapshot file whenever the statistics are
republished; a dataset reads the newest one.  The listing uses the
``binaryFile`` source with only ``path`` and ``modificationTime`` selected, so
file contents are never read to find the newest file, and only that one path
(a single string) reaches the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoindicators.functions.nulls import normalise_nans

ID_COLUMNS = ("delbydel_id", "delbydel_navn", "bydel_id", "bydel_navn")


class NoSnapshotError(FileNotFoundError):
    pass


def list_snapshots(spark: SparkSession, input_dir: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length) of every file in ``input_dir`` matching ``pattern``."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(input_dir)
            .select("path", "modificationTime", "length"))


def resolve_input(spark: SparkSession, input_dir: str, pattern: str = "*") -> str:
    """Path of the newest snapshot (by modification time, then name); error if none."""
    try:
        newest = (list_snapshots(spark, input_dir, pattern)
                  .orderBy(F.col("modificationTime").desc(), F.col("path").desc()).select("path").first())
    except AnalysisException as e:  # a missing directory is the same condition as an empty one
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is None:
        raise NoSnapshotError(f"No snapshot files matching {pattern!r} in {input_dir}")
    return newest.path


def _text_ids(schema: "T.StructType | str", names: tuple[str, ...]) -> T.StructType:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in names else f.dataType, f.nullable) for f in schema.fields])


def read_snapshot(spark: SparkSession, path: str, fmt: str = "csv", schema: "T.StructType | str | None" = None,
                  date_column: str | None = "aar", sep: str = ";", header: bool = True,
                  string_columns: tuple[str, ...] = ID_COLUMNS) -> DataFrame:
    """Read one snapshot, year column renamed to ``date``.

    Without a ``schema`` every CSV column is text exactly as written, so ids keep their leading
    zeros and no extra pass guesses types; the normalisers cast years and measures.  With one, the
    id columns (``string_columns``) of a CSV file are read as text whatever the schema says.  NaN is
    normalised to NULL on ingest.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("sep", sep).option("header", header).option("encoding", "UTF-8")
        if schema is not None:
            schema = _text_ids(schema, string_columns)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    casts = {c: F.col(c).cast("string") for c in string_columns if c in df.columns
             and not isinstance(df.schema[c].dataType, T.StringType)}
    if casts:
        df = df.withColumns(casts)
    if date_column and date_column in df.columns:
        df = df.withColumnRenamed(date_column, "date")
    return normalise_nans(df)


def read_latest(spark: SparkSession, input_dir: str, pattern: str = "*.csv", **kw) -> DataFrame:
    return read_snapshot(spark, resolve_input(spark, input_dir, pattern), **kw)

"""Committed publishing: all documents of a dataset appear at once, as ``<id>.json`` files of one version.

    <root>/_versions/<version>/<variant>/<id>.json     one document a file, UTF-8
    <root>/_current                                     the name of the version that readers see

A run writes all variants under a new version, gives the files their published names and then replaces ``_current``
in one rename.  Readers resolve ``_current`` first, so they see the previous version whole until then, and a run that fails leaves
it in place.  Variants that a run doesn't write are carried over.  Versions sort by time; older ones than ``keep`` are removed after the commit, never the current one.

Spark writes the texts; the driver only renames files, one a geography (bounded by the dimension's rows).
"""

from __future__ import annotations

import datetime
import uuid
from typing import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoindicators.publish.document import to_json_documents

CURRENT, VERSIONS = "_current", "_versions"


class _Files:
    """The few file-system calls needed, through Hadoop's API, so any scheme that Spark knows works."""

    def __init__(self, spark: SparkSession, root: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self.path(root).getFileSystem(self._conf)
        self._java = spark._jvm.java

    def path(self, name: str):
        return self._hadoop.Path(name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(folder))) if self.exists(folder) else []

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self.path(old), self.path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def replace(self, old: str, new: str) -> None:
        """Rename over an existing file, in one step where the file system has one."""
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri())
        option = self._java.lang.reflect.Array.newInstance(self._java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        option[0] = getattr(self._hadoop, "Options$Rename").OVERWRITE
        context.rename(self._fs.makeQualified(self.path(old)), self._fs.makeQualified(self.path(new)), option)

    def copy(self, old: str, new: str) -> None:
        if not self._hadoop.FileUtil.copy(self._fs, self.path(old), self._fs, self.path(new), False, self._conf):
            raise OSError(f"could not copy {old} to {new}")

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def write(self, name: str, text: str) -> None:
        out = self._fs.create(self.path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that readers see, None before the first commit."""
    files = _Files(spark, root)
    return files.read(f"{root}/{CURRENT}").strip() if files.exists(f"{root}/{CURRENT}") else None


def published_dir(spark: SparkSession, root: str, variant: str) -> str:
    """The folder of a variant's documents in the current version."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return f"{root}/{VERSIONS}/{version}/{variant}"


def publish_documents(documents: Mapping[str, DataFrame], root: str, keep: int = 3) -> dict[str, str]:
    """Write the documents of all variants as one new version and make it current; returns the variants' folders.

    A failure before the commit leaves the current version as it was and removes what was written.  Two documents of one
    name in a variant are an error, and so is a name that no file can have ("/" or a leading "_" or ".", which readers skip).  A variant
    without documents has an empty folder.
    """
    spark = next(iter(documents.values())).sparkSession
    root = root.rstrip("/")
    files = _Files(spark, root)
    version = f"{datetime.datetime.now(datetime.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    base = f"{root}/{VERSIONS}/{version}"
    try:
        for variant, docs in documents.items():
            staged = f"{base}/_staged-{variant}"
            one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("Several documents named "), F.col("name")))).otherwise(F.first("json"))
            to_json_documents(docs).groupBy("name").agg(one.alias("json")).write.partitionBy("name").text(staged)
            _name_files(files, staged, f"{base}/{variant}")
        before = current_version(spark, root)
        for variant in files.names(f"{root}/{VERSIONS}/{before}") if before else []:
            if variant not in documents:  # not part of this run: stays as it is published
                files.copy(f"{root}/{VERSIONS}/{before}/{variant}", f"{base}/{variant}")
        files.write(f"{root}/{CURRENT}-{version}", version)
        files.replace(f"{root}/{CURRENT}-{version}", f"{root}/{CURRENT}")
    except BaseException:
        files.delete(base)
        raise
    for old in files.names(f"{root}/{VERSIONS}")[:-keep]:
        if old != version:
            files.delete(f"{root}/{VERSIONS}/{old}")
    return {variant: f"{base}/{variant}" for variant in documents}


def _name_files(files: _Files, staged: str, folder: str) -> None:
    """``name=<id>/part-*`` -> ``<id>.json``."""
    files._fs.mkdirs(files.path(folder))
    for part in files.names(staged):
        if not part.startswith("name="):
            continue
        name = unquote(part.removeprefix("name="))
        if "/" in name or name[:1] in ("_", "."):
            raise ValueError(f"{name!r} cannot be a published file name")
        texts = [n for n in files.names(f"{staged}/{part}") if n.startswith("part-")]
        if len(texts) != 1:
            raise ValueError(f"{len(texts)} files of documents named {name!r}")
        files.rename(f"{staged}/{part}/{texts[0]}", f"{folder}/{name}.json")
    files.delete(staged)

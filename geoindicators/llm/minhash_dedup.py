"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

Shingles are five lower-cased words in a row (a text of fewer words is one shingle).  Weight = occurrences x idf; the
idf is the hashing trick's: shingles fall into ``FEATURES`` slots, document frequencies per slot are counted over all
documents, idf = 1 + ln((1 + N) / (1 + df)) / ln(1 + N), between 1 and 2.  The table broadcast has FEATURES numbers at
any corpus size.

Signature: ``BANDS`` x ``ROWS`` samples (k, t) by Ioffe's consistent weighted sampling, so two texts agree in a sample with
probability their weighted Jaccard similarity; at 0.8 a pair misses all bands with probability 0.0016.  Band buckets are
resolved in ``lsh`` and every link is verified by the exact weighted Jaccard similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.common import NOT_WHITE, numbered, table, with_row_id, without
from geoindicators.llm.lsh import FINE_SETS, Profiles, fine_sets, near_classes
from geoindicators.llm.tokens import U, counted48, mix, shingles, split_words, text_chunks

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 9, 3
FINE_BANDS = 6
FEATURES = 1 << 17
_CHUNK = 1 << 20


def _features(key: np.ndarray) -> np.ndarray:
    return ((key >> U(16)) & U(FEATURES - 1)).astype(np.int64)


def _counted(data, offsets):
    return counted48(*shingles(split_words(data, offsets), SHINGLE))


def idf_table(texts: DataFrame) -> np.ndarray:
    """idf of each hashed slot, from all rows of the column _t."""
    def frequency(batches):
        rows, df = 0, np.zeros(FEATURES, dtype=np.int64)
        for b in batches:
            for _, size, data, offsets in text_chunks(b.column(0), _CHUNK):
                rows += size
                df += np.bincount(_features(_counted(data, offsets)[1]), minlength=FEATURES)
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, used], pa.int32()), pa.array(np.r_[rows, df[used]], pa.int64())], names=["slot", "n"])

    counts = texts.mapInArrow(frequency, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()  # FEATURES + 1 rows at most
    n = int(counts.loc[counts["slot"] < 0, "n"].sum())
    df = np.zeros(FEATURES)
    own = counts[counts["slot"] >= 0]
    df[own["slot"].to_numpy()] = np.minimum(own["n"].to_numpy(), n)
    return (1 + np.log((1 + n) / (1 + df)) / np.log(2 + n)).astype(np.float32)


def _uniform(bits: np.ndarray, size: int) -> np.ndarray:
    """In (0, 1), from the low ``size`` bits."""
    return ((bits & U((1 << size) - 1)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -size)


def cws_samples(key: np.ndarray, log_weight: np.ndarray, start: np.ndarray, row: np.ndarray, sample: int) -> np.ndarray:
    """One consistent weighted sample per row (rows are runs from ``start``), as a hash of (shingle, level)."""
    h = mix(key + U((sample + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    g = mix(h ^ U(0xD1B54A32D192ED03))
    r = -np.log(_uniform(h, 21) * _uniform(h >> U(21), 21))
    beta = _uniform(h >> U(42), 22)
    log_c = np.log(-np.log(_uniform(g, 24) * _uniform(g >> U(32), 24)))
    level = np.floor(log_weight / r + beta)
    rank = log_c - r * (level - beta + 1)
    least = np.minimum.reduceat(rank, start)
    at = np.flatnonzero(rank == least[row])
    first = at[np.searchsorted(row[at], np.arange(len(start)))]  # ties: the least shingle
    return mix(key[first] ^ mix(level[first].astype(np.int64).view(U) + U(sample)))


def _signatures(texts, idf: np.ndarray, samples: range, rows: int, profile: bool = False):
    """Per slice: (places of the rows with a shingle, band keys, profiles)."""
    for first, size, data, offsets in text_chunks(texts, _CHUNK):
        row, key, n = _counted(data, offsets)
        present, start = np.unique(row, return_index=True)
        if not len(present):
            continue
        index = np.repeat(np.arange(len(present)), np.diff(np.append(start, len(row))))
        log_weight = np.log(n * idf[_features(key)]).astype(np.float32)
        bands = []
        for b in range(samples.start, samples.stop, rows):
            band = np.full(len(present), b, dtype=U)
            for s in range(b, b + rows):
                band = mix(band * U(31) + cws_samples(key, log_weight, start, index, s))
            bands.append(band.view(np.int64))
        blobs = None
        if profile:
            end = np.append(start[1:], len(row))
            slot, count = (key >> U(16)).astype("<u4"), np.minimum(n, 65535).astype("<u2")
            blobs = [slot[a:z].tobytes() + count[a:z].tobytes() for a, z in zip(start, end, strict=True)]
        yield first + present, np.stack(bands, axis=1), blobs


def profiles(idf: np.ndarray, threshold: float = THRESHOLD) -> Profiles:
    """Profiles of (shingle, occurrences), weighted by the idf."""
    def unpack(profile: bytes) -> tuple[np.ndarray, np.ndarray]:
        n = len(profile) // 6
        key, count = np.frombuffer(profile, "<u4", n), np.frombuffer(profile, "<u2", n, 4 * n)
        return key, count * idf[key & np.uint32(FEATURES - 1)].astype(np.float64)

    return Profiles(unpack, threshold)


def _lists(bands: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, bands.shape[1]), pa.int32()), pa.array(bands.ravel(), pa.int64()))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id_col, cluster_id (least id of the class), cluster_size, kept.

    Texts that are equal after lower-casing are one node; classes are the components of the verified links.  Null texts and texts without a word have no shingle: each is a
    class of its own.  Of a class the row with the least id stays (null ids last; of repeated ids one row).  An empty
    table gives no rows; other columns are ignored.
    """
    own = _nodes(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")))
    out = _classed(own, table(with_row_id(own.select("_id", _class())), "ids"), threshold)
    return out.select(F.col("_id").alias(id_col), F.when(F.col("n").isNull(), F.col("_id")).otherwise(F.col("k.id")).alias("cluster_id"),
                      F.coalesce("n", F.lit(1)).cast("long").alias("cluster_size"), _kept())


def _nodes(rows: DataFrame) -> DataFrame:
    """Rows with _t lower-cased, null as empty, and its digest cls."""
    return rows.withColumn("_t", F.lower(F.coalesce("_t", F.lit("")))).withColumn("cls", F.md5(F.encode("_t", "UTF-8")))


def _class():
    """The digest of a text with a word."""
    return F.when(F.col("_t").rlike(NOT_WHITE), F.col("cls")).alias("cls")


def _kept():
    return (F.col("n").isNull() | (F.col("_rid") == F.col("k.rid"))).alias("kept")


def _classed(own: DataFrame, ids: DataFrame, threshold: float) -> DataFrame:
    """(_rid, _id, n, k) of all rows: size and least row of the class, null where the row is alone; own: (_id, _t, cls), ids: (_rid, _id, cls)."""
    spark = own.sparkSession
    words = F.col("_t").rlike(NOT_WHITE)
    texts = own.where(words).select("_id", "cls", "_t")
    idf = idf_table(own.select("_t"))
    shared = spark.sparkContext.broadcast(idf)

    def sign(batches):
        for b in batches:
            for at, bands, _ in _signatures(b.column("_t"), shared.value, range(BANDS * ROWS), ROWS):
                yield pa.RecordBatch.from_arrays([b.column("cls").take(pa.array(at)), _lists(bands)], names=["cls", "keys"])

    def profile(batches):
        more = range(BANDS * ROWS, (BANDS + FINE_SETS * FINE_BANDS) * ROWS)
        for b in batches:
            for at, bands, blobs in _signatures(b.column("_t"), shared.value, more, ROWS, profile=True):
                yield pa.RecordBatch.from_arrays([b.column("cls").take(pa.array(at)), pa.array(blobs, pa.binary()), fine_sets(bands)], names=["cls", "profile", "fine"])

    def profile_of(nodes: DataFrame) -> DataFrame:
        # one row of each class: the key holds the id, so a class with very many copies is no hot key
        chosen = ids.groupBy("cls").agg(F.min("_id").alias("_id")).join(nodes, "cls", "left_semi")
        same = (texts["cls"] == chosen["cls"]) & texts["_id"].eqNullSafe(chosen["_id"])
        made = texts.join(chosen, same, "left_semi").select("cls", "_t").mapInArrow(profile, "cls string, profile binary, fine array<array<bigint>>")
        return made.groupBy("cls").agg(F.first("profile").alias("profile"), F.first("fine").alias("fine"))

    signed = texts.select("cls", "_t").mapInArrow(sign, "cls string, keys array<bigint>")
    bands = table(signed.groupBy("cls").agg(F.first("keys").alias("keys")), "bands")
    comps = near_classes(bands, profile_of, profiles(idf, threshold))
    rows = ids.join(comps.withColumnRenamed("node", "cls"), "cls", "left")
    group = F.coalesce("comp", "cls", F.concat(F.lit("row "), F.col("_rid").cast("string")))
    rows = table(rows.select("_rid", "_id", group.alias("_g")), "classed")
    least = F.min(F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_rid").alias("rid")))
    stats = table(rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), least.alias("k")).where("n > 1"), "class-sizes")
    return rows.join(stats, "_g", "left").select("_rid", "_id", "n", "k")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``near_dedup`` keeps, row by row: ids may repeat or be null."""
    rows = numbered(docs)
    own = _nodes(rows.select("_rid", F.col("_doc")[id_col].alias("_id"), F.col("_doc")[text_col].alias("_t")))
    return without(rows, _classed(own, table(own.select("_rid", "_id", _class()), "ids"), threshold).where(~_kept()))

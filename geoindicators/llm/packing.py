"""Best-fit packing with conflicts: sequences of ``capacity`` words, no source and no duplicate cluster twice in one.

Bins are kept in the order of their residual space and carry a bitmap of their sources and one of their duplicate
clusters.  A piece (largest first) starts at the tightest bin that has room and moves to the successor until the
bin's bitmaps don't meet its own; without such a bin it opens a new one.  A text longer than the capacity is cut into whole
sequences of its own, which take no other text, and a remainder that is packed as a piece.

Scale: a piece is one narrow row.  Rows are dealt to shards of about ``SHARD_ROWS`` by a hash, so a source with a third of all
rows is spread evenly and no task holds more than a shard; each shard is packed for itself, at the cost of the few
open bins at its end.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.common import WHITE, table, with_row_id

CAPACITY = 2048
SHARD_ROWS = 8192


def pack(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Bin of each item (sizes up to ``capacity``), items in the order given; None never conflicts."""
    masks = [_bitmaps(sources), _bitmaps(clusters)]
    by_residual: list[tuple[int, int]] = []  # (residual, bin)
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    out = []
    for size, s, c in zip(sizes, *masks, strict=True):
        at = bisect_left(by_residual, (size, -1))
        while at < len(by_residual) and (source_bits[by_residual[at][1]] & s or cluster_bits[by_residual[at][1]] & c):
            at += 1
        if at < len(by_residual):
            residual, b = by_residual.pop(at)
        else:
            residual, b = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[b] |= s
        cluster_bits[b] |= c
        insort(by_residual, (residual - size, b))
        out.append(b)
    return out


def _bitmaps(keys: list) -> list[int]:
    """A bit for each key that occurs twice or more; a key that occurs once meets nothing."""
    count = Counter(k for k in keys if k is not None)
    number = {k: i for i, k in enumerate(sorted(k for k, n in count.items() if n > 1))}
    return [1 << number[k] if k in number else 0 for k in keys]


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source", cluster_col: str | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: bin_id, position (in the bin), id_col, piece, first_word, n_words.

    Words are runs of non-white-space.  Null and empty texts are one piece of 0 words.  A null source or cluster conflicts with
    nothing.  cluster_col None: documents whose texts are equal but for white space are a cluster.  Repeated rows are
    packed each; an empty table gives no rows; other columns are ignored.
    """
    plain = F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITE, " "))
    words = F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1)
    cluster = F.xxhash64(plain) if cluster_col is None else F.col(cluster_col)
    rows = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(source_col).cast("string").alias("_source"), cluster.cast("string").alias("_cluster"), words.alias("_n"))
    rows = table(with_row_id(rows), "sizes")
    id_type = docs.schema[id_col].dataType.simpleString()
    whole = F.when(F.col("_n") > capacity, F.floor(F.col("_n") / capacity)).otherwise(0).cast("int")
    rest = F.col("_n") - whole * capacity
    rows = rows.withColumns({"_whole": whole, "_rest": rest})
    pieces = rows.where("_rest > 0 or _n = 0")
    shards = max(1, -(-pieces.count() // shard_rows))
    pieces = pieces.withColumn("_shard", F.pmod(F.xxhash64("_rid"), F.lit(shards)).cast("int"))

    def pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_rest", "_rid"], ascending=[False, True], ignore_index=True)
        keys = [[None if pd.isna(x) else x for x in pdf[c]] for c in ("_source", "_cluster")]
        pdf["_bin"] = pack(pdf["_rest"].tolist(), *keys, capacity)
        pdf["position"] = pdf.groupby("_bin").cumcount().astype("int32")
        pdf["bin_id"] = pdf["_shard"].map("s{}-".format) + pdf["_bin"].astype(str)
        return pd.DataFrame({"bin_id": pdf["bin_id"], "position": pdf["position"], "_id": pdf["_id"], "piece": pdf["_whole"].astype("int32"),
                             "first_word": (pdf["_n"] - pdf["_rest"]).astype("int64"), "n_words": pdf["_rest"].astype("int64")})

    schema = "bin_id string, position int, _id string, piece int, first_word bigint, n_words bigint"
    packed = pieces.groupBy("_shard").applyInPandas(pack_shard, schema)
    # whole sequences: bins of their own
    full = rows.where("_whole > 0").select("_rid", "_id", F.explode(F.sequence(F.lit(0), F.col("_whole") - 1)).alias("piece")).select(
        F.format_string("w%d-%d", "_rid", "piece").alias("bin_id"), F.lit(0).alias("position"), "_id", "piece",
        (F.col("piece") * F.lit(capacity)).cast("long").alias("first_word"), F.lit(capacity).cast("long").alias("n_words"))
    return packed.unionByName(full).select("bin_id", "position", F.col("_id").cast(id_type).alias(id_col), "piece", "first_word", "n_words")

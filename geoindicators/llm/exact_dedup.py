"""Exact dedup by distributed MSD radix partitioning.

Every text (white-space runs as one space, UTF-8) is a byte string.  Round 1 splits all documents by
their first ``first_digit`` bytes; each later round splits the groups that are left by the next
bytes, each digit four times as wide as the last, so the number of rounds is the logarithm of the
longest shared prefix.  A group of one row leaves at once (singleton).  Rows that end inside a digit
form their own subgroup: if it has two rows or more they are equal byte for byte, no digest involved.

Scale: the split of a round is a count per (group, digit), combined map-side, and a join that hands
the surviving rows their new group id; a group that holds a third of all rows is pre-aggregated in
the count and split by AQE's skew join in the hand-out.  Only rows that still share a prefix with
another row travel on, without the bytes already compared.  Every round's survivors are written to
the shared folder, so a lost executor costs one task, not the rounds before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.common import WHITE, numbered, table, with_row_id, without

FIRST_DIGIT = 256
WIDEN = 4


def normalised(text):
    """White-space runs become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _split(rows: DataFrame, width: int) -> DataFrame:
    """One radix round: rows (_rid, _gid, _id, _rest) that share group and digit with another row.

    Returns them with the new _gid, the bytes after the digit, and whether the text ended in it.
    """
    rows = rows.withColumns({"_digit": F.substring("_rest", 1, width), "_end": F.length("_rest") <= width})
    key = ["_gid", "_digit", "_end"]
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("_rid").alias("_new"))
    groups = table(groups.where("_n > 1").drop("_n"), "groups")  # else its exchange serves the join too, and AQE can't split a hot key
    return rows.join(groups, key).select(
        "_rid", F.col("_new").alias("_gid"), "_id",
        F.when(~F.col("_end"), F.expr(f"substring(_rest, {width + 1})")).alias("_rest"), "_end")


def radix_groups(prepared: DataFrame, first_digit: int = FIRST_DIGIT) -> DataFrame:
    """(_rid, _gid, _id) of all rows whose bytes equal another row's; prepared: (_rid, _id, _body)."""
    rows = prepared.select("_rid", F.lit(0).cast("long").alias("_gid"), "_id", F.col("_body").alias("_rest"))
    width, ended = first_digit, []
    while True:
        done = table(_split(rows, width), "radix")
        ended.append(done.where("_end").select("_rid", "_gid", "_id"))
        rows, width = done.where("not _end").drop("_end"), width * WIDEN
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, ended)


def _members(prepared: DataFrame, first_digit: int) -> DataFrame:
    """(_rid, _n, _keep) of the rows (_rid, _id, _body) with an equal one: group size, and the row that stays."""
    members = table(radix_groups(prepared, first_digit), "members")
    first = F.min(F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_rid").alias("rid")))
    stats = table(members.groupBy("_gid").agg(F.count(F.lit(1)).alias("_n"), first.alias("_keep")), "stats")  # as in _split
    return members.join(stats, "_gid").select("_rid", "_n", "_keep")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                first_digit: int = FIRST_DIGIT) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id is kept (null ids last; of repeated ids one row).  Null
    text counts as empty, so null and empty texts form one group.  An empty table gives no rows; other
    columns, whatever their names, are ignored.
    """
    prepared = table(with_row_id(docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_t"))).select(
        "_rid", "_id", F.encode("_t", "UTF-8").alias("_body"),
        F.sha2(F.encode("_t", "UTF-8"), 256).alias("text_sha256")), "exact")
    members = _members(prepared.drop("text_sha256"), first_digit)
    return prepared.select("_rid", "_id", "text_sha256").join(members, "_rid", "left").select(
        F.col("_id").alias(id_col),
        F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep.id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("_n").isNull() | (F.col("_rid") == F.col("_keep.rid"))).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, row by row: ids may repeat or be null."""
    rows = numbered(docs)
    prepared = rows.select("_rid", F.col("_doc")[id_col].alias("_id"), F.encode(normalised(F.col("_doc")[text_col]), "UTF-8").alias("_body"))
    return without(rows, _members(prepared, FIRST_DIGIT).where("_rid != _keep.rid"))

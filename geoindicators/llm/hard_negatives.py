"""Hard-negative mining by angular triangle filtering over integer vectors.

Every row keeps its norm and its angles to a few reference directions.  For an anchor a and a row v the triangle
inequality on the sphere puts their angle between the largest |angle(a, r) - angle(v, r)| and the least of
angle(a, r) + angle(v, r) and 2 pi minus that, over all references r.  The cosines of both ends, times the two norms and
widened by more than the rounding error, are an upper and a lower bound of the integer inner product.  A pair is scored
only if its bounds overlap a window that is still open: for positives all scores from the k-th best so far, for the
negatives of a positive the scores in its share window from the k-th best so far.  Scores are exact integers.

Scale: rows lie in slabs sorted by nearest reference and angle, anchors in groups; slabs and groups have a bounded number of
rows, and a task sees one slab and one group at a time (a cell).  A cell returns at most k rows for each anchor and window,
of which a window with a group limit keeps the first k.  Work is anchors x rows less what the bounds exclude, in
cells that don't depend on how labels or vectors are spread: a label or vector with a third of all rows is cut like any other.
References come from a bounded sample (``SAMPLE`` rows) and only steer the bounds, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoindicators.llm.common import table, with_row_id
from geoindicators.llm.vectors import finite, floored, lists, longest, matrix

SAMPLE = 2048
REFERENCES = 12
SLAB_ROWS = 16384
GROUP_ANCHORS = 4096
ROW_BLOCK, ANCHOR_BLOCK = 1024, 256
LEAST = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def references(sample: np.ndarray, n: int = REFERENCES) -> np.ndarray:
    """Up to n unit directions out of the sample, each as far (by angle) from those before it as can be."""
    norm = np.sqrt((sample.astype(float) ** 2).sum(axis=1))
    unit = sample[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    out = [0]
    nearest = unit @ unit[0]
    while len(out) < n and nearest.min() < 1 - 1e-9:
        out.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[out[-1]])
    return unit[out]


def norms_and_angles(q: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A zero vector has angles 0: its bounds are 0 whatever they are."""
    norm = np.sqrt((q.astype(float) ** 2).sum(axis=1))
    unit = q / np.where(norm > 0, norm, 1)[:, None]
    return norm, np.where(norm[:, None] > 0, np.arccos(np.clip(unit @ refs.T, -1, 1)), 0)


class Side:
    """Rows or anchors of a cell as arrays."""

    def __init__(self, t: pa.Table, width: int):
        self.rid = t["_rid"].to_numpy()
        self.no_id = t["_id"].is_null().to_numpy()
        self.id = t["_id"].fill_null(0).to_numpy()
        self.q = matrix(t["_q"], width)
        self.norm = t["_norm"].to_numpy()
        self.angles = matrix(t["_angles"], len(t["_angles"][0]) if len(t) else 0, float)


def score_bounds(na: np.ndarray, ta: np.ndarray, nv: np.ndarray, tv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds, as floats rounded outwards, of the inner products of anchors (norms, angles) with rows."""
    near = np.zeros((len(na), len(nv)))
    far = np.full((len(na), len(nv)), np.pi)
    for j in range(ta.shape[1]):
        a, v = ta[:, j, None], tv[None, :, j]
        np.maximum(near, np.abs(a - v), out=near)
        both = a + v
        np.minimum(far, np.minimum(both, 2 * np.pi - both), out=far)
    size = na[:, None] * nv[None, :]
    slack = 1 + 1e-6 * size  # arccos is off by 3e-8 at most, the norms by less
    return size * np.cos(np.maximum(far, near)) - slack, size * np.cos(near) + slack


def search(a: Side, v: Side, k: int, allowed, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Yields (anchor, window, row, score): for each anchor and window [low, high] (anchors x windows) the k best rows.

    allowed(anchors, rows) -> boolean matrix of the pairs that count.  Order: score downwards, id upwards (null last), row.
    """
    exact = (a.norm.max(initial=0) * v.norm.max(initial=0)) < 2 ** 52  # else 64-bit integers instead of doubles
    vq = v.q.astype(float) if exact else v.q
    for first in range(0, len(a.rid), ANCHOR_BLOCK):
        rows_a = np.arange(first, min(first + ANCHOR_BLOCK, len(a.rid)))
        aq = vq[:0] if not len(rows_a) else (a.q[rows_a].astype(float) if exact else a.q[rows_a])
        need, top = low[rows_a].copy(), high[rows_a]
        best = [[np.zeros(0, np.int64)] * 3 for _ in range(low.shape[1])]  # anchor, row, score
        for at in range(0, len(v.rid), ROW_BLOCK):
            rows_v = np.arange(at, min(at + ROW_BLOCK, len(v.rid)))
            lower, upper = score_bounds(a.norm[rows_a], a.angles[rows_a], v.norm[rows_v], v.angles[rows_v])
            # a window's ends are longs; as doubles they are off by 2^-53 of their size, far less than the slack
            open_ = np.zeros(lower.shape, dtype=bool)
            for w in range(low.shape[1]):
                open_ |= (need[:, w] <= top[:, w])[:, None] & (upper >= need[:, w, None]) & (lower <= top[:, w, None])
            open_ &= allowed(rows_a, rows_v)
            if not open_.any():
                continue
            if open_.mean() > 1 / 16:
                score = (aq @ vq[rows_v].T).astype(np.int64)
            else:
                i, j = np.nonzero(open_)
                score = np.zeros(open_.shape, np.int64)
                for c in range(0, len(i), 1 << 16):
                    p, r = i[c:c + (1 << 16)], j[c:c + (1 << 16)]
                    score[p, r] = np.einsum("ij,ij->i", aq[p], vq[rows_v[r]]).astype(np.int64)
            for w in range(low.shape[1]):
                ok = open_ & (score >= need[:, w, None]) & (score <= top[:, w, None])
                if ok.shape[1] > k:
                    kth = np.partition(np.where(ok, score, LEAST), -k, axis=1)[:, -k]
                    need[:, w] = np.maximum(need[:, w], kth)
                    ok &= score >= need[:, w, None]
                i, j = np.nonzero(ok)
                if len(i):
                    best[w] = _first(v, k, *(np.concatenate(x) for x in zip(best[w], (i, rows_v[j], score[i, j]), strict=True)))
                    full = np.bincount(best[w][0], minlength=len(rows_a)) == k
                    worst = np.full(len(rows_a), MOST)
                    np.minimum.at(worst, best[w][0], best[w][2])
                    need[full, w] = np.maximum(need[full, w], worst[full])
        for w, (i, row, score) in enumerate(best):
            yield rows_a[i], np.full(len(i), w), row, score


def _first(v: Side, k: int, i: np.ndarray, row: np.ndarray, score: np.ndarray) -> list[np.ndarray]:
    order = np.lexsort((v.rid[row], v.id[row], v.no_id[row], -score, i))
    i, row, score = i[order], row[order], score[order]
    start = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
    rank = np.arange(len(i)) - np.repeat(start, np.diff(np.r_[start, len(i)]))
    return [i[rank < k], row[rank < k], score[rank < k]]


def share(percent: int, score: np.ndarray, up: bool) -> np.ndarray:
    """percent / 100 of scores, rounded up or down, without overflow."""
    whole, rest = np.divmod(score, 100)
    return percent * whole + (-((-percent * rest) // 100) if up else percent * rest // 100)


def _codes(a: pa.ChunkedArray, v: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    codes = pa.concat_arrays([*a.chunks, *v.chunks]).dictionary_encode().indices.to_numpy()
    return codes[:len(a)], codes[len(a):]


def place(rows: DataFrame, width: int, slab_rows: int) -> tuple[DataFrame, int]:
    """Rows with norm, angles and slab, as a written table, and the number of slabs."""
    sample = rows.orderBy(F.xxhash64("_rid"), "_rid").limit(SAMPLE).select("_q").toArrow()
    refs = references(matrix(sample["_q"], width))

    def angles(batches):
        for b in batches:
            norm, theta = norms_and_angles(matrix(b["_q"], width), refs)
            near = theta.argmin(axis=1) if len(theta) else np.zeros(0, np.int64)
            for name, values in (("_norm", norm), ("_ref", near.astype(np.int32)), ("_near", theta[np.arange(len(theta)), near])):
                b = b.append_column(name, pa.array(values))
            yield b.append_column("_angles", lists(theta))

    schema = "_rid bigint, _id bigint, _label string, _anchor boolean, _q array<bigint>, _norm double, _ref int, _near double, _angles array<double>"
    slabs = max(1, -(-rows.count() // slab_rows))
    sorted_ = rows.mapInArrow(angles, schema).repartitionByRange(slabs, "_ref", "_near", "_rid")
    placed = table(sorted_.select("*", F.spark_partition_id().alias("_slab")).sortWithinPartitions("_ref", "_near", "_rid"), "placed")
    return placed, int(placed.agg(F.coalesce(F.max("_slab"), F.lit(0))).first()[0]) + 1


def mine_hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, least_percent: int = 50, most_percent: int = 95, scale: int = 256,
                        id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
                        slab_rows: int = SLAB_ROWS, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of each anchor and positive.

    A row's score is the inner product of the floored vectors (scale * x) with the anchor's.  An anchor's positives are its
    first ``positives`` other rows of the same label by score (ties by smaller id, null ids last, then any stable order);
    the negatives of a positive are the first ``negatives`` rows of other labels whose score lies between least_percent and
    most_percent of the positive's (both ends count; a positive with a negative score has none).  ``anchor`` is a condition on
    the columns of ``rows``; null counts as false.

    Rows with a null label, a null vector or a null or non-finite component take no part.  Vectors of unequal lengths count as
    padded with zeros; empty and zero vectors score 0.  Repeated rows, and rows with equal ids, count each for itself (an
    anchor that occurs twice has two sets of rows).  A squared norm that doesn't fit a long raises an error.  Ids are whole numbers.
    An empty table, or one without anchors, gives no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    kept = rows.where(finite(rows[vector_col]) & rows[label_col].isNotNull()).select(
        rows[id_col].cast("bigint").alias("_id"), rows[label_col].cast("string").alias("_label"), F.coalesce(anchor, F.lit(False)).alias("_anchor"), floored(rows[vector_col], scale).alias("_q"))
    kept = table(with_row_id(kept), "vectors")
    n, anchors_n = kept.agg(F.count(F.lit(1)), F.count_if("_anchor")).first()
    if not anchors_n:
        return spark.createDataFrame([], RESULT)
    width = longest(kept, "_q")
    placed, slabs = place(kept, width, min(slab_rows, max(256, n // 32)))  # small tables: 32 slabs, for the cores
    groups = -(-anchors_n // group_anchors)
    row_side = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"))
    anchors = table(placed.where("_anchor").select("_rid", "_id", "_label", "_q", "_norm", "_angles", F.pmod(F.xxhash64("_rid"), F.lit(groups)).cast("int").alias("_group")), "anchors")
    slab_ids = F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))).alias("_slab")

    def cells(anchor_side: DataFrame, k: int, same: bool) -> DataFrame:
        def cell(left: pa.Table, right: pa.Table) -> pa.Table:
            out = {x: [np.zeros(0, np.int64)] for x in ("a", "p", "r", "s")}
            no_id = [np.zeros(0, bool)]
            ids = [np.zeros(0, np.int64)]
            if len(left) and len(right):
                v, a = Side(left, width), Side(right, width)
                la, lv = _codes(right["_label"], left["_label"])

                def allowed(i, j):
                    return ((la[i, None] == lv[None, j]) == same) & (a.rid[i, None] != v.rid[None, j])

                if same:
                    wins, low, high = np.zeros((len(a.rid), 1), np.int64), np.full((len(a.rid), 1), LEAST + 1), np.full((len(a.rid), 1), MOST)
                else:  # a place without a positive is a window that is never open
                    size = right["_scores"].combine_chunks().value_lengths().to_numpy()
                    wins = matrix(right["_scores"], int(size.max()))
                    there = np.arange(wins.shape[1])[None, :] < size[:, None]
                    low, high = np.where(there, share(least_percent, wins, True), 1), np.where(there, share(most_percent, wins, False), 0)
                for i, w, row, score in search(a, v, k, allowed, low, high):
                    for x, values in zip(out, (a.rid[i], wins[i, w], v.rid[row], score), strict=True):
                        out[x].append(values)
                    no_id.append(v.no_id[row])
                    ids.append(v.id[row])
            cols = {x: pa.array(np.concatenate(y)) for x, y in out.items()}
            return pa.table({**cols, "id": pa.array(np.concatenate(ids), mask=np.concatenate(no_id))})

        return row_side.groupBy("_slab", "_group").cogroup(anchor_side.select("*", slab_ids).groupBy("_slab", "_group")).applyInArrow(
            cell, "a bigint, p bigint, r bigint, s bigint, id bigint")

    def first(found: DataFrame, k: int, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.col("s").desc(), F.col("id").asc_nulls_last(), "r")
        return found.select("*", F.row_number().over(order).alias("k")).where(F.col("k") <= k)

    good = table(first(cells(anchors, positives, True), positives, "a").select("a", "r", "s", "id"), "positives")
    scores = good.groupBy("a").agg(F.sort_array(F.collect_set("s")).alias("_scores"))
    bad = cells(anchors.join(scores.withColumnRenamed("a", "_rid"), "_rid"), negatives, False)
    bad = table(first(bad, negatives, "a", "p").select("a", "p", F.col("s").alias("negative_score"), F.col("id").alias("negative_id"), F.col("k").cast("int").alias("rank")), "negatives")
    names = anchors.select(F.col("_rid").alias("a"), F.col("_id").alias("anchor_id"))
    pairs = good.select("a", F.col("s").alias("p"), F.col("id").alias("positive_id")).join(bad, ["a", "p"]).join(names, "a")
    return pairs.select("anchor_id", "positive_id", "rank", "negative_id", F.col("p").alias("positive_score"), "negative_score")

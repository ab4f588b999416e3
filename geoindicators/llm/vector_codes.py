"""Vector code compression: codebooks per part, fitted with k-means over metric trees (anchors hierarchies).

Vectors become integers and are cut into equal parts.  Rows lie in chunks; for each chunk and part a metric tree is built
middle-out: about sqrt(n) anchors are planted, each the farthest point of the widest ball so far and taking the points
nearer to it (points close to their own anchor are skipped by the triangle inequality); anchors are then merged upwards,
the pair with the smallest common ball first, and split downwards in the same way until a ball is small.  Every ball caches its
points' sum and count.

A round walks the trees from their roots, all balls of a depth at once.  A ball inherits the candidate entries of its parent and
drops those that another entry beats over the whole ball (the difference of the two squared distances is linear, so its
largest value over the ball is that at the centre plus 2 r |e - f|).  A ball with one candidate left is owned: its cached
sum and count go to that entry, without a look at its points.  Small balls compare their points with what is left, in exact integers.
The rounds give the same integers as plain k-means: a tie in distance goes to the lower index, and entries are dropped only where
the inequality is strict beyond rounding.

Scale: trees are built once, a chunk of ``CHUNK`` rows in a task's hands at a time, and written.  A round is one pass over the trees; each
task returns parts x entries x places sums, and the codebooks that go back are of that fixed size.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.common import table, with_row_id
from geoindicators.llm.vectors import finite, floored, lists, longest, matrix

CHUNK = 4096
LEAF = 16


@dataclass
class Tree:
    """Balls in breadth-first order: points order[start:stop], children first..last (none: leaf), cached sums."""

    order: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    left: np.ndarray    # -1: a leaf
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    total: np.ndarray   # integer sums of the points; the count is stop - start


def _anchors(x: np.ndarray, n: int) -> np.ndarray:
    """The anchor (0 to n-1 at most) of each point; anchors are points, each point is with its nearest."""
    owner = np.zeros(len(x), dtype=np.int64)
    dist = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    places = [0]
    while len(places) < n:
        far = int(dist.argmax())
        if dist[far] == 0:
            break
        # a point nearer to its anchor than half the way to the new one can't be taken
        between = np.sqrt(((x[places] - x[far]) ** 2).sum(axis=1))
        try_ = np.flatnonzero(dist > between[owner] * 0.4999999)
        d = np.sqrt(((x[try_] - x[far]) ** 2).sum(axis=1))
        taken = d < dist[try_]
        owner[try_[taken]] = len(places)
        dist[try_[taken]] = d[taken]
        owner[far] = len(places)
        dist[far] = 0
        places.append(far)
    return np.unique(owner, return_inverse=True)[1]


class _Builder:
    def __init__(self, x: np.ndarray):
        self.x = x.astype(float)
        self.nodes: list[tuple[int, int] | np.ndarray] = []  # children, or the points of a leaf

    def leaf(self, rows: np.ndarray) -> int:
        self.nodes.append(rows)
        return len(self.nodes) - 1

    def grow(self, rows: np.ndarray) -> int:
        x = self.x[rows]
        if len(rows) <= LEAF or not (x != x[0]).any():
            return self.leaf(rows)
        owner = _anchors(x, max(2, round(len(rows) ** 0.5)))
        order = np.argsort(owner, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)
        # middle: the anchors' balls; down: each is grown by itself; up: pairs with the smallest common ball are merged
        nodes = [self.grow(rows[g]) for g in groups]
        centre = np.array([x[g].mean(axis=0) for g in groups])
        radius = np.array([np.sqrt(((x[g] - c) ** 2).sum(axis=1)).max() for g, c in zip(groups, centre, strict=True)])
        count = np.array([len(g) for g in groups], dtype=float)
        k = len(nodes)
        gap = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2))
        both = np.maximum((gap + radius[:, None] + radius[None]) / 2, np.maximum(radius[:, None], radius[None]))
        both[np.tril_indices(k)] = np.inf
        live = np.ones(k, dtype=bool)
        for _ in range(k - 1):
            i, j = divmod(int(both.argmin()), k)
            new = (centre[i] * count[i] + centre[j] * count[j]) / (count[i] + count[j])
            radius[i] = max(np.sqrt(((centre[i] - new) ** 2).sum()) + radius[i], np.sqrt(((centre[j] - new) ** 2).sum()) + radius[j])
            centre[i], count[i], live[j] = new, count[i] + count[j], False
            self.nodes.append((nodes[i], nodes[j]))
            nodes[i] = len(self.nodes) - 1
            both[j, :] = both[:, j] = np.inf
            gap = np.sqrt(((centre - centre[i]) ** 2).sum(axis=1))
            common = np.where(live, np.maximum((gap + radius + radius[i]) / 2, np.maximum(radius, radius[i])), np.inf)
            both[i, i + 1:], both[:i, i] = common[i + 1:], common[:i]
        return nodes[0]


def build_tree(x: np.ndarray) -> Tree:
    """The metric tree of integer points (one at least)."""
    b = _Builder(x)
    b.grow(np.arange(len(x)))
    n = len(b.nodes)
    start, stop, left, right = (np.full(n, -1) for _ in range(4))
    order, at = [], 0
    walk = [n - 1]  # depth first, so that a ball's points lie together
    while walk:
        node = walk.pop()
        kind = b.nodes[node]
        if isinstance(kind, tuple):
            left[node], right[node] = kind
            walk += [kind[1], kind[0]]
        else:
            order.append(kind)
            start[node], stop[node] = at, at + len(kind)
            at += len(kind)
    order = np.concatenate(order)
    sums = np.zeros((n, x.shape[1]), dtype=np.int64)
    for node, kind in enumerate(b.nodes):  # children come before their parents
        if isinstance(kind, tuple):
            start[node], stop[node] = start[kind[0]], stop[kind[1]]
            sums[node] = sums[kind[0]] + sums[kind[1]]
        else:
            sums[node] = x[kind].sum(axis=0)
    centre = sums / (stop - start)[:, None]
    radius = np.zeros(n)
    for node in range(n):  # exact radii: the points of a ball lie together
        own = x[order[start[node]:stop[node]]]
        radius[node] = np.sqrt(((own - centre[node]) ** 2).sum(axis=1).max())
    return Tree(order, start, stop, left, right, centre, radius, sums)


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances, points x entries."""
    out = np.zeros((len(x), len(book)), dtype=np.int64)
    for j in range(x.shape[1]):
        d = x[:, j, None] - book[None, :, j]
        out += d * d
    return out


def assign(tree: Tree, x: np.ndarray, book: np.ndarray, points: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(sums, counts by entry, entry of each point if ``points``, points compared one by one)."""
    k = len(book)
    sums, counts = np.zeros(book.shape, dtype=np.int64), np.zeros(k, dtype=np.int64)
    entry = np.full(len(x), -1, dtype=np.int64)
    wide = 2 * np.sqrt(((book[:, None].astype(float) - book[None]) ** 2).sum(axis=2))
    ball = np.array([len(tree.start) - 1])
    mask = np.ones((1, k), dtype=bool)
    compared = 0
    while len(ball):
        d = ((tree.centre[ball][:, None] - book[None]) ** 2).sum(axis=2)
        best = np.where(mask, d, np.inf).argmin(axis=1)
        reach = tree.radius[ball][:, None] * wide[best]
        near = d[np.arange(len(ball)), best][:, None]
        mask = mask & ~(near - d + reach < -(1e-9 * (near + d + reach) + 1e-6))
        owned = mask.sum(axis=1) == 1
        np.add.at(sums, best[owned], tree.total[ball[owned]])
        np.add.at(counts, best[owned], tree.stop[ball[owned]] - tree.start[ball[owned]])
        if points:
            for b, e in zip(ball[owned], best[owned], strict=True):
                entry[tree.order[tree.start[b]:tree.stop[b]]] = e
        leaf = ~owned & (tree.left[ball] < 0)
        if leaf.any():
            size = tree.stop[ball[leaf]] - tree.start[ball[leaf]]
            at = np.repeat(tree.start[ball[leaf]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            rows = tree.order[at]
            exact = np.where(np.repeat(mask[leaf], size, axis=0), distances(x[rows], book), np.iinfo(np.int64).max)
            e = exact.argmin(axis=1)  # the first of equal ones: the lower index
            entry[rows] = e
            np.add.at(sums, e, x[rows])
            counts += np.bincount(e, minlength=k)
            compared += len(rows)
        down = ~owned & ~leaf
        ball = np.concatenate([tree.left[ball[down]], tree.right[ball[down]]])
        mask = np.concatenate([mask[down], mask[down]])
    return sums, counts, entry, compared


_TREE = "_chunk bigint, _part int, _rid array<bigint>, _x array<bigint>, _order array<bigint>, _start array<bigint>, _stop array<bigint>, _left array<bigint>, _right array<bigint>, _centre array<double>, _radius array<double>, _total array<bigint>"


def _trees(rows: DataFrame, parts: int, width: int, chunk_rows: int) -> DataFrame:
    """One row per chunk and part: its rows, points and tree, as a written table."""
    chunks = max(1, -(-rows.count() // chunk_rows))
    dealt = rows.select("_rid", "_q", F.pmod(F.xxhash64("_rid"), F.lit(chunks)).alias("_chunk"))
    dealt = dealt.select("_chunk", "_rid", F.posexplode(F.array(*[F.slice("_q", 1 + i * width, width) for i in range(parts)])).alias("_part", "_q"))

    def build(t: pa.Table) -> pa.Table:
        t = t.sort_by("_rid")
        x = matrix(t["_q"], width)
        tree = build_tree(x)
        cols = {"_rid": t["_rid"].to_numpy(), "_x": x, "_order": tree.order, "_start": tree.start, "_stop": tree.stop, "_left": tree.left, "_right": tree.right,
                "_centre": tree.centre, "_radius": tree.radius, "_total": tree.total}
        return pa.table({"_chunk": t["_chunk"][:1], "_part": t["_part"][:1], **{k: lists(np.ascontiguousarray(v).reshape(1, -1)) for k, v in cols.items()}})

    return table(dealt.groupBy("_chunk", "_part").applyInArrow(build, _TREE), "trees")


def _unpacked(batches, width: int):
    """(chunk's first row id, part, row ids, points, tree) of every record."""
    for b in batches:
        for i in range(b.num_rows):
            v = {name: b[name][i].values.to_numpy() for name in b.schema.names if name not in ("_chunk", "_part")}
            tree = Tree(v["_order"], v["_start"], v["_stop"], v["_left"], v["_right"], v["_centre"].reshape(-1, width), v["_radius"], v["_total"].reshape(-1, width))
            yield b["_part"][i].as_py(), v["_rid"], v["_x"].reshape(-1, width), tree


def compress(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label", chunk_rows: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """((id_col, label, code, error, label_error, codebooks_sha256), codebooks (parts, entries, places)).

    Each part's codebook starts as that part of the rows with the smallest ids (null ids last, equal ids by their vectors; fewer rows
    give fewer entries); ``rounds`` times every part goes to its nearest entry (ties: the lower index) and each
    entry becomes floor(sum / count) of its parts, an unused one stays; then parts are assigned once more.  code: two hex
    digits a part.  error: squared distances summed over the parts; label_error: errors summed over rows of an equal label (nulls together).

    Rows whose vector is null or holds a null or non-finite component are left out.  Vectors shorter than the longest, and a length
    that the parts don't divide, count as padded with zeros.  Empty vectors only: every code is zeros.  Repeated rows count each.  A
    squared norm that doesn't fit a long raises an error.  An empty table gives no rows; other columns are ignored.
    """
    out = rows.where(finite(rows[vector_col])).select(rows[id_col].alias("_id"), rows[label_col].alias("_label"), floored(rows[vector_col], scale).alias("_q"))
    out = table(with_row_id(out), "vectors")
    width = -(-max(1, longest(out, "_q")) // parts)
    full = F.concat("_q", F.array_repeat(F.lit(0).cast("bigint"), F.lit(parts * width) - F.size("_q")))
    out = out.withColumn("_q", F.when(F.size("_q") < parts * width, full).otherwise(F.col("_q")))
    first = out.orderBy(F.col("_id").asc_nulls_last(), "_q", "_rid").limit(entries).select("_q").toArrow()
    books = matrix(first["_q"], parts * width).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    trees = _trees(out, parts, width, chunk_rows)

    def round_(books: np.ndarray) -> DataFrame:
        def sums(batches):
            total, count = np.zeros(books.shape, dtype=np.int64), np.zeros(books.shape[:2], dtype=np.int64)
            for part, _, x, tree in _unpacked(batches, width):
                s, c, _, _ = assign(tree, x, books[part], False)
                total[part] += s
                count[part] += c
            at = np.flatnonzero(count.ravel())
            place = np.arange(at.size * width) % width
            yield pa.record_batch({"_at": pa.array(np.repeat(at, width)), "_place": pa.array(place), "_sum": pa.array(total.reshape(-1, width)[at].ravel()),
                                   "_n": pa.array(np.repeat(count.ravel()[at], width))})

        return trees.mapInArrow(sums, "_at bigint, _place bigint, _sum bigint, _n bigint").groupBy("_at", "_place").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))

    if books.shape[1]:
        for _ in range(rounds):
            t = round_(books).toArrow()  # parts x entries x places rows
            books = books.copy()
            books.reshape(-1, width)[t["_at"].to_numpy(), t["_place"].to_numpy()] = t["_sum"].to_numpy() // t["_n"].to_numpy()

    def codes(batches):
        for part, rid, x, tree in _unpacked(batches, width):
            _, _, e, _ = assign(tree, x, books[part], True)
            d = ((x - books[part][e]) ** 2).sum(axis=1)
            yield pa.record_batch({"_rid": pa.array(rid), "_part": pa.array(np.full(len(rid), part, dtype=np.int32)), "_e": pa.array(e.astype(np.int32)), "_d": pa.array(d)})

    found = trees.mapInArrow(codes, "_rid bigint, _part int, _e int, _d bigint").groupBy("_rid").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_part", "_e"))), lambda s: F.lpad(F.lower(F.hex(s["_e"])), 2, "0")), "").alias("code"),
        F.sum("_d").alias("error"))
    coded = table(out.select("_rid", "_id", "_label").join(found, "_rid"), "codes")
    labels = table(coded.groupBy("_label").agg(F.sum("error").alias("label_error")).withColumnRenamed("_label", "_of"), "label-errors")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = coded.join(labels, coded["_label"].eqNullSafe(labels["_of"]))
    return coded.select(F.col("_id").alias(id_col), F.col("_label").alias(label_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")), books

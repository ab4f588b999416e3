"""Gradient-boosted trees for binary labels (logistic loss, histogram splits), with a logistic calibration.

Trees grow on codes, a row's places among each feature's cuts, and need only a level's histograms: per node, feature and code the
number of rows and their sums of gradients.  These are sums of whole numbers, so the trees don't depend on the order of rows or
where they are added up: in numpy (``fit``) or by Spark over any number of rows (``fit_rows``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS, DEPTH, RATE, BINS, L2, LEAST_ROWS = 60, 3, 0.2, 32, 1.0, 8
SCALE = 1 << 24  # gradients are added up in whole parts of 1 / SCALE
GRID = 1024  # margins are whole parts of 1 / GRID, so that there are few different ones however many rows
FEW = 200_000  # different rows up to which the driver adds up the histograms itself

Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def _place(x: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Each row's node of a tree."""
    rows, at = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
    for _ in range(DEPTH):
        f = feature[at]
        at = np.where(f >= 0, 2 * at + 1 + (x[rows, np.maximum(f, 0)] > cut[at]), at)
    return at


@dataclass
class Boosted:
    """Trees as heaps: feature (-1: leaf), cut and value of each place; ``slope`` and ``shift`` turn a margin into a logit."""

    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            out += value[_place(x, feature, cut)]
        return np.rint(out * GRID) / GRID

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.chance(self.margin(x))

    def chance(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def _sums(codes: np.ndarray, y: np.ndarray, w: np.ndarray, margin: np.ndarray, tree: Tree, level: int) -> np.ndarray:
    """(gradients, their slopes, rows) of each node of a level, feature and code; ``w``: how often a row counts."""
    feature, cut, _ = tree
    at = _place(codes, feature, cut) - (2 ** level - 1)
    rows = np.flatnonzero((at >= 0) & (at < 2 ** level))
    n = codes.shape[1]
    slot = ((at[rows, None] * n + np.arange(n)) * BINS + codes[rows]).ravel()
    p = 1 / (1 + np.exp(-margin[rows]))
    each = [np.rint(v * SCALE) * w[rows] for v in (y[rows] - p, p * (1 - p))] + [w[rows]]
    return np.stack([np.bincount(slot, np.repeat(v, n), 2 ** level * n * BINS) for v in each]).astype(np.int64)


def _grow(sums: Callable[[list[Tree], Tree, int], np.ndarray], cuts: list[np.ndarray], n: int, up: int, rounds: int) -> Boosted:
    """sums(finished trees, the tree that grows, level); cuts: of each feature; n rows, up of them with label 1."""
    rate = np.clip(up / n if n else 0.5, 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(rate / (1 - rate))))
    if not 0 < up < n:
        return model
    trees: list[Tree] = []  # cuts by their number
    size = 2 ** (DEPTH + 1) - 1
    for _ in range(rounds):
        feature, cut, value = tree = np.full(size, -1), np.zeros(size, dtype=np.int64), np.zeros(size)
        for level in range(DEPTH):
            found = sums(trees, tree, level).reshape(3, 2 ** level, len(cuts), BINS).astype(float)
            for node in range(2 ** level - 1, 2 ** (level + 1) - 1):
                gl, hl, nl = (a / s for a, s in zip(found[:, node - 2 ** level + 1].cumsum(axis=2), (SCALE, SCALE, 1), strict=True))
                g, h, rows = gl[0, -1], hl[0, -1], nl[0, -1]
                value[node] = RATE * g / (h + L2)
                if rows < 2 * LEAST_ROWS:
                    continue
                gain = gl ** 2 / (hl + L2) + (g - gl) ** 2 / (h - hl + L2) - g ** 2 / (h + L2)
                gain[(nl < LEAST_ROWS) | (rows - nl < LEAST_ROWS)] = 0
                f, b = divmod(int(gain.argmax()), BINS)
                if gain[f, b] <= 1e-9 or b >= len(cuts[f]):
                    continue
                feature[node], cut[node] = f, b
                for child, gc, hc in ((2 * node + 1, gl[f, b], hl[f, b]), (2 * node + 2, g - gl[f, b], h - hl[f, b])):
                    value[child] = RATE * gc / (hc + L2)
        trees.append(tree)
        model.trees.append((feature, np.array([cuts[f][b] if f >= 0 else 0.0 for f, b in zip(feature, cut, strict=True)]), value))
    return model


def _margins(codes: np.ndarray, start: float, trees: list[Tree]) -> np.ndarray:
    out = np.full(len(codes), start)
    for feature, cut, value in trees:
        out += value[_place(codes, feature, cut)]
    return out


def _fit_here(codes: np.ndarray, y: np.ndarray, w: np.ndarray, cuts: list[np.ndarray], rounds: int) -> Boosted:
    n, up = int(w.sum()), int(w[y > 0].sum())
    margin = np.full(len(codes), _grow(None, cuts, n, up, 0).start)
    done = 0

    def sums(trees, tree, level):
        nonlocal done
        for feature, cut, value in trees[done:]:
            margin[:] += value[_place(codes, feature, cut)]
        done = len(trees)
        return _sums(codes, y, w, margin, tree, level)

    return _grow(sums, cuts, n, up, rounds)


def encode(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The number of each feature's cuts below the value."""
    return np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1).astype(np.uint8)


def quantiles() -> np.ndarray:
    return np.linspace(0, 1, BINS + 1)[1:-1]


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> Boosted:
    """Fits the trees; both labels should occur, else the margin is a constant."""
    if not len(y):
        return Boosted()
    cuts = [np.unique(np.quantile(c, quantiles())) for c in x.T]
    return _fit_here(encode(x, cuts), y, np.ones(len(y)), cuts, rounds)


def fit_rows(rows: DataFrame, cuts: list[np.ndarray], rounds: int = ROUNDS, few: int = FEW) -> Boosted:
    """Fits the trees on all rows (codes binary: a byte a feature, y int, w bigint: how often it occurs).

    Of more than ``few`` rows Spark adds up the histograms, a job a level; fewer are added up in the driver, with equal trees.
    """
    count, n, up = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("w"), F.lit(0)), F.coalesce(F.sum(F.col("w") * F.col("y")), F.lit(0))).first()
    if count <= few:
        return _fit_here(*_arrays(rows.select("codes", "y", "w").toArrow(), len(cuts)), cuts, rounds)
    start, n_features = _grow(None, cuts, n, up, 0).start, len(cuts)

    def sums(trees, tree, level):
        def add(batches):
            total = 0
            for b in batches:
                codes, y, w = _arrays(b, n_features)
                total = total + _sums(codes, y, w, _margins(codes, start, trees), tree, level)
            if not isinstance(total, int):
                at = np.flatnonzero(total[2])
                yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(t[at]) for t in total)], names=["at", "g", "h", "n"])

        found = rows.select("codes", "y", "w").mapInArrow(add, "at bigint, g bigint, h bigint, n bigint")
        found = found.groupBy("at").agg(*(F.sum(c).alias(c) for c in "ghn")).toArrow()
        out = np.zeros((3, 2 ** level * n_features * BINS), dtype=np.int64)
        for own, c in zip(out, "ghn", strict=True):
            own[found["at"].to_numpy()] = found[c].to_numpy()
        return out

    return _grow(sums, cuts, n, up, rounds)


def _arrays(b, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"".join(b["codes"].to_pylist()), np.uint8).reshape(-1, n_features)
    return codes, b["y"].to_numpy().astype(float), b["w"].to_numpy().astype(float)


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray) -> None:
    """Fits slope and shift on rows that the trees haven't seen."""
    calibrate_margins(model, model.margin(x), y, np.ones(len(y)))


def calibrate_margins(model: Boosted, m: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
    """The same on counted margins (Newton's steps, with Platt's smoothed targets)."""
    if not len(y) or y.min() == y.max():
        return
    up, down = w[y > 0].sum(), w[y <= 0].sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    scale = max(float(np.abs(m).max()), 1e-9)
    design = np.stack([m / scale, np.ones(len(m))], axis=1)
    loss = lambda v: float(w @ np.logaddexp(0, design @ v) - (w * target) @ (design @ v) + 5e-7 * v @ v)
    line = np.array([scale, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ line, -500, 500)))
        step = np.linalg.solve((design * (w * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2), design.T @ (w * (target - p)) - 1e-6 * line)
        size = 1.0
        while size > 1e-10 and loss(line + size * step) > loss(line):  # a whole step may overshoot where most rows are certain
            size /= 2
        line = line + size * step if size > 1e-10 else line
        if size <= 1e-10 or np.abs(size * step).max() < 1e-9:
            break
    line = line / np.array([scale, 1.0])
    model.slope, model.shift = float(max(line[0], 1e-3)), float(line[1])

"""Hard negatives and vector codes against brute force; rows with gaps; what the bounds and the balls leave out."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geoindicators.llm import hard_negatives as hn
from geoindicators.llm import vector_codes as vc
from geoindicators.llm.vectors import matrix

EXTRA = ", _rid string, _id string, _q string, _label string, code string, error string, a string, p string, s string, anchor_id string"


def table(spark, rows, kind="float"):
    """(vec_id, embedding, label) rows with extra columns whose names the operators use themselves."""
    schema = f"vec_id long, embedding array<{kind}>, label int{EXTRA}"
    return spark.createDataFrame([(*r, *["x"] * EXTRA.count("string")) for r in rows], schema)


def clustered(rng, n, dims=16, near=0.3):
    centres = rng.normal(size=(6, dims))
    label = rng.integers(0, 4, n)
    x = centres[rng.integers(0, 6, n)] + near * rng.normal(size=(n, dims))
    return [(int(i), [float(np.float32(v)) for v in x[i]], int(label[i])) for i in range(n)]


def takes_part(r, label=True):
    return r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1]) and (not label or r[2] is not None)


def brute_negatives(rows, every=5, positives=5, negatives=3):
    kept = [r for r in rows if takes_part(r)]
    width = max((len(r[1]) for r in kept), default=0)
    q = [[int(np.floor(256 * float(np.float32(v)))) for v in r[1]] + [0] * (width - len(r[1])) for r in kept]
    out = []
    key = lambda r, s: (-s, r[0] is None, r[0] or 0)
    for i, a in enumerate(kept):
        if a[0] is None or a[0] % every:
            continue
        score = [sum(x * y for x, y in zip(q[i], v, strict=True)) for v in q]
        other = sorted((j for j in range(len(kept)) if j != i), key=lambda j: key(kept[j], score[j]))
        for j in [j for j in other if kept[j][2] == a[2]][:positives]:
            p = score[j]
            bad = [k for k in other if kept[k][2] != a[2] and 50 * p <= 100 * score[k] <= 95 * p][:negatives]
            out += [(a[0], kept[j][0], n + 1, kept[k][0], p, score[k]) for n, k in enumerate(bad)]
    return sorted(out, key=str)


def mined(spark, rows, **kw):
    got = hn.mine_hard_negatives(table(spark, rows), F.col("vec_id") % 5 == 0, **kw)
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("near", [0.05, 0.5])
def test_hard_negatives_match_brute_force_over_many_cells(spark, near):
    rows = clustered(np.random.default_rng(1), 260, near=near)
    want = brute_negatives(rows)
    assert want and mined(spark, rows, slab_rows=40, group_anchors=20) == want


def test_hard_negatives_of_rows_with_gaps(spark):
    rng = np.random.default_rng(2)
    rows = clustered(rng, 60)
    hot = rows[7][1]
    rows += [(100 + i, hot, i % 2) for i in range(40)]                      # one vector many times: ties by id
    rows += [(0, rows[0][1], rows[0][2]), (0, rows[0][1], rows[0][2])]      # repeated anchor
    rows += [(None, rows[3][1], 1), (5000, None, 1), (5005, [None, 1.0], 1), (5010, [float("nan")] * 16, 2), (5015, [float("inf")] * 16, 2),
             (5020, rows[4][1], None), (5025, [0.0] * 16, 1), (5030, [], 1), (5035, [1.0, 2.0], 1), (-5, rows[6][1], 3)]
    assert mined(spark, rows) == brute_negatives(rows)


def test_hard_negatives_of_tables_without_pairs(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == []                # no anchor
    assert mined(spark, [(5, [1.0], 1), (10, [1.0], 2)]) == []  # no positive
    with pytest.raises(Exception, match="squared norm"):
        mined(spark, [(5, [1e30], 1)])


def test_bounds_hold_every_score_and_leave_pairs_out():
    rng = np.random.default_rng(3)
    q = np.array([np.floor(256 * np.array(r[1])) for r in clustered(rng, 400, near=0.05)]).astype(np.int64)
    q[:5] = 0
    refs = hn.references(q)
    norm, theta = hn.norms_and_angles(q, refs)
    lower, upper = hn.score_bounds(norm, theta, norm, theta)
    score = q @ q.T
    assert (lower <= score).all() and (score <= upper).all()
    kth = np.partition(score, -10, axis=1)[:, -10]
    assert (upper < kth[:, None]).mean() > 0.3  # far clusters are never scored


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [r for r in rows if takes_part(r, label=False)]
    width = -(-max([1, *(len(r[1]) for r in kept)]) // parts)
    q = np.array([[int(np.floor(4096 * float(np.float32(v)))) for v in r[1]] + [0] * (parts * width - len(r[1])) for r in kept]).reshape(len(kept), parts, width)
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, q[i].ravel().tolist()))[:entries]
    books = [q[first, p].copy() for p in range(parts)]

    def nearest(p):
        d = ((q[:, p, None] - books[p][None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            e, _ = nearest(p)
            for k in range(len(books[p])):
                if (e == k).any():
                    books[p][k] = [int(s) // int((e == k).sum()) for s in q[e == k, p].sum(axis=0)]
    found = [nearest(p) for p in range(parts)]
    error = [int(sum(f[1][i] for f in found)) for i in range(len(kept))]
    by_label = {}
    for r, e in zip(kept, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    return sorted(((r[0], r[2], "".join(f"{f[0][i]:02x}" for f in found), error[i], by_label[r[2]], digest) for i, r in enumerate(kept)), key=str)


def compressed(spark, rows, **kw):
    out, books = vc.compress(table(spark, rows), **kw)
    assert out.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_vector_codes_match_plain_k_means(spark):
    rows = clustered(np.random.default_rng(4), 300, near=0.05)
    assert compressed(spark, rows, chunk_rows=70) == brute_codes(rows)


def test_vector_codes_of_rows_with_gaps(spark):
    rows = clustered(np.random.default_rng(5), 60)
    rows += [(200 + i, rows[2][1], None) for i in range(50)] + [rows[9]] * 3
    rows += [(None, rows[1][1], 1), (-3, None, 1), (-4, [None], 1), (-5, [float("nan")], 1), (-6, [float("-inf")], 1), (300, [], 2), (301, [0.5, -0.5], 2)]
    assert compressed(spark, rows) == brute_codes(rows)
    few = rows[:3]  # fewer rows than entries; a width that the parts don't divide
    few = [(i, v[:13], n) for i, v, n in few]
    assert compressed(spark, few) == brute_codes(few)
    assert compressed(spark, []) == []
    assert compressed(spark, [(1, [], None)]) == brute_codes([(1, [], None)])


def test_trees_hold_all_points_and_own_whole_balls():
    rng = np.random.default_rng(6)
    x = (rng.integers(0, 8, size=(900, 1)) * 1000 + rng.integers(-30, 30, size=(900, 6))).astype(np.int64)
    tree = vc.build_tree(x)
    assert sorted(tree.order.tolist()) == list(range(900)) and (tree.total[-1] == x.sum(axis=0)).all()
    for b in range(len(tree.start)):
        own = x[tree.order[tree.start[b]:tree.stop[b]]]
        assert (tree.total[b] == own.sum(axis=0)).all() and np.sqrt(((own - tree.centre[b]) ** 2).sum(axis=1)).max() <= tree.radius[b] + 1e-6
    book = x[rng.choice(900, 16, replace=False)]
    book[5] = book[3]  # a tie goes to the lower index
    sums, counts, entry, compared = vc.assign(tree, x, book, True)
    want = ((x[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (entry == want).all() and (counts == np.bincount(want, minlength=16)).all() and counts[5] == 0
    assert all((sums[k] == x[want == k].sum(axis=0)).all() for k in range(16))
    near = np.array([np.full(6, 1000 * k) for k in range(8)])
    assert vc.assign(tree, x, near, False)[3] == 0  # every ball is owned whole


def test_matrix_pads_short_rows():
    assert matrix(pa.array([[1, 2], [], [3]], pa.list_(pa.int64())), 2).tolist() == [[1, 2], [0, 0], [3, 0]]

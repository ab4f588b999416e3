import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from geoindicators.llm import lsh
from geoindicators.llm import minhash_dedup as M
from geoindicators.llm.graph import components
from tests.llm.corpus_fixtures import changed, gaps, messy, text


def corpus(seed=14):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(60):
        t = text(rng, rng.randrange(60, 300))
        rows.append((i, t))
        for edits in (0, 1, 2, 4, 8, 16):
            if rng.random() < 0.6:
                i += 1
                rows.append((i, changed(rng, t, edits)))
        i += 1
    shared = text(rng, 60)
    for _ in range(40):   # a passage many documents share: not near copies
        rows.append((i, shared + "\n" + text(rng, 240)))
        i += 1
    stem = text(rng, 200)
    for _ in range(150):   # one large group of near copies
        rows.append((i, changed(rng, stem, 1)))
        i += 1
    return rows


def brute_links(rows, idf, threshold=0.8):
    profiles = {}
    for i, t in rows:
        for _, _, blobs in M._signatures(pa.array([t.lower()]), idf, range(0, 3), 3, profile=True):
            profiles[i] = blobs[0]
    ids, unpack = sorted(profiles), M.profiles(idf).unpack
    weights = {i: dict(zip(*(x.tolist() for x in unpack(profiles[i])), strict=True)) for i in ids}

    def similarity(p, q):
        return sum(min(w, q[k]) for k, w in p.items() if k in q) / max(1e-9, sum(max(p.get(k, 0), q.get(k, 0)) for k in {**p, **q}))
    return {(a, b): w for k, a in enumerate(ids) for b in ids[k + 1:] if (w := similarity(weights[a], weights[b])) >= threshold}


def groups(pairs, ids):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("small,block,crowd", [(12, 512, 8192), (4, 16, 8192), (4, 16, 60)])
def test_classes_match_brute_force(spark, monkeypatch, small, block, crowd):
    monkeypatch.setattr(lsh, "SMALL", small)
    monkeypatch.setattr(lsh, "BLOCK", block)
    monkeypatch.setattr(lsh, "CROWD", crowd)
    rows = corpus()
    docs = messy(spark, rows)
    idf = M.idf_table(docs.selectExpr("lower(text) as _t"))
    links = brute_links(rows, idf)
    want = groups(links, [i for i, _ in rows])
    got = {r.doc_id: r for r in M.near_dedup(docs).collect()}
    for a, b in ((a, b) for a in got for b in got if a < b and got[a].cluster_id == got[b].cluster_id):
        assert want[a] == want[b]                       # nothing is joined that isn't linked
    strong = [p for p, w in links.items() if w >= 0.85]
    assert all(got[a].cluster_id == got[b].cluster_id for a, b in strong)
    assert sum(got[a].cluster_id == got[b].cluster_id for a, b in links) >= 0.99 * len(links)
    by = defaultdict(list)
    for r in got.values():
        by[r.cluster_id].append(r)
    for c, rs in by.items():
        assert c == min(r.doc_id for r in rs) and all(r.cluster_size == len(rs) and r.kept == (r.doc_id == c) for r in rs)


def test_samples_agree_with_the_weighted_similarity():
    rng = random.Random(15)
    t = text(rng, 200)
    u = changed(rng, t, 6)
    idf = np.linspace(1, 2, M.FEATURES).astype(np.float32)
    [(_, bands, blobs)] = list(M._signatures(pa.array([t, u]), idf, range(0, 600), 1, profile=True))
    how = M.profiles(idf)
    assert abs((bands[0] == bands[1]).mean() - how.similarity(how.unpack(blobs[0]), how.unpack(blobs[1]))) < 0.07


def test_gaps_and_empty_table(spark):
    rows = gaps(random.Random(16))
    got = M.near_dedup(messy(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.cluster_id, r.cluster_size) for r in got}
    assert {(1, 1, 4), (2, 1, 4), (None, 1, 4), (6, 6, 2), (7, 6, 2), (8, 8, 1), (9, 9, 1)} <= by
    assert {(3, 3, 1), (4, 4, 1), (5, 5, 1)} <= by
    assert sum(r.kept for r in got if r.cluster_id == 1) == 1
    assert M.near_dedup(messy(spark, [])).collect() == []
    df = messy(spark, [(1, rows[0][1]), (2, rows[0][1]), (3, "x")])
    kept = M.drop_near_copies(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_components_match_brute_force(spark):
    rng = random.Random(17)
    for n, m in ((40, 25), (200, 180), (30, 0)):
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + ([(i, i + 1) for i in range(n, n + 60)] + [(n + 100, x) for x in range(n + 200, n + 260)] if m else [])
        df = spark.createDataFrame([*pairs, *([(None, 1)] if m else [])], "a long, b long")
        got = {r.node: r.comp for r in components(df).collect()}
        want = groups([p for p in pairs if p[0] != p[1]], {x for p in pairs if p[0] != p[1] for x in p})
        assert got == want


def test_crowded_buckets_are_compared_whole(spark, monkeypatch):
    """All links between nodes that share a band are joined, also where the fine keys miss or mislead."""
    monkeypatch.setattr(lsh, "SMALL", 3)
    monkeypatch.setattr(lsh, "BLOCK", 8)
    monkeypatch.setattr(lsh, "CROWD", 10)
    rng = random.Random(23)
    how = lsh.Profiles(lambda p: (np.frombuffer(p, "<i8"), np.ones(len(p) // 8)), 0.8)
    nodes, i = {}, 0
    for _ in range(30):   # groups of near copies, of which some fine keys are met by all and others by none
        stem = [rng.randrange(1 << 40) for _ in range(40)]
        for _ in range(rng.randrange(1, 5)):
            nodes[i] = sorted({*stem[rng.randrange(4):], *(rng.randrange(1 << 40) for _ in range(rng.randrange(3)))})
            i += 1
    bands = {c: [c % 2] for c in nodes}

    def similar(p, q):
        return len({*p} & {*q}) >= 0.8 * len({*p} | {*q})
    want = groups([(a, b) for a in nodes for b in nodes if a < b and bands[a] == bands[b] and similar(nodes[a], nodes[b])], nodes)
    for fine in (lambda c: [[c + 10], [c + 10]], lambda c: [[rng.randrange(3), 7], [rng.randrange(5), c + 10]]):
        rows = [(c, np.array(p, "<i8").tobytes(), fine(c)) for c, p in nodes.items()]
        profiles = spark.createDataFrame([(c, bytearray(p), f) for c, p, f in rows], "cls long, profile binary, fine array<array<long>>")
        keys = spark.createDataFrame([(c, b) for c, b in bands.items()], "cls long, keys array<long>")
        links = [(r.a, r.b) for r in lsh.near_links(keys, lambda own, p=profiles: p.join(own, "cls", "left_semi"), how).collect()]
        assert groups(links, nodes) == want

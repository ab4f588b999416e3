import random
import zlib

import numpy as np
import pyarrow.parquet as pq

from geoindicators.llm import toxicity as T
from tests.llm.corpus_fixtures import gaps, messy, text

SF = "/root/testdata/sf0.1"


def test_nearest_is_exact():
    rng = np.random.default_rng(5)
    ex = rng.random((300, 40), dtype=np.float32) * (rng.random((300, 40)) < 0.1)
    ex[17] = ex[3]
    norm = np.sqrt((ex * ex).sum(axis=1, keepdims=True))
    ex = (ex / np.where(norm > 0, norm, 1)).astype(np.float32)
    m = T.ToxicityModel(np.arange(40, dtype=np.uint64), np.ones(40, np.float32), ex, rng.integers(0, 2, 300), np.arange(300).astype(object), np.zeros(3), 0.1)
    q = np.concatenate([ex[:50], np.zeros((1, 40), np.float32), rng.random((20, 40), dtype=np.float32)])
    place, sim = m.nearest(q, 7)
    full = q @ ex.T
    for i in range(len(q)):
        order = np.lexsort((np.arange(300), -full[i]))[:7]
        want = [j for j in order if full[i, j] > 0]
        assert np.allclose(sim[i][:len(want)], full[i][want], atol=1e-5) and (sim[i][len(want):] == 0).all() and (place[i][len(want):] == -1).all()
        assert np.allclose(full[i][place[i][:len(want)]], full[i][want], atol=1e-5)
    place, _ = m.nearest(ex, 7, without=np.arange(300))
    assert all(i not in place[i] for i in range(300))


def test_held_out_quality_and_contract(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = T.train_toxicity_model(docs, labels)
    got = T.score_toxicity(docs, model).collect()
    y = pq.read_table(f"{SF}/labels.parquet").to_pandas().set_index("doc_id")["toxic"].to_dict()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(r.predicted, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]
    tp, fp, fn = (sum(p == a and t == b for p, t in held) for a, b in ((1, 1), (1, 0), (0, 1)))
    assert tp / (tp + fp) > 0.9 and tp / (tp + fn) > 0.75   # some labels contradict their text
    # evidence: labelled rows that aren't held out
    assert all(zlib.crc32(i.encode()) % 4 != 2 and int(i) in y for r in got for i in r.evidence)


def test_gaps_and_empty_tables(spark):
    rng = random.Random(6)
    bad = ["vilest", "scumbag"]
    rows = [(100 + i, text(rng, 30) + (" " + " ".join(bad) if i % 3 == 0 else "")) for i in range(150)] + gaps(rng)
    docs = messy(spark, rows)
    labels = spark.createDataFrame([(100 + i, int(i % 3 == 0), "x") for i in range(150)] + [(None, 1, "x"), (101, None, "x"), (102, 7, "x"), (100, 1, "x")], "doc_id long, toxic int, text string")
    model = T.train_toxicity_model(docs, labels)
    got = T.score_toxicity(docs, model).collect()
    assert len(got) == len(rows)
    assert all(r.predicted == int((r.doc_id - 100) % 3 == 0) for r in got if r.doc_id is not None and r.doc_id >= 100)
    assert all(r.predicted == 0 and r.evidence == [] for r in got if r.doc_id in (3, 4, 5))
    assert T.score_toxicity(docs.limit(0), model).collect() == []
    blank = T.train_toxicity_model(docs, labels.limit(0))   # nothing to learn from: one score for all
    assert len({r.score for r in T.score_toxicity(docs, blank).collect()}) == 1
    kept = T.drop_toxic(docs.where("doc_id is not null and doc_id != 2"), labels)
    assert kept.columns == docs.columns and all((r.doc_id - 100) % 3 for r in kept.collect() if r.doc_id >= 100)

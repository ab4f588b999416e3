"""The corpus pipeline on a small corpus with planted cases: what each stage drops, and what it must keep."""

import random
import re

import pytest

import corpus_pipeline
from tests.llm.corpus_fixtures import changed, text, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    path = tmp_path_factory.mktemp("corpus")
    plain = [(i, text(rng, rng.randrange(40, 200)), "en", f"s{i % 7}") for i in range(120)]
    toxic = [(1000 + i, text(rng, 60) + " scumbag " + text(rng, 20) + " vilest", "en", "s1") for i in range(90)]
    copies = [(2000 + i, t.replace(" ", "  "), "en", "s2") for i, t, *_ in plain[:15]]
    near = [(3000 + i, changed(rng, t, 1), "en", "s3") for i, t, *_ in plain[:60] if len(t.split()) > 120]
    items = [(i, " ".join(words(rng, 30))) for i in range(10)]
    leaks = [(4000 + i, text(rng, 50) + " " + " ".join(t.split()[15:] + words(rng, 5) + t.split()[:15]), "en", "s4") for i, t in items]
    gap = [(5000, "", None, None), (5001, " ", "en", "s5"), (5002, text(rng, 5000), "en", None)]
    rows = [(*r, len(r[1])) for r in plain + toxic + copies + near + leaks + gap]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, int(r[0] in range(1000, 2000))) for r in rows if r[0] < 2000 and r[0] % 10 < 8]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), {r[0]: r for r in rows}, {r[0] for r in near}


def test_stages(spark, folder):
    path, rows, near = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    have = set(rows)
    drops = {"toxicity": {i for i in rows if 1000 <= i < 2000},
             "exact_dedup": {i for i in rows if 2000 <= i < 3000},   # "" and " " stay: they are different texts
             "near_dedup": near, "decontamination": {i for i in rows if 4000 <= i < 5000}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        got = {r.doc_id for r in out.collect()}
        assert have - got == drops[name], name
        have, docs = got, spark.createDataFrame(out.collect(), out.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r.doc_id for r in packed} == have
    assert sum(r.n_words for r in packed) == sum(len(re.findall(r"\S+", rows[i][1])) for i in have)


def test_run_applies_all_stages(spark, folder):
    path, rows, near = folder
    got = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in got} == {i for i in rows if i < 1000 or i >= 5000}

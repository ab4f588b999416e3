import random
import zlib

import pyarrow.parquet as pq

from geoindicators.llm.langid import even_sample, identify_language, train_language_model
from tests.conftest import SF_ORACLE
from tests.llm.corpus_fixtures import gaps, messy


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = identify_language(docs, train_language_model(docs)).collect()
    lang = pq.read_table(f"{SF_ORACLE}/documents.parquet").to_pandas().set_index("doc_id")["lang"].to_dict()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got) and len(got) == len(lang)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    # calibration: the mean score is near the accuracy
    assert abs(sum(r.score for r in held) / len(held) - sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held)) < 0.05


def test_gaps_rejection_and_nothing_to_learn(spark):
    rng = random.Random(7)
    rows = [(100 + i, " ".join(rng.choice(["der", "und", "nicht", "schön"] if i % 2 else ["the", "and", "with", "of"]) for _ in range(20)), "de" if i % 2 else "en") for i in range(80)]
    rows += gaps(rng) + [(11, "12 34 !?"), (12, None, "en")]
    docs = messy(spark, rows)
    model = train_language_model(docs)
    got = identify_language(docs, model).collect()
    assert len(got) == len(rows)
    assert all(r.lang_pred == ("de" if r.doc_id % 2 else "en") for r in got if r.doc_id is not None and r.doc_id >= 100)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (3, 4, 5, 11, 12))
    assert all(r.lang_pred in ("de", "en") for r in got if r.doc_id in (1, 6, 8))
    strict = identify_language(docs, model, reject=1.01).collect()
    assert {r.lang_pred for r in strict} == {"und"}
    assert identify_language(docs.limit(0), model).collect() == []
    assert train_language_model(docs.withColumn("lang", docs["lang"].substr(1, 0)).where("false")) is None
    assert {r.lang_pred for r in identify_language(docs, None).collect()} == {"und"}


def test_sample_is_bounded_and_even(spark):
    rows = spark.createDataFrame([(i, "big") for i in range(5000)] + [(10_000 + i, "small") for i in range(40)], "_id long, _l string")
    got = even_sample(rows, "_l", 300).collect()
    n = {c: sum(r._l == c for r in got) for c in ("big", "small")}
    assert n == {"big": 260, "small": 40}
    assert sorted(r._id for r in got) == sorted(r._id for r in even_sample(rows.repartition(7), "_l", 300).collect())

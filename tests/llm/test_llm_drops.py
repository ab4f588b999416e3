"""The drop functions judge each row by itself: repeated rows, one id with two texts, and null ids."""

import random

from geoindicators.llm.exact_dedup import drop_exact_copies
from geoindicators.llm.minhash_dedup import drop_near_copies
from geoindicators.llm.tiling import drop_contaminated
from geoindicators.llm.toxicity import drop_toxic
from tests.llm.corpus_fixtures import changed, gaps, messy, text, words


def left(df, docs):
    assert df.columns == docs.columns and df.dtypes == docs.dtypes
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_exact_copies_keep_one_row_of_each_text(spark):
    rows = gaps(random.Random(31))
    rows += [(2, rows[1][1]), (None, "only null"), (None, "only null"), (30, "x"), (30, "y")]
    docs = messy(spark, rows)
    kept = [(1, rows[0][1]), (5, " \t\n "), (6, rows[7][1]), *[(r[0], r[1]) for r in rows[9:12]], (None, "only null"), (30, "x"), (30, "y")]
    assert left(drop_exact_copies(docs), docs) == sorted([*kept, (3, None)], key=str)


def test_near_copies_keep_one_row_of_each_class(spark):
    rng = random.Random(32)
    rows = gaps(rng)
    t = text(rng, 150)
    rows += [(40, t), (40, t), (None, changed(rng, t, 1)), (41, text(rng, 80)), (41, text(rng, 80))]
    docs = messy(spark, rows)
    kept = [(1, rows[0][1]), *[(r[0], r[1]) for r in rows[4:8]], *[(r[0], r[1]) for r in rows[9:13]], *[(r[0], r[1]) for r in rows[15:]]]
    assert left(drop_near_copies(docs), docs) == sorted(kept, key=str)


def test_contaminated_rows_go_and_their_ids_stay(spark):
    rng = random.Random(33)
    item = " ".join(words(rng, 30))
    rows = [*gaps(rng), (50, item), (50, "clean " + text(rng, 40)), (None, item + " x"), (51, item), (51, item)]
    docs = messy(spark, rows)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert left(drop_contaminated(docs, benchmark), docs) == sorted([(r[0], r[1]) for r in rows if item not in (r[1] or "")], key=str)


def test_toxic_rows_go_and_their_ids_stay(spark):
    rng = random.Random(34)
    bad = " vilest scumbag"
    rows = [(100 + i, text(rng, 30) + (bad if i % 3 == 0 else "")) for i in range(150)] + gaps(rng)
    rows += [(500, text(rng, 30) + bad), (500, text(rng, 30)), (None, text(rng, 30) + bad), (501, "clean"), (501, "clean")]
    docs = messy(spark, rows)
    labels = spark.createDataFrame([(100 + i, int(i % 3 == 0)) for i in range(150)], "doc_id long, toxic int")
    assert left(drop_toxic(docs, labels), docs) == sorted([(r[0], r[1]) for r in rows if bad not in (r[1] or "")], key=str)

import hashlib
import random
import re
from collections import defaultdict

from geoindicators.llm.exact_dedup import drop_exact_copies, exact_dedup
from tests.llm.corpus_fixtures import gaps, messy, text


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def run(spark, rows, **kw):
    got = exact_dedup(messy(spark, rows), **kw).collect()
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.doc_id is not None and r.group_size == 1)
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r.kept)
    assert all(sum(k) == 1 for k in by.values())   # exactly one row of each group stays
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str)


def test_matches_brute_force_on_gaps(spark):
    rows = gaps(random.Random(1))
    assert run(spark, rows) == brute(rows)


def test_long_shared_prefixes_and_ends_at_digit_borders(spark):
    rng = random.Random(2)
    stem = text(rng, 400)
    rows, i = [], 0
    for width in (0, 1, 3, 4, 5, 15, 16, 17, 20, 21, 84, 85, 340, 341, 1364, 1365):
        for tail in ("", "", "a", "b", "a"):
            rows.append((i, (stem * 3)[:width] + tail))
            i += 1
    rows += [(i, "é" * 9), (i + 1, "é" * 9), (i + 2, "a \t b"), (i + 3, "a b"), (i + 4, "a\u00a0b")]
    assert run(spark, rows, first_digit=4) == brute(rows)


def test_empty_table_and_drop(spark):
    assert run(spark, []) == []
    rows = [(1, "x  y"), (2, "x y"), (3, "z")]
    df = messy(spark, rows)
    kept = drop_exact_copies(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_one_group_with_most_rows(spark):
    rows = [(i, "same text" if i % 3 else f"own {i}") for i in range(600)]
    assert run(spark, rows) == brute(rows)

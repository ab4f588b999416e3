"""Shared passages are removed whole, in running text and across line ends."""

import random

from geoindicators.llm.paragraph_dedup import repeated_passages
from tests.llm.corpus_fixtures import messy, words


def brute_covered(rows, k=51, own=False):
    """(doc, word) of all windows of k words that an earlier document has (``own``: or an earlier place), line ends as white space."""
    seen, out = {}, set()
    for i, t in sorted(rows):
        w = (t or "").split()
        for j in range(len(w) - k + 1):
            if seen.setdefault(tuple(w[j:j + k]), (i, j)) != (i, j) and (own or seen[tuple(w[j:j + k])][0] != i):
                out |= {(i, x) for x in range(j, j + k)}
    return out


def removed_words(rows, got):
    out = set()
    for i, t in rows:
        data = t.encode()
        for r in got:
            if r.doc_id == i and r.removed:
                before = len(data[:r.start].decode().split())
                out |= {(i, x) for x in range(before, before + len(data[r.start:r.end].decode().split()))}
    return out


def test_removed_spans_are_the_whole_shared_runs(spark):
    rng = random.Random(41)
    rows = [(i, " ".join(words(rng, 150))) for i in range(20)]
    for k in range(30):   # in running text; the third copy shares a longer run with the second than with the first
        passage, more = words(rng, rng.randrange(51, 76)), words(rng, rng.randrange(1, 40))
        for c in range(3):
            own = words(rng, 120)
            at = rng.randrange(121)
            rows.append((1000 + 10 * k + c, " ".join(own[:at] + passage + (more if c else []) + own[at:])))
    want = brute_covered(rows)
    assert {i for i, _ in want} == {i for i, _ in rows if i >= 1000 and i % 10}
    assert removed_words(rows, repeated_passages(messy(spark, rows)).collect()) == want


def test_passages_across_line_ends(spark):
    rng = random.Random(42)

    def wrapped(w, width):
        return "\n".join(" ".join(w[i:i + width]) for i in range(0, len(w), width))
    rows = [(i, wrapped(words(rng, 100), 13)) for i in range(10)]
    for k in range(20):   # lines of 12 to 15 words, wrapped elsewhere in each copy
        passage = words(rng, rng.randrange(51, 90))
        for c in range(2):
            rows.append((1000 + 10 * k + c, wrapped(words(rng, rng.randrange(60)) + passage + words(rng, rng.randrange(60)), 12 + rng.randrange(4))))
    rows += [(2000, wrapped(words(rng, 200), 13))]
    rows += [(2001, rows[-1][1])]
    want = brute_covered(rows)
    assert {i for i, _ in want} == {1001 + 10 * k for k in range(20)} | {2001}
    assert removed_words(rows, repeated_passages(messy(spark, rows)).collect()) == want


def test_spans_go_to_their_documents_on_shuffled_input(spark):
    rng = random.Random(41)
    shared = [words(rng, 70) for _ in range(4)]
    docs = [(i, " ".join([*words(rng, 30), *shared[i % 4], *words(rng, 30)])) for i in range(60)]
    scanned = messy(spark, docs)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        shuffled = scanned.repartition(13, "doc_id")
        got = [sorted(map(tuple, repeated_passages(d).collect()), key=str) for d in (scanned, shuffled)]
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert got[0] == got[1] and len({r[0] for r in got[0]}) == 60


def test_stretches_that_go_on_differently_in_several_documents(spark):
    """Documents are overlapping cuts of a few long texts, so a seed's class goes on in many ways on either side."""
    rng = random.Random(43)
    bases = [words(rng, 400) for _ in range(5)]
    rows = []
    for i in range(90):
        w = []
        for _ in range(rng.randrange(1, 5)):
            base, n = rng.choice(bases), rng.randrange(15, 130)
            at = rng.randrange(400 - n)
            w += base[at:at + n] + words(rng, rng.choice([0, 0, 3, 30]))
        rows.append((i, " ".join(w)))
    rows += [(100 + i, t.replace(" ", "\n", 3)) for i, t in rows[:8]] + [(200, " ".join(["w"] * 90)), (201, " ".join(["w"] * 130))]
    got = repeated_passages(messy(spark, rows)).collect()
    removed = removed_words(rows, got)
    assert brute_covered(rows) <= removed <= brute_covered(rows, 20, own=True)
    assert all(r.first_doc_id <= r.doc_id for r in got)


def test_classes_of_few_seeds_are_followed_by_a_row_a_seed_with_what_joins_find(spark, monkeypatch):
    from geoindicators.llm import paragraph_dedup

    rng = random.Random(44)
    bases = [words(rng, 300) for _ in range(3)]
    rows = []
    for i in range(40):
        base, n = rng.choice(bases), rng.randrange(51, 130)
        at = rng.randrange(300 - n)
        rows.append((None if i % 13 == 5 else i % 30, " ".join(words(rng, 30) + base[at:at + n] + words(rng, rng.randrange(60)))))
    docs = messy(spark, rows)
    seen, got = [], {}
    followed = paragraph_dedup._followed
    monkeypatch.setattr(paragraph_dedup, "_followed", lambda r: seen.append(r.cache().select("cls", "start", "_rid", "side").distinct().count() / max(1, r.count())) or followed(r))
    for crowd in (paragraph_dedup.CROWD, 6):
        seen.clear()
        monkeypatch.setattr(paragraph_dedup, "CROWD", crowd)
        got[crowd] = sorted(map(tuple, repeated_passages(docs).collect()), key=str)
        if crowd == 1024:
            assert set(seen[1:]) == {1.0}
    assert len(got[1024]) > 40 and got[1024] == got[6]


def test_spans_of_a_document_are_joined_and_cut():
    import pyarrow as pa

    from geoindicators.llm.paragraph_dedup import _document_spans

    rng = random.Random(45)
    names = ["doc_rid", "start", "end", "removed", "first_doc_id"]
    places = [(d, a := rng.randrange(300), a + rng.randrange(1, 40), rng.random() < 0.4, f"{rng.randrange(9)}") for d in range(60) for _ in range(rng.randrange(1, 20))]
    places = sorted(places, key=lambda x: (x[0], x[1], x[2], x[4]))
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*places[i:i + 7], strict=True)], names=names) for i in range(0, len(places), 7)]
    got = [tuple(r.values()) for b in _document_spans(iter([*batches[:3], batches[0].slice(0, 0), *batches[3:]])) for r in b.to_pylist()]
    for d in range(60):
        own = [x for x in places if x[0] == d]
        cut = {p for x in own if x[3] for p in range(x[1], x[2])}
        keep = {p for x in own if not x[3] for p in range(x[1], x[2])} - cut
        for removed, want in ((True, cut), (False, keep)):
            spans = [x for x in got if x[0] == d and x[3] == removed]
            assert sorted(p for x in spans for p in range(x[1], x[2])) == sorted(want)
            assert all(any(y[3] == removed and y[4] == x[4] and (y[1] == x[1] if removed else y[1] <= x[1]) for y in own) for x in spans)
    assert not any(a[0] == b[0] and a[2] == b[1] for a in got for b in got if a[3] and b[3])


def test_crowded_classes_are_followed_by_a_row_a_seed_in_ranges(spark, monkeypatch):
    from geoindicators.llm import paragraph_dedup

    rng = random.Random(46)
    rows = []
    for rid in range(400):   # few words, so that many go on alike; documents without an id, ids that repeat, several seeds of a document
        for start in range(rng.choice((1, 1, 2))):
            ext = [0]
            for _ in range(rng.randrange(12)):
                ext.append(hash((ext[-1], rng.choice((1, 1, 1, 1, 1, 1, 2, 3)))) % 2**31)
            rows.append((rid, None if rid % 17 == 3 else rid * 7 % 150, start, start + 9, rid % 5 // 4, 1, start == 0, rng.random() < 0.1, True, ext[1:], [20 + k for k in range(len(ext) - 1)]))
    docs = spark.createDataFrame(rows, "_rid bigint, _id bigint, start bigint, end bigint, cls bigint, more int, side boolean, wide boolean, crowd boolean, ext array<int>, far array<int>")
    want = {}
    place = lambda r: (r[1] is None, r[1] or 0, r[0], r[2])
    for r in rows:
        best = [None, None]
        for n in range(1, len(r[9]) + 1):
            alike = [o for o in rows if o[4:7] == r[4:7] and o[9][:n] == r[9][:n]]
            if len({o[0] for o in alike}) > 1 or any(o[7] for o in alike):
                f = min(alike, key=place)
                for i in range(2 if f != r else 1):
                    best[i] = (n, 19 + n, r[3], (f[1] is None, f[1], f[0], f[2]))
        if best[0]:
            want[r[0], r[2], r[6]] = tuple(best)
    written = []
    table = paragraph_dedup.table
    monkeypatch.setattr(paragraph_dedup, "table", lambda df, *a: (out := table(df, *a), written.append(out.count()))[0])
    for n in (1, 7, 60):
        monkeypatch.setattr(paragraph_dedup, "parts", lambda s, n=n: n)
        written.clear()
        got = paragraph_dedup._followed(docs).collect()
        assert {(r._rid, r.start, r.side): tuple(x and (*x[:3], tuple(x[3])) for x in (r.shared, r.earlier)) for r in got if r.shared} == want and len(got) >= len(want) > 200
        assert max(written) <= len(rows) + 2 * 12 * n   # a row a seed, and a word of a range's borders; not a row a word


def test_crowded_and_other_classes_are_both_a_row_a_seed(spark, monkeypatch):
    from geoindicators.llm import paragraph_dedup

    rng = random.Random(47)
    base = words(rng, 200)
    rows = []
    for i in range(30):
        at = rng.randrange(100)
        rows.append((i, " ".join(words(rng, 30) + base[at:at + rng.randrange(51, 100)] + words(rng, 20))))
    seen, followed = [], paragraph_dedup._followed
    monkeypatch.setattr(paragraph_dedup, "CROWD", 8)
    monkeypatch.setattr(paragraph_dedup, "_followed", lambda r: seen.append((r.count(), r.select("cls", "more", "side", "_rid", "start").distinct().count())) or followed(r))
    assert brute_covered(rows) <= removed_words(rows, repeated_passages(messy(spark, rows)).collect())
    assert seen[0][0] > 8 and all(n == seeds for n, seeds in seen)


def test_word_hashes_by_running_sums_are_those_of_the_words_alone():
    import numpy as np
    import pyarrow as pa

    from geoindicators.llm.paragraph_dedup import PIECE, WINDOW, _anchors, _content
    from geoindicators.llm.tokens import U, _hash_each, mix, split_words, text_chunks

    rng = random.Random(48)
    texts = ["", None, "x" * 70000 + " y " + "z" * 65536, *(" ".join(words(rng, rng.randrange(200)) + ["ab"] * rng.randrange(90)) for _ in range(300))]
    for _, _, data, offsets in text_chunks(pa.array(texts)):
        w = split_words(data, offsets)
        assert np.array_equal(w.hash, _hash_each(data, w.start, w.end - w.start)) and len(w.hash) > 20000
        assert np.array_equal(w.row, np.searchsorted(offsets, w.start, "right") - 1)
        first = w.first()
        a = _anchors(w, first[:-1], first[1:])
        power = [pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(PIECE)]
        want = [sum(int(h) * p for h, p in zip(w.hash[i:i + PIECE], power, strict=True)) % (1 << 64) ^ PIECE for i in a]
        assert np.array_equal(_content(w.hash, a, a + PIECE), mix(np.array(want, U)))
        for r in range(w.rows):   # an anchor in each window, none where no window is
            places, own = first[r + 1] - first[r] - PIECE + 1, a[(a >= first[r]) & (a < first[r + 1])] - first[r]
            assert (len(own) > 0) == (places >= WINDOW)
            assert not len(own) or max(np.diff(np.r_[-1, own, places])) <= WINDOW

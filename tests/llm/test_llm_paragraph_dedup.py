import random

from geoindicators.llm.lsh import Profiles
from geoindicators.llm.paragraph_dedup import repeated_passages, unpack
from tests.llm.corpus_fixtures import changed, gaps, messy, text, words


def shared_windows(rows, k):
    seen, out = {}, set()
    for i, t in rows:
        own = set()
        for line in (t or "").split("\n"):
            w = line.split()
            own |= {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
        for x in own:
            if seen.setdefault(x, i) != i:
                out |= {i, seen[x]}
    return out


def test_passages_of_over_50_words_are_caught_wherever_they_stand(spark):
    rng = random.Random(18)
    rows = [(i, text(rng, 400, line=130)) for i in range(60)]
    short = " ".join(words(rng, 12))
    rows = [(i, t + "\n" + short) for i, t in rows]                       # a short line that all share
    for k in range(25):
        passage = " ".join(words(rng, rng.randrange(51, 75)))
        for c in range(2 + k % 3):
            own = words(rng, 160)
            at = rng.randrange(161)
            where = " ".join(own[:at] + [passage] + own[at:]) if k % 2 else " ".join(own[:80]) + "\n" + passage + "\n" + " ".join(own[80:])
            rows.append((1000 + 10 * k + c, where))
    got = repeated_passages(messy(spark, rows)).collect()
    texts = dict(rows)
    assert {r.doc_id for r in got} == shared_windows(rows, 51) == {i for i, _ in rows if i >= 1000}
    first = {i for i in texts if i >= 1000 and i % 10 == 0}
    for r in got:   # the first place stays; what is removed is words of an earlier document of the group
        assert r.first_doc_id // 10 == r.doc_id // 10 and (r.first_doc_id < r.doc_id if r.removed else r.first_doc_id == r.doc_id)
        assert not r.removed or len(texts[r.doc_id].encode()[r.start:r.end].decode().split()) >= 20
        assert not r.removed or texts[r.doc_id].encode()[r.start:r.end].decode() in texts[r.doc_id // 10 * 10] or r.first_doc_id not in first
    assert all(any(r.removed for r in got if r.doc_id == i) == (i not in first) for i in {r.doc_id for r in got})
    for i in {r.doc_id for r in got}:   # spans of a document don't overlap
        own = sorted((r.start, r.end) for r in got if r.doc_id == i)
        assert all(a[1] <= b[0] for a, b in zip(own, own[1:], strict=False))


def test_near_equal_paragraphs_are_joined(spark):
    rng = random.Random(19)
    stems = [" ".join(words(rng, 90)) for _ in range(40)]
    rows = [(i, s) for i, s in enumerate(stems)] + [(100 + i, changed(rng, s, 1 if i % 2 else 40)) for i, s in enumerate(stems)]

    def grams(t):
        w = t.split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    near = {i for i in range(40) if len(grams(rows[i][1]) & grams(rows[40 + i][1])) >= 0.8 * len(grams(rows[i][1]) | grams(rows[40 + i][1]))}
    got = {r.doc_id: r.first_doc_id for r in repeated_passages(messy(spark, rows)).collect() if r.removed}
    assert near <= {i - 100 for i in got} and all(got[100 + i] == i for i in near)
    assert not {i - 100 for i in got} - near - shared_to_ids(rows)


def shared_to_ids(rows):
    return {i - 100 for i in shared_windows(rows, 20) if i >= 100}


def test_gaps_and_empty_table(spark):
    rng = random.Random(20)
    rows = gaps(rng) + [(20, "é " * 30), (21, "é " * 30), (22, "w " * 25 + "\n" + "w " * 25)]
    got = repeated_passages(messy(spark, rows)).collect()
    ids = {r.doc_id for r in got}
    assert {1, 2, None, 6, 7, 20, 21} <= ids and not ids & {3, 4, 5, 8, 9, 10, 22}
    assert {r.first_doc_id for r in got if r.doc_id in (2, None)} == {1}
    assert any(r.doc_id == 1 and not r.removed for r in got) and all(not r.removed for r in got if r.doc_id in (1, 6, 20))
    assert repeated_passages(messy(spark, [])).collect() == []


def test_jaccard():
    import numpy as np
    a, b = (unpack(np.array(x, "<u8").tobytes()) for x in ([1, 2, 3, 4], [3, 4, 5]))
    how = Profiles(unpack, 0.8)
    assert how.similarity(a, b) == 2 / 5 and how.similarity(a, a) == 1


def test_shares_of_the_classes_bound_a_step_and_change_nothing(spark, monkeypatch):
    from geoindicators.llm import paragraph_dedup

    rng = random.Random(21)
    passages = [" ".join(words(rng, rng.randrange(51, 70))) for _ in range(12)]
    rows = [(i, " ".join(words(rng, 40) + [rng.choice(passages)] + words(rng, rng.randrange(40)))) for i in range(60)]
    docs = messy(spark, rows)
    whole, found = [], {}
    followed = paragraph_dedup._followed
    monkeypatch.setattr(paragraph_dedup, "_followed", lambda r: whole.append(r.count()) or followed(r))
    for shares in (1, paragraph_dedup.SHARES):
        whole.clear()
        monkeypatch.setattr(paragraph_dedup, "SHARES", shares)
        found[shares] = sorted(map(tuple, repeated_passages(docs).collect()))
        coarse, *fine = whole
        found[shares, "steps"] = fine
    assert found[1] == found[4] and len(found[1]) > 50
    assert len(found[4, "steps"]) == 4 and sum(found[4, "steps"]) == sum(found[1, "steps"]) > 2 * max(found[4, "steps"])

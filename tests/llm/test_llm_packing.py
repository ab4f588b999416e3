import random
from collections import defaultdict

from geoindicators.llm.packing import pack, pack_documents
from tests.llm.corpus_fixtures import gaps, messy, text, words


def brute_pack(sizes, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= n and (s is None or s not in b[1]) and (c is None or c not in b[2])]
        if fits:
            i = min(fits)[1]
        else:
            bins.append([capacity, set(), set()])
            i = len(bins) - 1
        bins[i][0] -= n
        bins[i][1].add(s)
        bins[i][2].add(c)
        out.append(i)
    return out


def test_pack_is_the_tightest_compatible_bin():
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randrange(1, 80)
        sizes = sorted((rng.randrange(0, 101) for _ in range(n)), reverse=True)
        sources = [rng.choice([None, *range(6)]) for _ in range(n)]
        clusters = [rng.choice([None, *range(12)]) for _ in range(n)]
        assert pack(sizes, sources, clusters, 100) == brute_pack(sizes, sources, clusters, 100)


def check(rows, got, capacity):
    bins, words_of = defaultdict(list), defaultdict(int)
    for r in got:
        bins[r.bin_id].append(r)
        words_of[r.doc_id] += r.n_words
    have = defaultdict(int)
    for r in rows:
        have[r[0]] += len((r[1] or "").split())
    assert words_of == have
    source = {r[0]: r[3] if len(r) > 3 else "s" for r in rows}
    for b in bins.values():
        assert sum(r.n_words for r in b) <= capacity and sorted(r.position for r in b) == list(range(len(b)))
        s = [source[r.doc_id] for r in b if source[r.doc_id] is not None]
        assert len(s) == len(set(s))
    return bins


def test_documents_keep_all_words_and_no_conflict(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(words(rng, rng.randrange(0, 120))), None, f"s{0 if i % 3 == 0 else i % 11}") for i in range(400)]
    rows += [(1000 + i, "the same few words", None, f"q{i}") for i in range(20)]   # a cluster: never two in one bin
    got = pack_documents(messy(spark, rows), capacity=100, shard_rows=150).collect()
    bins = check(rows, got, 100)
    for b in bins.values():
        assert sum(r.doc_id >= 1000 for r in b) <= 1
    assert len(bins) < 0.75 * len(got)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.first_word, r.n_words, r.piece))
    for p in pieces.values():   # pieces follow on from one another
        p.sort()
        assert [x[2] for x in p] == list(range(len(p))) and all(a[0] + a[1] == b[0] for a, b in zip(p, p[1:], strict=False))


def test_gaps_and_empty_table(spark):
    rows = gaps(random.Random(10))
    got = pack_documents(messy(spark, rows), capacity=512).collect()
    check([(r[0], r[1], None, None) for r in rows], got, 512)
    assert sum(r.doc_id in (3, 4, 5) for r in got) == 3
    assert pack_documents(messy(spark, [])).collect() == []
    assert len(pack_documents(messy(spark, [(1, text(random.Random(1), 1024))]), capacity=512).collect()) == 2

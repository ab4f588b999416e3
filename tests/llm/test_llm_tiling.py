import random
import re

from pyspark.sql import functions as F

from geoindicators.llm.tiling import contaminated, drop_contaminated, greedy_tiles
from tests.llm.corpus_fixtures import EXTRA, gaps, messy, text, words


def brute_tiles(p, t, least):
    fp, ft, total = [True] * len(p), [True] * len(t), 0
    while True:
        best, found = 0, []
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and fp[i + n] and ft[j + n] and p[i + n] == t[j + n]:
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best and n:
                    found.append((i, j))
        if best < least:
            return total
        for i, j in found:
            if all(fp[i:i + best]) and all(ft[j:j + best]):
                fp[i:i + best] = [False] * best
                ft[j:j + best] = [False] * best
                total += best


def test_tiles_match_brute_force():
    rng = random.Random(11)
    for _ in range(400):
        p = [rng.randrange(4) for _ in range(rng.randrange(3, 30))]
        t = [rng.randrange(4) for _ in range(rng.randrange(3, 60))]
        tiles = greedy_tiles(p, t, 3)
        assert sum(x[2] for x in tiles) == brute_tiles(p, t, 3)
        assert all(p[i:i + n] == t[j:j + n] and n >= 3 for i, j, n in tiles)


def bench(spark, items):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, doc_id string, _t string")


def norm(t):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (t or "").lower())


def brute(docs, items, least=4, coverage=0.5):
    out = set()
    for d, t in docs:
        for i, u in items:
            p = norm(u)
            if p and brute_tiles(p, norm(t), min(least, len(p))) >= coverage * len(p):
                out.add((d, i))
    return out


def case(rng):
    items = [(i, " ".join(words(rng, rng.randrange(12, 30)))) for i in range(12)] + [(50, None), (51, ""), (52, "Só lo"), (53, "!!"), (3, "again " + " ".join(words(rng, 9)))]
    docs = [(i, text(rng, 60)) for i in range(30)]
    for k, (i, t) in enumerate(items[:12]):
        w = t.split()
        a, b = w[:len(w) // 2], w[len(w) // 2:]
        own = words(rng, 15)
        docs.append((100 + k, " ".join(own[:7] + [t.upper() + "."] + own[7:])))           # as it is
        docs.append((200 + k, " ".join(own[:5] + b + own[5:9] + a + own[9:])))            # reordered
        docs.append((300 + k, " ".join(own + w[:len(w) // 3])))                            # a third: too little
    docs.append((400, "x só, LO y"))
    return docs, items


def test_contaminated_matches_brute_force(spark):
    docs, items = case(random.Random(12))
    for block in (8 << 20, 300):   # one block, and several
        got = contaminated(messy(spark, docs), bench(spark, items), block_bytes=block).collect()
        assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
        assert all(0.5 <= r.coverage <= 1 and r.n_tiles >= 1 for r in got)
    kept = {r.doc_id for r in drop_contaminated(messy(spark, docs), bench(spark, items)).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in brute(docs, items)}


def test_gaps_and_empty_tables(spark):
    rows = gaps(random.Random(13))
    docs = messy(spark, rows)
    b = bench(spark, [(1, rows[0][1].replace("\n", " ")), (2, "one two"), (None, "one two"), (2, "one two")])
    got = contaminated(docs, b).collect()
    assert sorted(str((r.doc_id, r.item_id)) for r in got) == sorted(map(str, [(1, 1), (2, 1), (2, 1), (None, 1), (9, 2), (9, 2), (9, None)]))
    assert contaminated(docs.limit(0), b).collect() == [] and contaminated(docs, b.limit(0)).collect() == []
    assert len(EXTRA) and drop_contaminated(docs.where("doc_id != 2"), b).columns == docs.columns


def test_repetitive_texts_take_little_time():
    import time

    rng = random.Random(9)
    start = time.process_time()
    assert greedy_tiles([1] * 400, [1] * 20_000) == [(0, 0, 400)]
    assert sum(x[2] for x in greedy_tiles([1, 2] * 300, [1, 2] * 9_000 + [3])) == 600
    broken = [w for _ in range(300) for w in [1] * 30 + [rng.randrange(5, 9)]]
    assert sum(x[2] for x in greedy_tiles([1] * 400, broken)) == 400
    assert time.process_time() - start < 6
    for _ in range(300):  # many ties and cut matches: equal to brute force
        item, text_ = [rng.randrange(2) for _ in range(rng.randrange(1, 14))], [rng.randrange(2) for _ in range(rng.randrange(1, 22))]
        assert sum(x[2] for x in greedy_tiles(item, text_, 2)) == brute_tiles(item, text_, 2)


def test_repetitive_items_and_texts_and_ids_of_any_type(spark):
    docs = messy(spark, [(1, "la " * 30_000), (2, "la la la"), (3, "one two three four five")])
    bench = spark.createDataFrame([(1, "la " * 5_000), (2, "one two three four"), (None, "la la la la la")], "item_id smallint, text string")
    got = sorted((r["doc_id"], r["item_id"] or 0) for r in contaminated(docs, bench).collect())
    assert got == [(1, 0), (1, 1), (3, 2)]
    dates = bench.withColumn("item_id", F.to_date(F.lit("2024-01-01")))
    assert contaminated(docs, dates).count() == 3

"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits.  Documents and benchmark items meet on shared seeds, the
hashes of ``min_match`` words in a row.  For each document and item that share any, greedy string tiling
marks the longest common run of unmarked words again and again (found by running Karp-Rabin with a
search length that halves), until no run of ``min_match`` words is left.  The share of the item's words
under tiles is its coverage; tiles may lie in any order, so reordered passages are caught.

Scale: documents are read once and never shuffled.  The benchmark is the stated query set: it goes to the tasks in
blocks of at most about ``BLOCK_BYTES`` (dealt by a hash of the item, one pass over the documents per block), so the
broadcast is bounded however large the benchmark is.
"""

from __future__ import annotations

import heapq
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from geoindicators.llm.common import numbered, without
from geoindicators.llm.tokens import NOT_WORD, U, mix, split_words, text_chunks

MIN_MATCH = 4
MIN_COVERAGE = 0.5
BLOCK_BYTES = 8 << 20
_BASE, _MOD = 1_000_003, (1 << 61) - 1
FIRST_SEARCH = 32


def _windows(words: list[int], free: list[bool], s: int):
    """(start, Karp-Rabin hash) of every run of ``s`` words that are all free; a break restarts the window."""
    top = pow(_BASE, s - 1, _MOD)
    h, size = 0, 0
    for i, (w, ok) in enumerate(zip(words, free, strict=True)):
        if not ok:
            h, size = 0, 0
            continue
        if size == s:
            h = (h - words[i - s] % _MOD * top) % _MOD
            size -= 1
        h = (h * _BASE + w) % _MOD
        size += 1
        if size == s:
            yield i - s + 1, h


def _runs(free: list[bool]) -> list[int]:
    """Free words in a row from each place on."""
    out = [0] * (len(free) + 1)
    for i in range(len(free) - 1, -1, -1):
        out[i] = out[i + 1] + 1 if free[i] else 0
    return out


def _common(item: list[int], text: list[int], i: int, t: int, most: int) -> int:
    """Equal words from both places on, ``most`` at most; slices of doubling and then halving length are compared."""
    n, step = 0, 8
    while n < most:
        step = min(step, most - n)
        if item[i + n:i + n + step] == text[t + n:t + n + step]:
            n, step = n + step, 2 * step
        elif step == 1:
            break
        else:
            step //= 2
            while step > 1 and item[i + n:i + n + step] != text[t + n:t + n + step]:
                step //= 2
    return n


def greedy_tiles(item: list[int], text: list[int], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in text, length), longest first; negative words in ``text`` never match.

    Only maximal matches are collected: one that lies within a match starting a word earlier is that match's part, and parts come
    back when a longer tile cuts it.  A match over twice the search length raises that length at once.
    """
    free_i, free_t = [True] * len(item), [w >= 0 for w in text]
    tiles, s = [], max(min_match, min(FIRST_SEARCH, len(item)))
    while True:
        places: dict[int, list[int]] = {}
        for i, h in _windows(item, free_i, s):
            places.setdefault(h, []).append(i)
        found, longest = [], 0
        if places:
            run_i, run_t = _runs(free_i), _runs(free_t)
            for t, h in _windows(text, free_t, s):
                before = text[t - 1] if t and free_t[t - 1] else None
                for i in places.get(h, ()):
                    if before is not None and i and free_i[i - 1] and item[i - 1] == before:
                        continue
                    n = _common(item, text, i, t, min(run_i[i], run_t[t]))
                    if n >= s:
                        found.append((-n, i, t))
                        longest = max(longest, n)
                if longest > 2 * s:
                    break
        if longest > 2 * s:
            s = longest
            continue
        heapq.heapify(found)
        while found:
            n, i, t = heapq.heappop(found)
            free = [a and b for a, b in zip(free_i[i:i - n], free_t[t:t - n], strict=True)]
            if all(free):
                free_i[i:i - n] = [False] * -n
                free_t[t:t - n] = [False] * -n
                tiles.append((i, t, -n))
                continue
            # a longer tile cut this match short: its free parts take their place in the queue
            start = 0
            for ok, run in groupby(free):
                size = len(list(run))
                if ok and size >= s:
                    heapq.heappush(found, (-size, i + start, t + start))
                start += size
        if s == min_match:
            return sorted(tiles, key=lambda x: -x[2])
        s = max(min_match, s // 2)


class _Index:
    """Items of a block: their words, and the sorted seeds of all with the item and the places in it of each."""

    def __init__(self, items: list[tuple], min_match: int):
        kept = [(i, t) for i, t in items if t]
        data = pa.array([t for _, t in kept], pa.large_string())
        self.ids, self.words, seeds, owner, place = [i for i, _ in kept], [], [], [], []
        self.length, self.min_match = [], []
        for first, rows, chunk, offsets in text_chunks(data):
            w = split_words(chunk, offsets, NOT_WORD)
            at = w.first()
            for r in range(rows):
                own = w.hash[at[r]:at[r + 1]] >> U(2)
                self.words.append(own.astype(np.int64).tolist())
                k = min(min_match, len(own))
                self.length.append(len(own))
                self.min_match.append(k)
                if k:
                    s = seed_hash(own, k)
                    seeds.append(s)
                    owner.append(np.full(len(s), first + r))
                    place.append(np.arange(len(s)))
        self.sizes = sorted(set(self.min_match) - {0})
        seed = np.concatenate(seeds) if seeds else np.zeros(0, dtype=U)
        owner = np.concatenate(owner) if owner else np.zeros(0, int)
        order = np.lexsort((owner, seed))
        seed, owner = seed[order], owner[order]
        self.place = np.concatenate(place)[order] if place else np.zeros(0, int)
        # an entry per seed and item, with all its places: a seed that an item repeats meets a text's place once
        new = np.r_[True, (seed[1:] != seed[:-1]) | (owner[1:] != owner[:-1])] if len(seed) else np.zeros(0, bool)
        self.low = np.flatnonzero(new)
        self.high = np.r_[self.low[1:], len(seed)] if len(seed) else self.low
        self.seed, self.owner = seed[self.low], owner[self.low]


_STEP = [U(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(1, 64)]


def seed_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k words in a row, the length mixed in."""
    n = len(words) - k + 1
    return mix(sum(words[i:n + i] * _STEP[i] for i in range(k)) ^ U(k)) if n > 0 else np.zeros(0, dtype=U)


def _tile_chunk(index: _Index, data, offsets, min_coverage: float):
    """(row, item, tiles) of the documents of a slice that cover an item."""
    if not index.sizes:
        return
    w = split_words(data, offsets, NOT_WORD)
    own = w.hash >> U(2)
    hits_t, hits_s = [], []
    for k in index.sizes:
        s = seed_hash(own, k)
        whole = w.row[:len(s)] == w.row[k - 1:] if len(s) else np.zeros(0, bool)
        at = np.searchsorted(index.seed, s)
        ok = whole & (at < len(index.seed))
        ok[ok] = index.seed[at[ok]] == s[ok]
        t = np.flatnonzero(ok)
        hits_t.append(t)
        hits_s.append(s[t])
    t, s = np.concatenate(hits_t), np.concatenate(hits_s)
    if not len(t):
        return
    # every (place in text, item) that shares a seed
    low, high = np.searchsorted(index.seed, s, "left"), np.searchsorted(index.seed, s, "right")
    n = high - low
    at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    t, owner = np.repeat(t, n), index.owner[at]
    row = w.row[t]
    order = np.lexsort((t, owner, row))
    t, at, owner, row = t[order], at[order], owner[order], row[order]
    border = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (owner[1:] != owner[:-1])])
    for a, b in zip(border, np.r_[border[1:], len(row)], strict=True):
        item, size = owner[a], index.min_match[owner[a]]
        # tiles lie within shared seeds: a bound from above, and all the text that matters
        covered = np.zeros(index.length[item], dtype=bool)
        for e in np.unique(at[a:b]):
            here = index.place[index.low[e]:index.high[e]]
            for i in range(size):
                covered[here + i] = True
        if covered.sum() < min_coverage * len(covered):
            continue
        places = np.unique((t[a:b][:, None] + np.arange(size)).ravel())
        gap = np.flatnonzero(np.diff(places) > 1) + 1
        words = np.insert(own[places].astype(np.int64), gap, -1).tolist()
        tiles = greedy_tiles(index.words[item], words, size)
        if sum(x[2] for x in tiles) >= min_coverage * len(covered):
            yield row[a], item, tiles


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH,
                 min_coverage: float = MIN_COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and benchmark item whose words the document covers to ``min_coverage`` or more.

    Columns id_col, item_id, coverage, n_tiles, longest_tile (words).  Null and empty documents and items match
    nothing; an item of fewer than ``min_match`` words must occur whole.  Repeated documents or items are
    judged each; an empty table on either side gives no rows; other columns are ignored.  Ids are of any type.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).alias("item_id"), F.lower(F.col(item_text)).alias("t")).where("t is not null and t != ''")
    mass = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-mass // block_bytes)
    own = docs.select(F.col(id_col), F.lower(F.col(text_col)).alias("_t"))
    id_type, item_type = own.schema[id_col].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    item_arrow = to_arrow_type(items.schema["item_id"].dataType)
    schema = f"`{id_col}` {id_type}, item_id {item_type}, coverage double, n_tiles int, longest_tile int"

    def tiled(block: int) -> DataFrame:
        rows = items.where(F.pmod(F.xxhash64("t", F.col("item_id").cast("string")), F.lit(blocks)) == block).collect()
        rows = sorted(((r["item_id"], r["t"]) for r in rows), key=lambda r: (r[0] is None, str(r[0]), r[1]))
        shared = spark.sparkContext.broadcast(_Index(rows, min_match))

        def tile(batches):
            index = shared.value
            for b in batches:
                at, item, coverage, count, longest = [], [], [], [], []
                for first, _, data, offsets in text_chunks(b.column("_t")):
                    for r, i, tiles in _tile_chunk(index, data, offsets, min_coverage):
                        at.append(first + int(r))
                        item.append(index.ids[i])
                        coverage.append(sum(x[2] for x in tiles) / index.length[i])
                        count.append(len(tiles))
                        longest.append(tiles[0][2])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at, pa.int64())), pa.array(item, item_arrow), pa.array(coverage, pa.float64()), pa.array(count, pa.int32()), pa.array(longest, pa.int32())],
                    names=[id_col, "item_id", "coverage", "n_tiles", "longest_tile"])

        return own.mapInArrow(tile, schema)

    if not blocks:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [tiled(i) for i in range(blocks)])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The documents that cover no benchmark item, row by row: ids may repeat or be null."""
    rows = numbered(docs)
    own = rows.select("_rid", F.col("_doc")[kw.pop("text_col", "text")].alias("text"))
    return without(rows, contaminated(own, benchmark, "_rid", **kw).select("_rid").distinct())

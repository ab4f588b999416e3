"""Substring dedup by paragraphs: MinHash banding, exact Jaccard verification, removal by components.

A paragraph is a line of ``MIN_WORDS`` words or more.  It is signed by the min-hashes of its five-word shingles in
``BANDS`` bands of ``ROWS``; at a Jaccard similarity of 0.8 a pair misses all bands with probability 0.003.  Colliding
paragraphs are verified exactly, and the components of the verified links are the classes (``lsh``).

Passages are also set into running text, where no line border tells them, and across line ends.  So the words of a
document, line ends as white space, also give pieces of ``PIECE`` words, each beginning at an anchor chosen by
winnowing: of every ``WINDOW`` places in a row the one with the least hash of three words.  Anchors depend on the words
around them only, and any passage of PIECE + WINDOW - 1 = 51 words holds a whole piece, so it gives that piece
wherever it stands.

Documents of 51 words or more with the same words are told first: all but the first are removed whole and give no units.
Pieces that two documents or more have are seeds.  Shared text is told from a seed to the next, and word by word only
where such a stretch ends:

* A chunk is the words from a seed to the end of the next one, at most WINDOW words on; equal chunks form a class.
* Where the seeds of a class go on differently, to the right or to the left, each is followed over the WINDOW - 1 words
  beyond it.  Seeds with all of these words alike need it once, for the first of them.  How far a seed's words are an
  earlier document's, or any other's, is told word by word with the seeds of a class side by side in one task, many classes at a time.
* A class of more than ``CROWD`` seeds is not put into one task: its seeds are sorted by the words beyond them and dealt in ranges, as
  those alike so far then stand in a row.  Seeds as far alike as the first or last of a range may have others in other ranges; what
  each range knows of these, a row a word, is put together and handed back.
* Classes of few seeds go a share of the classes after the other, which bounds what lies on disk at a time.

In a shared passage of 51 words or more both documents have the same seeds from the first to the last that a whole
window of the passage chooses, and both ends are at most WINDOW - 1 words beyond these, so it is covered from the first
word to the last, whichever documents share it.

A class counts if it occurs in two documents or more.  Its first place (least document, then position) stays, the
others are to be removed; overlapping places in a document are joined into spans.

Scale: a unit is one narrow row; counting and joining go by its 64-bit content hash with map-side aggregation, so a line
that a third of the documents share is one row per task, and its hand-out a skewed join for AQE.  Texts travel only for
one representative of each colliding paragraph, and for documents with a seed.  A shared text costs about one row every
13 words, its ends one row each.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.common import parts, table, with_row_id
from geoindicators.llm.lsh import FINE_SETS, Profiles, fine_sets, near_classes
from geoindicators.llm.tokens import U, Words, mix, shingles, split_words, text_chunks

SHINGLE = 5
MIN_WORDS = 20
THRESHOLD = 0.8
BANDS, ROWS = 8, 3
FINE_BANDS = 6
PIECE = 20
WINDOW = 32  # PIECE + WINDOW - 1 = 51: a passage of 51 words shares a piece for certain
REACH = WINDOW - 1
SHARES = 4  # of the classes, one after the other where seeds are followed word by word
CROWD = 1024  # seeds of a class that are followed side by side in one task at most
_CHUNK = 1 << 20
_ODD, _EVEN_OUT = U(0x9E3779B97F4A7C15), U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))  # their product is 1
_STEP = [U(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(1, 64)]


def _paragraphs(words: Words, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, after the last word) of each line of MIN_WORDS words or more."""
    if not len(words.row):
        return np.zeros(0, int), np.zeros(0, int)
    line = np.searchsorted(np.flatnonzero(data == 10), words.start)
    border = np.flatnonzero((np.diff(line) != 0) | (np.diff(words.row) != 0)) + 1
    first, last = np.r_[0, border], np.r_[border, len(line)]
    long = last - first >= MIN_WORDS
    return first[long], last[long]


def _least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value in each run [first, last)."""
    at = np.stack([first, last], axis=1).ravel()
    return np.minimum.reduceat(np.append(values, values[-1:]), at)[::2]


def _bands(key: np.ndarray, first: np.ndarray, last: np.ndarray, samples: range, rows: int) -> np.ndarray:
    out = []
    for b in range(samples.start, samples.stop, rows):
        band = np.full(len(first), b + 1, dtype=U)
        for s in range(b, b + rows):
            band = mix(band * U(31) + _least(mix(key ^ U((s + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)), first, last))
        out.append(band.view(np.int64))
    return np.stack(out, axis=1)


def _content(word_hash: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of the words of each run, order included: a difference of running sums, turned back by the power of its first word."""
    power, back = (np.cumprod(np.r_[U(1), np.full(len(word_hash), x, dtype=U)], dtype=U) for x in (_ODD, _EVEN_OUT))
    sums = np.r_[U(0), np.cumsum(word_hash * power[:-1], dtype=U)]
    return mix((sums[last] - sums[first]) * back[first] ^ (last - first).astype(U))


def _anchors(words: Words, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """First words of the pieces, by winnowing: the place with the least three-word hash of each ``WINDOW`` places in a row.

    Of equal ones in a window the leftmost counts, so later windows never choose earlier places.
    """
    h = words.hash
    long = last - first >= WINDOW + PIECE - 1
    if not long.any():
        return np.zeros(0, int)
    least = mix(h * _STEP[0] + np.r_[h[1:], h[:1]] * _STEP[1] + np.r_[h[2:], h[:2]] * _STEP[2])
    place, wide = np.arange(len(h)), 1
    while wide < WINDOW:  # the least of windows of ever more places, by the place they begin at
        step = min(wide, WINDOW - wide)
        later = least[step:] < least[:-step]
        place, least = np.where(later, place[step:], place[:-step]), np.minimum(least[step:], least[:-step])
        wide += step
    begin = first[long]
    size = last[long] - PIECE + 1 - WINDOW + 1 - begin
    at = place[np.arange(int(size.sum())) + np.repeat(begin - np.r_[0, np.cumsum(size)[:-1]], size)]
    return at[np.r_[True, at[1:] != at[:-1]]]


def _units(batches):
    """_rid, start and end (bytes), n_words, piece, cls (content hash), keys (band keys; empty for pieces)."""
    for b in batches:
        rid = b.column("_rid").to_numpy()
        for at, _, data, offsets in text_chunks(b.column("_t"), _CHUNK):
            w = split_words(data, offsets)
            first, last = _paragraphs(w, data)
            place = _shingle_keys(w)
            if len(first):
                keys = _bands(place, first, last - SHINGLE + 1, range(BANDS * ROWS), ROWS)
                yield _batch(rid, at, w, offsets, first, last, _content(w.hash, first, last), keys, False)
            border = w.first()
            a = _anchors(w, border[:-1], border[1:])
            if len(a):
                yield _batch(rid, at, w, offsets, a, a + PIECE, _run_hash(place, a), np.zeros((len(a), 0), np.int64), True)


def _run_hash(place: np.ndarray, a: np.ndarray, turn: int = 0) -> np.ndarray:
    """64-bit hash of the PIECE words from each place ``a``; another one for each ``turn``."""
    return mix(sum(place[a + i] * _STEP[i + 5 + turn] for i in range(0, PIECE, SHINGLE)) ^ U(PIECE))


def _wholes(batches):
    """_rid, _id, start, end (bytes), cls, more (content hashes) of the words of each document of PIECE + REACH words or more."""
    for b in batches:
        for at, _, data, offsets in text_chunks(b.column("_t"), _CHUNK):
            w = split_words(data, offsets)
            border = w.first()
            own = np.flatnonzero(np.diff(border) >= PIECE + REACH)
            if not len(own):
                continue
            a, z = border[own], border[own + 1]
            take = pa.array(at + own)
            yield pa.RecordBatch.from_arrays(
                [b.column("_rid").take(take), b.column("_id").take(take), pa.array((w.start[a] - offsets[own]).astype(np.int64)),
                 pa.array((w.end[z - 1] - offsets[own]).astype(np.int64)), pa.array(_content(w.hash, a, z).view(np.int64)),
                 pa.array(_content(mix(w.hash ^ _STEP[3]), a, z).view(np.int64))], names=["_rid", "_id", "start", "end", "cls", "more"])


def _marks(batches):
    """One row per seed; ``at``: first bytes of a document's seeds.

    chunk: hash of the words up to the end of the next seed (null: none in WINDOW words), chunk_end; prev: that of the chunk that ends
    here; right, right_end: hash of the seed and the REACH words after it (as far as there are any), left, left_start: before it.
    """
    for b in batches:
        seeds = b.column("at")
        for at, rows, data, offsets in text_chunks(b.column("_t"), _CHUNK):
            w = split_words(data, offsets)
            border = w.first()
            a = np.sort(_word_at(w, offsets, seeds.slice(at, rows)))
            if not len(a):
                continue
            line = w.row[a]
            low, high = border[line], border[line + 1]
            after = np.r_[a[1:], a[-1:]]
            linked = (np.r_[line[1:], -1] == line) & (after - a <= WINDOW)
            end = np.where(linked, after, a) + PIECE
            chunk, right_end, left_start = _content(w.hash, a, end), np.minimum(a + PIECE + REACH, high), np.maximum(a - REACH, low)
            before = np.r_[False, linked[:-1]]
            take = pa.array(at + line)
            byte = lambda x: pa.array((x - offsets[line]).astype(np.int64))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [b.column("_rid").take(take), b.column("_id").take(take), byte(w.start[a]), byte(w.end[a + PIECE - 1]), *_seed_keys(w, a),
                 pa.array(chunk.view(np.int64), mask=~linked), byte(w.end[end - 1]), pa.array(np.r_[chunk[:1], chunk[:-1]].view(np.int64), mask=~before),
                 pa.array(_content(w.hash, a, right_end).view(np.int64)), byte(w.end[right_end - 1]),
                 pa.array(_content(w.hash, left_start, a + PIECE).view(np.int64)), byte(w.start[left_start])], names=_MARK)


_MARK = ["_rid", "_id", "start", "end", "cls", "more", "chunk", "chunk_end", "prev", "right", "right_end", "left", "left_start"]


def _word_at(w: Words, offsets: np.ndarray, starts: pa.ListArray) -> np.ndarray:
    """The words at the given first bytes of each row."""
    row = np.repeat(np.arange(len(starts)), np.diff(starts.offsets.to_numpy()))
    return np.searchsorted(w.start, starts.flatten().to_numpy() + offsets[row])


def _seed_keys(w: Words, a: np.ndarray) -> list[pa.Array]:
    """Two independent hashes of the pieces at ``a``."""
    more = _run_hash(_shingle_keys(w, PIECE), a, 1) >> U(32)
    return [pa.array(_run_hash(_shingle_keys(w), a).view(np.int64)), pa.array(more.astype(np.uint32).view(np.int32))]


def _arms(batches):
    """_rid, _id, start, end, cls, more of seeds and, for one side of each, ext: hashes of the 1, 2, ... words beyond it, far: the byte
    where these end (to the left: begin).  ``at``, ``side``, ``wide``, ``crowd``: the seeds' first bytes, whether to the right, passed on."""
    step = np.arange(REACH)
    for b in batches:
        seeds = b.column("at")
        for at, rows, data, offsets in text_chunks(b.column("_t"), _CHUNK):
            w = split_words(data, offsets)
            border = w.first()
            own = seeds.slice(at, rows)
            a = _word_at(w, offsets, own)
            if not len(a):
                continue
            side, wide, crowd = (b.column(c).slice(at, rows).flatten() for c in ("side", "wide", "crowd"))
            to_right = side.to_numpy(zero_copy_only=False)[:, None]
            line = w.row[a]
            word = np.where(to_right, a[:, None] + PIECE + step, a[:, None] - 1 - step)
            inside = np.where(to_right, word < border[line + 1][:, None], word >= border[line][:, None])
            word = np.where(inside, word, 0)
            ext = mix(np.cumsum(w.hash[word] * np.array(_STEP[:REACH], U), axis=1, dtype=U) ^ step.astype(U)) >> U(32)
            far = np.where(to_right, w.end[word], w.start[word]) - offsets[line][:, None]
            borders = pa.array(np.r_[0, np.cumsum(inside.sum(axis=1))], pa.int32())
            take = pa.array(at + line)
            yield pa.RecordBatch.from_arrays(
                [b.column("_rid").take(take), b.column("_id").take(take), pa.array((w.start[a] - offsets[line]).astype(np.int64)),
                 pa.array((w.end[a + PIECE - 1] - offsets[line]).astype(np.int64)), *_seed_keys(w, a), side, wide, crowd,
                 pa.ListArray.from_arrays(borders, pa.array(ext[inside].astype(np.uint32).view(np.int32))),
                 pa.ListArray.from_arrays(borders, pa.array(far[inside].astype(np.int32)))], names=_ARM)


_ARM = ["_rid", "_id", "start", "end", "cls", "more", "side", "wide", "crowd", "ext", "far"]


def _shingle_keys(w: Words, turn: int = 0) -> np.ndarray:
    """Shingle hash at each word (runs over borders are never asked for); another one for each ``turn``."""
    n = len(w.hash) - SHINGLE + 1
    out = np.zeros(len(w.hash), dtype=U)
    if n > 0:
        out[:n] = mix(sum(w.hash[i:n + i] * _STEP[i + turn] for i in range(SHINGLE)))
    return out


def _batch(rid, at, w: Words, offsets, first, last, content, keys, piece: bool) -> pa.RecordBatch:
    row = w.row[first]
    n = keys.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1) * n, pa.int32()), pa.array(keys.ravel(), pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(rid[at + row]), pa.array((w.start[first] - offsets[row]).astype(np.int64)), pa.array((w.end[last - 1] - offsets[row]).astype(np.int64)),
         pa.array((last - first).astype(np.int32)), pa.array(np.full(len(first), piece)), pa.array(content.view(np.int64)), lists],
        names=["_rid", "start", "end", "n_words", "piece", "cls", "keys"])


def unpack(profile: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A profile of sorted distinct 64-bit shingles, each of weight 1."""
    key = np.frombuffer(profile, "<u8")
    return key, np.ones(len(key))


def _profiles(batches):
    """cls, profile, fine of paragraph texts; a text whose content hash isn't cls is left out."""
    for b in batches:
        cls = b.column("cls").to_numpy()
        for at, rows, data, offsets in text_chunks(b.column("_p"), _CHUNK):
            w = split_words(data, offsets)
            first = w.first()
            own = np.flatnonzero(np.diff(first) >= MIN_WORDS)
            if not len(own):
                continue
            a, z = first[own], first[own + 1]
            same = _content(w.hash, a, z).view(np.int64) == cls[at + own]
            own, a, z = own[same], a[same], z[same]
            if not len(own):
                continue
            key = _shingle_keys(w)
            fine = _bands(key, a, z - SHINGLE + 1, range(BANDS * ROWS, (BANDS + FINE_SETS * FINE_BANDS) * ROWS), ROWS)
            blobs = [np.unique(key[i:j - SHINGLE + 1]).astype("<u8").tobytes() for i, j in zip(a, z, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[at + own]), pa.array(blobs, pa.binary()), fine_sets(fine)], names=["cls", "profile", "fine"])


def _new(b: pa.RecordBatch, *key: str) -> np.ndarray:
    """Whether a row's key is another than that of the row before it; the first row's is."""
    return np.r_[True, np.any([(x := b.column(c).to_numpy(zero_copy_only=False))[1:] != x[:-1] for c in key], axis=0)]


def _whole_groups(batches, *key: str):
    """The rows of batches sorted by the key, those of one key in one batch; holds one group of rows beside a batch."""
    rest = []
    for b in batches:
        if not b.num_rows:
            continue
        b = pa.Table.from_batches([*rest, b]).combine_chunks().to_batches()[0]
        last = int(np.flatnonzero(_new(b, *key))[-1])
        if last:
            yield b.slice(0, last)
        rest = [b.slice(last)]
    yield from rest


def _document_spans(batches):
    """Spans of rows (doc_rid, start, end, removed, first_doc_id) sorted by document and place: the overlapping places to be removed
    joined, and what they leave of the first places, joined too.  The leftmost place of a span names the first document."""
    for b in _whole_groups(batches, "doc_rid"):
        gone = b.column("removed").to_numpy(zero_copy_only=False)
        start, end = b.column("start").to_numpy(), b.column("end").to_numpy()
        shift = (np.cumsum(_new(b, "doc_rid")) - 1) * (end.max() + 2)  # so that documents don't touch
        cut, keep = (_joined(at, start[at] + shift[at], end[at] + shift[at]) for at in (np.flatnonzero(gone), np.flatnonzero(~gone)))
        for removed, (at, a, z) in ((True, cut), (False, _without(keep, cut))):
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_rid").take(take), pa.array(a - shift[at]), pa.array(z - shift[at]), pa.array(np.full(len(at), removed)),
                 b.column("first_doc_id").take(take)], names=["doc_rid", "start", "end", "removed", "first_doc_id"])


def _joined(at: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in order as spans: overlapping and touching ones are joined; ``at`` is that of the first."""
    if not len(at):
        return at, start, end
    first = np.flatnonzero(np.r_[True, start[1:] > np.maximum.accumulate(end)[:-1]])
    return at[first], start[first], np.maximum.reduceat(end, first)


def _without(spans: tuple, cuts: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of the spans outside the cuts; both sorted and disjoint."""
    (at, start, end), (_, a, z) = spans, cuts
    low = np.searchsorted(z, start, "right")
    n = np.searchsorted(a, end, "left") - low  # cuts in each span, which leave a part more
    own = np.repeat(np.arange(len(at)), n + 1)
    part = np.arange(len(own)) - np.repeat(np.cumsum(n + 1) - n - 1, n + 1)
    left, right = start[own], end[own]
    after, before = part > 0, part < n[own]
    left[after], right[before] = z[(low[own] + part - 1)[after]], a[(low[own] + part)[before]]
    some = left < right
    return at[own[some]], left[some], right[some]


def _place() -> Column:
    """Places in order: by document, those without an id last, then by position."""
    return F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_rid").alias("rid"), F.col("start").alias("start"))


def _is_first() -> Column:
    return (F.col("_rid") == F.col("f.rid")) & (F.col("start") == F.col("f.start"))


def _firsts(places: DataFrame, *key: str) -> DataFrame:
    """The key and the first place f of the classes that two rows or more have."""
    found = places.groupBy(*key).agg(F.min("_rid").alias("a"), F.max("_rid").alias("b"), F.min(_place()).alias("f")).where("a != b")
    return table(found.drop("a", "b"), "class-firsts")


def _verdicts(places: DataFrame, far: bool = False) -> DataFrame:
    """Places with the first place f of their class: doc_rid, start, end, first_doc_id, removed; ``far``: stretched to that byte."""
    start, end = (F.least("start", "far"), F.greatest("end", "far")) if far else (F.col("start"), F.col("end"))
    return places.select(F.col("_rid").alias("doc_rid"), start.alias("start"), end.alias("end"), F.col("f.id").cast("string").alias("first_doc_id"),
                         (~_is_first()).alias("removed"))


def _judged(places: DataFrame, firsts: DataFrame, *key: str) -> DataFrame:
    return _verdicts(places.join(firsts, list(key)))


def _shared_runs(own: DataFrame, pieces: DataFrame) -> DataFrame:
    """Verdicts on the words that documents share at and around seeds; pieces: (_rid, start, cls)."""
    id_type = own.schema["_id"].dataType.simpleString()
    seeds = table(pieces.groupBy("cls").agg(F.min("_rid").alias("a"), F.max("_rid").alias("b")).where("a != b").select("cls"), "seeds")
    seeded = table(pieces.join(seeds, "cls").groupBy("_rid").agg(F.collect_list("start").alias("at")), "seeded")
    schema = (f"_rid bigint, _id {id_type}, start bigint, end bigint, cls bigint, more int, chunk bigint, chunk_end bigint, prev bigint, "
              "right bigint, right_end bigint, left bigint, left_start bigint")
    texts = table(own.join(seeded, "_rid").select("_rid", "_id", "_t", "at"), "seeded-texts")  # read again for the arms
    marks = table(texts.mapInArrow(_marks, schema), "marks")

    key = ["cls", "more"]
    parted = lambda c: (F.min(c) != F.max(c)) | (F.count_if(F.col(c).isNull()) > 0)
    same = marks.groupBy(*key).agg(F.min("_rid").alias("a"), F.max("_rid").alias("b"), F.min(_place()).alias("f"),
                                   parted("chunk").alias("parts_right"), parted("prev").alias("parts_left"), (F.count(F.lit(1)) > CROWD).alias("crowd"))
    same = table(same.where("a != b").drop("a", "b"), "seed-firsts")
    chunks = marks.where("chunk is not null").select("_rid", "_id", "start", F.col("chunk_end").alias("end"), "cls", "chunk")
    out = [_judged(marks.select("_rid", "start", "end", *key), same, *key), _judged(chunks, _firsts(chunks, "cls", "chunk"), "cls", "chunk")]

    # seeds whose classes go on differently: alike in all words in reach, or to be followed
    each = F.explode(F.array(F.struct(F.lit(True).alias("side"), F.col("right").alias("ctx"), F.col("right_end").alias("far"), F.col("parts_right").alias("on")),
                             F.struct(F.lit(False).alias("side"), F.col("left").alias("ctx"), F.col("left_start").alias("far"), F.col("parts_left").alias("on"))))
    sides = marks.join(same.where("parts_right or parts_left").drop("f"), key).select("_rid", "_id", "start", "end", *key, "crowd", each.alias("x"))
    sides = table(sides.where("x.on").select("_rid", "_id", "start", "end", *key, "crowd", "x.side", "x.ctx", "x.far"), "sides")
    alike = sides.join(_firsts(sides, *key, "side", "ctx"), [*key, "side", "ctx"], "left")
    out.append(_verdicts(alike.where("f is not null"), far=True))
    follow = alike.where(F.col("f").isNull() | _is_first()).groupBy("_rid").agg(
        F.collect_list(F.struct("start", "side", F.col("f").isNotNull().alias("wide"), "crowd")).alias("x"))
    follow = texts.join(follow, "_rid").select("_rid", "_id", "_t", F.col("x.start").alias("at"), *(F.col(f"x.{c}").alias(c) for c in ("side", "wide", "crowd")))
    arms = follow.mapInArrow(_arms, f"_rid bigint, _id {id_type}, start bigint, end bigint, cls bigint, more int, side boolean, wide boolean, "
                                    "crowd boolean, ext array<int>, far array<int>").where("size(ext) > 0")
    # seeds of different classes have nothing to do with each other, so they go share by share of the classes
    share = F.when(F.col("crowd"), -1).otherwise(F.pmod(F.xxhash64(F.lit(2), "cls"), F.lit(SHARES)).cast("int"))
    arms = table(arms.withColumn("share", share), "arms", "crowd", "share")
    for found in [_followed(arms.where("crowd"))] + [_followed(arms.where(f"not crowd and share = {i}")) for i in range(SHARES)]:
        for c in ("shared", "earlier"):
            have = found.where(F.col(c).isNotNull()).select("_rid", "start", f"{c}.far", f"{c}.end", f"{c}.f")
            out.append(_verdicts(have, far=True).where("removed" if c == "earlier" else "not removed"))
    return reduce(DataFrame.unionByName, out)


def _followed(rows: DataFrame) -> DataFrame:
    """(_rid, start, side, shared, earlier): the most words n beyond a seed that another document has too, and that an earlier place
    has; each with far, end and the first place f, or null.  rows: seeds (``_arms``) and, for 1, 2, ... words beyond them, their hashes
    ext, to far."""
    id_type = rows.schema["_id"].dataType.simpleString()
    place = f"struct<last: boolean, id: {id_type}, rid: bigint, start: bigint>"
    best = f"struct<n: int, far: int, end: bigint, f: {place}>"
    schema = f"_rid bigint, start bigint, side boolean, shared {best}, earlier {best}"
    rows = rows.where("size(ext) > 0")
    key = ["cls", "more", "side"]
    few, crowds = rows.where("not crowd"), rows.where("crowd")
    dealt = few.repartition(parts(rows.sparkSession), *key).sortWithinPartitions(*key, F.col("_id").isNull(), "_id", "_rid", "start")
    found = dealt.mapInArrow(_side_by_side, schema)
    if not crowds.isEmpty():
        found = found.unionByName(_followed_in_ranges(crowds, schema, place))
    return table(found, "followed")


def _followed_in_ranges(rows: DataFrame, schema: str, place: str) -> DataFrame:
    """``_followed`` for classes of any size: sorted by their words, those alike so far stand in a row, so a task gets a range of them.

    Only places that are as far alike as the first or the last of a range may have others in other ranges; what a range knows
    of these is a row for each of their words, put together over all ranges and handed back.
    """
    key = ["cls", "more", "side"]
    dealt = rows.repartitionByRange(parts(rows.sparkSession), *key, "ext").sortWithinPartitions(*key, "ext")
    dealt = dealt.select("_rid", "_id", "start", "end", *key, "wide", "ext", "far", F.spark_partition_id().alias("range"))
    found = table(dealt.mapInArrow(_side_by_side_in_range, f"{schema}, border bigint, n int, end bigint, far array<int>, cls bigint, more int, "
                                                           f"ext int, a bigint, b bigint, w boolean, f {place}"), "ranges")
    words = found.where("f is not null").select("border", *key, "n", "ext", "a", "b", "w", "f")
    key = [*key, "n", "ext"]
    # one of several places alike stands for all ("wide"): what it has is shared, even if no other seed is followed that far
    same = words.groupBy(*key).agg(F.min("a").alias("a"), F.max("b").alias("b"), F.max("w").alias("w"), F.min("f").alias("f"))
    same = table(same.where("a != b or w").drop("a", "b", "w"), "border-firsts")
    known = words.select("border", *key).join(same, key).groupBy("border").agg(F.sort_array(F.collect_list(F.struct("n", "f"))).alias("known"))

    def best(c: str, which) -> Column:
        fit = F.filter("known", lambda x: (x["n"] <= F.col("n")) & which(x["f"]))
        x = F.get(fit, F.size(fit) - 1)
        return F.coalesce(c, F.when(x.isNotNull(), F.struct(x["n"].alias("n"), F.get("far", x["n"] - 1).alias("far"), F.col("end"), x["f"].alias("f")))).alias(c)

    own = found.where("f is null")
    rest = own.where("border is not null").join(table(known, "borders"), "border", "left").select(
        "_rid", "start", "side", best("shared", lambda f: F.lit(True)), best("earlier", lambda f: (f["rid"] != F.col("_rid")) | (f["start"] != F.col("start"))))
    return own.where("border is null").select(*rest.columns).unionByName(rest)


def _side_by_side(batches):
    """``_followed`` for classes of few seeds, sorted by class, side and place: of all that are alike so far, the next word tells who still is."""
    for b in _whole_groups(batches, "cls", "more", "side"):
        rid, wide = b.column("_rid").to_numpy(), b.column("wide").to_numpy(zero_copy_only=False)
        border = b.column("ext").offsets.to_numpy()
        begin, size = border[:-1], np.diff(border)
        word = b.column("ext").values.to_numpy().view(np.uint32)
        group = np.cumsum(_new(b, "cls", "more", "side")).astype(U)
        most, first = np.zeros((2, len(rid)), int), np.zeros((2, len(rid)), int)  # shared, earlier
        n, live = 0, np.arange(len(rid))
        while len(live := live[size[live] > n]):
            alike = group[live] << U(32) | word[begin[live] + n]
            order = np.argsort(alike, kind="stable")  # so each group still begins with its first place
            live, alike = live[order], alike[order]
            new = np.r_[True, alike[1:] != alike[:-1]]
            at, own = np.flatnonzero(new), np.cumsum(new) - 1
            several = (np.minimum.reduceat(rid[live], at) != np.maximum.reduceat(rid[live], at)) | np.logical_or.reduceat(wide[live], at)
            f, on = live[at][own], several[own]
            n += 1
            group[live] = own
            live, f = live[on], f[on]
            for i, those in enumerate((live == live, live != f)):
                most[i, live[those]], first[i, live[those]] = n, f[those]
            live = np.sort(live)
        own = np.flatnonzero(most[0])
        yield pa.RecordBatch.from_arrays(
            [b.column(c).take(pa.array(own)) for c in ("_rid", "start", "side")] + [_best(b, k, f, own) for k, f in zip(most, first, strict=True)],
            names=["_rid", "start", "side", "shared", "earlier"])


def _places(b: pa.RecordBatch, at: np.ndarray) -> pa.StructArray:
    """``_place`` of some rows."""
    rid, ids, start = (b.column(c).take(pa.array(at)) for c in ("_rid", "_id", "start"))
    return pa.StructArray.from_arrays([ids.is_null(), ids, rid, start], names=["last", "id", "rid", "start"])


def _best(b: pa.RecordBatch, most: np.ndarray, first: np.ndarray, own: np.ndarray) -> pa.StructArray:
    """The most words beyond some rows with far, end and the first place that has them; null for none."""
    k, far = most[own], b.column("far")
    values = [pa.array(k.astype(np.int32)), far.values.take(pa.array(far.offsets.to_numpy()[own] + np.maximum(k, 1) - 1)), b.column("end").take(pa.array(own)),
              _places(b, first[own])]
    return pa.StructArray.from_arrays(values, names=["n", "far", "end", "f"], mask=pa.array(k == 0))


def _side_by_side_in_range(batches):
    """As ``_side_by_side``, for a range of rows sorted by class, side and words.  Beside the verdicts, two kinds of rows more: what the range knows
    of the places that are alike with its first or last one (``border``) in n words (a, b: least and greatest document, w: wide, f: first place);
    and the rows that may need to hear of it, with the border that they share the most words n with."""
    key = ["cls", "more", "side"]
    ahead, is_first = None, True
    for b in _with_end(_whole_groups(batches, *key)):
        b, ahead = ahead, b
        if b is None:
            continue
        yield from _in_range(b, is_first, ahead is _END)
        is_first = False


_END = object()


def _with_end(items):
    yield from items
    yield _END


def _in_range(b: pa.RecordBatch, is_first: bool, is_last: bool):
    key = ["cls", "more", "side"]
    rid, wide, start = b.column("_rid").to_numpy(), b.column("wide").to_numpy(zero_copy_only=False), b.column("start").to_numpy()
    border = b.column("ext").offsets.to_numpy()
    begin, size = border[:-1], np.diff(border)
    word = b.column("ext").values.to_numpy().view(np.uint32)
    group = np.cumsum(_new(b, *key)).astype(U)
    order = np.lexsort((start, rid, pc.rank(b.column("_id"), "ascending", null_placement="at_end", tiebreaker="dense").to_numpy()))
    rank = np.empty(len(order), int)
    rank[order] = np.arange(len(order))

    # places alike with the first or last one of the range
    open_to, at_border = np.zeros((2, len(rid)), int)
    told = []
    for last, i in ((0, 0),) * is_first + ((1, len(rid) - 1),) * is_last:
        alike = np.flatnonzero(group == group[i])
        for n in range(size[i]):
            alike = alike[size[alike] > n]
            alike = alike[word[begin[alike] + n] == word[begin[i] + n]]
            further = alike[open_to[alike] <= n]
            open_to[further], at_border[further] = n + 1, last
            told.append((last, i, n, rid[alike].min(), rid[alike].max(), bool(wide[alike].any()), order[rank[alike].min()]))

    most, first = np.zeros((2, len(rid)), int), np.zeros((2, len(rid)), int)  # shared, earlier
    n, live = 0, np.arange(len(rid))
    while len(live := live[size[live] > n]):
        alike = group[live] << U(32) | word[begin[live] + n]
        new = np.r_[True, alike[1:] != alike[:-1]]
        at, own = np.flatnonzero(new), np.cumsum(new) - 1
        several = (np.minimum.reduceat(rid[live], at) != np.maximum.reduceat(rid[live], at)) | np.logical_or.reduceat(wide[live], at)
        f, on = order[np.minimum.reduceat(rank[live], at)][own], several[own]
        group[live] = own
        known = open_to[live] <= n  # all places alike are here
        n += 1
        for i, those in enumerate((on & known, on & known & (live != f))):
            most[i, live[those]], first[i, live[those]] = n, f[those]
        live = live[on | ~known]

    asks = (open_to > 0) & (most[1] == 0)
    own = np.flatnonzero(asks | (most[0] > 0))
    asks, part, take = asks[own], b.column("range").to_numpy().astype(np.int64) * 2, pa.array(own)
    length = np.where(asks, open_to[own], 0)
    borders = np.r_[0, np.cumsum(length)]
    at = np.arange(borders[-1]) - np.repeat(borders[:-1], length) + np.repeat(b.column("far").offsets.to_numpy()[own], length)
    place = _places(b, np.zeros(0, int)).type
    yield pa.RecordBatch.from_arrays(
        [*(b.column(c).take(take) for c in ("_rid", "start", "side")), *(_best(b, k, f, own) for k, f in zip(most, first, strict=True)),
         pa.array((part + at_border)[own], mask=~asks), pa.array(length.astype(np.int32)), b.column("end").take(take),
         pa.ListArray.from_arrays(pa.array(borders, pa.int32()), b.column("far").values.take(pa.array(at))), *(pa.nulls(len(own), t) for t in (
             pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), place))], names=_RANGE)
    if told:
        last, i, n, low, high, any_wide, f = map(np.array, zip(*told, strict=True))
        best = _best(b, most[0], first[0], own[:0]).type
        take, none = pa.array(i), lambda t: pa.nulls(len(i), t)
        yield pa.RecordBatch.from_arrays(
            [none(pa.int64()), none(pa.int64()), b.column("side").take(take), none(best), none(best), pa.array(part[i] + last), pa.array((n + 1).astype(np.int32)),
             none(pa.int64()), none(pa.list_(pa.int32())), b.column("cls").take(take), b.column("more").take(take), pa.array(word[begin[i] + n].view(np.int32)),
             pa.array(low), pa.array(high), pa.array(any_wide), _places(b, f)], names=_RANGE)


_RANGE = ["_rid", "start", "side", "shared", "earlier", "border", "n", "end", "far", "cls", "more", "ext", "a", "b", "w", "f"]


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per repeated span: id_col, start, end (bytes of the UTF-8 text, end exclusive), removed, first_doc_id.

    removed: another document (or an earlier place) has the passage first; first_doc_id is that document's id.  Rows
    with removed false are the first places.  Null and empty texts give no units; a
    repeated row is a document of its own; null ids sort last.  An empty table gives no rows; other columns are ignored.
    """
    own = table(with_row_id(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))), "own")  # row ids hold only once written
    id_type = own.schema["_id"].dataType.simpleString()
    wholes = table(own.mapInArrow(_wholes, f"_rid bigint, _id {id_type}, start bigint, end bigint, cls bigint, more bigint"), "wholes")
    wholes = table(_judged(wholes, _firsts(wholes, "cls", "more"), "cls", "more"), "equal-documents")
    fresh = own.join(wholes.where("removed").select(F.col("doc_rid").alias("_rid")), "_rid", "left_anti")
    schema = "_rid bigint, start bigint, end bigint, n_words int, piece boolean, cls bigint, keys array<bigint>"
    units = table(fresh.select("_rid", "_t").mapInArrow(_units, schema), "units")
    ids = own.select("_rid", "_id")
    bands = units.where("not piece").groupBy("cls").agg(F.first("keys").alias("keys"))

    def profile_of(nodes: DataFrame) -> DataFrame:
        where = units.where("not piece").join(nodes, "cls", "left_semi").groupBy("cls").agg(F.min(F.struct("_rid", "start", "end")).alias("w"))
        where = where.select("cls", F.col("w._rid").alias("_rid"), "w.start", "w.end")
        found = own.select("_rid", F.encode("_t", "UTF-8").alias("_b")).join(where, "_rid").select(
            "cls", F.expr("substring(_b, cast(start + 1 as int), cast(end - start as int))").cast("string").alias("_p"))
        made = found.mapInArrow(_profiles, "cls bigint, profile binary, fine array<array<bigint>>")
        return made.groupBy("cls").agg(F.first("profile").alias("profile"), F.first("fine").alias("fine"))

    comps = near_classes(bands, profile_of, Profiles(unpack, threshold))
    comps = comps.withColumnRenamed("node", "cls")
    lines = units.where("not piece")
    # classes of equal text in two rows or more, and linked ones
    equal = lines.groupBy("cls").agg(F.min("_rid").alias("a"), F.max("_rid").alias("b")).where("a != b").select("cls")
    several = table(equal.unionByName(comps.select("cls")).distinct(), "repeated")
    hits = lines.select("_rid", "start", "end", "cls").join(several, "cls").join(comps, "cls", "left")
    hits = hits.join(ids, "_rid").select("_rid", "_id", "start", "end", F.coalesce("comp", "cls").alias("class"))
    hits = table(hits, "hits")
    first = table(hits.groupBy("class").agg(F.min(_place()).alias("f")), "firsts")
    pieces = units.where("piece").select("_rid", "start", "cls")
    hits = _verdicts(hits.join(first, "class")).unionByName(wholes).unionByName(_shared_runs(own, pieces))
    placed = hits.repartition(parts(docs.sparkSession), "doc_rid").sortWithinPartitions("doc_rid", "start", "end", "first_doc_id")
    spans = placed.mapInArrow(_document_spans, "doc_rid bigint, start bigint, end bigint, removed boolean, first_doc_id string")
    return spans.join(ids, spans["doc_rid"] == ids["_rid"]).select(
        F.col("_id").alias(id_col), "start", "end", "removed", F.col("first_doc_id").cast(id_type).alias("first_doc_id"))

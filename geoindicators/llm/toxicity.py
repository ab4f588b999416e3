"""Toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are lower-cased words and the 5-, 6- and 7-byte beginnings of longer words (so inflected forms meet), as 64-bit
hashes, each also as "occurs twice" and "occurs three times".  From the labelled rows a bounded sample is drawn (``max_positive`` and ``max_negative`` rows;
of near-identical ones, told by a min-hash of their 5-word shingles, one).  The ``max_terms`` terms with the
largest chi-square in favour of label 1 make the vocabulary.  Their document frequencies are counted over
all documents, whole texts.

Index: per block of ``BLOCK`` examples and term the largest weight in the block.  A document's bound for a block is
its product with those maxima; blocks are read from the largest bound down until the k-th best cosine
so far is above the next bound, so the k nearest are exact.  Votes are weighted by cosine;
a logistic curve fitted leave-one-out on the examples, weighted back to the label counts of all
labelled rows, turns them into a probability.  The neighbours are the evidence.

Everything broadcast is bounded by max_terms x (max_positive + max_negative).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoindicators.llm.langid import even_sample, held_out
from geoindicators.llm.tokens import NOT_WORD, U, counted, mix, prefix_hash, shingles, split_words, text_chunks

MAX_POSITIVE = 1500
MAX_NEGATIVE = 3000
MAX_TERMS = 384
MIN_TERM_ROWS = 4
BEGINNINGS = (5, 6, 7)
BLOCK = 64
NEAREST = 9
THRESHOLD = 0.3


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = split_words(data, offsets, NOT_WORD)
    found = [(words.row, words.hash), *(prefix_hash(data, words, n) for n in BEGINNINGS)]
    # the two lowest bits are free for the level of a term: once, twice, three times
    return np.concatenate([r for r, _ in found]), np.concatenate([h for _, h in found]) & ~U(3)


def _levels(row: np.ndarray, term: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term with its level, weight) of counted terms."""
    parts = [(row, term, 1 + np.log(n))] + [(row[n > k], term[n > k] | U(k), np.ones(int((n > k).sum()))) for k in (1, 2)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _known(vocabulary: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in the sorted vocabulary, weight) of the vocabulary's terms in a slice."""
    row, term = _terms(data, offsets)
    base = np.unique(vocabulary & ~U(3))
    at = np.minimum(np.searchsorted(base, term), len(base) - 1)
    row, term, weight = _levels(*counted(row[base[at] == term], term[base[at] == term]))
    at = np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)
    hit = vocabulary[at] == term
    return row[hit], at[hit], weight[hit]


@dataclass
class ToxicityModel:
    terms: np.ndarray      # sorted hashes of the vocabulary
    idf: np.ndarray
    examples: np.ndarray   # (rows, terms) unit vectors
    labels: np.ndarray
    ids: np.ndarray        # of the examples, as text
    curve: np.ndarray      # of the logistic: vote, mass, constant
    base: float            # share of label 1 among labelled rows without any term

    def __post_init__(self):
        n = -(-len(self.examples) // BLOCK)
        self.block_max = np.array([self.examples[i * BLOCK:(i + 1) * BLOCK].max(axis=0) for i in range(n)]) if n else np.zeros((0, len(self.terms)))

    def vectors(self, texts) -> np.ndarray:
        """Unit TF-IDF vectors over the vocabulary; a text without any of its terms has the zero vector."""
        out = np.zeros((len(texts), len(self.terms)), dtype=np.float32)
        if not len(self.terms):
            return out
        for first, _, data, offsets in text_chunks(texts):
            row, term, weight = _known(self.terms, data, offsets)
            out[first + row, term] = weight * self.idf[term]
        norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return out / np.where(norm > 0, norm, 1)

    def nearest(self, q: np.ndarray, k: int = NEAREST, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(places, cosines) of the k nearest examples with a cosine over 0, ties by place; place -1 where fewer.

        without: for each query an example that doesn't count (leave-one-out).
        """
        n, blocks = len(q), len(self.block_max)
        sim, place = np.zeros((n, k), dtype=np.float32), np.full((n, k), -1)
        if not n or not blocks:
            return place, sim
        bound = q @ self.block_max.T.astype(np.float32)
        order = np.argsort(-bound, axis=1, kind="stable")
        live = np.flatnonzero(bound.max(axis=1) > 0)
        for step in range(blocks):
            block = order[live, step]
            top = bound[live, block]
            # float error: a bound may fall short of a cosine by a few ulp; equal bounds may hold ties
            go = (top > 0) & (top + 1e-5 >= sim[live, -1])
            live, block = live[go], block[go]
            if not len(live):
                break
            for b in np.unique(block):
                rows = live[block == b]
                own = self.examples[b * BLOCK:(b + 1) * BLOCK]
                s = q[rows] @ own.T
                p = np.broadcast_to(np.arange(b * BLOCK, b * BLOCK + len(own)), s.shape)
                s = np.where(s > 0, s, 0)
                if without is not None:
                    s = np.where(p == without[rows][:, None], 0, s)
                s, p = np.concatenate([sim[rows], s], axis=1), np.concatenate([place[rows], np.where(s > 0, p, -1)], axis=1)
                best = np.lexsort((p, -s), axis=1)[:, :k]
                sim[rows], place[rows] = np.take_along_axis(s, best, 1), np.take_along_axis(p, best, 1)
        return place, sim

    def votes(self, place: np.ndarray, sim: np.ndarray) -> np.ndarray:
        """(share of label 1 weighted by cosine, mean cosine of label 1, 1) for each query."""
        y = np.where(place >= 0, self.labels[place] if len(self.labels) else 0, 0)
        mass = sim.sum(axis=1)
        return np.stack([(sim * y).sum(axis=1) / np.where(mass > 0, mass, 1), (sim * y).sum(axis=1) / sim.shape[1], np.ones(len(sim))], axis=1)

    def score(self, place: np.ndarray, sim: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-self.votes(place, sim) @ self.curve))
        return np.clip(np.where(sim.sum(axis=1) > 0, p, self.base), 0.0, 1.0)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> np.ndarray:
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ b))
        grad = x.T @ (w * (y - p)) - ridge * b
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(hess, grad)
        b += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return b


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: dict[int, int]) -> DataFrame:
    """(_id, _y, _t): the labelled sample, lower-cased whole texts."""
    y = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where(
        F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id")).groupBy("_id").agg(F.max("_y").alias("_y"))
    chosen = even_sample(y, "_y", sum(most.values()), most)
    texts = docs.select(F.col(id_col).alias("_id"), F.lower(F.col(text_col)).alias("_t"))
    return texts.join(F.broadcast(chosen), "_id")


def _marked(batches):
    """_id, _y, terms (distinct hashes), mark (least hash of the 5-word shingles)."""
    for b in batches:
        texts = pa.array(b["_t"], pa.large_string())
        for first, rows, data, offsets in text_chunks(texts):
            row, term, _ = _levels(*counted(*_terms(data, offsets)))
            order = np.argsort(row, kind="stable")
            row, term = row[order], term[order]
            at = np.searchsorted(row, np.arange(rows + 1))
            srow, key = shingles(split_words(data, offsets))
            marks = []
            for salt in (1, 2):
                least = np.full(rows, np.iinfo(np.uint64).max, dtype=U)
                np.minimum.at(least, srow, mix(key ^ U(salt)))
                marks.append(least.view(np.int64))
            part = b.iloc[first:first + rows]
            yield pd.DataFrame({"_id": part["_id"].to_numpy(), "_y": part["_y"].to_numpy(),
                                "_terms": [term[at[i]:at[i + 1]].view(np.int64) for i in range(rows)], "_m1": marks[0], "_m2": marks[1]})


def train_toxicity_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         label_col: str = "toxic", max_positive: int = MAX_POSITIVE, max_negative: int = MAX_NEGATIVE,
                         max_terms: int = MAX_TERMS) -> ToxicityModel:
    """Fit on a bounded sample of the labelled rows that aren't held out; labels other than 0 and 1 and null ids don't count."""
    from geoindicators.llm.common import table

    sample = table(_sample(docs, labels, id_col, text_col, label_col, {0: max_negative, 1: max_positive}), "toxic-sample")
    id_type = sample.schema["_id"].dataType.simpleString()
    marked = sample.select("_id", "_y", "_t").mapInPandas(_marked, f"_id {id_type}, _y int, _terms array<bigint>, _m1 bigint, _m2 bigint")
    for m in ("_m1", "_m2"):  # of near-identical examples one: the least id
        w = Window.partitionBy(m).orderBy("_id")
        marked = marked.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
    marked = table(marked.drop("_m1", "_m2"), "toxic-terms")
    n = {r["_y"]: r["n"] for r in marked.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    every = {r["_y"]: r["n"] for r in labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where(
        F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id")).groupBy("_y").agg(F.countDistinct("_id").alias("n")).collect()}
    all1, all0 = max(every.get(1, 0), 0), max(every.get(0, 0), 0)
    prior = (all1 + 1) / (all1 + all0 + 2)
    a, b = F.sum("_y"), F.sum(1 - F.col("_y"))
    counts = marked.select("_y", F.explode("_terms").alias("term")).groupBy("term").agg(a.alias("a"), b.alias("b"))
    counts = counts.where((F.col("a") >= min(MIN_TERM_ROWS, max(1, n1))) & (F.col("a") * max(n0, 1) > F.col("b") * max(n1, 1)))
    c, d = F.lit(n1) - F.col("a"), F.lit(n0) - F.col("b")
    chi = (F.col("a") * d - F.col("b") * c) ** 2 / ((F.col("a") + F.col("b")) * (c + d + 1e-9))
    top = [r["term"] for r in counts.withColumn("chi", chi).orderBy(F.desc("chi"), "term").limit(max_terms).collect()]
    terms = np.sort(np.array(top, dtype=np.int64).view(U))
    width = len(terms)

    known = docs.sparkSession.sparkContext.broadcast(terms)

    def frequency(batches):
        rows, df = 0, np.zeros(width, dtype=np.int64)
        for batch in batches:
            for _, size, data, offsets in text_chunks(batch.column(0)):
                rows += size
                if width:
                    df += np.bincount(_known(known.value, data, offsets)[1], minlength=width)
        place = np.arange(-1, width)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.concatenate([[rows], df]))], names=["place", "n"])

    df = dict(docs.select(F.lower(F.col(text_col)).alias("_t")).mapInArrow(frequency, "place bigint, n bigint")
              .groupBy("place").agg(F.sum("n").alias("n")).collect())
    idf = np.array([np.log((1 + df.get(-1, 0)) / (1 + df.get(i, 0))) + 1 for i in range(width)], dtype=np.float32)
    model = ToxicityModel(terms, idf, np.zeros((0, width), np.float32), np.zeros(0, int), np.zeros(0, object), np.zeros(3), prior)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def vectorise(batches):
        for part in batches:
            v = shared.value.vectors(pa.array(part["_t"], pa.large_string()))
            yield pd.DataFrame({"_id": part["_id"].astype(str), "_y": part["_y"], "v": [x.astype("<f4").tobytes() for x in v]})

    kept = sample.join(marked.select("_id"), "_id", "left_semi").mapInPandas(vectorise, "_id string, _y int, v binary").collect()
    kept.sort(key=lambda r: (r["_y"], r["_id"]))
    if not kept:
        return model
    vectors = np.array([np.frombuffer(r["v"], "<f4") for r in kept]).reshape(len(kept), width)
    y, ids = np.array([r["_y"] for r in kept]), np.array([r["_id"] for r in kept], dtype=object)
    some = vectors.any(axis=1)
    # share of label 1 where no term occurs, each class weighted to its count over all labelled rows
    share = [all0 / max(n0, 1), all1 / max(n1, 1)]
    empty1, empty0 = (y[~some] == 1).sum() * share[1], (y[~some] == 0).sum() * share[0]
    base = (empty1 + prior) / (empty1 + empty0 + 1)
    order = np.flatnonzero(some)[np.lexsort((np.argmax(vectors[some], axis=1), y[some]))]  # alike examples share blocks
    model = ToxicityModel(terms, idf, np.ascontiguousarray(vectors[order]), y[order], ids[order], np.zeros(3), float(base))
    place, sim = model.nearest(model.examples, without=np.arange(len(order)))
    seen = sim.sum(axis=1) > 0
    x, own = model.votes(place, sim)[seen], model.labels[seen]
    # two rows of weight 1 keep the curve finite where the classes separate
    x = np.concatenate([x, [[1, 1, 1], [0, 0, 1]]])
    own, weight = np.append(own, [1, 0]), np.append(np.where(own == 1, share[1], share[0]), [1, 1])
    model.curve = _logistic(x, own, weight)
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id_col, held_out, score, predicted (1 from ``threshold`` up), evidence (ids of the nearest examples).

    Null and empty texts, and texts without any term of the vocabulary, get the share of label 1 among such
    labelled rows and no evidence.  Repeated rows are scored each; an empty table gives no rows; other columns are ignored.
    """
    own = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.lower(F.col(text_col)).alias("_t"))
    id_type = own.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for b in batches:
            m = shared.value
            place, sim = m.nearest(m.vectors(b.column("_t")))
            s = m.score(place, sim)
            evidence = [[m.ids[p] for p in row if p >= 0] for row in place]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32)),
                 pa.array(evidence, pa.list_(pa.string()))],
                names=[id_col, "held_out", "score", "predicted", "evidence"])

    return own.mapInArrow(score, f"`{id_col}` {id_type}, held_out boolean, score double, predicted int, evidence array<string>")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored under ``threshold`` by a model trained on ``labels``, row by row: ids may repeat or be null."""
    model = train_toxicity_model(docs, labels, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    lowered = "_" * (1 + max(len(c) for c in docs.columns))  # a name that no column has

    def under(batches):
        for b in batches:
            m = shared.value
            kept = m.score(*m.nearest(m.vectors(b.column(lowered)))) < threshold
            yield pa.RecordBatch.from_arrays(b.columns[:-1], names=b.schema.names[:-1]).filter(pa.array(kept))

    return docs.withColumn(lowered, F.lower(F.col(text_col))).mapInArrow(under, docs.schema)

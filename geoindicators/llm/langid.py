"""Language id: averaged hashed subword embeddings with a linear softmax.

Subwords are the byte n-grams (2 to 4 bytes) of the lower-cased text with every run of non-letters as
one space, hashed into ``BUCKETS`` rows of an embedding table.  Text vector = mean of its subwords' rows;
logits = vector times a linear layer.  Both are trained by stochastic gradient descent in numpy on a
bounded sample, ``max_train`` labelled rows dealt evenly over the languages.  A temperature fitted on a fifth
of the sample calibrates the probabilities; below ``reject`` the answer is ``und``.

Prediction runs over every whole text: table times layer is one (BUCKETS x languages) array, so a text costs
one gather per subword.  The sample reaches the driver as hashed counts, at most max_train x BUCKETS.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoindicators.llm.tokens import text_chunks

BUCKETS = 1 << 14
ORDERS = (2, 3, 4)
DIM = 16
MAX_TRAIN = 2000
UNKNOWN = "und"
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def held_out(id_col: str):
    """crc32 of the id as text, mod 4, is 2; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def even_sample(rows: DataFrame, class_col: str, most: int, quota: dict | None = None) -> DataFrame:
    """At most ``most`` rows (_id, class_col), dealt evenly over the classes, chosen by a hash of the id.

    The classes are counted first; each row then passes if its hash falls under its class's share (with a margin), so
    what is ranked is a little more than the quota of each class, however many rows a class has.
    """
    sizes = {r[0]: r["n"] for r in rows.groupBy(class_col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), class_col).limit(most).collect()}
    if quota is None:
        quota, left = {}, most
        for i, c in enumerate(sorted(sizes, key=lambda c: (sizes[c], str(c)))):
            quota[c] = min(sizes[c], left // (len(sizes) - i))
            left -= quota[c]
    passes = [((F.col(class_col) == c) & (F.pmod(F.xxhash64(F.lit(17), F.col("_id").cast("string")), F.lit(1 << 30)) < int(min(1.0, (1.3 * quota[c] + 30) / n) * (1 << 30))))
              for c, n in sizes.items() if quota.get(c)]
    if not passes:
        return rows.limit(0)
    order = [F.xxhash64(F.col("_id").cast("string")), F.col("_id")]
    near = rows.where(reduce(lambda a, b: a | b, passes))
    ranked = near.withColumn("_k", F.row_number().over(Window.partitionBy(class_col).orderBy(*order)))
    return ranked.where(reduce(lambda a, b: a | b, [(F.col(class_col) == c) & (F.col("_k") <= q) for c, q in quota.items()])).drop("_k")


def _grams(data: np.ndarray, offsets: np.ndarray):
    """For each order: bucket of the n-gram at each place, and the row borders among the valid places."""
    letters = _LETTER[data]
    keep = letters.copy()
    if len(data):
        keep[1:] |= letters[:-1]  # the first non-letter after a word stays, as a space
    text = np.where(letters, data, 32).astype(np.uint32)[keep]
    border = np.concatenate([[0], np.cumsum(keep)])[offsets]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(border))
    for n in ORDERS:
        m = len(text) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, dtype=np.uint32)
        for i in range(n):
            h = (h ^ text[i:i + m]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        whole = row[:m] == row[n - 1:]
        yield row[:m][whole], (h[whole] >> np.uint32(18)).astype(np.int64)


@dataclass
class LanguageModel:
    names: list[str]
    table: np.ndarray  # (BUCKETS, languages): embedding times linear layer, over the temperature
    bias: np.ndarray

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        out = []
        for _, rows, data, offsets in text_chunks(texts):
            total, count = np.zeros((rows, len(self.names))), np.zeros(rows)
            for row, bucket in _grams(data, offsets):
                present, first = np.unique(row, return_index=True)
                if len(present):
                    count[present] += np.diff(np.append(first, len(row)))
                    for c in range(len(self.names)):
                        total[present, c] += np.add.reduceat(self.table[:, c][bucket], first)
            out.append(_softmax(total / np.maximum(count, 1)[:, None] + self.bias))
        return np.concatenate(out) if out else np.zeros((0, len(self.names)))


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _train(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, names: list[str], epochs: int = 12,
           batch: int = 32, rate: float = 2.0, seed: int = 7) -> LanguageModel:
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = rng.normal(0, 0.5, (DIM, len(names))), np.zeros(len(names))
    calib = np.arange(len(labels)) % 5 == 4
    if not calib.any() or len(set(labels[~calib])) < len(set(labels)):
        calib = np.zeros(len(labels), dtype=bool)
    train = np.flatnonzero(~calib)
    steps, done = epochs * -(-len(train) // batch), 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(train), -(-len(train) // batch)):
            eta = rate * (1 - done / steps)
            done += 1
            ids = np.concatenate([features[i][0] for i in part])
            weight = np.concatenate([features[i][1] for i in part])
            at = np.repeat(np.arange(len(part)), [len(features[i][0]) for i in part])
            used, place = np.unique(ids, return_inverse=True)
            dense = np.zeros((len(part), len(used)))
            dense[at, place] = weight
            vector = dense @ emb[used]
            error = _softmax(vector @ layer + bias)
            error[np.arange(len(part)), labels[part]] -= 1
            error /= len(part)
            back = error @ layer.T
            layer -= eta * vector.T @ error
            bias -= 0.1 * eta * error.sum(axis=0)
            emb[used] -= eta * 10 * dense.T @ back
    table = emb @ layer
    # temperature: the value of a grid with the least log loss on rows that the descent has not seen
    scale = 1.0
    if calib.any():
        logits = np.array([features[i][1] @ table[features[i][0]] for i in np.flatnonzero(calib)]) + bias
        own = labels[calib]
        loss = {s: -np.log(_softmax(logits * s)[np.arange(len(own)), own] + 1e-12).mean() for s in np.geomspace(0.1, 10, 41)}
        scale = min(loss, key=loss.get)
    return LanguageModel(names, np.ascontiguousarray(table * scale, dtype=np.float64), bias * scale)


def train_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                         max_train: int = MAX_TRAIN) -> LanguageModel | None:
    """Fit on at most ``max_train`` rows that are not held out, with a text and a language, dealt evenly over the languages."""
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), F.col(lang_col).cast("string").alias("_l"))
    own = own.where(F.col("_id").isNotNull() & F.col("_l").isNotNull() & F.col("_t").isNotNull() & ~held_out("_id"))
    chosen = even_sample(own.select("_id", "_l"), "_l", max_train).select("_id").distinct()

    def count(batches):
        for b in batches:
            texts = pa.array(b["_t"], pa.large_string())
            for first, rows, data, offsets in text_chunks(texts):
                parts = list(_grams(data, offsets))
                row = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
                bucket = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
                key, n = np.unique(row * BUCKETS + bucket, return_counts=True)
                at = np.searchsorted(key, np.arange(rows + 1) * BUCKETS)
                part = b.iloc[first:first + rows]
                yield pd.DataFrame({
                    "_id": part["_id"].astype(str).to_numpy(), "_l": part["_l"].to_numpy(),
                    "f": [(key[at[i]:at[i + 1]] % BUCKETS).astype("<u2").tobytes() for i in range(rows)],
                    "n": [(n[at[i]:at[i + 1]] / max(1, n[at[i]:at[i + 1]].sum())).astype("<f4").tobytes() for i in range(rows)]})

    rows = own.join(F.broadcast(chosen), "_id").select("_id", "_l", F.lower("_t").alias("_t")).mapInPandas(
        count, "_id string, _l string, f binary, n binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["_id"], r["_l"], bytes(r["f"])))
    names = sorted({r["_l"] for r in rows})
    features = [(np.frombuffer(r["f"], "<u2").astype(np.int64), np.frombuffer(r["n"], "<f4").astype(float)) for r in rows]
    return _train(features, np.array([names.index(r["_l"]) for r in rows]), names)


def identify_language(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text",
                      reject: float = 0.0) -> DataFrame:
    """One row per document: id_col, held_out, lang_pred, score (calibrated probability; 0 for ``und``).

    ``und``: text null or without a letter, probability below ``reject``, or no model (nothing to learn from).
    Repeated rows are judged each; an empty table gives no rows; other columns are ignored.
    """
    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    own = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.when(letter, F.lower(text_col)).alias("_t"))
    id_type = own.schema[id_col].dataType.simpleString()
    if model is None:
        return own.select(id_col, "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        names = np.array([*shared.value.names, UNKNOWN], dtype=object)
        for b in batches:
            texts = b.column("_t")
            p = shared.value.probabilities(texts)
            best, score = p.argmax(axis=1), p.max(axis=1)
            unknown = np.asarray(texts.is_null()) | (score < reject)
            best[unknown], score[unknown] = len(names) - 1, 0.0
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names[best], pa.string()), pa.array(score, pa.float64())],
                names=[id_col, "held_out", "lang_pred", "score"])

    return own.mapInArrow(predict, f"`{id_col}` {id_type}, held_out boolean, lang_pred string, score double")

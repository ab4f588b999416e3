"""Personal data: base patterns, high-recall candidates, and boosted trees that decide on the candidates.

Base spans (e-mail, ip, card, phone) are found by fixed patterns with their checks (parts up to 255, Luhn, digits) and always
stay.  Candidate generators are wider: e-mails with written-out or bracketed signs, defanged addresses, card numbers with any separators,
phones with 00 or without a country code.  Their spans overlap each other and the base.  Gradient-boosted trees score each
candidate by its format (digits, groups, separators, checks, borders) and context (hint words, signs and quotes before it);
a logistic curve on held-out candidates calibrates the scores and per kind the least threshold whose held-out precision
is ``PRECISION`` or more selects the redactions.  Of overlapping selected candidates the likeliest stays; none touches a base span.

The trees learn from the corpus itself: candidates that are a base span are positive, others negative; each positive
is also shown rewritten (other signs and separators: positive) and spoilt (a failing check or no separators: negative).  All candidates of
all documents count, in the trees' cuts and histograms, the calibration and the thresholds; what reaches the driver are sums of
bounded number (``boosting``).

Texts are read whole.  All patterns take time linear in the text.  Places are code points.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.boosting import FEW, GRID, Boosted, calibrate_margins, encode, fit_rows, quantiles
from geoindicators.llm.common import table

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
LEAST_HELD_OUT = 20
AROUND = 40

# base patterns: possessive where nothing can be given back, so that long runs cost linear time
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]*[ ().0-9-][0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(s: str) -> str:
    return _NOT_DIGIT.sub("", s)


def _emails(t: str) -> Iterator[tuple[int, int]]:
    end, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > end and t[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(t, at + 1)):
            end = m.end()
            yield start, end
        at = t.find("@", max(at + 1, end))


def base_spans(t: str) -> list[Span]:
    """The spans of the fixed patterns, by start, then kind."""
    out = [("email", s, e) for s, e in _emails(t)]
    for m in _IP.finditer(t):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(t):
        if 12 <= m.end() - m.start() <= 37 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# candidate generators: bounded repetitions and fixed borders
_AT = re.compile(r"\s?(?:@|[\[({]\s?(?:at|AT)\s?[\])}])\s?|\s(?:at|AT)\s")
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|DOT|\.)\s?[\])}]\s?|\s(?:dot|DOT)\s)"
_HOST = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,6}}(?![A-Za-z0-9-])")
_IP_LIKE = re.compile(r"(?<![0-9])[0-9]{1,4}(?:(?:\.|\[\.\]|\(\.\)|\s\.\s|\[dot\]|\(dot\))[0-9]{1,4}){3}(?![0-9])")
_CARD_LIKE = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ ./_-]{0,2}[0-9]){11,18}(?![0-9A-Za-z])")
_PHONE_LIKE = re.compile(r"(?<![0-9A-Za-z+])(?:\+|00)?\(?[0-9](?:[ ()./-]{0,3}[0-9]){6,14}(?![0-9A-Za-z])")
_LONG_LOCAL = 64


def candidates(t: str) -> list[Span]:
    """Proposed spans; those of different kinds may overlap."""
    out = []
    for m in _AT.finditer(t):
        host = _HOST.match(t, m.end())
        start = m.start()
        least = max(0, start - _LONG_LOCAL)
        while start > least and t[start - 1] in _LOCAL:
            start -= 1
        if host and start < m.start() and ("@" in m.group() or not m.group().isspace() and _written(m.group(), host.group())):
            out.append(("email", start, host.end()))
    out += [(k, m.start(), m.end()) for k, p in (("ip", _IP_LIKE), ("card", _CARD_LIKE), ("phone", _PHONE_LIKE)) for m in p.finditer(t)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _written(sign: str, host: str) -> bool:
    """A bare word "at" counts only with a written dot."""
    return any(c in sign for c in "[({") or bool(re.search(r"\s(?:dot|DOT)\s|[\[({]", host))


HINTS = {  # fixed word beginnings that hint at a kind
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "addr", "ping", "login"),
    "card": ("card", "visa", "amex", "master", "credit", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "fax", "mobil", "ruf", "appel", "llam"),
}
_WORD = re.compile(r"[^\W\d_]+")
_NUMBERS = re.compile(r"[0-9]+")


def features(t: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, start, end = span
    s, left, right = t[start:end], t[max(0, start - AROUND):start], t[end:end + 20]
    groups = [len(x) for x in _NUMBERS.findall(s)]
    digits = _digits(s)
    octets = [int(x[:4]) for x in _NUMBERS.findall(s)[:8]]
    words = [w.lower() for w in _WORD.findall(left)]
    seps = [sum(map(s.count, c)) for c in (".", "-_/", " ", "()[]{}", "@")]
    border = lambda c: 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4
    return [
        *(float(kind == k) for k in KINDS), len(s), len(digits), len(groups), min(groups, default=0), max(groups, default=0), *seps,
        float(s.startswith("00") or s.startswith("+")), float(bool(digits) and luhn(digits)), max(octets, default=0), sum(x.isalpha() for x in s) / max(1, len(s)),
        s.count(".") + len(re.findall(r"dot|DOT", s)), border(left[-1:]), border(right[:1]),
        *(float(any(w.startswith(h) for w in words[-4:] for h in HINTS[k])) for k in KINDS), float("=" in left[-4:] or '"' in left[-2:]),
    ]


def _overlap(a: Span, b: Span) -> float:
    """Shared part of both spans together."""
    return max(0, min(a[2], b[2]) - max(a[1], b[1])) / (max(a[2], b[2]) - min(a[1], b[1]))


def rewritten(kind: str, s: str) -> list[tuple[str, int]]:
    """(other writing of a base span, label)."""
    d = _digits(s)
    if kind == "email":
        local, host = s.split("@", 1)
        return [(x, 1) for x in (f"{local} [at] {host.replace('.', ' [dot] ')}", f"{local}(at){host.replace('.', '(dot)')}", f"{local} @ {host}", f"{local} at {host.replace('.', ' dot ')}")]
    if kind == "ip":
        parts = s.split(".")
        return [("[.]".join(parts), 1), ("(.)".join(parts), 1), (".".join([*parts[:2], str(256 + len(s) * 37 % 700), parts[3]]), 0), ("[.]".join([str(300 + len(s)), *parts[1:]]), 0)]
    if kind == "card":
        spoilt = d[:-1] + str((int(d[-1]) + 1 + len(set(d))) % 10)
        spoilt = spoilt if not luhn(spoilt) else d[:-1] + str((int(d[-1]) + 1) % 10)
        cut = lambda x, sep: sep.join(x[i:i + 4] for i in range(0, len(x), 4))
        return [*((cut(d, sep), 1) for sep in (".", "/", "  ")), *((cut(spoilt, sep), 0) for sep in (".", "/", " ", "-", ""))]
    bare = s.lstrip("+")
    local = bare.split(" ", 1)[1] if " " in bare else bare
    return [("00" + bare, 1), (bare, 1), *([(local, 1)] if 7 <= len(_digits(local)) else []), (d, 0), (d[:7], 0), (d[:4] + "-" + d[4:6] + "-" + d[6:8], 0)]


@dataclass
class PiiModel:
    trees: Boosted = field(default_factory=Boosted)
    thresholds: dict[str, float] = field(default_factory=dict)  # of calibrated scores; a kind without one adds nothing

    def spans(self, t: str) -> tuple[list[Span], list[tuple[Span, float]]]:
        """(base spans, added spans with their scores)."""
        base = base_spans(t)
        if not self.thresholds:
            return base, []
        open_ = [c for c in untouched(candidates(t), base) if c[0] in self.thresholds]
        if not open_:
            return base, []
        p = self.trees.probability(np.array([features(t, c) for c in open_]))
        chosen: list[tuple[int, int, int]] = []  # start, end, place in open_; by start, none overlaps
        for i in sorted(range(len(open_)), key=lambda i: (-p[i], open_[i][1], open_[i][2])):
            kind, start, end = open_[i]
            at = bisect_left(chosen, (start, end))
            if p[i] >= self.thresholds[kind] and (at == 0 or chosen[at - 1][1] <= start) and (at == len(chosen) or chosen[at][0] >= end):
                chosen.insert(at, (start, end, i))
        return base, [(open_[i], float(p[i])) for _, _, i in chosen]


def untouched(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that overlap no base span; base by start."""
    starts = [b[1] for b in base]
    ends = list(accumulate((b[2] for b in base), max))
    return [c for c in spans if not (n := bisect_left(starts, c[2])) or ends[n - 1] <= c[1]]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def _proposals(texts: pa.Array) -> Iterator[tuple]:
    """(kind, label, left, span, right, hash) of every candidate."""
    for t in texts.to_pylist():
        if not t or not (found := candidates(t)):
            continue
        base = base_spans(t)
        starts, free = [b[1] for b in base], set(untouched(found, base))
        for c in found:
            near = base[bisect_left(starts, c[1] - (c[2] - c[1])):bisect_left(starts, c[2])]
            label = int(any(c[0] == b[0] and _overlap(c, b) >= 0.8 for b in near))
            if label or c in free:
                left, s, right = t[max(0, c[1] - AROUND):c[1]], t[c[1]:c[2]], t[c[2]:c[2] + 20]
                yield c[0], label, left, s, right, zlib.crc32(f"{left}|{s}|{right}".encode())


def _examples(batches):
    """(kind, y, held, x) of each writing of the proposals."""
    for b in batches:
        kinds, y, held, x = [], [], [], []
        for row in b.to_pylist():
            for s, label in [(row["span"], row["label"])] + (_writings(row) if row["label"] else []):
                t = row["left"] + s + row["right"]
                mine = (row["kind"], len(row["left"]), len(row["left"]) + len(s))
                for c in candidates(t):
                    if c[0] == row["kind"] and _overlap(c, mine) >= 0.8:
                        x.append(features(t, c))
                        y.append(label)
                        kinds.append(c[0])
                        held.append(row["h"] % 3 == 0)
        yield pa.record_batch({"kind": pa.array(kinds, pa.string()), "y": pa.array(y, pa.int32()), "held": pa.array(held, pa.bool_()), "x": pa.array(x, pa.list_(pa.float64()))})


def _cuts(examples: DataFrame) -> list[np.ndarray]:
    """The different quantiles of each feature over all rows that aren't held out, from the counts of its values."""
    values = examples.where("not held").select(F.posexplode("x").alias("f", "v")).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    found = values.groupBy("f").agg(F.percentile("v", F.array(*map(F.lit, quantiles().tolist())), F.col("n")).alias("cuts")).collect()
    return [np.unique(r["cuts"]) for r in sorted(found, key=lambda r: r["f"])]


def train_pii_model(docs: DataFrame, text_col: str = "text", few: int = FEW) -> PiiModel:
    """Fits the trees on all of the documents' own candidates (see above); without candidates nothing is added to the base.

    Null and empty texts have no candidates; equal candidates in equal surroundings count once.  ``few``: see ``fit_rows``.
    """
    def propose(batches):
        for b in batches:
            found = list(_proposals(b["_t"]))
            yield pa.record_batch({n: pa.array([f[i] for f in found], kind) for i, (n, kind) in enumerate(
                [("kind", pa.string()), ("label", pa.int32()), ("left", pa.string()), ("span", pa.string()), ("right", pa.string()), ("h", pa.int64())])})

    found = docs.select(docs[text_col].cast("string").alias("_t")).mapInArrow(propose, "kind string, label int, left string, span string, right string, h bigint")
    examples = table(found.distinct().mapInArrow(_examples, "kind string, y int, held boolean, x array<double>"), "pii-examples")
    cuts = _cuts(examples)
    if not cuts:
        return PiiModel()

    def code(batches):
        for b in batches:
            x = b["x"].flatten().to_numpy().reshape(-1, len(cuts))
            yield pa.record_batch({"codes": pa.array([r.tobytes() for r in encode(x, cuts)], pa.binary()), "y": b["y"]})

    coded = examples.where("not held").select("x", "y").mapInArrow(code, "codes binary, y int")
    trees = fit_rows(table(coded.groupBy("codes", "y").agg(F.count(F.lit(1)).alias("w")), "pii-codes"), cuts, few=few)

    def score(batches):
        for b in batches:
            x = b["x"].flatten().to_numpy().reshape(-1, len(cuts))
            yield pa.record_batch({"kind": b["kind"], "y": b["y"], "m": pa.array(np.rint(trees.margin(x) * GRID).astype(np.int64))})

    held = examples.where("held").select("kind", "y", "x").mapInArrow(score, "kind string, y int, m bigint")
    held = held.groupBy("kind", "y", "m").agg(F.count(F.lit(1)).alias("w")).orderBy("kind", "y", "m").toArrow()
    kinds, y, m, w = np.array(held["kind"].to_pylist(), dtype=object), held["y"].to_numpy().astype(float), held["m"].to_numpy() / GRID, held["w"].to_numpy().astype(float)
    calibrate_margins(trees, m, y, w)
    p = trees.chance(m)
    thresholds = {k: c for k in KINDS if (c := _threshold(p[kinds == k], y[kinds == k], w[kinds == k])) is not None}
    return PiiModel(trees, thresholds)


def _writings(row: dict) -> list[tuple[str, int]]:
    base = base_spans(row["span"])
    return rewritten(row["kind"], row["span"]) if base and base[0][0] == row["kind"] and base[0][1:] == (0, len(row["span"])) else []


def _threshold(p: np.ndarray, y: np.ndarray, w: np.ndarray) -> float | None:
    """The least score, 0.5 at least, from which the share of positives upwards is PRECISION or more; None without enough held-out rows (w of each)."""
    if w.sum() < LEAST_HELD_OUT or not y.any():
        return None
    order = np.argsort(-p, kind="stable")
    precise = np.cumsum((w * y)[order]) / np.cumsum(w[order])
    last = np.r_[p[order][1:] != p[order][:-1], True]  # ties stand or fall together
    good = np.flatnonzero((precise >= PRECISION) & last)
    return max(0.5, float(p[order][good[-1]])) if len(good) else None


def find_pii(docs: DataFrame, model: PiiModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added, redacted.

    spans: base and added ones as kind:start:end (code points, end exclusive), comma-joined by start, then kind.  base_sha256: of
    the base spans, joined likewise.  redacted: the text with each stretch of overlapping spans replaced by its first kind in brackets.  A null
    text counts as empty; repeated rows and null ids each give a row; an empty table none; other columns are ignored.
    """
    def scan(batches):
        for b in batches:
            rows = []
            for t in b["_t"].to_pylist():
                base, added = model.spans(t or "")
                every = base + [c for c, _ in added]
                rows.append(([sum(s[0] == k for s in base) for k in KINDS], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), len(added), redact(t or "", every)))
            counts = {f"n_{k}": pa.array([r[0][i] for r in rows], pa.int64()) for i, k in enumerate(KINDS)}
            yield pa.record_batch({"_id": b["_id"], **counts, "base_sha256": pa.array([r[1] for r in rows], pa.string()), "spans": pa.array([r[2] for r in rows], pa.string()),
                                   "n_added": pa.array([r[3] for r in rows], pa.int64()), "redacted": pa.array([r[4] for r in rows], pa.string())})

    id_type = docs.schema[id_col].dataType.simpleString()
    out = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_t")).mapInArrow(
        scan, f"_id {id_type}, {', '.join(f'n_{k} bigint' for k in KINDS)}, base_sha256 string, spans string, n_added bigint, redacted string")
    return out.withColumnRenamed("_id", id_col)


def redact(t: str, spans: list[Span]) -> str:
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if start >= at:
            out += [t[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + t[at:]

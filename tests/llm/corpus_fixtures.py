"""Small corpora for the tests: invented words, planted copies, and rows with every kind of gap."""

from __future__ import annotations

import random

EXTRA = "_rid string, _id string, _t string, cls string, key string, n string, kept string, a string, b string, shard string, held_out string, score string, start string, piece string"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def text(rng: random.Random, n: int, line: int = 60) -> str:
    w = words(rng, n)
    return "\n".join(" ".join(w[i:i + line]) for i in range(0, n, line))


def changed(rng: random.Random, t: str, n: int) -> str:
    """The text with n words replaced."""
    lines = [x.split(" ") for x in t.split("\n")]
    for _ in range(n):
        line = rng.choice(lines)
        line[rng.randrange(len(line))] = "".join(words(rng, 1)) + "x"
    return "\n".join(" ".join(x) for x in lines)


def messy(spark, rows):
    """(doc_id, text, source, ...) rows as documents with extra columns whose names the operators use themselves."""
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
    width = len(EXTRA.split(","))
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else "s", None, *["x"] * width) for r in rows]
    return spark.createDataFrame(full, schema)


def gaps(rng: random.Random) -> list[tuple]:
    """Null id, null, empty and blank texts, one very long text, ties and repeated rows."""
    long = text(rng, 60_000)
    t = text(rng, 120)
    return [(1, t), (2, t), (2, t), (None, t), (3, None), (4, ""), (5, " \t\n "), (6, long), (7, long), (8, "one"), (9, "one two"), (10, text(rng, 90), None, None)]

"""URL filter: a trie over reversed host labels, and below each host over path segments.

Rules are (host, path, verdict).  A rule fits its host and all subdomains if the url's path starts with
the rule's path.  The longest match wins: more host labels first, then the longer path; of one rule
given as both allow and block, block.

The trie is broadcast only after a check of its size (``MAX_RULES`` rows and ``MAX_RULE_BYTES`` bytes are
read at most); a larger list goes through ``judge_by_join``, a shuffle join on host suffixes with the
same results.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 200_000
MAX_RULE_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url):
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


class RuleTrie:
    """Nested dicts: host labels from the right; at a host, path segments; at a segment, path tails."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("." + label, {})
            *segments, tail = path.split("/")
            for s in segments:
                node = node.setdefault("/" + s, {})
            tails = node.setdefault("tails", {})
            if tails.get(tail, ("", ""))[1] != "block":
                tails[tail] = (host + path, verdict)

    @staticmethod
    def _path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        """The longest rule path at this host that the url's path starts with."""
        best = None
        for s in segments:
            if tails := node.get("tails"):
                best = next((tails[s[:k]] for k in range(len(s), -1, -1) if s[:k] in tails), best)
            node = node.get("/" + s)
            if node is None:
                break
        return best

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest match, or None."""
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("." + label)
            if node is None:
                break
            best = self._path(node, segments) or best
        return best


def _urls(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    url = F.col(url_col)
    return pages.select(F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))


def judge_by_join(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  default: str = "allow") -> DataFrame:
    """The way for rule lists of any size: join on host suffixes, then the longest match per row."""
    urls = _urls(pages, id_col, url_col).withColumn("_rid", F.monotonically_increasing_id())
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = urls.select("page_id", "host", "path", "_rid", F.explode(suffix).alias("_host"))
    r = rules.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("verdict").alias("_v"))
    hits = keys.join(r, "_host", "left").withColumn("_fit", F.col("path").startswith(F.col("_path")))
    rank = F.struct(F.size(F.split("_host", r"\.")).alias("n"), F.length("_path").alias("l"), (F.col("_v") == "block").alias("b"),
                    F.concat("_host", "_path").alias("rule"), F.col("_v").alias("verdict"))
    best = hits.groupBy("_rid", "page_id", "host", "path").agg(F.max(F.when(F.col("_fit"), rank)).alias("m"))
    return best.select("page_id", "host", "path", F.col("m.rule").alias("rule"),
                       F.coalesce("m.verdict", F.lit(default)).alias("verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule (null if none fits), verdict (``default`` if none fits).

    rules: DataFrame (host, path, verdict 'allow' or 'block'); rules with a null field are ignored.  A null
    url or one without ``://`` has an empty host and path and fits no rule.  Repeated pages are judged
    each; an empty table gives no rows; other columns are ignored.
    """
    rules = rules.select("host", "path", "verdict").dropna()
    size = F.octet_length(F.concat("host", "path", "verdict"))
    n, mass = rules.limit(MAX_RULES + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    if n > MAX_RULES or mass > MAX_RULE_BYTES:
        return judge_by_join(pages, rules, id_col, url_col, default)
    trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(sorted(map(tuple, rules.collect()))))

    def judge(batches):
        for b in batches:
            urls = list(zip(b.column("host").to_pylist(), b.column("path").to_pylist(), strict=True))
            found = {hp: trie.value.find(*hp) or (None, default) for hp in set(urls)}
            rule, verdict = [pa.array([found[u][i] for u in urls], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, rule, verdict], names=["page_id", "host", "path", "rule", "verdict"])

    urls = _urls(pages, id_col, url_col)
    id_type = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInArrow(judge, f"page_id {id_type}, host string, path string, rule string, verdict string")

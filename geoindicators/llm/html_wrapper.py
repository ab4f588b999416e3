"""HTML main text by union-free regular-expression wrappers.

Every page is cut into a token stream: block tags (name and class without digits) and text slots; inline
markup belongs to the slot, end tags that HTML lets authors omit are dropped.  Adjacent repeats fold
into repeated groups, so pages of one template share a skeleton however many paragraphs they have.  The distinct
skeletons of a host (counted map-side) are aligned one after the other: equal parts stay, a part that only
one side has becomes optional, a run beside its repeated group joins it.  The result is a union-free regular
expression over tokens: tags, slots, ``(...)+`` and ``(...)?``.  Its position automaton reads a page in one
pass (no backtracking) and tells where the article region begins and ends.

Extraction matches each page against its host's wrapper and takes the text slots of the article group without
the boilerplate elements inside (menus, notices, adverts, forms, comments).  Hosts whose wrapper has
no article element take all slots outside boilerplate elements whose text differs between pages; copies of a page count as
one, and a page never loses all its text.

Scale: skeletons and slot statistics are aggregated map-side, folded per (host, salt) and then per host; a page's
html is read twice and shuffled only if the wrappers outgrow Spark's broadcast threshold (a plain join, skew
left to AQE).
"""

from __future__ import annotations

import hashlib
import html as htmllib
import json
import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.llm.common import table
from geoindicators.llm.url_filter import url_host

# HTML element names by what they do to the text.
RAW = "script|style|textarea|title|noscript|template|iframe|svg|select|button"
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meta link q s samp "
                   "small source span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OPTIONAL_END = frozenset("p li dt dd td th tr thead tbody tfoot option colgroup".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form head dialog menu object fieldset".split())
# Words of class and id attributes that mark boilerplate, and those that mark the article.
BOILERPLATE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification overlay "
    "pagination paywall popup promo promoted promotion related recommended replies reply share sharing sidebar sidenav signup "
    "skip social sponsor sponsored subscribe toolbar widget widgets".split())
CONTAINERS = ("article", "main")
ARTICLE_WORDS = frozenset("article articlebody content entry main post story".split())
FOLD_SALTS = 16
MAX_REPEAT = 24  # widest group, in tokens, that folding looks for
HEADINGS = frozenset(f"h{i}" for i in range(1, 7))

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    rf"|<(?P<raw>{RAW})\b[^>]*>(?:.*?</(?P=raw)\s*>|.*)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][\w:-]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass(slots=True)
class Token:
    kind: str          # 'start', 'end', 'text' or 'break' (a tag inside a slot)
    name: str          # of the element; the text of a text token
    words: frozenset   # of class, id and role
    key: str           # of a block tag in the skeleton


def tokens(page: str) -> list[Token]:
    """The token stream: block tags, inline tags as 'break', text; comments and raw elements are gone."""
    out = []
    for m in _TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            out.append(Token("text", text, frozenset(), ""))
        elif name := m["name"] or m["name2"]:
            name, kind = name.lower(), "end" if m["end"] or m["end2"] else "start"
            attrs = m["attrs"] or m["attrs2"] or ""
            named = [(k.lower(), a or b or c) for k, a, b, c in _NAMED.findall(attrs)] if kind == "start" and "=" in attrs else []
            words = frozenset(w for _, v in named for w in re.split(r"[^a-z]+", v.lower()) if w)
            if name in INLINE or name in VOID:
                out.append(Token("break" if name not in ("br", "wbr") else "space", name, words if kind == "start" else frozenset(), ("/" if kind == "end" else "") + name))
            else:
                label = " ".join(sorted({re.sub(r"\d+", "", v).strip() for k, v in named if k == "class"}))
                out.append(Token(kind, name, words, ("/" if kind == "end" else "") + name + (f".{label}" if label else "")))
    return out


def stream(toks: list[Token]) -> list[tuple[str, int]]:
    """(key, place of its first token) of the skeleton's flat form; '#' is a text slot."""
    out: list[tuple[str, int]] = []
    for i, t in enumerate(toks):
        if t.kind in ("break", "space") or t.kind == "end" and t.name in OPTIONAL_END:
            continue
        if t.kind == "text":
            if t.name.isspace() or out and out[-1][0] == "#":
                continue
            out.append(("#", i))
        else:
            out.append((t.key, i))
    return out


# --- union-free expressions: a node is a key, or ['+', nodes] or ['?', nodes] -----------------------------------------------

def _same(a, b) -> bool:
    return a == b


def fold(nodes: list) -> list:
    """Adjacent equal runs become one repeated group, short runs first, until nothing changes."""
    changed = True
    while changed:
        changed = False
        for w in range(1, min(MAX_REPEAT, len(nodes)) + 1):
            i, out = 0, []
            while i < len(nodes):
                run = nodes[i:i + w]
                # X X ... -> (X)+ ; (X)+ X and X (X)+ -> (X)+
                j = i + w
                if len(run) == w and nodes[j:j + w] == run and not (w == 1 and isinstance(run[0], list) and run[0][0] == "?"):
                    while nodes[j:j + w] == run:
                        j += w
                    group = run[0] if w == 1 and isinstance(run[0], list) else ["+", run]
                    out.append(group)
                    i, changed = j, True
                    continue
                if len(run) == w and j < len(nodes) and nodes[j] == ["+", run]:
                    out.append(nodes[j])
                    i, changed = j + 1, True
                    continue
                if isinstance(nodes[i], list) and nodes[i][0] == "+" and len(nodes[i][1]) == w and nodes[i + 1:i + 1 + w] == nodes[i][1]:
                    out.append(nodes[i])
                    i, changed = i + 1 + w, True
                    continue
                out.append(nodes[i])
                i += 1
            nodes = out
    return nodes


def _weight(a, b) -> int:
    """How much aligning two nodes is worth; 0 if they don't align."""
    if isinstance(a, str) or isinstance(b, str):
        inner = a[1] if isinstance(a, list) else b[1] if isinstance(b, list) else None
        if inner is not None:  # one key against a group of just that key
            return 2 if inner == [a if isinstance(a, str) else b] else 0
        return 3 if a == b else 0
    if a == b:
        return 3
    return 2 if a[1] and b[1] and _first(a) == _first(b) else 0


def _first(node):
    while isinstance(node, list):
        node = node[1][0]
    return node


def _merge(a, b):
    if a == b:
        return a
    if isinstance(a, str) or isinstance(b, str):
        return a if isinstance(a, list) else b
    sign = "+" if a[0] == b[0] == "+" else "?"
    left, right = a[1], b[1]
    if sign == "?" and "+" in (a[0], b[0]):  # an optional part against a repeated one: an optional repeat
        left, right = (a[1] if a[0] == "?" else [a]), (b[1] if b[0] == "?" else [b])
    return [sign, align(left, right)]


def align(a: list, b: list) -> list:
    """One expression for both: the heaviest common subsequence stays, the rest becomes optional groups."""
    if a == b:
        return a
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            w = _weight(a[i], b[j])
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + w if w else 0)
    out, only_a, only_b, i, j = [], [], [], 0, 0

    def flush():
        for part in (only_a, only_b):
            if part:
                # a part that is optional already stays as it is
                out.extend(part if all(isinstance(x, list) and x[0] == "?" for x in part) else [["?", list(part)]])
                part.clear()

    while i < n and j < m:
        w = _weight(a[i], b[j])
        if w and best[i][j] == best[i + 1][j + 1] + w:
            flush()
            out.append(_merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            only_a.append(a[i])
            i += 1
        else:
            only_b.append(b[j])
            j += 1
    only_a.extend(a[i:])
    only_b.extend(b[j:])
    flush()
    return _tidy(out)


def _tidy(nodes: list) -> list:
    """Fold again; of equal neighbouring optional parts one stays as an optional repeat."""
    out: list = []
    for x in fold(nodes):
        if out and isinstance(x, list) and x[0] == "?" and out[-1] == x:
            out[-1] = ["?", x[1] if len(x[1]) == 1 and isinstance(x[1][0], list) and x[1][0][0] == "+" else [["+", x[1]]]]
            continue
        out.append(x)
    return out


def skeleton(toks: list[Token]) -> list:
    return fold([k for k, _ in stream(toks)])


# --- wrappers -----------------------------------------------------------------------------------------------------------------

@dataclass
class Wrapper:
    nodes: list
    constant: frozenset  # paths whose text never differs between pages

    def __post_init__(self):
        keys = set(_keys(self.nodes))
        self.container = next((c for c in CONTAINERS if any(_is(k, c) for k in keys)), None)
        # the article group must open and close on one level of the expression
        opens = [i for i, k in enumerate(self.nodes) if isinstance(k, str) and _is(k, self.container)]
        closes = [i for i, k in enumerate(self.nodes) if k == f"/{self.container}"]
        self.span = (opens[0], closes[-1]) if len(opens) == 1 and closes and closes[-1] > opens[0] else None
        self._positions(self.nodes)

    def _positions(self, nodes: list) -> None:
        """The expression as sets of its tokens' positions (bits): the position automaton, which reads a page in one pass."""
        self.at: dict[str, int] = {}       # key -> its positions
        self.next: list[int] = []          # position -> those that may follow
        self.top: dict[int, int] = {}      # place in ``nodes`` of a token on the highest level -> its position

        def sequence(nodes: list, top: bool) -> tuple[bool, int, int]:
            """(may be empty, positions it may begin with, and end with)"""
            empty, first, last = True, 0, 0
            for i, x in enumerate(nodes):
                if isinstance(x, str):
                    bit = 1 << len(self.next)
                    if top:
                        self.top[i] = len(self.next)
                    self.at[x] = self.at.get(x, 0) | bit
                    self.next.append(0)
                    e, f, z = False, bit, bit
                else:
                    e, f, z = sequence(x[1], False)
                    if x[0] == "+":
                        self._link(z, f)
                    e = e or x[0] == "?"
                self._link(last, f)
                first = first | f if empty else first
                last = last | z if e else z
                empty = empty and e
            return empty, first, last

        self.empty, self.first, self.last = sequence(nodes, True)

    def _link(self, ends: int, begins: int) -> None:
        for p in _bits(ends):
            self.next[p] |= begins

    def _paths(self, flat: list[str]) -> list[int] | None:
        """The positions that each token may stand for on a path through the whole expression; None if there is none.

        Time is the number of tokens times the positions that are open at once."""
        ahead, sets = self.first, []
        for k in flat:
            now = ahead & self.at.get(k, 0)
            if not now:
                return None
            sets.append(now)
            ahead = 0
            for p in _bits(now):
                ahead |= self.next[p]
        if not sets or not sets[-1] & self.last:
            return None
        sets[-1] &= self.last
        for i in range(len(sets) - 2, -1, -1):
            after = sets[i + 1]
            sets[i] = sum(1 << p for p in _bits(sets[i]) if self.next[p] & after)
        return sets

    def region(self, toks: list[Token]) -> tuple[int, int] | None:
        """Places of the tokens of the article group, if the page matches the wrapper: the first that may open it, the last that may close it."""
        flat = stream(toks)
        if self.span is None or (sets := self._paths([k for k, _ in flat])) is None:
            return None
        opens, closes = (1 << self.top[i] for i in self.span)
        a = next(i for i, now in enumerate(sets) if now & opens)
        b = next(i for i in range(len(sets) - 1, -1, -1) if sets[i] & closes)
        return flat[a][1], flat[b][1] + 1


def _bits(x: int):
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def _is(key: str, name: str | None) -> bool:
    return name is not None and (key == name or key.startswith(name + "."))


def _keys(nodes: list):
    for x in nodes:
        if isinstance(x, str):
            yield x
        else:
            yield from _keys(x[1])


def _boilerplate(t: Token) -> bool:
    return t.name in BOILERPLATE_TAGS or bool(t.words & BOILERPLATE_WORDS) and t.name not in ("body", "html", *CONTAINERS) \
        or bool(t.words & {"comment", "comments"})


def slots(toks: list[Token], region: tuple[int, int] | None = None) -> list[tuple[str, str, bool, bool]]:
    """Blocks of text in order: (path, text, inside an article element, inside boilerplate)."""
    first, last = region or (0, len(toks))
    out, path, parts, skip, in_article = [], [], [], None, 0

    def flush():
        text = " ".join(htmllib.unescape("".join(parts)).split())
        if text:
            out.append((">".join(path), text, in_article > 0, skip is not None))
        parts.clear()

    skip_depth = 0
    for i in range(first, last):
        t = toks[i]
        if t.kind == "text":
            parts.append(t.name)
            continue
        if t.kind == "space":
            parts.append(" ")
            continue
        if t.kind == "break":
            if t.words & BOILERPLATE_WORDS and skip is None and t.name in ("span", "a", "label"):
                flush()
                skip, skip_depth = "inline:" + t.name, 1
            elif skip == "inline:" + t.name:
                skip_depth += -1 if t.key.startswith("/") else 1
                if not skip_depth:
                    flush()
                    skip = None
            continue
        flush()
        if skip and skip.startswith("inline:"):
            skip = None
        if t.kind == "start":
            if t.name in OPTIONAL_END:  # closes an open element of the same name
                if t.name in path[-1:]:
                    path.pop()
                if skip == t.name:
                    skip = None
            elif skip == "p":
                skip = None
            path.append(t.name)
            if t.name in CONTAINERS and not (skip and skip not in CONTAINERS):
                in_article += 1
            if skip is None and _boilerplate(t):
                skip, skip_depth = t.name, 1
            elif skip == t.name:
                skip_depth += 1
        else:
            if t.name in path:
                del path[len(path) - 1 - path[::-1].index(t.name):]
            if skip == t.name:
                skip_depth -= 1
                if not skip_depth:
                    skip = None
            if t.name in CONTAINERS:
                in_article = max(0, in_article - 1)
    flush()
    return out


def main_text(page: str | None, wrapper: Wrapper | None) -> str:
    """The text blocks of the article, joined by an empty line."""
    if not page:
        return ""
    toks = tokens(page)
    region = wrapper.region(toks) if wrapper else None
    if region:
        return "\n\n".join(x for _, x, _, bad in slots(toks, region) if not bad)
    found = slots(toks)
    if any(t.kind == "start" and t.name in CONTAINERS for t in toks):
        return "\n\n".join(x for _, x, inside, bad in found if inside and not bad)
    constant = wrapper.constant if wrapper else frozenset()
    own = [(p, x) for p, x, _, bad in found if not bad]
    return "\n\n".join([x for p, x in own if p not in constant] or [x for _, x in own])


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(errors="replace"), digest_size=8).digest(), "big", signed=True)


def _observed(batches):
    """(host, kind, what, body, least, most, n): skeletons and, for pages without an article element, slot texts by body, the digest of all of them."""
    for b in batches:
        forms, texts = Counter(), defaultdict(list)
        for host, page in zip(b["host"], b["html"], strict=True):
            if not page:
                continue
            toks = tokens(page)
            forms[host, json.dumps(skeleton(toks))] += 1
            if not any(t.kind == "start" and t.name in CONTAINERS for t in toks):
                own = [(path, text) for path, text, _, bad in slots(toks) if not bad]
                body = _digest(json.dumps(own))
                for path, text in own:
                    texts[host, path, body].append(_digest(text))
        rows = [(h, "skeleton", s, 0, 0, 0, n) for (h, s), n in forms.items()]
        rows += [(h, "slot", p, body, min(v), max(v), 1) for (h, p, body), v in texts.items()]
        yield pd.DataFrame(rows, columns=["host", "kind", "what", "body", "least", "most", "n"])


def _fold_group(pdf: pd.DataFrame) -> pd.DataFrame:
    out = None
    for x in pdf.sort_values(["n", "nodes"], ascending=[False, True])["nodes"]:
        out = json.loads(x) if out is None else align(out, json.loads(x))
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], "nodes": [json.dumps(out)], "n": [int(pdf["n"].sum())]})


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, nodes as JSON, constant slot paths): one union-free expression per host."""
    own = pages.select(url_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    seen = own.mapInPandas(_observed, "host string, kind string, what string, body long, least long, most long, n long")
    seen = table(seen.groupBy("host", "kind", "what", "body").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n")), "skeletons")
    forms = seen.where("kind = 'skeleton'").select("host", F.col("what").alias("nodes"), "n")
    schema = "host string, nodes string, n long"
    salted = forms.withColumn("_salt", F.crc32("nodes") % FOLD_SALTS).groupBy("host", "_salt").applyInPandas(_fold_group, schema)
    folded = salted.groupBy("host").applyInPandas(_fold_group, schema).drop("n")
    # a row of each distinct page; pages without a host have no template in common
    paths = seen.where("kind = 'slot' and host is not null and host != ''").groupBy("host", "what").agg(
        F.count(F.lit(1)).alias("pages"), F.min("least").alias("least"), F.max("most").alias("most"))
    fixed = paths.where("pages >= 3 and least = most").groupBy("host").agg(F.sort_array(F.collect_set("what")).alias("constant"))
    return table(folded.join(fixed, "host", "left"), "wrappers")


@lru_cache(maxsize=512)
def _compiled(nodes: str, constant: tuple) -> Wrapper:
    return Wrapper(json.loads(nodes), frozenset(constant))


def extract_main_text(pages: DataFrame, wrappers: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row per page: id_col, url, text, n_chars.

    A null html has an empty text.  A page that its host's wrapper doesn't match (or without one) is cut by the element
    rules alone.  Repeated rows are extracted each; an empty table gives no rows; other columns are ignored.
    """
    if wrappers is None:
        wrappers = infer_wrappers(pages, url_col, html_col)
    own = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("url"), url_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    id_type = own.schema["_id"].dataType.simpleString()

    def extract(batches):
        for b in batches:
            texts = []
            for page, nodes, constant in zip(*(b.column(c).to_pylist() for c in ("html", "nodes", "constant")), strict=True):
                texts.append(main_text(page, _compiled(nodes, tuple(constant or ())) if nodes else None))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[id_col, "url", "text", "n_chars"])

    return own.join(wrappers, "host", "left").mapInArrow(extract, f"`{id_col}` {id_type}, url string, text string, n_chars long")

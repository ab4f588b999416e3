import html
import json
import random
import re

import pyarrow.parquet as pq

from geoindicators.llm import html_wrapper as H
from tests.conftest import SF_ORACLE


def plain_article(page):
    """Main text of the given pages by a plain cut: the article element, blocks at p and h1."""
    m = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    if not m:
        return ""
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<[a-zA-Z/][^>]*\Z", "", m[1]))
    return "\n\n".join(y for y in (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks) if y)


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, nodes string")


def run(spark, rows):
    return {r.page_id: (r.text, r.n_chars) for r in H.extract_main_text(pages(spark, rows)).collect()}


def test_given_pages_match_a_plain_cut(spark):
    t = pq.read_table(f"{SF_ORACLE}/pages.parquet").to_pydict()
    got = run(spark, list(zip(t["page_id"], t["url"], t["html"], strict=True)))
    for i, page in zip(t["page_id"], t["html"], strict=True):
        want = plain_article(page)
        assert got[i] == (want, len(want))


def site(i, paragraphs, aside=True, comments=False):
    body = "".join(f"<p>Paragraph {i}.{k} of <b>the</b> text &amp; more" + ("</p>" if k % 2 else "") for k in range(paragraphs))
    return (f"<!doctype html><html><head><title>T{i}</title><style>p{{}}</style></head><body><header><a href=/>Home</a></header>"
            f"<nav><ul>{''.join(f'<li><a href=/{k}>Menu {k}</a>' for k in range(3))}</ul></nav>"
            + (f"<aside class=sidebar><p>Side {i}</aside>" if aside else "")
            + f"<div id=cookie-notice>We use cookies</div><article><h1>Head {i}</h1>{body}<div class='ad box'><div>Buy {i}</div> now</div>"
            f"<form><input name=q><button>Go</button><p>Sign up</form><script>var x = '<p>no</p>';</script><p>Last\u00a0one&nbsp;<br>line\n two</article>"
            + (f"<section class='comments'><p>Reader {i}: hello</p></section>" if comments else "")
            + f"<footer>&copy; {i}</footer></body></html>")


def test_boilerplate_inside_and_around_the_article_goes(spark):
    rows = [(i, "http://h.example/x", site(i, 1 + i % 4, i % 2 == 0, i % 3 == 0)) for i in range(9)]
    rows += [(100, None, None), (101, "http://h.example/y", ""), (102, "http://h.example/z", "<p>plain <i>one</i>"), (103, "http://other/", "a < b &amp;"),
             (104, "http://h.example/t", site(4, 3)[:-260]), (2, "http://h.example/x", site(2, 3))]
    got = run(spark, rows)
    for i in range(9):
        blocks = [f"Head {i}", *[f"Paragraph {i}.{k} of the text & more" for k in range(1 + i % 4)], "Last one line two"]
        assert got[i][0] == "\n\n".join(blocks) and got[i][1] == len(got[i][0])
    assert got[100] == got[101] == ("", 0) and got[102][0] == "plain one" and got[103][0] == "a < b &"
    assert got[104][0].startswith("Head 4\n\nParagraph 4.0")


def test_pages_without_an_article_lose_what_all_pages_share(spark):
    page = "<html><body><div class=top>Welcome to the site</div><div class=box><p>Story number {0} about {0}</p><p>It ends {0}</p></div><div class=end>All rights reserved</div></body></html>"
    shared = "<html><body><section><p>{0} first</p></section><table><tr><td>Same on every page</table></body></html>"
    got = run(spark, [(i, "http://a/", shared.format(i)) for i in range(4)])
    assert {got[i][0] for i in range(4)} == {f"{i} first" for i in range(4)}
    got = run(spark, [(i, "http://b/", page.format(i)) for i in range(4)])
    assert all(f"Story number {i} about {i}" in got[i][0] for i in range(4))


def test_every_page_of_a_host_matches_its_wrapper():
    rng = random.Random(4)
    made = [site(i, rng.randrange(1, 9), rng.random() < 0.5, rng.random() < 0.5) for i in range(40)]
    nodes = None
    for p in made:
        s = H.skeleton(H.tokens(p))
        nodes = s if nodes is None else H.align(nodes, s)
    w = H.Wrapper(json.loads(json.dumps(nodes)), frozenset())
    regions = [w.region(H.tokens(p)) for p in made]
    assert all(regions)
    assert any(isinstance(x, list) and x[0] == "?" and "aside.sidebar" in H._keys(x[1]) for x in nodes)   # an optional group
    assert any(isinstance(x, list) and x[0] == "+" for x in nodes)   # a repeated group


def test_fold_and_align():
    assert H.fold(list("abababc")) == [["+", ["a", "b"]], "c"]
    assert H.fold(["a", ["+", ["a"]], "a"]) == [["+", ["a"]]]
    assert H.align(list("abc"), list("axc")) == ["a", ["?", ["b"]], ["?", ["x"]], "c"]
    assert H.align(["a", "c"], ["a", ["+", ["b"]], "c"]) == ["a", ["?", [["+", ["b"]]]], "c"]


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_a_very_long_page(spark):
    page = "<article>" + "".join(f"<p>block {i}</p>" for i in range(30_000)) + "</article>"
    [(text, n)] = run(spark, [(1, "http://long/", page)]).values()
    assert text.count("\n\n") == 29_999 and n == len(text)


def test_copies_and_equal_blocks_without_an_article_element_keep_their_text(spark):
    def page(title, *blocks):
        return f"<html><body><div><h1>{title}</h1>" + "".join(f"<p>{b}</p>" for b in blocks) + "<section>All rights reserved</section></div></body></html>"
    copied = page("Title", "Only block")
    rows = [(i, f"http://copies.example/{i}", copied) for i in range(4)]                       # one page, four times
    rows += [(10, "http://blocks.example/1", page("Again", "same", "same", "same"))]            # equal blocks on one page
    rows += [(20 + i, f"http://own.example/{i}", page(f"Title {i}", f"block {i}")) for i in range(3)]
    rows += [(30, "http://own.example/9", "<html><body><div><section>All rights reserved</section></div></body></html>")]
    rows += [(40 + i, None, page("No url", f"block {i}")) for i in range(3)]                   # no host: no template
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n\n") for r in H.extract_main_text(pages).collect()}
    assert all(got[i] == ["Title", "Only block", "All rights reserved"] for i in range(4))
    assert got[10] == ["Again", "same", "same", "same", "All rights reserved"]
    assert all(got[20 + i] == [f"Title {i}", f"block {i}"] for i in range(3))                  # the constant slot is template
    assert got[30] == ["All rights reserved"]
    assert all(got[40 + i] == ["No url", f"block {i}", "All rights reserved"] for i in range(3))


def test_long_irregular_pages_match_in_linear_time():
    import time

    rng = random.Random(5)
    start, pages = time.process_time(), 0
    for _ in range(6):
        kinds = [f"<p class='k{i}'>x{i}</p>" for i in range(4)] + ["<ul><li>a</li><li>b</li></ul>", "<div><p>q</p></div>", "<h2>t</h2>", "<table><tr><td>1</td></tr></table>"]
        toks = [H.tokens("<html><body><div>menu</div><article>" + "".join(rng.choice(kinds) for _ in range(rng.randrange(20, 60))) + "</article><div>foot</div></body></html>") for _ in range(6)]
        nodes = H.skeleton(toks[0])
        for t in toks[1:]:
            nodes = H.align(nodes, H.skeleton(t))
        w = H.Wrapper(nodes, frozenset())
        for t in toks:  # every page that the wrapper comes from matches it
            region = w.region(t)
            assert region is not None and t[region[0]].name == "article"
            pages += 1
    assert pages == 36 and time.process_time() - start < 60


def test_wrapper_accepts_what_its_expression_says():
    import re

    rng = random.Random(6)

    def build(depth):
        return [rng.choice("ab") if depth == 0 or rng.random() < 0.6 else [rng.choice("?+"), build(depth - 1)] for _ in range(rng.randrange(1, 4))]

    def text(nodes):
        return "".join(x if isinstance(x, str) else f"(?:{text(x[1])}){x[0]}" for x in nodes)

    for _ in range(400):
        nodes = build(2)
        w = H.Wrapper(nodes, frozenset())
        for _ in range(20):
            s = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 9)))
            assert (w._paths(list(s)) is not None) == bool(re.fullmatch(text(nodes), s))

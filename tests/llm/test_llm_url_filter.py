import itertools
import random

from geoindicators.llm import url_filter as U
from geoindicators.llm.queries import URL_RULES


def brute(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(h.count("."), len(p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


URLS = ["http://" + h + p for h, p in itertools.product(
    ["com", "a.com", "EXAMPLE.com", "www.example.com", "x.www.example.com", "xexample.com", "net", "b.net", "org", "com.", ".com", "a.com:80", "u@a.com", "É.com"],
    ["", "/", "/en", "/en/", "/en/1?x=/fr/", "/es/#top", "/fr/2.html", "?q=1", "#f", "//en/", "/EN/", "/en//x"])] + [
    None, "", "www.example.com/en/", "://", "a://b://c/d", "mailto:x@y.com", "http:///path", "http://a.com/\nen/"]


def frame(spark, urls):
    return spark.createDataFrame([(i if i % 7 else None, u, "r", "v") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")


def test_trie_and_join_match_brute_force(spark):
    rng = random.Random(3)
    more = [(h, p, v) for h in ("com", "example.com", "www.example.com", "net") for p in ("/", "/e", "/en", "/en/1", "") for v in ("allow", "block") if rng.random() < 0.6]
    for rules in (URL_RULES, more, []):
        df = frame(spark, URLS)
        r = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string")
        want = sorted(str(brute(u, rules)) for u in URLS)
        for judge in (U.judge_urls, U.judge_by_join):
            got = judge(df, r.dropna()).collect()
            assert sorted(str((x.host, x.path, x.rule, x.verdict)) for x in got) == want
            assert sorted(map(str, (x.page_id for x in got))) == sorted(map(str, (x.page_id for x in df.collect())))


def test_larger_lists_go_through_the_join(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_RULES", 2)
    r = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    df = U.judge_urls(frame(spark, URLS), r)
    assert "MapInArrow" not in df._jdf.queryExecution().toString()
    assert sorted(str((x.host, x.path, x.rule, x.verdict)) for x in df.collect()) == sorted(str(brute(u, URL_RULES)) for u in URLS)


def test_empty_table(spark):
    r = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    assert U.judge_urls(frame(spark, []), r).collect() == []

"""URL rules against trying every rule."""

from __future__ import annotations

import re

from strata.llm import queries, urls
from tests.llm.helpers import SF, given

ODD = [
    None, "", "no scheme", "http://", "HTTP://Example.ORG/en/1", "http://example.org/en/12?x=/es/", "x://a.b.EXAMPLE.org/es/#f",
    "http://notexample.org/es/", "http://example.org:80/es/", "http://example.org?/es/", "http://org/", "http://org", "a://b://c.com/de/x",
    "http://x.com/fr/\nline", "http://x.com/de", "http://x.com/de/", "http://example.org/en//1", "http://\u00c9.ORG/x", "x" * 100_000 + "://a.org/" + "y/" * 50_000,
]


def split(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def expected(url, rules, default="allow"):
    host, path = split(url)
    fits = []
    for i, (verdict, rule) in enumerate(rules):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((-len(rule), i, rule, verdict))
    return (host, path, *(min(fits)[2:] if fits else (None, default)))


def test_query_urls(spark):
    want = [(r.page_id, *expected(r.url, queries.RULES)) for r in given(spark, "pages").select("page_id", "url").collect()]
    got = queries.op4_url_rules(spark, SF).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_odd_urls(spark):
    data = [(i, u, "h", "p", 1) for i, u in enumerate(ODD)] + [(3, "http://org/", None, None, 1), (None, "http://x.com/de/", "h", "p", 2)]
    df = spark.createDataFrame(data, "page_id long, url string, host string, path string, key int")
    rules = [*queries.RULES, ("block", "org/"), ("block", "c.com/de/")]
    got = urls.judge(df, rules).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, *expected(u, rules)) for i, u, *_ in data), key=repr)
    assert urls.judge(df.where("false"), rules).collect() == []
    assert {r.verdict for r in urls.judge(df, [], default="block").collect()} == {"block"}

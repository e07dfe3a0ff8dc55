"""URL filter against plain evaluation of every rule."""

import re

import pytest
from oracle import connect, difference

from marketlane.llm import queries, url_rules

URLS = [
    "https://a.example.org/en/12?x=1", "http://EXAMPLE.ORG/es/", "https://notexample.org/es/1", "https://shop.com/fr/a",
    "https://x.com/de/", "https://x.com", "no scheme/at/all", None, "", "://", "https://ads-track.example.com/fr/1",
    "https://ads-track.example.com/en/1", "https://my-casino.net/x", "http://a.net/ads/1", "http://u@h.org:80/de/x#y?z",
    "https://a.com/fr", "ftp://ünï.org/é/?q=http://x.com/de/", "https://a.net/p?affiliate_id=3",
]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    tail = rest[len(host) + len(path) :]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if re.search(r.pattern, host + path + tail)]
    best = max((r for r in fits if r.listed), key=lambda r: (len(r.text), r.text), default=None)
    if best:
        return host, path, best.text[2:], best.verdict
    return host, path, None, "block" if any(r.verdict == "block" for r in fits if not r.listed) else "allow"


def test_equals_sql(spark, folder):
    df = queries.QUERIES["op9_url_filter"](spark, folder)
    assert difference(df, connect(folder), queries.ORACLES["op9_url_filter"]) is None


def test_every_rule_is_found_through_its_token(spark):
    rules = queries.URL_RULES + [url_rules.Rule("*.zip|"), url_rules.Rule("|h.net/a*b^"), url_rules.Rule("x", "allow")]
    urls = [*URLS, "http://h.net/a1b/", "http://h.net/q/f.zip", "http://h.net/ab"] * 2
    rows = [(i, u, "kept", i) for i, u in enumerate(urls)]
    df = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string, extra string, rule int"), rules)
    assert df.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict", "n_rules"]
    for r in df.collect():
        assert (r.host, r.path, r.rule, r.verdict) == plain(urls[r.page_id], rules), urls[r.page_id]


def test_empty_table(spark):
    assert url_rules.judge(spark.createDataFrame([], "url string"), queries.URL_RULES).count() == 0


@pytest.mark.parametrize(
    "text, tokens", [("||example.org/en/1", ["en", "example", "org"]), ("ads", []), ("/ads/", ["ads"]), ("|a*b|", ["b"][:0]), ("-x^", ["x"])]
)
def test_tokens_are_whole_words(text, tokens):
    assert url_rules.Rule(text).tokens == tokens


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", 7, 8, 9)], "page_id long, url string, _subject int, HOST int, _hits int")
    out = url_rules.judge(pages, queries.URL_RULES)
    assert out.columns == ["page_id", "url", "_subject", "_hits", "host", "path", "rule", "verdict", "n_rules"]
    assert tuple(out.first())[:7] == (1, "http://a.org/x", 7, 9, "a.org", "/x", "org/")

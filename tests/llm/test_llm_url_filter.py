import random

import pytest

from ledgerlens.llm import url_filter
from ledgerlens.llm.queries import URL_RULES

ODD = [None, "", "no scheme", "http://", "http://ORG/x", "https://a.Example.org/es/1?q#f", "x://example.org/en/1",
       "http://example.org?x=/es/", "http://b.com/fr/", "http://b.com/de/#/fr/", "http://notexample.org/es/",
       "ftp://a.b.c.org/", "http://org/", "://com/fr/x://y", "http://ex.com:80/fr/", "http://a..com/fr/", "http://é.com/de/ü"]


def expected(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [
        (len(h + p), v, h + p) for v, h, p in rules
        if h and host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[1] if best else default


@pytest.mark.parametrize("limit", [100_000, 0])
def test_verdicts_match_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", limit)
    rng = random.Random(5)
    urls = ODD + [
        f"{rng.choice(['http', 'https'])}://{rng.choice(['', 'm.', 'a.b.'])}{rng.choice(['example.org', 'x.org', 'y.com', 'z.net'])}"
        f"/{rng.choice(['es', 'en', 'fr', 'de'])}/{rng.randrange(30)}{rng.choice(['', '?a=1', '#x'])}"
        for _ in range(150)
    ]
    rules = [*URL_RULES, ("allow", "example.org", "/es/1"), ("block", "example.org", "/es/1"), ("block", "", "/"), ("block", "net", "")]
    pages = spark.createDataFrame([(k % 90 if k % 7 else None, u, "h", "r") for k, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string")
    out = url_filter.url_filter(pages, url_filter.rule_table(spark, rules))
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect()), key=str)
    want = [(k % 90 if k % 7 else None, *expected(u, rules)) for k, u in enumerate(urls)]
    assert got == sorted(want, key=str)


def test_no_rules_and_no_pages(spark):
    none = url_filter.rule_table(spark, [])
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.url_filter(pages, none, "block").collect()] == [(1, "a.org", "/", None, "block")]
    rules = url_filter.rule_table(spark, URL_RULES)
    assert url_filter.url_filter(pages.limit(0), rules).count() == 0


def test_hosts_of_very_many_labels(spark):
    host = "a." * 100_000
    urls = [f"http://{host}example.org/es/1", f"http://{host}com/de/", f"http://{host}net/", "http://.org/", "http://org./"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = url_filter.url_filter(pages, url_filter.rule_table(spark, URL_RULES))
    got = sorted((r.page_id, r.rule, r.verdict) for r in out.select("page_id", "rule", "verdict").collect())
    assert got == [(k, *expected(u, URL_RULES)[2:]) for k, u in enumerate(urls)]

import pytest

from stormfare.llm import urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"), ("block", "c.com", "/fr"), ("allow", "ab.com", "/f")]
PAGES = [
    None, "", "no scheme", "http://", "http:///x", "http://example.org", "http://example.org/", "https://EXAMPLE.org/es/1?x#y",
    "http://a.b.example.org/en/123", "http://example.org/en/2", "http://badexample.org/es/", "http://x.com/fr/1",
    "http://x.com/de/", "http://c.com/fr/", "http://c.com?q=/fr/", "http://x.net/a://b", "http://a.ab.com/fx",
    "ftp://org/es/", "http://..org/", "http://example.org./es/", "http://x.com/fr/" + "a" * 50_000, "http://example.org/es/1?x",
]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), a == "block", h + p, a) for a, h, p in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_verdicts_equal_brute_force(spark):
    rules = spark.createDataFrame(RULES + RULES[:2], "action string, host string, path string")
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(PAGES)], "page_id long, url string, host string")
    found = {r.page_id: tuple(r)[1:] for r in urls.judge_urls(pages, rules).collect()}
    assert found == {i: brute(u) for i, u in enumerate(PAGES)}


@pytest.mark.parametrize("rules, pages", [(RULES, []), ([], PAGES[:8]), ([], [])])
def test_empty_tables_and_repeated_rows(spark, rules, pages):
    listed = spark.createDataFrame(rules, "action string, host string, path string")
    given = spark.createDataFrame([(7, u) for u in pages] * 2, "page_id long, url string")
    rows = urls.judge_urls(given, listed, default="block").collect()
    assert len(rows) == 2 * len(pages) and all((r.rule, r.verdict) == (None, "block") for r in rows)

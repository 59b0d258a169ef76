import re

import pytest

from peakwise.llm import queries, url_rules

SF_DIR = "/root/testdata/sf0.01"
RULES = [(v, h, p) for v, h, p in queries.URL_RULES]


def judged(url, rules):
    """Host, path, rule and verdict by trying every rule."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.DOTALL).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://a.net/", "HTTP://A.NET/x?y#z",
    "http://example.net/en/1", "http://m.example.net/en", "http://m.example.net/en/",
    "https://example.com/de/5?x=/fr/", "https://x.org/fr/", "https://x.org#/fr/", "http://net:80/",
    "http://planet/", "a://b://c.net/d", "http://.net/", "http://É.net/é", "http://a.net/" + "x" * 9999,
    "http://example.net//en/", "://net/", "http://user@a.net/en/",
]


def test_query_against_every_rule(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect()
    df = queries.op4_url_filter(spark, SF_DIR)
    assert sorted(map(tuple, df.collect())) == sorted(
        (p.page_id, *judged(p.url, RULES)) for p in pages)


def test_edges_repeated_rows_and_clashing_columns(spark):
    rows = [(i // 2, u, "x", "y") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    got = url_rules.filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")
    key = lambda r: tuple(str(x) for x in r)
    expected = [(i // 2, *judged(u, RULES)) for i, u in enumerate(URLS)]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)
    assert url_rules.filter_urls(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in url_rules.filter_urls(pages, [], "block").collect()} == {"block"}


@pytest.mark.parametrize("hash_of", [url_rules.digest, lambda text: len(text) % 3, lambda text: 7])
def test_colliding_digests_are_told_apart(tmp_path, hash_of):
    rules = [("block", f"h{i}.example", "/" + "a" * (i % 4)) for i in range(60)]
    rules += [("allow", "x.h7.example", "/"), ("allow", "h8.example", "/"), ("block", "h8.example", "/")]
    path = tmp_path / "rules"
    path.write_bytes(url_rules.RuleFile.pack(rules, hash_of))
    listed = url_rules.RuleFile(str(path), hash_of)
    urls = [f"http://{sub}h{i}.example/{'a' * n}" for i in range(0, 62, 3) for n in (0, 2)
            for sub in ("", "x.", "h3.")]
    split = [url_rules.host_and_path(u) for u in urls]
    for u, (rule, verdict) in zip(urls, listed.judge(split)):
        _, _, expected, fits = judged(u, rules)
        assert (rule, verdict or "allow") == (expected, fits)


def test_rules_are_checked():
    with pytest.raises(ValueError):
        url_rules.RuleFile.pack([("maybe", "net", "/")])
    with pytest.raises(ValueError):
        url_rules.RuleFile.pack([("block", "", "/")])


def test_columns_with_dots(spark):
    pages = spark.createDataFrame([("http://a.net/", 1)], "url string, `a.b` int")
    got = url_rules.filter_urls(pages, RULES)
    assert got.columns == ["url", "a.b", "host", "path", "rule", "verdict"]
    assert got.first().verdict == "block"

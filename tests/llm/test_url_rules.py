import pytest

import check_oracle
from touchline.llm import url_rules

SF = "/root/testdata/sf0.001"
URLS = [None, "", "no scheme", "http://", "http://COM/", "http://example.com/en/x?y#z", "https://www.Example.com/en/", "http://a.www.example.com/en/1", "http://example.com", "http://example.com?q=/en/", "http://xexample.com/en/", "ftp://net/es/", "http://x.net/fr", "http://x.net/fr/", "http://x.org/en/", "http://example.com:80/en/", "a://b://c.com/d"]


def brute(url):
    host, path = url_rules.split_url(url)
    fits = [(host_ + path_, v) for v, host_, path_ in url_rules.QUERY_RULES if (host == host_ or host.endswith("." + host_)) and path.startswith(path_)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
    return host, path, rule, verdict


def test_odd_urls_repeats_and_clashing_columns(spark):
    rows = [(i % 9, u, "host?", "x") for i, u in enumerate(URLS + URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = sorted(map(str, (tuple(r) for r in url_rules.judge(pages).collect())))
    assert got == sorted(str((k, *brute(u))) for k, u, *_ in rows)
    assert url_rules.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("url", "rule", "verdict"),
    [
        ("http://a.b.c/x/y", "b.c/x/", "block"),
        ("http://b.c/x/yz", "b.c/x/yz", "allow"),
        ("http://b.c/x/y", "b.c/x/", "block"),
        ("http://z/x", "/", "allow"),
        ("http://c/t", "c/t", "block"),
    ],
)
def test_longest_match(url, rule, verdict):
    rules = [("allow", "", "/"), ("block", "b.c", "/x/"), ("allow", "b.c", "/x/yz"), ("allow", "c", "/t"), ("block", "c", "/t"), ("allow", "c", "/t")]
    assert url_rules.RuleTrie(rules).match(*url_rules.split_url(url)) == (rule.replace("/", "/", 1), verdict)


def test_op6_equals_its_sql(spark):
    assert check_oracle.compare(spark, check_oracle.connect(SF), "op6_url_filter", SF)[0] == "ok"

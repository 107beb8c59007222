import re

from tidemart.llm.queries import URL_RULES
from tidemart.llm.url_filter import UrlRule, filter_urls, host_of, path_of, with_rule

LINK = '<head><LINK data-x="1" rel="canonical" href="{}"></head>'
META = "<meta http-equiv='Refresh' content='0; URL={}'>"


def pages(spark, *rows):
    df = spark.createDataFrame(list(rows), "page_id long, url string, html string")
    return df.selectExpr("*", "'x' AS host", "'x' AS path", "'x' AS rule", "'x' AS node", "1 AS n", "true AS allow", "'x' AS best")


def verdicts(df):
    return {r.page_id: (r.rule, r.verdict) for r in df.collect()}


def test_parts_and_longest_rule(spark):
    got = filter_urls(pages(
        spark,
        (1, "HTTP://M.Example.NET/en/1?a=/de/#x", None), (2, "http://example.net/fr/1", None), (3, "http://notexample.com/de/1", None),
        (4, "http://a.b.example.com/de/", None), (5, "http://x.org/fr/", None), (6, "http://a.net", None), (7, None, None),
        (8, "example.net/en/", None), (9, "http://net/", None), (10, "", None), (11, "x://y://z.net/", None),
    ), URL_RULES)
    rows = {r.page_id: r for r in got.collect()}
    assert (rows[1].host, rows[1].path) == ("m.example.net", "/en/1")
    assert (rows[11].host, rows[11].path) == ("y:", "//z.net/")
    assert verdicts(got) == {
        1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: (None, "allow"), 4: ("example.com/de/", "block"),
        5: ("org/fr/", "allow"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: ("net/", "block"),
        10: (None, "allow"), 11: (None, "allow")}
    assert all(rows[k].host == rows[k].path == "" for k in (7, 8, 10))


def test_aliases_take_the_groups_decision(spark):
    got = filter_urls(pages(
        spark,
        (1, "http://one.test/a#top", LINK.format("https://bad.net/x")),         # blocked by its canonical address
        (2, "http://two.test/b", META.format("http://ONE.test/a")),             # and what redirects to it
        (3, "http://two.test/b", "<p>copy</p>"),                                # and the same URL again
        (4, "http://two.test/c", META.format("/b")),                            # by a relative target
        (5, "http://three.test/", LINK.format("http://x.org/fr/1")),
        (6, "http://four.test/", META.format("http://three.test/")),
        (7, "http://q.net/1", LINK.format("http://four.test")),                 # own rule stays; group holds an allow
        (8, "http://five.test/", LINK.format("http://six.test/")),              # no decision in the group
        (9, "http://seven.test/", None), (10, "http://six.test/?a=1&b=2", LINK.format("http://z.net/?x=1&amp;y")),
    ), URL_RULES)
    assert verdicts(got) == {
        1: (None, "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "block"), 5: (None, "allow"), 6: (None, "allow"),
        7: ("net/", "block"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "block")}


def test_redirects_given_beside(spark):
    moved = spark.createDataFrame([("http://a.test/", "http://bad.net/"), (None, "http://a.test/")], "from_url string, to_url string")
    got = filter_urls(pages(spark, (1, "http://a.test", None), (2, "http://b.test", None)), URL_RULES, moved)
    assert verdicts(got) == {1: (None, "block"), 2: (None, "allow")}


def test_empty_table_and_no_rules(spark):
    assert filter_urls(pages(spark, (1, "http://a.net/", None)).where("false"), URL_RULES).count() == 0
    assert verdicts(filter_urls(pages(spark, (1, "http://a.net/", None)), [])) == {1: (None, "allow")}


def test_many_rules_equal_few_rules(spark):
    rules = [UrlRule(f"{h}", p, (len(h) + len(p)) % 2 == 0) for h in ("net", "a.net", "b.a.net", "com", "x.com") for p in ("/", "/a", "/a/b", "/z/")]
    urls = spark.createDataFrame(
        [(f"http://{h}{p}",) for h in ("net", "q.a.net", "b.a.net", "ba.net", "x.com", "", "org") for p in ("", "/", "/ab", "/a/b/c", "/zz")], "u string")
    urls = urls.select("u", host_of(urls.u).alias("host"), path_of(urls.u).alias("path"))
    few, many = (sorted((r.u, r.rule or "", r.allow) for r in with_rule(urls, rules, k).collect()) for k in (64, 0))
    assert few == many
    for u, rule, _ in few:
        host, path = re.match(r".*?://([^/?#]*)([^?#]*)", u).groups()
        fits = [r.text for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        assert rule == max(fits, key=len, default="")

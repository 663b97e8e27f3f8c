import re

import pytest

from tabscope.llm import queries, urlfilter
from tests.conftest import SMALL
from verification.compare import connect, difference

ODD = [
    None, "", "no scheme", "://", "http://", "https://Example.ORG", "http://EXAMPLE.org/en/1x?q#f",
    "http://sub.example.org/en/2", "http://org/", "http://org.evil.com/de/x", "ftp://a.com/fr/?x=://b.org/",
    "http://notexample.org/es/", "http://a.com?/de/", "http://a.com#/de/", "http://x.COM/de/ü",
    "http://ÄB.org/", "http://a..org/", "http://.org/x", "http://com/fr/", "a://b://c.org/",
]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule in rules:
        rule_host, _, rule_path = rule.partition("/")
        fits = host == rule_host or host.endswith("." + rule_host)
        if fits and path.startswith("/" + rule_path):
            if best is None or (len(rule), rule, verdict) > best:
                best = (len(rule), rule, verdict)
    return host, path, best and best[1], best[2] if best else "allow"


@pytest.mark.parametrize("salted", [False, True])
def test_odd_urls(spark, rows, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(urlfilter, "small_side", lambda df, rows, size: df)
    rules = [(v, h + p) for v, h, p in queries.URL_RULES]
    rules += [("block", "org.evil.com/"), ("allow", "org.evil.com/"), ("block", "b.org/x/y"), (None, "c/")]
    frame = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(ODD)] * 2,
                                  "page_id long, url string, host string, rule long")
    listed = spark.createDataFrame(rules, "verdict string, rule string")
    want = [(i, *plain(u, [r for r in rules if r[0]])) for i, u in enumerate(ODD)] * 2
    assert rows(urlfilter.judge(frame, listed)) == sorted(want, key=repr)


def test_empty_rules_and_pages(spark):
    frame = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = spark.createDataFrame([], "verdict string, rule string")
    assert urlfilter.judge(frame, none).first().verdict == "allow"
    one = spark.createDataFrame([("block", "a.org/")], "verdict string, rule string")
    assert urlfilter.judge(frame, one).first().verdict == "block"
    assert urlfilter.judge(frame.where("false"), one).count() == 0


def test_filter_passes_all_rules_and_few_others(spark):
    rules = spark.range(3000).selectExpr("concat('h', id, '.com/a') AS rule", "'block' AS verdict")
    pages = spark.range(6000).selectExpr("id AS page_id", "concat('http://h', id, '.com/ab') AS url")
    judged = urlfilter.judge(pages, rules)
    assert judged.where("verdict = 'block'").count() == 3000
    blocks = 3000 // urlfilter.RULES_A_BLOCK + 1
    assert urlfilter.bloom_blocks(rules, blocks).count() <= blocks


def test_query_equals_its_sql(spark):
    made = queries.url_verdicts(spark, SMALL)
    assert difference(made, connect(SMALL), queries.URL_SQL) is None
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

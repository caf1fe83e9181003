"""Operator 3 against a plain loop over the rules."""

import random
import re

from millrace.llm import urlrules


def plain(url, rules, default):
    match = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda m: m.group().lower(), match.group(1)) if match else ""
    path = match.group(2) if match else ""
    fits = []
    for rule_host, rule_path, action in rules:
        rule_host, rule_path = (rule_host or "").lower(), rule_path or ""
        if (host == rule_host or host.endswith("." + rule_host) or not rule_host) and path.startswith(rule_path):
            fits.append((len(rule_host + rule_path), len(rule_host), action or "block", rule_host + rule_path))
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


def test_against_plain_loop(spark):
    rng = random.Random(3)
    labels = ["a", "b", "net", "org", "x-y", "b0", "é"]
    rules = [("net", "/", "block"), ("a.net", "/en/", "allow"), ("b.a.net", "", "block"), ("org", "/fr/", "allow"), ("a.org", "/fr/x/", "block"), (None, "/zz", None), ("a.net", "/en/", "allow"), ("net", "/", "allow")]
    urls = [None, "", "no scheme", "http://", "http://NET", "ftp://a.net?x=://b", "://org/fr/", "http://..net/", "http://a.net/en/" + "p" * 20000, "http://x/y\nz"]
    for _ in range(400):
        host = ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
        urls.append(f"http://{host}{rng.choice(['', '/', '/en/1', '/fr/x/2', '/fr/', '/zz', '/en?q', '#f'])}")
    rows = [(k, u, "old", 1) for k, u in enumerate(urls)] + [(1, urls[20], "old", 1)] * 50
    pages = spark.createDataFrame(rows, "page_id bigint, url string, verdict string, key int")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    found = urlrules.judge_urls(pages, table)
    assert found.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"]
    found = found.collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain(r["url"], rules, "allow"), r["url"]


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://a/b"), (None, None)], "page_id bigint, url string")
    assert {r["verdict"] for r in urlrules.judge_urls(pages, none, default="block").collect()} == {"block"}
    assert urlrules.judge_urls(pages.limit(0), none).count() == 0


def test_runs_no_python(spark):
    rules = spark.sql("SELECT 'net' AS host, '/' AS path, 'block' AS action")
    df = urlrules.judge_urls(spark.sql("SELECT 1L AS page_id, 'http://a.net/' AS url"), rules)
    assert "Python" not in df._jdf.queryExecution().toString()

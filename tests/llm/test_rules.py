"""Operators 1 and 4 against their SQL and brute force."""

from __future__ import annotations

import re

import duckdb
import pytest

from tests.compare import connect, differences
from wickframe.llm import quality, registry, urls

from .rows import EDGE_ROWS, SF_DIR

URLS = [
    (1, None), (2, ""), (3, "no scheme/org"), (4, "http://example.org"), (5, "http://example.org/"),
    (6, "HTTPS://WWW.Example.ORG/es/x?y#z"), (7, "http://example.org/es"), (8, "http://notexample.org/es/"),
    (9, "http://a.b.example.org/en/12"), (9, "http://a.b.example.org/en/12"), (10, "http://x.com/de/1"),
    (11, "http://com/de/"), (12, "http://x.com/fr/../de/"), (13, "x://y.com:80/de/"), (None, "http://org/a?b://c"),
    (14, "a://b://c/d"), (15, "http://example.org?es/"), (16, "http://.org/"), (17, "http:///es/"), (18, "http://org./"),
]


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_sql_twin(spark, name):
    query = registry.QUERIES[name]
    assert differences(query(spark, SF_DIR), connect(SF_DIR), registry.ORACLE[name]) == ""


def twin(view: str, table, sql: str):
    db = duckdb.connect()
    db.register(view, table)
    return db.sql(sql).fetchall()


def test_quality_edge_rows(documents):
    repeats = [(20, "a b c d e " * 3), (21, "q a b c d e r a b c d e"), (22, "x\nx\n\n \ny\nx"), (23, "#*$%&|<> !! " * 20)]
    docs = documents(EDGE_ROWS + repeats)
    found = quality.judge(docs).select(quality.RESULT)
    wanted = twin("documents", docs.toArrow(), quality.SQL)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted, key=repr)


def repeated(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    return len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)})


def test_repeated_windows_by_brute_force(documents):
    texts = ["a " * n for n in range(1, 12)] + ["a b c d e f a b c d e f g", "a b c d e a b c d e", "k l m n o x k l m n o p"]
    found = {r["doc_id"]: r["n_repeat_words"] for r in quality.judge(documents(list(enumerate(texts)))).collect()}
    assert found == {i: repeated(text) for i, text in enumerate(texts)}


def test_rules_are_one_projection_without_functions(spark, documents):
    plan = quality.judge(documents(EDGE_ROWS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas|Generate|Aggregate", plan)


def test_own_rules_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 7, 1), (2, "a " * 30, 8, 2)], "doc_id int, body string, n_words int, text int")
    rule = quality.Rule("short", "n_words / n_lines", high=5)
    found = quality.judge(docs, "body", ("doc_id",), (rule,)).select("doc_id", "failed").collect()
    assert [tuple(r) for r in sorted(found)] == [(1, []), (2, ["short"])]
    assert all(r["failed"] == [] for r in quality.judge(docs, "body", ("doc_id",), ()).collect())


def test_urls_edge_rows(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in URLS], "page_id bigint, url string, host string")
    found = urls.judge(pages, urls.rule_table(spark)).collect()
    wanted = twin("pages", pages.toArrow(), urls.SQL)
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_nested_rules_by_brute_force(spark):
    paths = ["/", "/a", "/a/", "/a/b", "/ab", "/b", "/a/b/c"]
    rules = [("allow" if k % 2 else "block", f"{host}{path}") for k, (host, path) in enumerate((h, p) for h in ("x.y", "y", "z.x.y") for p in paths)]
    found_urls = [(k, f"http://{host}{path}{tail}") for k, (host, path, tail) in enumerate((h, p, t) for h in ("x.y", "w.x.y", "z.x.y", "y", "xy") for p in paths for t in ("", "c", "/"))]
    pages = spark.createDataFrame(found_urls, "page_id bigint, url string")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, urls.rule_table(spark, rules), salts=3).collect()}
    for page, url in found_urls:
        host, _, path = url.split("//")[1].partition("/") if "//" in url else ("", "", "")
        path = "/" + url.split("//", 1)[1].partition("/")[2]
        host = url.split("//", 1)[1].partition("/")[0]
        fits = []
        for verdict, rule in rules:
            rule_host, _, rest = rule.partition("/")
            if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rest):
                fits.append((len(rule), rule, verdict))
        assert found[page] == (max(fits)[1:] if fits else (None, "allow"))


def test_no_pages_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    rules = urls.rule_table(spark)
    assert urls.judge(none, rules).collect() == []
    pages = spark.createDataFrame(URLS, "page_id bigint, url string")
    assert all(r["rule"] is None for r in urls.judge(pages, rules.limit(0)).collect())
    conflict = urls.rule_table(spark, [("allow", "org/"), ("block", "org/")])
    assert {r["verdict"] for r in urls.judge(pages, conflict).where("rule is not null").collect()} == {"block"}


@pytest.mark.parametrize("name", ["op1_quality_rules", "op4_url_filters"])
def test_no_python_in_native_plans(spark, name):
    plan = registry.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_only_rules_of_hot_hosts_are_copied(spark, monkeypatch):
    """Many hosts of few urls and one of many: results as by SQL, and cold hosts are swept once."""
    monkeypatch.setattr(urls, "HOT_HOSTS", 5)
    hosts = [f"h{k}.example.org" for k in range(60)] + ["fr.com"] * 40 + ["de.com"] * 3
    rows = [(k, f"http://{host}/{('es', 'en/1', 'fr', 'de/x')[k % 4]}/p{k}") for k, host in enumerate(hosts)] + [(200, None), (201, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    tops = urls._hot(spark.createDataFrame([("org",)] * 60 + [("com",)] * 43 + [("com.de",)] * 3, "top string"))
    assert {r["top"] for r in tops.collect()} == {"org", "com"}
    found = urls.judge(pages, urls.rule_table(spark)).collect()
    wanted = twin("pages", pages.toArrow(), urls.SQL)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))

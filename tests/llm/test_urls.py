import pytest
from pyspark.sql import functions as F

from odd_documents import SF
from gaugeworks.llm import url_templates
from gaugeworks.llm.queries import ORACLES, QUERIES, URL_RULES
from oracle import connect, differs


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme/at all", "", "", None, "allow"),
    ("http://", "", "", None, "allow"), ("HTTP://WWW.Example.NET/en/1", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("x://a.net", "a.net", "", None, "allow"), ("x://a.net/", "a.net", "/", "net/", "block"), ("x://net/q?u=://b.org/fr/", "net", "/q", "net/", "block"),
    ("x://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"), ("x://é.example.com/de/#a", "é.example.com", "/de/", "example.com/de/", "block"),
    ("x://b.org/fr/", "b.org", "/fr/", "org/fr/", "allow"), ("x://b.org/fr", "b.org", "/fr", None, "allow"), ("x://a.net?x/y", "a.net", "", None, "allow"),
])
def test_rules(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, None, "kept", 7)], "page_id long, url string, good int, shape string, _salt int")
    got = url_templates.judge_urls(df, URL_RULES).collect()[0]
    assert (got.host, got.path, got.rule, got.verdict, got["shape"], got._salt) == (host, path, rule, verdict, "kept", 7)


def test_templates_with_bad_labels_are_rejected(spark):
    rows = [(f"http://h.com/{kind}/{name}{i}/x", good) for i in range(60) for kind, name, good in (
        ("spam", "", 0), ("news", "", 1), ("user", "abcdefghijklmnopqrstuvwxyz"[i % 26] * (i // 26 + 1) + "q", int(i % 2 == 0)))]
    rows += [("http://h.com/spam/999/x", None), ("http://h.com/spam", None), ("http://other.com/spam/1/x", None)]
    df = spark.createDataFrame(rows, "url string, good int").selectExpr("monotonically_increasing_id() as page_id", "url", "good")
    got = {}
    for r in url_templates.judge_urls(df, URL_RULES).collect():
        got.setdefault((r.host, r.path.split("/")[1] if "/" in r.path else ""), set()).add((r.path, r.verdict))
    assert {v for p, v in got["h.com", "spam"] if p != "/spam"} == {"block"}
    assert {v for _, v in got["h.com", "news"]} == {"allow"} and {v for _, v in got["h.com", "user"]} == {"allow"}
    assert {v for _, v in got["other.com", "spam"]} == {"allow"}


def made_pages(spark, rows):
    return spark.createDataFrame(rows, "url string, good int").selectExpr("monotonically_increasing_id() as page_id", "url", "good")


NAMES = ["".join("abcdefghij"[int(c)] for c in f"{i:03d}") for i in range(300)]


@pytest.mark.parametrize("pages", [1, 2, 3, 5, 50])
def test_variable_names_are_one_template_however_many_pages_they_have(spark, pages):
    rows = [(f"http://h.com/user/{n}/buy", 0) for n in NAMES for _ in range(pages)]
    rows += [(f"http://h.com/user/{n}/home", 1) for n in NAMES for _ in range(3 * pages)]
    rows += [(f"http://h.com/user/unseen{n}/{k}", None) for n in NAMES[:20] for k in ("buy", "home")]
    got = url_templates.judge_urls(made_pages(spark, rows), []).collect()
    assert len(got) == len(rows) and {(r.path.rsplit("/", 1)[1], r.verdict) for r in got} == {("buy", "block"), ("home", "allow")}
    assert {r.rule for r in got} == {None}


def test_two_variable_segments_below_each_other(spark):
    rows = [(f"http://h.com/u/{n}/{NAMES[(7 * k + j) % 300]}x/{end}", good) for k, n in enumerate(NAMES) for j in range(3)
            for end, good in (("offer", 0), ("view", 1), ("view", 1))]
    got = url_templates.judge_urls(made_pages(spark, rows), URL_RULES).collect()
    assert {(r.path.rsplit("/", 1)[1], r.verdict) for r in got} == {("offer", "block"), ("view", "allow")}
    shapes = made_pages(spark, rows).selectExpr("'h.com' as host", "substring_index(url, 'h.com/', -1) as shape", "good").groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count("good").alias("labels"), F.sum("good").alias("goods"))
    assert {tuple(r.t) for r in url_templates.generalised(shapes, F.lit(0.5)).collect()} == {("u", "*", "*", "offer"), ("u", "*", "*", "view")}


def test_what_labels_tell_apart_or_many_pages_share_keeps_its_name(spark):
    rows = [(f"http://h.com/{n}/p", 1) for n in NAMES for _ in range(3)] + [("http://h.com/spammer/p", 0)] * 30
    rows += [("http://h.com/hub/p", None)] * 200 + [("http://h.com/" + "/".join("abcdefghijklmnopqrstuv") + f"/{n}", 1) for n in NAMES[:30]]
    got = {(r.path.split("/")[1], r.verdict) for r in url_templates.judge_urls(made_pages(spark, rows), []).collect()}
    assert ("spammer", "block") in got and {v for n, v in got if n != "spammer"} == {"allow"}
    shapes = spark.createDataFrame([("h", f"{n}/p", 3, 3, 3) for n in NAMES] + [("h", "hub/p", 200, 0, 0), ("h", "spammer/p", 30, 30, 0)],
                                   "host string, shape string, n long, labels long, goods long")
    assert {r.t[0] for r in url_templates.generalised(shapes, F.lit(0.9)).collect()} == {"*", "hub", "spammer"}


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, good int")
    assert url_templates.judge_urls(df, URL_RULES).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    sf = SF.replace("sf0.001", "sf0.01")
    assert differs(spark, connect(sf), QUERIES[name], ORACLES[name], sf) is None

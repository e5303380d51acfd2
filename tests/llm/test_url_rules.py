import itertools
import re

from pyspark.sql import functions as F

from tessera.llm import url_rules as ur
from tessera.llm.url_queries import RULES, op6_url_rules, page_labels

ODD = [None, "", "no scheme/en/", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://a.example.com/en/1", "http://example.com/en", "http://com/",
       "http://x.net/fr/a", "http://xnet/fr/a", "http://net/es/", "http://a.org?u=http://b.net/fr/", "http://a.org#/en/", "ftp://É.com/é", "a://b://c/d"]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, default=(0, None, None))[1:]


def test_parts_and_given_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate([*ODD, ODD[4]])], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, verdict string")
    got = {r.key: (r.host, r.path, r.rule, r.verdict) for r in ur.judge(df, none, RULES).collect()}
    for i, url in enumerate([*ODD, ODD[4]]):
        host, path = split(url)
        rule, verdict = rule_of(host, path)
        assert got[i] == (host, path, rule, verdict or "allow"), url


def test_mined_rules_equal_brute_force(spark):
    urls = [(f"http://{h}.org/{s}/{i}?{q}=1", "block" if s == "spam" or (h == "bad" and q == "ref") else "allow")
            for i, (h, s, q) in enumerate(itertools.product(["bad", "good", "fine"] * 3, ["spam", "news", "blog"], ["ref", "page", "id"]))]
    df = spark.createDataFrame(urls, "url string, verdict string").withColumn("tokens", ur.tokens(F.col("url")))
    rows = [(frozenset(r.tokens), r.verdict) for r in df.collect()]
    rules = {}
    for combo in {c for t, _ in rows for n in range(1, len(t) + 1) for c in itertools.combinations(sorted(t), n)}:
        n = sum(set(combo) <= t for t, _ in rows)
        bad = sum(set(combo) <= t and v == "block" for t, v in rows)
        if bad >= 20 and bad / n >= ur.MIN_CONFIDENCE:
            rules[combo] = bad / n
    rules = {c: p for c, p in rules.items() if not any(rules.get(tuple(x for x in c if x != out), -1) >= p for out in c)}
    mined = ur.mine(df)
    assert {tuple(r.antecedent): round(r.confidence, 9) for r in mined.collect()} == {c: round(p, 9) for c, p in rules.items()}
    hit = {tuple(r.tokens) for r in ur.matches(df, mined).collect()}
    assert hit == {tuple(sorted(t)) for t, _ in rows if any(set(c) <= t for c in rules)}


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert ur.judge(none, spark.createDataFrame([], "page_id long, verdict string"), RULES).collect() == []


def test_labels_are_those_of_the_document_shown(spark):
    urls = ["http://a.org/en/7", "http://a.org/de/8.html?x=1", "http://a.org/en/9/", "http://a.org/en/x7", "http://a.org/7", None, "",
            "http://a.org/en/7", "http://a.org/en/99999999999999999999", "http://a.org/en/70", "http://a.org/en/10#7"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (8, 1, 1), (9, 1, 0), (10, None, None), (None, 0, 1), (0, 0, 1)], "doc_id long, quality int, toxic int")
    got = sorted((r.page_id, r.verdict) for r in page_labels(pages, labels).collect())
    assert got == [(0, "block"), (1, "block"), (2, "allow"), (7, "block"), (10, "allow")]
    assert page_labels(pages.limit(0), labels).collect() == []
    assert page_labels(pages, labels.limit(0)).collect() == []


def test_mined_rules_decide_pages(spark, tmp_path):
    # page i shows document 1000 + i; the labels of documents 0 to 119 belong to no page
    host = lambda i: ["bad", "good", "fine"][i % 3]
    pages = [(i, f"http://{host(i)}.org/en/{1000 + i}") for i in range(120)]
    labels = [(1000 + i, 1, int(host(i) == "bad")) for i in range(90)] + [(i, 1, int(host(i) == "good")) for i in range(120)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in op6_url_rules(spark, str(tmp_path)).collect()}
    assert got == {i: (None, "block" if host(i) == "bad" else "allow") for i in range(120)}

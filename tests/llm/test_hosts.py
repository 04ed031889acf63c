import math

import pytest
from pyspark.sql import functions as F

from gleanrow.llm import hosts

PAGES = "page_id long, url string, html string, host string, n long"


def judged(spark, urls, labels=()):
    pages = spark.createDataFrame([(i, u, "", "clash", 1) for i, u in enumerate(urls)], PAGES)
    known = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    return {r["page_id"]: r for r in hosts.judge(pages, known).collect()}


def test_parts_and_longest_rule(spark):
    urls = [
        None, "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://a.example.com/en/", "http://example.com/en",
        "http://xexample.com/en/", "ftp://b.net/es/1#f",
        "http://b.net/eso", "http://c.com", "http://c.com/a://b.net/fr/", "http://É.com/\nx?q",
    ]
    got = judged(spark, urls)
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(len(urls))] == [
        ("", "", None), ("", "", None), ("", "", None), ("www.example.com", "/en/x", "www.example.com/en/"),
        ("a.example.com", "/en/", "example.com/en/"), ("example.com", "/en", "com/"), ("xexample.com", "/en/", "com/"),
        ("b.net", "/es/1", "net/es/"), ("b.net", "/eso", None), ("c.com", "", None), ("c.com", "/a://b.net/fr/", "com/"),
        ("É.com", "/\nx", "com/"),
    ]
    assert [got[i]["verdict"] for i in (3, 4, 5, 7)] == ["allow", "block", "allow", "block"]
    assert all(got[i]["verdict"] == "allow" for i in (0, 1, 8, 9))


def test_reputation_shrinks_and_blocks(spark):
    urls = [f"http://bad.spam.org/{i}" for i in range(60)] + [f"http://h{i}.good.org/{i}" for i in range(60)] + ["http://new.spam.org/",
        "http://new.good.org/", "http://once.good.org/", "http://x.unseen/"]
    labels = [(i, 0, 0) for i in range(55)] + [(i, 1, 0) for i in range(60, 118)] + [(122, 1, 1), (5, None, None), (None, 0, 0)]
    got = judged(spark, urls, labels)
    assert got[0]["verdict"] == got[59]["verdict"] == "block"
    assert got[120]["verdict"] == "block"  # its domain is known
    assert got[121]["verdict"] == "allow"
    assert got[122]["verdict"] == "allow"  # one bad page of a good domain
    assert got[123]["verdict"] == "allow"


def test_empty(spark):
    assert judged(spark, []) == {}
    assert judged(spark, ["http://a.org/"], [(7, 0, 1)])[0]["verdict"] == "allow"


def test_levels_of_hosts(spark):
    want = {
        "www.bbc.co.uk": ("bbc.co.uk", "co.uk"), "bbc.co.uk": ("bbc.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"),
        "a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"),
        "com": ("com", "com"), "localhost": ("localhost", "localhost"), "me:pw@www.x.org:8080": ("x.org", "org"),
        "x.org.": ("x.org", "org"), "10.0.3.4:80": ("10.0.3.4", "(address)"),
        "[::1]:80": ("[::1]", "(address)"), "": ("", ""), "x.org.:80": ("x.org", "org"),
    }
    rows = spark.createDataFrame([(h,) for h in want], "host string")
    domain, suffix = hosts.levels(F.col("host"))
    assert {r["host"]: (r["d"], r["s"]) for r in rows.select("host", domain.alias("d"), suffix.alias("s")).collect()} == want


def test_beta_tails(spark):
    """Against binomial sums: beta(a, b) is at most x as often as a or more of a + b - 1 draws are under x."""
    cases = [(1, 1), (2, 1), (5, 1), (3, 7), (40, 20), (900, 700), (1, 60)]
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in cases], "a double, b double")
    for x in (0.5, 0.3):
        got = {(r["a"], r["b"]): r["p"] for r in rows.select("a", "b", hosts.below(F.col("a"), F.col("b"), x).alias("p")).collect()}
        for a, b in cases:
            n = a + b - 1
            term = lambda j: math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(x) + (n - j) * math.log(1 - x))
            assert got[a, b] == pytest.approx(sum(term(j) for j in range(a, n + 1)), abs=2e-3)


def test_a_suffix_without_labels_takes_the_rate_of_all(spark):
    urls = [f"http://h{i}.bad.org/{i}" for i in range(40)] + ["http://x.unseen/", "http://" + "h" * 30000 + ".org/" + "p" * 100000]
    got = judged(spark, urls * 2, [(i, 0, 0) for i in range(40)])
    assert got[40]["verdict"] == got[82]["verdict"] == "block"
    assert len(got[41]["host"]) == 30004 and len(got[41]["path"]) == 100001

import numpy as np
import pytest

from pyspark.sql import functions as F

from framewright.llm.url_filter import beta_share, filter_urls, page_outcomes, site_of


def verdicts(spark, rows, outcomes):
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'clash' host", "'clash' bad", "'clash' n")
    known = spark.createDataFrame(outcomes, "page_id long, bad int")
    return filter_urls(df, known).collect()


def test_rules_and_parts(spark):
    cases = {
        "http://example.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
        "HTTPS://WWW.Example.COM/en/1?x=/es/": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/1": ("notexample.com", "/en/1", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://x.net/es/#y": ("x.net", "/es/", "net/es/", "block"),
        "http://x.net?/fr/": ("x.net", "", None, "allow"),
        "http://net/fr/a://b": ("net", "/fr/a://b", "net/fr/", "block"),
        "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), "://": ("", "", None, "allow"),
    }
    rows = list(enumerate(cases))
    got = {r.page_id: r for r in verdicts(spark, rows + [(99, None)], [])}
    for i, url in rows:
        assert tuple(got[i])[1:] == cases[url], url
    assert tuple(got[99])[1:] == ("", "", None, "allow")


def test_reputation_needs_evidence(spark):
    rows = [(i, f"http://good{i % 4}.b.org/") for i in range(400)] + [(1000 + i, "http://bad.b.org/") for i in range(60)] + [(2000, "http://once.b.org/"), (2000, "http://once.b.org/"), (None, "http://bad.b.org/")]
    outcomes = [(i, int(i % 20 == 0)) for i in range(400)] + [(1000 + i, 1) for i in range(40)] + [(2000, 1), (None, 1), (3, None)]
    got = verdicts(spark, rows, outcomes)
    assert {(r.host, r.verdict) for r in got} == {*((f"good{i}.b.org", "allow") for i in range(4)), ("bad.b.org", "block"), ("once.b.org", "allow")}
    assert len(got) == len(rows)


def test_hosts_without_labels_are_judged_by_their_domain(spark):
    """Down to the suffix and to all pages where the domain has no labels either."""
    sites = [(f"h{i}.spam.org", 9) for i in range(20)] + [(f"h.d{i}.info", 9) for i in range(20)] + [(f"h{i}.good{i % 10}.org", 1) for i in range(150)]
    rows = [(10 * s + i, f"http://{host}/") for s, (host, _) in enumerate(sites) for i in range(10)]
    outcomes = [(10 * s + i, int(i < bad)) for s, (_, bad) in enumerate(sites) for i in range(10)]
    new = {"x.spam.org": "block", "spam.org": "block", "x.new.info": "block", "x.good1.org": "allow", "x.new.zzz": "allow", "": "allow"}
    got = verdicts(spark, rows + [(9000 + i, f"http://{host}/") for i, host in enumerate(new)] + [(None, "http://y.spam.org/")], [*outcomes, (9000, None), (None, 0)])
    assert {r.host: r.verdict for r in got if r.host in new} == new
    assert {r.verdict for r in got if r.host in ("y.spam.org", "h1.spam.org")} == {"block"}
    assert {r.verdict for r in got if ".good" in r.host} == {"allow"} and len(got) == len(rows) + 7


def test_empty(spark):
    assert verdicts(spark, [], []) == []
    labels = spark.createDataFrame([(1, 0, None), (2, None, 0), (3, 1, 0), (4, None, 1)], "doc_id long, quality int, toxic int")
    assert {r.page_id: r.bad for r in page_outcomes(labels).collect()} == {1: 1, 2: None, 3: 0, 4: 1}


@pytest.mark.parametrize("host", ["", "localhost"])
def test_short_hosts(spark, host):
    assert verdicts(spark, [(1, f"http://{host}/x")], [(1, 1)])[0].verdict in ("allow", "block")


def test_sites_domains_and_suffixes(spark):
    cases = {
        "a.b.example.co.uk": ("a.b.example.co.uk", "example.co.uk", "co.uk"), "x.example.com": ("x.example.com", "example.com", "com"),
        "me:pw@x.org:8080": ("x.org", "x.org", "org"), "1.2.3.4:80": ("1.2.3.4", "1.2.3.4", "1.2.3.4"), "[::1]:80": ("[::1]",) * 3,
        "co.uk": ("co.uk", "co.uk", "co.uk"), "acme.uk": ("acme.uk", "acme.uk", "uk"), "x.com.": ("x.com", "x.com", "com"), "": ("", "", ""),
    }
    df = spark.createDataFrame([(h,) for h in cases], "h string")
    got = df.select("h", *(c.alias(n) for c, n in zip(site_of(F.col("h")), "sdp"))).collect()
    assert {r.h: (r.s, r.d, r.p) for r in got} == cases


def test_the_posterior_share_against_a_sum(spark):
    def by_sum(a, b, x, n=200_000):
        grid = (np.arange(n) + 0.5) / n
        logs = (a - 1) * np.log(grid) + (b - 1) * np.log1p(-grid)
        weights = np.exp(logs - logs.max())
        return weights[grid < x].sum() / weights.sum()

    cases = [(1.0, 1.0), (2.5, 7.5), (40.0, 60.0), (1.2, 300.0), (900.0, 2000.0), (3000.0, 7010.0), (14_800.0, 35_100.0), (80.0, 2.0)]
    df = spark.createDataFrame(cases, "a double, b double")
    for r in df.select("a", "b", beta_share(F.col("a"), F.col("b"), 0.3).alias("s")).collect():
        assert abs(r.s - by_sum(r.a, r.b, 0.3)) < 1e-4, r


def test_a_very_long_url(spark):
    long = "http://long.example.org/" + "x/" * 200_000
    got = verdicts(spark, [(1, long), (2, "http://" + "a." * 20_000 + "org/")], [(1, 0)])
    assert {(r.page_id, len(r.path), len(r.host)) for r in got} == {(1, 400_001, 16), (2, 1, 40_003)}

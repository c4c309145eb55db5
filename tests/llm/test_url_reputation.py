import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickscope.llm import url_reputation as U
from clickscope.llm.queries import URL_RULES, op5_host_reputation
from tests.conftest import SF_SMALL

CASES = [("http://A.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/"), ("https://net", "net", "", None),
         ("https://net/", "net", "/", "net/"), ("ftp://x.net/en", "x.net", "/en", "net/"), ("xnet://xnet/a", "xnet", "/a", None),
         ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/"), ("http://badexample.com/de/1", "badexample.com", "/de/1", None),
         ("http://a.org/fr/", "a.org", "/fr/", "org/fr/"), ("http://a.org/fr", "a.org", "/fr", None), (None, "", "", None), ("", "", "", None),
         ("no scheme", "", "", None), ("http://", "", "", None), ("http://h?q=a://b.net/", "h", "", None), ("http://h#x/y", "h", "", None),
         ("a\nb://Ä.Org/fr/\nq", "Ä.org", "/fr/\nq", "org/fr/"), ("http://u:p@h.net:80/en/", "u:p@h.net:80", "/en/", None)]


@pytest.mark.parametrize("case", CASES)
def test_hosts_paths_and_rules(spark, case):
    df = spark.createDataFrame([(1, case[0])], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    r = U.filter_urls(df, none, URL_RULES).first()
    assert (r["host"], r["path"], r["rule"]) == case[1:]
    want = {"net/": "block", "example.com/de/": "block", None: "allow"}.get(case[3], "allow")
    assert r["verdict"] == want


def test_longest_rule_wins(spark):
    rules = [U.Rule("com/a/b/", "allow"), U.Rule("com/", "block"), U.Rule("com/a/", "block")]
    df = spark.createDataFrame([("x.com", "/a/b/c"), ("x.com", "/a/c"), ("x.com", "/")], "host string, path string")
    got = [r[0] for r in df.select(U.rule_for(F.col("host"), F.col("path"), rules)["rule"]).collect()]
    assert got == ["com/a/b/", "com/a/", "com/"]


def _quantile(a, b, q=0.05):
    """By summing the density over a fine grid of the log odds."""
    u = np.linspace(-60, 60, 400_001)
    log = a * -np.logaddexp(0, -u) + b * -np.logaddexp(0, u)
    mass = np.cumsum(np.exp(log - log.max()))
    return 1 / (1 + math.exp(-u[np.searchsorted(mass, q * mass[-1])]))


def test_lower_bound_is_the_beta_quantile(spark):
    cases = [(a, b) for a in (1.0, 1.5, 3.0, 10.0, 80.0, 900.0) for b in (1.0, 1.7, 5.0, 40.0, 700.0)]
    df = spark.createDataFrame([(a / (a + b), a + b, a, b) for a, b in cases], "m double, w double, a double, b double")
    for low, a, b in df.select(U.lower_bound(F.col("m"), F.col("w")), "a", "b").collect():
        assert low == pytest.approx(_quantile(a, b), abs=0.01)
    odd = spark.createDataFrame([(0.0, 5.0), (1.0, 5.0), (0.9, 0.2), (0.001, 0.3), (1.0, 1e9)], "m double, w double")
    low = [r[0] for r in odd.select(U.lower_bound(F.col("m"), F.col("w"))).collect()]
    assert low[0] == low[2] == low[3] == 0 and 0.5 < low[1] < 1 and low[4] > 0.999


def _levels(host):
    two = 2 if ".".join(host.split(".")[-2:]) in U.SUFFIXES else 1
    parts = host.split(".")
    return ("",), ("s", ".".join(parts[-two:])), ("d", ".".join(parts[-two - 1:])), ("h", host)


def _slow(pages, labels):
    """Posterior mean and weight of each host, in plain loops over the groups of each level."""
    seen, inside = {}, {}
    for p, h in pages:
        path = _levels(h)
        for level in path:
            x = seen.setdefault(level, [0, 0])
            x[0] += sum(b for q, b in labels if q == p)
            x[1] += sum(1 for q, _ in labels if q == p)
        for up, down in zip(path, path[1:], strict=False):
            inside.setdefault(up, set()).add(down)
    strength = {}
    for kind in ("", "s", "d"):
        over = room = 0.0
        for up in [k for k in inside if k[0] == kind and seen[k][1]]:
            some = [seen[d] for d in inside[up] if seen[d][1]]
            big, p = seen[up][1], seen[up][0] / seen[up][1]
            over += sum(n * (b / n - p) ** 2 for b, n in some) - p * (1 - p) * (len(some) - 1)
            room += p * (1 - p) * (big - sum(n * n for _, n in some) / big - (len(some) - 1))
        strength[kind] = min(max(room / over - 1, 1), 1000) if room > 0 and over > 0 else 1000
    whole = seen[("",)]
    prior = {("",): (whole[0] / whole[1] if whole[1] else 0, 1.0)}
    for kind in ("", "s", "d"):
        for up in [k for k in inside if k[0] == kind]:
            for down in inside[up]:
                left = seen[up][1] - seen[down][1] + prior[up][1]
                mean = (seen[up][0] - seen[down][0] + prior[up][1] * prior[up][0]) / left
                # variance of a rate drawn about a rate that is drawn itself
                s = strength[kind]
                var = mean * (1 - mean) * (1 - left / (left + 1) * s / (s + 1)) if 0 < mean < 1 else None
                weight = mean * (1 - mean) / var - 1 if var else 1 / (1 - left / (left + 1) * s / (s + 1)) - 1
                prior[down] = (mean, weight)
    out = {}
    for h in {h for _, h in pages}:
        (b, n), (m, w) = seen[("h", h)], prior[("h", h)]
        out[h] = ((b + w * m) / (n + w), n + w)
    return out, strength


@pytest.mark.parametrize("seed", range(3))
def test_reputation_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rates = {f"{h}.{d}": rng.choice([0.0, 0.1, 0.5, 0.9, 1.0]) for d in ("a.com", "b.com", "x.co.uk", "y.co.uk", "org", "z.org") for h in "pqr"}
    rates |= {"": 0.3, "com": 0.5, "co.uk": 0.2, "new.a.com": None, "lone.net": 1.0}
    pages = [(i, rng.choice(list(rates))) for i in range(400)] + [(7, "p.a.com")]
    labels = [(i, rng.random() < rates[h]) for i, h in pages if rates[h] is not None and rng.random() < 0.8]
    df = spark.createDataFrame(pages, "page_id long, host string")
    out = spark.createDataFrame([*labels, (None, True), (3, None), (10**9, True)], "page_id long, bad boolean")
    want, _ = _slow(pages, labels)
    got = {r["host"]: (r["mean"], r["weight"]) for r in U.host_reputation(df, out).collect()}
    assert got.keys() == want.keys()
    for h, (mean, weight) in want.items():
        assert got[h] == (pytest.approx(mean), pytest.approx(weight)), h


def _verdicts(spark, hosts, pages_each, **how):
    """Verdict of each host, of which so many pages are all bad or all good (None: no label)."""
    rows = [(i * 1000 + j, h, bad) for i, (h, bad) in enumerate(hosts.items()) for j in range(pages_each)]
    df = spark.createDataFrame([(i, f"http://{h}/p") for i, h, _ in rows], "page_id long, url string")
    out = spark.createDataFrame([(i, b) for i, _, b in rows if b is not None], "page_id long, bad boolean")
    return {r["host"]: r["verdict"] for r in U.filter_urls(df, out, [], **how).collect()}


def test_a_wholly_bad_host_among_good_ones_is_blocked(spark):
    hosts = {f"h{i}.site{i % 20}.com": False for i in range(99)} | {"bad.site5.com": True, "new.site6.com": None}
    got = _verdicts(spark, hosts, 10)
    assert [h for h, v in got.items() if v == "block"] == ["bad.site5.com"]


def test_one_bad_page_blocks_no_host(spark):
    hosts = {f"h{i}.com": False for i in range(50)} | {f"b{i}.com": True for i in range(3)}
    assert set(_verdicts(spark, hosts, 1).values()) == {"allow"}


def test_domains_under_a_shared_suffix_are_apart(spark):
    hosts = {f"www.bad{i}.co.uk": True for i in range(10)} | {f"www.ok{i}.com": False for i in range(50)}
    hosts |= {f"www.fine{i}.co.uk": False for i in range(10)} | {"new.co.uk": None}
    got = _verdicts(spark, hosts, 10)
    assert got["new.co.uk"] == "allow" and got["www.fine3.co.uk"] == "allow" and got["www.bad3.co.uk"] == "block"
    df = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x.com",), ("com",), ("",), ("a.b.x.y.z",)], "h string")
    parts = [tuple(r) for r in df.select(U.suffix(F.col("h"), ["co.uk", "x.y.z"]), U.registered_domain(F.col("h"), ["co.uk", "x.y.z"])).collect()]
    assert parts == [("co.uk", "b.co.uk"), ("co.uk", "co.uk"), ("com", "x.com"), ("com", "com"), ("", ""), ("x.y.z", "b.x.y.z")]


def test_strength_follows_the_spread(spark):
    def strength(rates, seed=1):
        rng = random.Random(seed)
        groups = spark.createDataFrame([(sum(rng.random() < r for _ in range(100)), 100) for r in rates], "bad long, n long")
        return U.prior_strength(groups.agg(*U._totals()))
    assert strength([0.3] * 200) > 200
    rng = random.Random(4)
    assert strength([rng.betavariate(2, 6) for _ in range(400)]) == pytest.approx(8, rel=0.25)
    assert strength([0.0, 1.0] * 20) == U.LEAST_STRENGTH
    assert strength([0.0] * 5) == U.MOST_STRENGTH and strength([0.4]) == U.MOST_STRENGTH


def test_rows_and_extra_columns_stay(spark):
    df = spark.createDataFrame([(1, "http://a.b/", "x", "y"), (1, "http://a.b/", "x", "y"), (None, None, None, None)],
                               "page_id long, url string, host string, bad string")
    out = spark.createDataFrame([(1, True), (1, True)], "page_id long, bad boolean")
    got = U.filter_urls(df, out, URL_RULES).collect()
    assert sorted((r["page_id"] or 0, r["bad"] or "") for r in got) == [(0, ""), (1, "y"), (1, "y")]
    assert U.filter_urls(df.where("false"), out, URL_RULES).collect() == []
    assert {r["verdict"] for r in U.filter_urls(df, out.where("false"), []).collect()} == {"allow"}


def test_very_long_urls_are_read_whole(spark):
    host, path = "a" * 200_000 + ".example.com", "/de/" + "p" * 500_000
    r = U.filter_urls(spark.createDataFrame([(1, f"http://{host}{path}?q")], "page_id long, url string"),
                      spark.createDataFrame([(1, False)], "page_id long, bad boolean"), URL_RULES).first()
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, "example.com/de/", "block")


def test_query_covers_every_page(spark):
    n = spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
    df = op5_host_reputation(spark, SF_SMALL)
    assert df.columns == ["page_id", "host", "path", "rule", "verdict"] and df.count() == n

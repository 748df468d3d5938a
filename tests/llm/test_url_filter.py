"""Bloom cascade and rules against plain string tests."""

import random
import re

import numpy as np
import pytest

from saasmart.llm import queries, url_filter
from saasmart.llm.url_filter import judge, rule_table
from tests.conftest import SF01


def plain(url, rules, default="allow"):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = {}
    for h, p, verdict in rules:
        if not h or p is None or p and p[0] != "/":
            continue
        h = "".join(c.lower() if "A" <= c <= "Z" else c for c in h)
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits[h + p] = (len(h + p), len(h), h + p, verdict == "block" or fits.get(h + p, (0, 0, 0, False))[3])
    if not fits:
        return host, path, None, default
    best = max(fits.values())
    return host, path, best[2], "block" if best[3] else "allow"


def answers(df):
    return sorted((r.page_id, r.found.host, r.found.path, r.found.rule or "-", r.found.verdict) for r in df.collect())


def want(rows, rules, default="allow"):
    return sorted((i, h, p, r or "-", v) for i, (h, p, r, v) in ((i, plain(u, rules, default)) for i, u in rows))


def test_query(spark):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()]
    got = queries.op11_url_filter(spark, SF01).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule or "-", r.verdict) for r in got) == want(rows, queries.URL_RULES)
    assert {r.rule for r in got} >= {"net/", "org/fr/", None}


ODD = [None, "", "no scheme", "http://", "http://NET", "http://net/", "HTTP://A.Net/x", "x://y://net/", "http://.net/", "http://b.net./",
       "http://net?q=/", "http://example.net/en", "http://example.net/en/", "http://myexample.net/en/", "http://a.example.net/en/?x#y",
       "http://example.com/de/", "http://example.com/de", "http://example.com/DE/", "http://u@example.com/de/", "http://example.com:80/de/",
       "http://x.org/fr/", "http://org/fr/a/b", "http://é.net/ü", "http://a\n.net/\n", "http://" + "a." * 3000 + "net/" + "p" * 50_000,
       "http://ÀB.net/"]


def test_odd_urls_and_clashing_columns(spark):
    rows = [*enumerate(ODD), (3, "http://net/"), (3, "http://net/"), (None, "http://x.net/")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as _keys", "3 as key", "4 as _hits", "5 as path")
    found = judge(df.repartition(3), rule_table(spark, queries.URL_RULES), default="block")
    got = sorted(((r.page_id is not None, r.page_id or 0), r.found.host, r.found.path, r.found.rule or "-", r.found.verdict) for r in found.collect())
    assert got == sorted(((i is not None, i or 0), *rest[:2], rest[2] or "-", rest[3])
                         for i, rest in ((i, plain(u, queries.URL_RULES, "block")) for i, u in rows))
    assert found.columns == [*df.columns, "found"]


@pytest.mark.parametrize("filter_bytes", [64 << 20, 150])
def test_long_lists_in_one_and_in_several_groups(spark, monkeypatch, filter_bytes):
    rng = random.Random(3)
    label = lambda: rng.choice("abcdefghijkl") * rng.randint(1, 2)
    host = lambda: ".".join(label() for _ in range(rng.randint(1, 3))) + rng.choice([".net", ".org"])
    path = lambda: "/" + "".join(rng.choice("xyz/") for _ in range(rng.randint(0, 3)))
    rules = [(host(), rng.choice(["", path()]), rng.choice(["block", "allow"])) for _ in range(300)]
    rules += [(h, p, "block" if v == "allow" else "allow") for h, p, v in rules[:20]] + [("A.NET", "/", "block")]
    rules += [(None, "/", "block"), ("", "/", "block"), ("net", None, "block"), ("net", "x", "block")]
    rows = [(i, f"https://{host()}{path()}") for i in range(4000)] + [(i, "https://hot.a.net/x") for i in range(4000, 6000)]
    monkeypatch.setattr(url_filter, "FILTER_BYTES", filter_bytes)
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(5)
    assert answers(judge(pages, rule_table(spark, rules))) == want(rows, rules)


def test_cascade_needs_and_gets_several_levels(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "RATE", 0.5)
    inside = spark.range(0, 3000).selectExpr("concat('in', id) as key")
    outside = spark.range(0, 3000).selectExpr("concat('out', id) as key")
    levels = url_filter.cascade(inside, outside, 3000, 3000)
    assert len(levels) > 4
    told = inside.union(outside).select("key", url_filter.listed(__import__("pyspark").sql.functions.array("key"), levels)[0].alias("x")).collect()
    assert len(told) == 6000 and all(r.x == r.key.startswith("in") for r in told)


def test_answers_by_the_first_level_that_misses():
    full, none = np.full(8, 255, np.uint8), np.zeros(8, np.uint8)
    values = np.arange(9, dtype=np.int64).reshape(3, 3)
    for made, said in (((none, full, full), False), ((full, none, full), True), ((full, full, none), False), ((full, full, full), True)):
        assert (url_filter._answers(values, [(64, 2, x) for x in made]) == said).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    some = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert judge(none, rule_table(spark, queries.URL_RULES)).count() == 0
    assert answers(judge(some, rule_table(spark, []))) == [(1, "a.net", "/", "-", "allow")]

"""Op 10: rules and parts against plain Python, the regression against a plain gradient descent."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimflow.llm import queries, url_filter as uf
from tables import MEDIUM

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:stop]


def rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


URLS = [None, "", "no scheme.org/x", "://", "http://", "HTTP://A.Example.ORG/es/1?x#y", "http://org/", "http://org", "x://y://org/",
        "http://notexample.org/es/", "http://example.org/en/17", "http://example.com/fr/", "http://fr.com/de/x", "http://com?/fr/",
        "http://É.com/De/", "http://a.example.org#/es/", "http://example.org/ES/", "ftp://user@h.org:80/en/1\nline/2?q"]


@pytest.mark.parametrize("kind", ["table", "odd"])
def test_parts_and_rules(spark, kind):
    if kind == "table":
        urls = pd.read_parquet(f"{MEDIUM}/pages.parquet")[["page_id", "url"]].itertuples(index=False, name=None)
        urls = dict(urls)
        got = queries.QUERIES["op10_url_filter"](spark, MEDIUM).collect()
    else:
        urls = dict(enumerate(URLS))
        df = spark.createDataFrame(list(urls.items()), "page_id long, url string").selectExpr("*", "1 as host", "2 as _grams", "3 as verdict")
        got = uf.filter_urls(df.drop("_grams"), queries.labelled_urls(spark), queries.URL_RULES).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = parts(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        text, said = rule(host, path)
        assert r.rule == text
        assert r.verdict == (said or ("block" if r.p_block >= 0.5 else "allow"))


def plain_grams(host, path):
    return {t + s[i : i + n] for t, s in (("h", f"^{host}$"), ("p", f"^{path}$")) for n in uf.SIZES for i in range(len(s) - n + 1)}


def test_regression_equals_plain_descent(spark):
    """Without hashing (few collisions in 16,384 buckets) the same penalised likelihood has the same optimum."""
    rows = [(r.url, r.label) for r in queries.labelled_urls(spark).collect()]
    sets = [plain_grams(*parts(u)) for u, _ in rows]
    names = {g: i for i, g in enumerate(sorted(set().union(*sets)))}
    x = np.zeros((len(rows), len(names)))
    for i, s in enumerate(sets):
        x[i, [names[g] for g in s]] = 1
    y = np.array([label for _, label in rows], float)
    w, b = np.zeros(len(names)), 0.0
    for _ in range(6000):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        w -= 0.05 * (x.T @ (p - y) / len(y) + uf.SHRINK * w)
        b -= 0.05 * np.mean(p - y)
    want = 1 / (1 + np.exp(-(x @ w + b)))
    got = [r.p_block for r in uf.filter_urls(queries.labelled_urls(spark), queries.labelled_urls(spark)).collect()]
    assert np.abs(np.array(got) - want).max() < 0.05
    assert ((np.array(got) >= 0.5) == (y == 1)).all()


def test_held_out_hosts(spark):
    rows = queries.QUERIES["op10_url_filter"](spark, MEDIUM).where("rule is null").toPandas()
    bad = rows.host.str.contains("spam-farm|adult-x")
    assert (rows[bad].verdict == "block").all()
    assert (rows[~bad].verdict == "allow").mean() > 0.95


def test_odd_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    labelled = queries.labelled_urls(spark)
    assert uf.filter_urls(none, labelled, queries.URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://spam-farm.net/x")], "page_id long, url string")
    assert uf.filter_urls(one, labelled.where("label = 0")).first().verdict == "allow"
    assert uf.filter_urls(one, labelled.where("label = 1")).first().verdict == "block"
    assert uf.filter_urls(one, labelled.limit(0)).first().verdict == "allow"
    assert uf.filter_urls(one, labelled.unionByName(labelled.select("url", F.lit(None).cast("int").alias("label")))).first().verdict == "block"


def test_columns_of_any_name_pass_through(spark):
    pages = spark.createDataFrame([(1, "https://a.org/x", 5, 6)], "page_id long, url string, _rule int, own_host int")
    labelled = spark.createDataFrame([("https://good.org/", 0), ("https://bad.com/", 1)], "url string, label int")
    got = uf.filter_urls(pages, labelled, [("allow", "org/")]).first()
    assert (got._rule, got.own_host, got.rule, got.verdict) == (5, 6, "org/", "allow")

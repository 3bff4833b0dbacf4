"""Op 2: counts against plain Python; estimates against a plain minimum-covariance-determinant search."""

import re
from collections import Counter

import numpy as np
import pandas as pd

from claimflow.llm import quality_outliers as qo, queries
from tables import MEDIUM

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(lines), sum("A" <= c <= "Z" for c in text)) if words else (0,) * 7


def test_query_counts_and_base_rules(spark):
    docs = pd.read_parquet(f"{MEDIUM}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op2_quality_rules"](spark, MEDIUM).collect()}
    assert len(got) == len(docs)
    for d, t in zip(docs.doc_id, docs.text, strict=True):
        c = plain_counts(t)
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c[:5]
        assert r.base_failed == (c[0] < 10 or 100 * c[4] > 20 * c[0])
        assert r.kept == (not r.base_failed and r.distance <= r.bound)
    labels = pd.read_parquet(f"{MEDIUM}/labels.parquet")
    judged = [(q, got[d].kept) for d, q in zip(labels.doc_id, labels.quality, strict=True) if not got[d].base_failed]
    assert np.mean([k for q, k in judged if q == 1]) > 0.98
    assert np.mean([k for q, k in judged if q == 0]) < 0.2


def test_odd_texts():
    for t in [None, "", " \n ", "é🙂 ü", "a b c d e a b c d e", "x\nx\n\nx \n", "one two three four", "w " * 5000, "#$ A|B <C>\t\x0b"]:
        assert qo.counts(t) == plain_counts(t), t


def vectors(rng, n, share=0.3):
    """A group of clean vectors with correlation and small spreads, and a ``share`` that stands some eight spreads off."""
    spread = np.array([1.0, 0.04, 0.01, 0.05, 0.05, 0.015])
    z = rng.normal(size=(n, qo.P))
    z[:, 1] = 0.6 * z[:, 0] + 0.8 * z[:, 1]
    far = rng.random(n) < share
    z[far] += [0, 4, 4, 4, 0, 4]
    return z * spread + [5, 1.5, 0.1, 0.3, 0.3, 0.2], far


def plain_mcd(x, subset):
    """Concentration steps from many random starts, without floors."""
    rng, best, n = np.random.default_rng(3), None, len(x)
    for _ in range(200):
        take = rng.choice(n, qo.P + 2, replace=False)
        for _ in range(30):
            center, cov = x[take].mean(0), np.cov(x[take].T, bias=True) + 1e-12 * np.eye(qo.P)
            d = np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(cov), x - center)
            take = np.argsort(d)[: int(np.ceil(subset * n))]
        value = np.linalg.slogdet(np.cov(x[take].T, bias=True))[1]
        if best is None or value < best[0]:
            best = value, x[take].mean(0), np.cov(x[take].T, bias=True)
    return best


def test_fits_equal_a_plain_search_and_find_moderate_outliers(spark):
    rng = np.random.default_rng(2)
    groups = {c: vectors(rng, 600, share) for c, share in (("a", 0.15), ("b", 0.3))}
    rows = spark.createDataFrame([(c, *map(float, v)) for c, (x, _) in groups.items() for v in x],
                                 "cell string, " + ", ".join(f"{s} double" for s in qo.STATISTICS))
    fits = {r["cell"]: r for r in qo.fit_groups(rows).collect()}
    for c, (x, far) in groups.items():
        _, center, cov = plain_mcd(x, qo.SUBSET)
        off = x - np.array(fits[c]["center"])
        d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(np.array(fits[c]["scatter"]).reshape(qo.P, qo.P)), off)
        plain = np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(cov), x - center)
        bound = np.exp(fits[c]["tail"])
        assert (d[far] > np.quantile(d[~far], 0.99)).mean() > 0.97
        if c == "a":  # fewer than a quarter: the group's upper quartile is of its own kind
            assert (d[far] > bound).mean() > 0.97 and (d[~far] <= bound).mean() > 0.94
        assert np.corrcoef(np.argsort(np.argsort(d)), np.argsort(np.argsort(plain)))[0, 1] > 0.95
        spread = x[~far].std(0)
        assert (np.abs(np.array(fits[c]["center"]) - center) < 0.4 * spread).all()
        # the floors hardly count: the scatter's own correlation is found
        s = np.array(fits[c]["scatter"]).reshape(qo.P, qo.P)
        assert 0.4 < s[0, 1] / np.sqrt(s[0, 0] * s[1, 1]) < 0.75
        assert 0.5 < np.median(d[~far]) / qo.CHI2_MEDIAN < 1.5


def test_a_statistic_without_spread(spark):
    rng = np.random.default_rng(4)
    x, _ = vectors(rng, 500, 0.1)
    x[:, 2] = 0.0  # no symbols at all, but for three texts
    x[:3] = x[10:13]
    x[:3, 2] = 0.6
    rows = spark.createDataFrame([("a", *map(float, v)) for v in x], "cell string, " + ", ".join(f"{s} double" for s in qo.STATISTICS))
    fit = qo.fit_groups(rows).first()
    off = x - np.array(fit["center"])
    d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(np.array(fit["scatter"]).reshape(qo.P, qo.P)), off)
    assert d[:3].min() > np.exp(fit["tail"]) and np.median(d) < 10


def test_odd_rows_and_small_groups(spark, odd_docs, no_docs):
    assert qo.quality_rules(no_docs).count() == 0
    rows = qo.quality_rules(odd_docs.selectExpr("*", "1 as cell", "2 as own", "3 as _id")).collect()
    assert len(rows) == 9
    assert all(not r.kept and r.base_failed and r.distance is None for r in rows if r.n_words == 0)
    assert all(r.distance is not None for r in rows if r.n_words)
    clean = [f"word{i} some other plain text number {i} " * 1 + " ".join(f"v{j}{i}" for j in range(30 + i % 9)) for i in range(200)]
    docs = [(i, t, "en", "big" if i % 4 else f"s{i}") for i, t in enumerate(clean)] + [(999, "###### ###### " * 2 + " ".join("#$%&" * 9 + str(j) for j in range(40)), "en", "s0")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in qo.quality_rules(df).collect()}
    assert not got.pop(999)
    assert all(got.values())

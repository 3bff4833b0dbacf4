"""Op 1 against all pairs of a small table."""

import re

import pandas as pd
import pytest

from claimflow.llm import jaccard_join as jj
from tables import MEDIUM

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    w = WORD.findall(text or "")
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs):
    """(id -> class, id -> links) from all pairs."""
    sets = [(i, shingle_set(t)) for i, t in docs]
    root = {i: i for i, _ in sets}
    links = dict.fromkeys(root, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[n + 1 :]:
            if s and t and min(len(s), len(t)) >= 0.8 * max(len(s), len(t)) and len(s & t) >= 0.8 * len(s | t):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}, links


@pytest.mark.parametrize("block", [512, 3])
def test_classes_equal_all_pairs(spark, block):
    table = pd.read_parquet(f"{MEDIUM}/documents.parquet")[["doc_id", "text"]]
    classes, links = brute(table.itertuples(index=False, name=None))
    got = jj.jaccard_classes(spark.read.parquet(f"{MEDIUM}/documents.parquet"), block=block).collect()
    assert len(got) == len(table)
    assert {r.doc_id: r.class_id for r in got} == classes
    assert {r.doc_id: r.n_links for r in got} == links


def test_hot_group_of_near_copies(spark):
    words = [f"w{i}" for i in range(60)]
    docs = [(n, " ".join([*words, f"x{n}"])) for n in range(90)] + [(200 + n, " ".join([*words, "x1"])) for n in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in jj.jaccard_classes(df, block=16).collect()}
    assert {r.class_id for r in got.values()} == {0}
    assert {r.n_links for r in got.values()} == {129}
    assert got[203].copy_of == 1
    pairs, member = jj.similar_pairs(df, block=16)
    assert pairs.count() == 90 * 89 // 2
    assert member.where("representative = 1").count() == 41


def test_odd_rows(spark, odd_docs, no_docs):
    extra = odd_docs.selectExpr("*", "1 as node", "2 as class_id", "3 as sig", "4 as _id", "5 as bucket")
    got = sorted((str(r.doc_id), r.class_id, r.n_links) for r in jj.jaccard_classes(extra).collect())
    assert got == sorted([("1", 1, 0), ("2", 2, 0), ("3", 3, 0), ("4", 4, 0), ("5", 5, 2), ("5", 5, 2), ("6", 5, 2),
                          ("7", 7, 0), ("None", None, 0)])
    assert jj.jaccard_classes(no_docs).count() == 0


def test_pruning_bounds():
    least = jj.least_matches(0.8, 1e-6)
    assert list(least) == [32, 64, 96, 128, 160]
    assert all(m < 0.8 * n for n, m in least.items())
    assert least[160] > 90

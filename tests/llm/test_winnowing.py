"""Op 9 against every window of every document."""

import hashlib
import re

import pandas as pd

from claimflow.llm import queries, winnowing
from tables import MEDIUM

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    0 < len(hit) and 20 * len(hit) >= len(w)))
    return out


def key(rows):
    return sorted(rows, key=str)


def test_query_equals_brute_force(spark):
    docs = pd.read_parquet(f"{MEDIUM}/documents.parquet")[["doc_id", "text"]].itertuples(index=False, name=None)
    items = pd.read_parquet(f"{MEDIUM}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False, name=None)
    want = brute(docs, items)
    got = [tuple(r) for r in queries.QUERIES["op9_winnowing"](spark, MEDIUM).collect()]
    assert key(got) == key(want)
    assert any(r[5] for r in want)


def judged(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int, t string, h int, f int, at int")
    b = spark.createDataFrame(items, "item_id string, text string, id int")
    rows = winnowing.decontaminate(d, b).collect()
    return key((r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids)) for r in rows)


def test_short_items_overlaps_and_odd_rows(spark):
    span = " ".join(f"w{i}" for i in range(20))
    docs = [(1, None), (2, ""), (3, "--- !!"), (4, f"intro {span.upper()} outro"), (4, f"intro {span.upper()} outro"),
            (4, "another text of this id"), (5, "tiny pair tiny pair tiny"), (None, "x tiny pair"), (6, "É tiny　pair")]
    items = [("a", span), ("b", "Tiny, pair!"), ("b", "Tiny pair"), (None, "w3 w4"), ("e", None), ("f", "")]
    got = judged(spark, [(i, t, 0, "", 0, 0, 0) for i, t in docs], [(i, t, 0) for i, t in items])
    want = key((i, n, h, ",".join(sorted(s.split(",")) if s else [])) for i, n, h, s in [
        (1, 0, 0, None), (2, 0, 0, None), (3, 0, 0, None), (4, 22, 20, ",a"), (4, 22, 20, ",a"), (4, 5, 0, None),
        (5, 5, 4, "b"), (None, 3, 2, "b"), (6, 2, 0, None)])
    assert got == want


def test_empty_tables(spark, no_docs, odd_docs):
    none = spark.createDataFrame([], "item_id int, text string")
    assert winnowing.decontaminate(no_docs, none).count() == 0
    assert {r.n_hit for r in winnowing.decontaminate(odd_docs, none).collect()} == {0}
    some = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta alpha beta gamma delta epsilon zeta alpha")], "item_id int, text string")
    hit = {r.doc_id: r.n_hit for r in winnowing.decontaminate(odd_docs, some).collect()}
    assert hit[4] == 23995 and hit[5] == 0

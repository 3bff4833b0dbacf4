"""Op 12 against scoring of every item with every document."""

import math
import re
from collections import Counter

import pandas as pd

from claimflow.llm import queries, reversed_search
from tables import MEDIUM

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(items, docs, k=10):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for d, c in counts:
            m = 10 + (90 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scored.append((-s, d is not None, d or 0))
        out += [(item, i, d if known else None, -s) for i, (s, known, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def pairs(frame, *names):
    return list(frame[list(names)].itertuples(index=False, name=None))


def test_query_equals_brute_force(spark):
    items, docs = (pd.read_parquet(f"{MEDIUM}/{t}.parquet") for t in ("benchmark", "documents"))
    want = brute(pairs(items, "item_id", "text"), pairs(docs, "doc_id", "text"))
    assert rows_of(queries.QUERIES["op12_reversed_search"](spark, MEDIUM)) == want
    assert len(want) == 400


DOCS = [(1, None), (2, ""), (3, "--- !!"), (4, "Red GREEN blue, red"), (4, "Red GREEN blue, red"), (5, "red green blue red"), (None, "red Élan élan"),
        (6, "x" * 200_000 + " green"), (7, "green " * 50_000), (8, "zero9 9 a_b"), (9, "blue blue")] + [(20 + i, "red tie") for i in range(30)]
ITEMS = [("a", "red green"), ("a", "red green"), ("a", "blue"), ("b", None), ("c", "!!"), (None, "TIE, élan 9"), ("d", "nowhere at all")]


def test_odd_rows_and_blocks(spark):
    docs = spark.createDataFrame([(*d, 0, "", 1) for d in DOCS], "doc_id long, text string, rank int, item_id string, score long")
    items = spark.createDataFrame([(*i, 1, 2) for i in ITEMS], "item_id string, text string, doc_id long, no int")
    want = brute(ITEMS, DOCS)
    assert rows_of(reversed_search.search(items, docs)) == want
    assert rows_of(reversed_search.search(items, docs, max_postings=1)) == want
    assert rows_of(reversed_search.search(items, docs, k=3)) == brute(ITEMS, DOCS, 3)


def test_ids_of_text_and_empty_tables(spark, no_docs):
    named = [("n" + str(i), t) for i, t in DOCS if i is not None]
    docs = spark.createDataFrame(named, "doc_id string, text string")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = reversed_search.search(items, docs)
    assert got.schema["doc_id"].dataType.simpleString() == "string" and got.count() > 20
    assert reversed_search.search(items, no_docs).count() == 0
    assert reversed_search.search(items.limit(0), docs).count() == 0

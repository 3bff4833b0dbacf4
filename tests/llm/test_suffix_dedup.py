"""Op 3: suffix order and LPF against plain comparison; removed bytes against every window of every text."""

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from claimflow.llm import queries, suffix_dedup as sd
from tables import MEDIUM


def plain_lpf(texts, groups):
    """(LPF, LNF) by comparing all suffixes of a group."""
    flat = [(g, i, j) for i, (t, g) in enumerate(zip(texts, groups, strict=True)) for j in range(len(t))]
    lpf, lnf = [], []

    def same(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for x, (g, i, j) in enumerate(flat):
        own = texts[i][j:]
        lens = [same(own, texts[k][m:]) if h == g and y != x else 0 for y, (h, k, m) in enumerate(flat)]
        lpf.append(max(lens[:x], default=0))
        lnf.append(max(lens[x + 1 :], default=0))
    return lpf, lnf


@pytest.mark.parametrize("seed", range(8))
def test_lpf_equals_plain_comparison(seed):
    rng = np.random.default_rng(seed)
    texts = [bytes(rng.choice(list(b"ab\x00"), rng.integers(1, 40)).tolist()) for _ in range(5)]
    texts += [texts[0] + texts[1], b"a" * 30, b"ab" * 20]
    groups = np.array(sorted(rng.integers(1, 3, len(texts)).tolist()))
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
    order = sd.SuffixOrder(data, starts, groups, 64)
    lpf, lnf = order.longest()
    want = plain_lpf(texts, groups)
    assert lpf.tolist() == want[0] and lnf.tolist() == want[1]
    at_least = [[x if x >= 5 else 0 for x in w] for w in want]
    got = order.longest(5)
    assert got[0].tolist() == at_least[0] and got[1].tolist() == at_least[1]


def brute(texts, length, first=False):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    met, out = set(), []
    for r in raw:
        cover = np.zeros(len(r) + 1, np.int64)
        for i in range(len(r) - length + 1):
            w = r[i : i + length]
            if (w in met) if first else seen[w] > 1:
                cover[i] += 1
                cover[min(i + length, len(r))] -= 1
            if first:
                met.add(w)
        gone = np.cumsum(cover[:-1]) > 0
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((len(r), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return out


def result(rows):
    return [(r.n_bytes, r.n_removed, len(r.runs), r.kept_sha256) for r in rows]


def test_query_equals_brute_force(spark):
    docs = pd.read_parquet(f"{MEDIUM}/documents.parquet").sort_values("doc_id")
    want = [(d, *w) for d, w in zip(docs.doc_id, brute(docs.text, 400), strict=True)]
    rows = queries.QUERIES["op3_suffix_dedup"](spark, MEDIUM).collect()
    assert sorted(tuple(r)[:5] for r in rows) == want
    # the text left: its bytes are those of the digest but where a cut left part of a character
    whole = [r for r in rows if "\ufffd" not in r.text]
    assert len(whole) > 0.9 * len(rows)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in whole)
    assert sum(w[2] for w in want) > 10_000


def passages(rng, n):
    words = [f"w{i}" for i in range(400)]
    common = [" ".join(rng.choice(words, k)) for k in (12, 20, 25, 40)]
    out = []
    for i in range(n):
        parts = [" ".join(rng.choice(words, rng.integers(0, 40))) for _ in range(3)]
        out.append(" ".join(x for p in parts for x in (p, common[rng.integers(0, 4)] if i % 3 else "é" * (i % 7))))
    out += [out[1], out[1], out[2] * 3, "ab" * 150, "a" * 70, "a" * 64, None, "", common[0] * 4]
    return out


@pytest.mark.parametrize(("length", "split", "keep"), [(64, 16_384, "none"), (64, 3, "none"), (90, 2, "first"), (64, 16_384, "first"), (33, 5, "none")])
def test_lengths_splits_and_first_copies(spark, length, split, keep):
    texts = passages(np.random.default_rng(length + split), 60)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as id", "2 as t", "3 as runs", "4 as s")
    rows = sd.remove_repeats(df.repartition(5), length=length, split=split, keep=keep).orderBy("doc_id").collect()
    assert result(rows) == brute(texts, length, keep == "first")


def test_long_text_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK", 100)
    rng = np.random.default_rng(4)
    data = rng.integers(97, 101, 3000).astype(np.uint8)
    small = sd.anchors(data, 64)
    monkeypatch.setattr(sd, "CHUNK", 1 << 18)
    for a, b in zip(small, sd.anchors(data, 64), strict=True):
        assert (a == b).all()


def test_odd_rows(spark, odd_docs, no_docs):
    assert sd.remove_repeats(no_docs).count() == 0
    rows = sd.remove_repeats(odd_docs).collect()
    assert len(rows) == 9
    by = {r.doc_id: r for r in rows}
    assert by[4].n_removed == by[4].n_bytes and len(by[4].runs) == 1
    assert by[1].n_bytes == 0 and by[None].n_removed == 0
    twice = spark.createDataFrame([(1, "x" * 500), (1, "x" * 500), (None, "y" * 399), (None, "y" * 399), (2, "z" * 399)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_removed) for r in sd.remove_repeats(twice).collect()) == [
        ("1", 500), ("1", 500), ("2", 0), ("None", 0), ("None", 0)]

"""Op 11 against a trie of dictionaries."""

import hashlib
import random
import zlib

import pandas as pd

from claimflow.llm import prefix_trie, queries
from tables import MEDIUM

SCHEMA = "conv_id long, turn long, role string, text string, k1 string, depth int, _range int"


def rebuilt(turns):
    by = {}
    for conv, turn, role, text in turns:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    by = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in by.items() if c is not None}
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = by.get(c - int(c % 5), [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    rows = []
    for node, who in members.items():
        ends = sorted(c for c in who if len(convs[c]) == len(node))
        rows.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children.get(node, [])),
                     leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    turns = pd.read_parquet(f"{MEDIUM}/conversations.parquet")
    want = brute(rebuilt(turns[["conv_id", "turn", "role", "text"]].itertuples(index=False, name=None)))
    got = rows_of(queries.QUERIES["op11_prefix_trie"](spark, MEDIUM))
    assert got == want
    assert sum(r[3] > 1 for r in want) > 30


def made(seed):
    """Conversations that share first turns, copies, one that is a prefix of others, one very long, some without turns left."""
    rnd, out = random.Random(seed), []
    for c in range(60):
        n, fork = rnd.randint(1, 9), rnd.randint(0, 6)
        for t in range(n):
            said = f"turn {t} é" if t < fork else f"own {rnd.randint(0, 2)}"
            out.append((c, t, rnd.choice(["user", None]) if t > 5 else "user", said if rnd.random() > 0.1 else None))
    for c in (70, 71, 75):
        out += [(c, t, "user", f"long {t % 7}") for t in range(700)]
    out += [(80, 0, "user", "only"), (81, 0, "user", "only"), (-7, None, "user", "a"), (-7, 3, "user", "b"), (-5, 1, None, "a")]
    rnd.shuffle(out)
    return out


def test_made_conversations_small_sketch_and_hot_keys(spark):
    for seed, cells, hot in ((1, 1 << 27, 10_000), (2, 1 << 10, 5), (3, 1 << 11, 1)):
        turns = made(seed)
        df = spark.createDataFrame([(*t, "x", 1, 2) for t in turns], SCHEMA)
        keys = prefix_trie.respliced(prefix_trie.turn_keys(df))
        convs = rebuilt(turns)
        for c in (-7, -5):  # the remainder of a negative id has its sign
            own = [t[2:] for t in sorted((t for t in turns if t[0] == c), key=lambda t: (t[1] is not None, t[1] or 0))]
            own = [(r or "", x or "") for r, x in own]
            h = zlib.crc32(str(c).encode()) % 9
            base = [("", "a")]
            convs[c] = base[:h] + own[h:]
        assert rows_of(prefix_trie.trie(keys, max_cells=cells, least_hot=hot)) == brute(convs), seed


def test_as_they_are_with_repeated_rows_and_nulls(spark):
    turns = [(1, 0, "u", "a"), (1, 0, "u", "a"), (2, 0, "u", "a"), (3, 0, "u", None), (None, 0, "u", "a"), (4, 0, "u", "b" * 300_000)]
    df = spark.createDataFrame([(*t, "x", 1, 2) for t in turns], SCHEMA)
    convs = {1: [("u", "a")] * 2, 2: [("u", "a")], 3: [("u", "")], 4: [("u", "b" * 300_000)]}
    assert rows_of(prefix_trie.prefix_trie(df)) == brute(convs)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(none).count() == 0
    assert prefix_trie.trie(prefix_trie.respliced(prefix_trie.turn_keys(none))).count() == 0

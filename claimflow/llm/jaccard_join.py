"""N-gram Jaccard self-join with Bayesian candidate pruning.

Each text becomes its set of distinct runs of ``SHINGLE`` words (texts with fewer words: one run of
all of them). Texts with equal sets form one node, so exact copies are never paired. Nodes meet in
buckets of MinHash bands; in a bucket, a pair's MinHash values are compared a stretch at a time and
the pair is dropped as soon as the posterior probability (uniform prior) that its similarity reaches
the threshold is below ``TOLERANCE``; the rest are verified on the whole sets.

How it stays whole and bounded:

* Buckets that hold the same nodes are worked once, at their lowest band; a pair counts only in the
  bucket of its first agreeing band, so every pair is counted exactly once.
* A bucket of any size is dealt out as pairs of blocks of ``BLOCK`` nodes; pairs never become rows.
  A block pair returns, for each node, its number of links and the least node it is connected to.
* Whole sets travel only for nodes that have a pair left after pruning.
* Groups are the connected components of the links, by rounds of least-label exchange with pointer
  jumping; each round is a reliable checkpoint.

A pair at similarity 0.8 shares no band with probability (1 - 0.8**5)**32 = 3e-6; more similar pairs
less. Defined results: null, empty and wordless texts are linked to nothing and are their own class;
a null id has no class (null) and no links; repeated rows are copies of each other; texts are read whole;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from math import exp, lgamma, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import settle
from claimflow.llm.text_bytes import mix, span_hashes, to_bytes, window_hashes, word_bounds

SHINGLE = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, ROWS = 32, 5
VALUES = BANDS * ROWS
STRETCH = 32
BLOCK = 512
FEW = 8  # links and labels are a small part of the rows: one file for so many partitions
_RNG = np.random.default_rng(5)
_A = (_RNG.integers(0, 2**31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _RNG.integers(0, 2**32, VALUES, dtype=np.uint32)[:, None]


def shingles(text) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word runs."""
    data = to_bytes(text)
    words = span_hashes(data, *word_bounds(data))
    if 0 < len(words) < SHINGLE:
        return mix(window_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(window_hashes(words, SHINGLE))


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """VALUES MinHash values, 16 bits of each."""
    low = np.full(VALUES, 2**32 - 1, np.uint32)
    base = (shingle_set >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(base), 1024):
        part = _A * base[None, at : at + 1024]
        part += _B
        np.minimum(low, part.min(axis=1), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2")


def node_of(shingle_set: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For n compared values, the fewest matches with P(similarity >= threshold | matches) >= tolerance.
    Under a uniform prior that posterior is P(Binomial(n + 1, threshold) <= matches)."""
    out = {}
    for n in range(STRETCH, VALUES + 1, STRETCH):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(threshold)
                         + (n + 1 - m) * log(1 - threshold))
        out[n] = m
    return out


def _sketch(batches):
    for b in batches:
        nodes, sigs = [], []
        for text in b["_text"]:
            s = shingles(text)
            nodes.append(node_of(s) if len(s) else None)
            sigs.append(signature(s).tobytes() if len(s) else None)
        yield pd.DataFrame({"_id": b["_id"], "_key": b["_key"], "node": nodes, "sig": sigs})


def _sets(batches):
    for b in batches:
        found = [shingles(t) for t in b["_text"]]
        yield pd.DataFrame({"node": [node_of(s) for s in found], "shingles": [s.tobytes() for s in found]})


def _groups(batches):
    """Whole groups of rows with equal (bucket, lo, hi) from batches sorted by them."""
    held = None
    for b in batches:
        if held is not None:
            b = pd.concat([held, b], ignore_index=True)
        if not len(b):
            continue
        keys = b[["bucket", "lo", "hi"]].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist()]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            yield b.iloc[s:e]
        held = b.iloc[edges[-1] :]
    if held is not None and len(held):
        yield held


def candidates(group: pd.DataFrame, least: dict[int, int]):
    """Index pairs of a block pair that meet first in this bucket and survive the pruning, in chunks."""
    sig = np.frombuffer(b"".join(group["sig"]), "<u2").reshape(len(group), VALUES)
    band_keys = window_hashes(sig.astype(np.uint64).ravel(), ROWS)[::ROWS].reshape(len(group), BANDS)
    band, lo, hi = int(group["band"].iloc[0]), int(group["lo"].iloc[0]), int(group["hi"].iloc[0])
    block = group["block"].to_numpy()
    left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    step = max(1, 32768 // max(1, len(right)))
    for at in range(0, len(left), step):
        i, j = np.repeat(left[at : at + step], len(right)), np.tile(right, len(left[at : at + step]))
        if lo == hi:
            i, j = i[i < j], j[i < j]
        agree = band_keys[i] == band_keys[j]
        meet = agree[:, band] & (agree.argmax(axis=1) == band)
        i, j = i[meet], j[meet]
        matches = np.zeros(len(i), np.int64)
        for n in range(STRETCH, VALUES + 1, STRETCH):
            part = slice(n - STRETCH, n)
            matches += (sig[i, part] == sig[j, part]).sum(axis=1)
            stay = matches >= least[n]
            i, j, matches = i[stay], j[stay], matches[stay]
        if len(i):
            yield i, j


def _prune(least):
    def run(batches):
        for g in _groups(batches):
            alive = np.zeros(len(g), bool)
            for i, j in candidates(g, least):
                alive[i] = alive[j] = True
            if alive.any():
                yield g.loc[alive, ["bucket", "band", "lo", "hi", "block", "node"]]
    return run


def similar(group: pd.DataFrame, least: dict[int, int], threshold: float):
    """Verified index pairs and their similarities."""
    sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
    for i, j in candidates(group, least):
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        edges = np.flatnonzero(np.diff(i)) + 1
        for s, e in zip([0, *edges], [*edges, len(i)], strict=True):
            own, at = sets[i[s]], s
            while at < e:  # partners in chunks of bounded size
                to, size = at, 0
                while to < e and (to == at or size + len(sets[j[to]]) <= 4_000_000):
                    size += len(sets[j[to]])
                    to += 1
                lens = np.array([len(sets[x]) for x in j[at:to]])
                other = np.concatenate([sets[x] for x in j[at:to]])
                place = np.minimum(np.searchsorted(own, other), len(own) - 1)
                common = np.add.reduceat((own[place] == other).astype(np.int64),
                                         np.concatenate([[0], np.cumsum(lens)[:-1]]))
                union = len(own) + lens - common
                hit = common >= threshold * union - 1e-9
                yield i[at:to][hit], j[at:to][hit], (common / union)[hit]
                at = to


def _link(least, threshold):
    def run(batches):
        for g in _groups(batches):
            root, links = np.arange(len(g)), np.zeros(len(g), np.int64)
            copies, nodes = g["copies"].to_numpy(), g["node"].tolist()

            def find(x, root=root):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for i, j, _ in similar(g, least, threshold):
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                for a, b in zip(i.tolist(), j.tolist(), strict=True):
                    a, b = find(a), find(b)
                    if a != b:
                        if nodes[a] < nodes[b]:
                            root[b] = a
                        else:
                            root[a] = b
            linked = np.flatnonzero(links)
            if len(linked):
                yield pd.DataFrame({"node": [nodes[x] for x in linked], "links": links[linked],
                                    "root": [nodes[find(x)] for x in linked]})
    return run


def _pairs(least, threshold):
    def run(batches):
        for g in _groups(batches):
            nodes = g["node"].to_numpy()
            for i, j, s in similar(g, least, threshold):
                yield pd.DataFrame({"a": nodes[i], "b": nodes[j], "similarity": s})
    return run


def _nodes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Every row's node and text hash, and the nodes with their copies, least (id, text hash) and signature."""
    kind = docs.schema[id_col].dataType.simpleString()
    named = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_key"),
                        F.col(text_col).alias("_text"))
    rows = settle(named.mapInPandas(_sketch, f"_id {kind}, _key long, node binary, sig binary"))
    nodes = settle(rows.where("node is not null and _id is not null").groupBy("node")
                   .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("_id", "_key")).alias("least"),
                        F.first("sig").alias("sig"))
                   .select("node", "copies", F.col("least._id").alias("least_id"),
                           F.col("least._key").alias("least_key"), "sig"))
    return rows.select("_id", "_key", "node"), nodes


def _dealt(members: DataFrame) -> DataFrame:
    """Members of a block pair together and in order."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.repartition(n, "bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")


def _verified(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, threshold: float, tolerance: float,
              block: int, make, schema: str) -> DataFrame:
    least = least_matches(threshold, tolerance)
    width = 2 * ROWS
    banded = nodes.select("node", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("sig"), i * width + 1, F.lit(width))))).alias("band", "bucket"))
    shared = (banded.groupBy("bucket")
              .agg(F.count(F.lit(1)).alias("n"), F.min("band").alias("band"),
                   F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
              .where("n > 1"))
    worked = (shared.groupBy("n", "x", "y").agg(F.min(F.struct("band", "bucket")).alias("at"))
              .select("n", "at.band", "at.bucket"))
    members = banded.select("bucket", "node").join(worked, "bucket")
    blocks = F.ceil(F.col("n") / block).cast("int")
    spread = (members.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .select("bucket", "band", F.least("block", "other").alias("lo"),
                      F.greatest("block", "other").alias("hi"), "block", "node"))
    key = "bucket long, band int, lo int, hi int, block int, node binary"
    left = settle(_dealt(spread.join(nodes.select("node", "sig"), "node")).mapInPandas(_prune(least), key))
    asked = left.select("node").distinct().join(nodes.select("node", "least_id"), "node").select("least_id")
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = named.join(asked, F.col("_id") == F.col("least_id"), "left_semi")
    sets = (texts.mapInPandas(_sets, "node binary, shingles binary")
            .groupBy("node").agg(F.first("shingles").alias("shingles")))
    full = left.join(sets, "node").join(nodes.select("node", "sig", "copies"), "node")
    return _dealt(full).mapInPandas(make(least, threshold), schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of undirected ``edges`` (a, b): label is the least node of the component."""
    both = settle(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), FEW)
    labels = settle(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), FEW)
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m")))
        lower = (labels.join(near.withColumnRenamed("a", "node"), "node")
                 .select("node", F.col("label").alias("was"), F.least("label", "m").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = settle(lower.join(jump, "label", "left")
                     .select("node", "was", F.coalesce(F.least("label", "next"), F.col("label")).alias("label")), FEW)
        labels = new.select("node", "label")
        if new.where("was != label").isEmpty():
            return labels


def similar_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                  tolerance: float = TOLERANCE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Pairs (id_a, id_b, similarity) between class representatives, and the membership (id, representative)."""
    rows, nodes = _nodes(docs, id_col, text_col)
    pairs = _verified(docs, nodes, id_col, text_col, threshold, tolerance, block, _pairs,
                      "a binary, b binary, similarity double")
    ids = nodes.select("node", "least_id")
    named = (pairs.join(ids.select(F.col("node").alias("a"), F.col("least_id").alias("id_a")), "a")
             .join(ids.select(F.col("node").alias("b"), F.col("least_id").alias("id_b")), "b"))
    low, high = F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")
    member = rows.join(ids, "node", "left").select(
        F.col("_id").alias(id_col), F.coalesce("least_id", "_id").alias("representative"))
    return named.select(low, high, "similarity"), member


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """One row per input row: id, class_id (least id connected to it by links), copy_of (least id with
    the same shingle set), n_links (other documents of similarity >= threshold), text_key (a hash of the
    text) and class_key. Different texts may share an id: (class_id, class_key), the least (id, text_key)
    of the class, tells classes apart, and (id, text_key) rows."""
    rows, nodes = _nodes(docs, id_col, text_col)
    found = settle(_verified(docs, nodes, id_col, text_col, threshold, tolerance, block, _link,
                             "node binary, links long, root binary"))
    labels = components(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (nodes.select("node", "copies", "least_id", "least_key").join(labels, "node", "left").join(links, "node", "left")
             .withColumn("label", F.coalesce("label", "node")))
    classes = known.groupBy("label").agg(F.min(F.struct("least_id", "least_key")).alias("least"))
    known = known.join(classes, "label").select("node", F.col("least.least_id").alias("class_id"),
                                                F.col("least_id").alias("copy_of"),
                                                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                                F.col("least.least_key").alias("class_key"))
    alone = F.col("node").isNull() | F.col("_id").isNull()
    return (rows.where(~alone).join(known, "node")
            .select(F.col("_id").alias(id_col), "class_id", "copy_of", "n_links", F.col("_key").alias("text_key"), "class_key")
            .unionByName(rows.where(alone).select(
                F.col("_id").alias(id_col), F.col("_id").alias("class_id"), F.col("_id").alias("copy_of"),
                F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("text_key"), F.col("_key").alias("class_key"))))

"""Ranked lexical search the other way round: documents stream past an inverted index of the items.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` in the whole text with A-Z
lower-cased. In UTF-8 every byte outside those ranges belongs to a term, so one byte table and a split give them.

1. The items' terms (one list an item) are the index: term -> items. Items are dealt into blocks of at most
   ``MAX_POSTINGS`` postings in all, so that what is broadcast has that bound; each block is one more pass
   over the documents. A single item with more terms than the bound is a block of its own.
2. A pass over all documents gives the collection's figures: documents with a term, all terms, and for each index
   term the documents that hold it (one row a task and term, summed by Spark).
3. A second pass scores each document against the items that share a term with it, through the index, and keeps the
   ``k`` best of each item in the task: a bounded heap an item. Spark merges the heaps by rank.

Scores, all in 64-bit integers (div rounds down): term weight w = floor(1000 * ln((2N + 2) / (2df + 1))),
m = 100 - 90 + (90 * n * N) div L, score = sum over an item's distinct terms of
w * ((1000000000 * tf) div (1000 * tf + 8 * m)).

Defined results: a null or termless text has no terms and counts nowhere; an item without terms has no hits; rows that
repeat an item's id and text are one item, different texts under one id are items of their own; rows that repeat a
document's id and text are documents of their own; equal scores rank by ascending id, null first; texts are read whole;
empty tables give no rows. Other columns are left unread, whatever their names.
"""

from __future__ import annotations

import math
from bisect import insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from claimflow.llm.common import settle

MAX_POSTINGS = 500_000
SALTS = 64
_APART = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TABLE = bytes(0x20 if b in _APART else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Index:
    """Terms of a block of items: number of each term, and its items as one slice of ``items``."""

    def __init__(self, lists: list[list[bytes]]):
        of: dict[bytes, list[int]] = {}
        for i, words in enumerate(lists):
            for w in words:
                of.setdefault(w, []).append(i)
        self.n_items = len(lists)
        self.number = {w: i for i, w in enumerate(of)}
        self.start = np.cumsum([0, *map(len, of.values())])
        self.items = np.array([i for found in of.values() for i in found], np.int64)

    def counts(self, text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of terms of a text; the index terms in it and how often each occurs."""
        words = terms(text)
        got = self.number.get
        found = np.array([t for t in map(got, words) if t is not None], np.int64)
        return len(words), *np.unique(found, return_counts=True)


def _blocks(items: DataFrame, item_col: str, text_col: str, most: int):
    """Lists of (item id, terms) with at most ``most`` terms together, the next one read when it is asked for."""
    def listed(frames):
        for f in frames:
            yield pd.DataFrame({"item": f["item"], "terms": [sorted(set(terms(t))) for t in f["text"]]})

    named = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("binary").alias("text")).where("text is not null").distinct()
    item = StructField("item", items.schema[item_col].dataType)
    schema = StructType([item, *StructType.fromDDL("terms array<binary>").fields])
    lists = settle(named.mapInPandas(listed, schema).where(F.size("terms") > 0).orderBy("item", F.sha2(F.concat_ws(",", F.transform("terms", F.hex)), 256)))
    block, held = [], 0
    for r in lists.toLocalIterator():
        if block and held + len(r.terms) > most:
            yield item, block
            block, held = [], 0
        block.append((r.item, [bytes(t) for t in r.terms]))
        held += len(r.terms)
    if block:
        yield item, block


def _figures(index):
    def run(frames):
        ix, df = index.value, None
        n_docs = n_terms = 0
        df = np.zeros(len(ix.number), np.int64)
        for f in frames:
            for text in f["text"]:
                n, found, _ = ix.counts(text)
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                df[found] += 1
        held = np.flatnonzero(df)
        yield pd.DataFrame({"term": [-2, -1, *held], "n": [n_docs, n_terms, *df[held]]})

    return run


def _scored(index, weight, n_docs: int, n_terms: int, k: int):
    def run(frames):
        ix, w = index.value, weight.value
        heaps: list[list] = [[] for _ in range(ix.n_items)]
        least = np.zeros(ix.n_items, np.int64)  # the score of a full heap's last entry
        for f in frames:
            for doc, text in zip(f["doc"], f["text"], strict=True):
                n, found, tf = ix.counts(text)
                if not len(found):
                    continue
                m = 10 + (90 * n * n_docs) // n_terms
                gain = w[found] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                sizes = ix.start[found + 1] - ix.start[found]
                at = np.arange(sizes.sum()) + np.repeat(ix.start[found] - np.cumsum(sizes) + sizes, sizes)
                scores = np.zeros(ix.n_items, np.int64)
                np.add.at(scores, ix.items[at], np.repeat(gain, sizes))
                key = (doc is not None and doc == doc, doc if doc is not None and doc == doc else 0)
                for i in np.flatnonzero((scores > 0) & (scores >= least)):
                    heap = heaps[i]
                    insort(heap, (-int(scores[i]), key))
                    if len(heap) > k:
                        heap.pop()
                    if len(heap) == k:
                        least[i] = -heap[-1][0]
        rows = [(i, -score, key[1] if key[0] else None) for i, heap in enumerate(heaps) for score, key in heap]
        for at in range(0, len(rows), 10_000):
            part = rows[at : at + 10_000]
            yield pd.DataFrame({"no": [r[0] for r in part], "score": [r[1] for r in part],
                                "doc": pd.Series([r[2] for r in part], dtype=object)})

    return run


def best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    ranked = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def search(items: DataFrame, docs: DataFrame, k: int = 10, item_col: str = "item_id", item_text: str = "text",
           id_col: str = "doc_id", text_col: str = "text", max_postings: int = MAX_POSTINGS) -> DataFrame:
    """Each item's ``k`` best documents: item, rank, document id, score."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("binary").alias("text")).where("text is not null")
    doc = docs.schema[id_col].dataType
    heap = StructType([*StructType.fromDDL("no int, score long").fields, StructField("doc", doc)])
    out = None
    for item, block in _blocks(items, item_col, item_text, max_postings):
        index = spark.sparkContext.broadcast(Index([words for _, words in block]))
        figures = dict(map(tuple, texts.select("text").mapInPandas(_figures(index), "term int, n long").groupBy("term")
                           .agg(F.sum("n").alias("n")).collect()))  # at most ``max_postings`` + 2 rows
        n_docs, n_terms = figures.pop(-2, 0), figures.pop(-1, 0)
        if not n_docs:
            continue
        df = np.zeros(len(index.value.number), np.int64)
        df[list(figures)] = list(figures.values())
        weight = spark.sparkContext.broadcast(np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64))
        heaps = (texts.mapInPandas(_scored(index, weight, n_docs, n_terms, k), heap)
                 .withColumn("salt", F.spark_partition_id() % SALTS))
        merged = best(best(heaps, ["no", "salt"], k), ["no"], k)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)],
                                      StructType([*StructType.fromDDL("no int").fields, item]))
        found = merged.join(F.broadcast(names), "no").select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"),
                                                             F.col("doc").alias(id_col), "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        empty = StructType([StructField(item_col, items.schema[item_col].dataType), *StructType.fromDDL("rank int").fields,
                            StructField(id_col, doc), *StructType.fromDDL("score long").fields])
        return spark.createDataFrame([], empty)
    return out

"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every run of ``SPAN`` words, the least hash of its ``K``-word grams is kept as a fingerprint. Two
texts that share a span of ``SPAN`` words or more share the grams in it, so they share a fingerprint:
the join of test and training fingerprints misses no shared span. Documents with a common fingerprint
are then read again and their hits extended to whole windows: every ``SPAN``-word window of an item
is looked up at every word of those documents, and the words inside matches are counted once.
Items of fewer words than ``SPAN`` are one window of their own length (at most SPAN - 1 lengths),
looked up in every document. Word counts and fingerprints (a fifth of a long for each word) of all
documents are checkpointed, so texts are split once, and once more where there is something to extend.

Words: A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Windows are equal if their
64-bit hashes over the words' 64-bit hashes are.

Defined results: null or wordless texts have no words and no hits; an item without words is no window;
a null item id is read as an empty string; rows that repeat an id and a text share their result, and
rows that share only an id are judged apart; texts are read whole; an empty table of documents gives no
rows, one of items no hits. Other columns are left unread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.common import broadcast_within, settle

K = 5
SPAN = 13
MAX_BROADCAST_ROWS = 500_000  # narrow rows of numbers: at most some 20 MB
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), _LETTERS, _LETTERS.lower())
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


def runs(h: str, n: int) -> Column:
    """The hash of each run of n entries of array ``h``."""
    return F.transform(F.slice(F.col(h), 1, F.greatest(F.size(h) - (n - 1), F.lit(0))),
                       lambda x, i: F.xxhash64(x, *[F.get(F.col(h), i + j) for j in range(1, n)]))


def fingerprints(h: str, k: int = K, span: int = SPAN) -> tuple[Column, Column]:
    """Grams of ``h`` as column g, and from g the least of each stretch that a span holds."""
    width = span - k + 1
    least = F.transform(F.slice(F.col("g"), 1, F.greatest(F.size("g") - (width - 1), F.lit(0))),
                        lambda x, i: F.least(x, *[F.get(F.col("g"), i + j) for j in range(1, width)]))
    return runs(h, k), F.array_distinct(least)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", k: int = K, span: int = SPAN) -> DataFrame:
    """One row per document: id, text_key (hash of the text), n_words, n_hit, item_ids (sorted strings)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), text.alias("x"))
    item = F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item")
    tests = (items.select(item, words_of(F.col(item_text)).alias("w"))
             .select("item", F.transform("w", lambda w: F.xxhash64(w)).alias("h")).where(F.size("h") > 0))
    tests = settle(tests)
    sizes = [r[0] for r in tests.select(F.least(F.size("h"), F.lit(span))).distinct().collect()]  # at most span values

    grams, least = fingerprints("h", k, span)
    prints = (tests.where(F.size("h") >= span).withColumn("g", grams)
              .select(F.explode(least).alias("f")).distinct())
    windows = reduce(DataFrame.unionByName, [
        tests.where(F.least(F.size("h"), F.lit(span)) == n)
        .select("item", F.lit(n).alias("n"), F.explode(runs("h", n)).alias("f")).distinct() for n in sizes
    ]) if sizes else spark.createDataFrame([], "item string, n int, f long")
    windows = settle(windows)

    hashed = keyed.select("id", "t", words_of(F.col("x")).alias("w")).select(
        "id", "t", F.transform("w", lambda w: F.xxhash64(w)).alias("h"))
    sketched = settle(hashed.withColumn("g", grams).select("id", "t", F.size("h").cast("long").alias("n_words"),
                                                           least.alias("f")))
    asked = settle(sketched.select("id", "t", F.explode("f").alias("f"))
                   .join(broadcast_within(prints, MAX_BROADCAST_ROWS), "f", "left_semi")
                   .select("id", "t").distinct())
    named = broadcast_within(asked.select(F.col("id").alias("id2"), F.col("t").alias("t2")), MAX_BROADCAST_ROWS)
    read_again = (keyed.join(named, (F.col("t") == F.col("t2")) & F.col("id").eqNullSafe(F.col("id2")), "left_semi")
                  .select("id", "t", words_of(F.col("x")).alias("w"))
                  .select("id", "t", F.transform("w", lambda w: F.xxhash64(w)).alias("h")))

    found = []
    for n in sizes:
        source = read_again if n == span else hashed
        found.append(source.select("id", "t", F.posexplode(runs("h", n)).alias("at", "f"))
                     .join(broadcast_within(windows.where(F.col("n") == n), MAX_BROADCAST_ROWS), "f")
                     .select("id", "t", "at", "n", "item"))
    hits = (settle(reduce(DataFrame.unionByName, found).distinct()) if found
            else spark.createDataFrame([], f"id {docs.schema[id_col].dataType.simpleString()}, t long, at int, n int, item string"))
    before = Window.partitionBy("id", "t").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("n")
    covered = (hits.select("id", "t", "at", "n").distinct()
               .withColumn("past", F.coalesce(F.max(end).over(before), F.lit(0)))
               .groupBy("id", "t")
               .agg(F.sum(F.greatest(end - F.greatest("at", "past"), F.lit(0))).cast("long").alias("n_hit")))
    listed = hits.groupBy("id", "t").agg(F.array_sort(F.collect_set("item")).alias("item_ids"))
    known = (covered.alias("c").join(listed.alias("l"), F.expr("c.id <=> l.id and c.t = l.t"))
             .select("c.id", "c.t", "n_hit", "item_ids"))
    known = known.select(F.col("id").alias("id2"), F.col("t").alias("t2"), "n_hit", "item_ids")
    return (sketched.select("id", "t", "n_words")
            .join(known, (F.col("t") == F.col("t2")) & F.col("id").eqNullSafe(F.col("id2")), "left")
            .select(F.col("id").alias(id_col), F.col("t").alias("text_key"), "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty lies inside a window of the benchmark."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)

"""Filtered top-k text retrieval (G11) as a Spark job: BM25 over a corpus table.

Plan shape, all DataFrame operators:
  1. tokenize queries -> distinct (query, term); the set of query terms is
     the (small) driving side;
  2. tokenize the corpus once -> (doc, term, tf), counted inside each row by runs of its
     sorted tokens, so a task holds one document and no table of a whole input split;
     semi-joined to the query terms so only matching postings are shuffled further; each
     document also has one posting of a mark (``MARKS`` different ones, so no task holds
     them all), from which the corpus-wide figures (document count, mean length) are
     summed: they come out of the same exchange, as a scalar subquery, and no job runs
     while the plan is built but the counts that bound the broadcasts of the query terms;
  3. postings are dealt by document to ``TASKS`` partitions for each one of the corpus (a
     fixed number, which AQE does not coalesce by the postings' few bytes: each posting
     meets many queries), so rows of one document id merge where they are;
  4. document frequency per query term (aggregate), idf;
  5. equality filters on corpus attributes travel with the postings and are keys of the
     join with the query terms, so pairs that a filter excludes are never scored;
  6. score = sum over matching terms, per (query, doc); with query terms and idf broadcast
     the pairs of a document are scored in its partition and none is shuffled;
  7. top-k per query with ``row_number() <= k`` (score ties, e.g. duplicate
     documents, broken by doc id) — Spark plans this as a
     WindowGroupLimit, which already cuts each partition to k rows per query
     before the shuffle, so a query matching most documents stays cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOKEN_PATTERN = "[^a-z0-9]+"
MARK = "\u0000"  # no token holds it
MARKS = 256
TASKS = 8  # partitions of postings for each one of the corpus


def tokenize(text: Column) -> Column:
    """Lower-cased [a-z0-9] runs; the empty edge tokens of ``split`` are removed natively."""
    return F.array_remove(F.split(F.lower(text), TOKEN_PATTERN), "")


def term_counts(toks: Column) -> Column:
    """array<struct<term, tf>> of an array of tokens: the runs of equal ones once they are sorted. An array of
    one element binds a value, so it is computed once and not for each element."""
    def runs(s: Column) -> Column:
        starts = F.array_compact(F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1) != x), i)))
        return F.transform(F.array(starts), lambda at: F.transform(at, lambda a, j: F.struct(
            F.get(s, a).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(s)) - a).alias("tf"))))[0]

    return F.transform(F.array(F.sort_array(toks)), runs)[0]


def search(corpus: DataFrame, queries: DataFrame, text_col: str, doc_id: str, k: int = 10,
           filters: dict[str, str] | None = None, k1: float = 1.2, b: float = 0.75,
           return_cols: list[str] | None = None) -> DataFrame:
    """Top-``k`` documents per query by BM25.

    ``queries`` has ``query_id`` and ``query``. ``filters`` maps a corpus column
    to a query column that must be equal (the '@eq' filter of the source).
    Returns (query_id, rank, doc_id, score, *return_cols).
    """
    from claimflow.session import bounded_broadcast, spread
    filters = filters or {}
    extra = list(dict.fromkeys([*filters, *(return_cols or [])]))
    docs = corpus.select(F.col(doc_id).alias("doc_id"), F.col(text_col).alias("_text"), *extra)
    parts = TASKS * max(docs.rdd.getNumPartitions(), docs.sparkSession.sparkContext.defaultParallelism)
    docs = spread(docs, key=["doc_id"])
    mark = F.concat(F.lit(MARK), F.pmod(F.xxhash64("doc_id"), F.lit(MARKS)).cast("string"))
    kept = [F.col(c).alias(f"_q_{c}") for c in filters]
    wanted = [f"_q_{c}" for c in filters]
    toks = docs.select("doc_id", *kept, F.coalesce(tokenize(F.col("_text")), F.array().cast("array<string>")).alias("_toks"), mark.alias("_mark"))
    qterms = (queries.select("query_id", *[F.col(v).alias(f"_q_{c}") for c, v in filters.items()],
                             F.explode(tokenize(F.col("query"))).alias("term"))
              .groupBy("query_id", *wanted, "term").agg(F.count(F.lit(1)).alias("qtf")))
    marks = queries.sparkSession.range(MARKS).select(F.concat(F.lit(MARK), F.col("id").cast("string")).alias("term"))
    vocab = qterms.select("term").distinct().unionByName(marks)
    near = bounded_broadcast(vocab)
    # document length rides along with each posting: no per-document join back
    post = (toks.select("doc_id", *wanted, F.size("_toks").alias("dl"), F.inline(term_counts(F.array_append("_toks", F.col("_mark")))))
            .join(near, "term", "left_semi")
            .repartition(parts, "doc_id")
            .groupBy("doc_id", *wanted, "term", "dl").agg(F.sum("tf").alias("tf")))
    # one aggregate gives the document frequencies and, by the marks, the corpus-wide figures; ``_dl`` is read
    # and the marks are not filtered in both branches, so Catalyst prunes neither and the exchange is reused:
    # the corpus is tokenized once
    terms = post.groupBy("term").agg(F.count(F.when(F.col("tf") > 0, F.lit(1))).alias("df"), F.sum("dl").alias("_dl")).where("_dl >= 0")
    marked = F.col("term").startswith(MARK)
    total = F.sum(F.when(marked, F.col("df")))
    stats = terms.agg(F.coalesce(total, F.lit(0)).cast("double").alias("n"), (F.sum(F.when(marked, F.col("_dl"))) / total).alias("avgdl"))
    n_docs, avgdl = stats.select("n").scalar(), stats.select("avgdl").scalar()
    idf = terms.select("term", F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    if near is not vocab:  # as few rows as the query terms that were counted
        idf = F.broadcast(idf)
    p = post.join(idf, "term")                   # one row per matched query term
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / F.greatest(avgdl, F.lit(1e-9)))
    p = p.withColumn("w", F.col("idf") * F.col("tf") * (k1 + 1.0) / (F.col("tf") + norm))
    scored = (p.join(bounded_broadcast(qterms), ["term", *wanted]).groupBy("query_id", "doc_id")
              .agg(F.sum(F.col("w") * F.col("qtf")).alias("score")))
    # equal documents score equal up to summation order: rank on 1e-9 so ties fall to doc_id
    w = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), F.col("doc_id").asc())
    top = scored.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)
    if return_cols:
        top = top.join(docs.select("doc_id", *return_cols), "doc_id")
    return top.select("query_id", "rank", "doc_id", "score", *(return_cols or []))

"""URL filter: host and path rules, and logistic regression on hashed character n-grams.

The host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z
lower-cased; the path is what follows up to ``?``, ``#`` or the end. A rule (verdict, host + path) fits
its host and all subdomains if the path starts with the rule's path; the longest rule that fits decides.
Other URLs are judged by a logistic regression: character n-grams of host and path (each with marks
for its ends, hashed into ``BUCKETS``, one feature each if present) are fitted on a small labelled table
of URLs (url, label: 1 block) and scored on every row. Everything runs in the JVM.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is
judged on its end marks alone; repeated rows are judged alike; whole URLs are read; an empty table gives
no rows; a labelled table with one label or none makes that label (none: allow) every verdict. Other
columns pass through, but for those of the result's names, which are replaced.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import free_prefix

BUCKETS = 1 << 14
SIZES = (3, 4, 5)
SHRINK = 0.01
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. ``rules``: (verdict, "host/path"), a short list."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(slash + p)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def grams(host: Column, path: Column) -> Column:
    """Distinct n-grams of both, told apart by a prefix."""
    found = []
    for tag, part in (("h", host), ("p", path)):
        marked = F.concat(F.lit("^"), part, F.lit("$"))
        for n in SIZES:
            last = F.length(marked) - n + 1
            at = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
            found.append(_cut(at, marked, n, tag))
    return F.array_distinct(F.concat(*found))


def _cut(at: Column, marked: Column, n: int, tag: str) -> Column:
    return F.transform(at, lambda i: F.concat(F.lit(tag), F.substring(marked, i, F.lit(n))))


def filter_urls(pages: DataFrame, labelled: DataFrame, rules=(), url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, p_block and verdict. ``labelled``: (url, label)."""
    mine = ["host", "path", "rule", "p_block", "verdict"]
    pages = pages.drop(*[c for c in mine if c != url_col])
    own = free_prefix(pages)
    parts = lambda df, url: df.withColumns({f"{own}host": host_of(F.col(url)), f"{own}path": path_of(F.col(url))})
    known = (parts(labelled.select(F.col("url").alias(f"{own}url"), F.col("label").cast("double").alias(f"{own}label"))
                   .where(f"{own}label is not null"), f"{own}url")
             .select(f"{own}label", grams(F.col(f"{own}host"), F.col(f"{own}path")).alias(f"{own}grams")))
    labels = sorted(r[0] for r in known.select(f"{own}label").distinct().limit(3).collect())
    df = parts(pages, url_col)
    rule, said = rule_for(F.col(f"{own}host"), F.col(f"{own}path"), rules)
    df = df.withColumns({f"{own}rule": rule, f"{own}said": said})
    if len(labels) > 1:
        hashing = HashingTF(numFeatures=BUCKETS, binary=True, inputCol=f"{own}grams", outputCol=f"{own}features")
        model = LogisticRegression(featuresCol=f"{own}features", labelCol=f"{own}label", probabilityCol=f"{own}probability",
                                   rawPredictionCol=f"{own}raw", predictionCol=f"{own}predicted", regParam=SHRINK,
                                   standardization=False, maxIter=100).fit(hashing.transform(known.coalesce(1)))
        df = model.transform(hashing.transform(df.withColumn(f"{own}grams", grams(F.col(f"{own}host"), F.col(f"{own}path")))))
        df = df.withColumn(f"{own}block", vector_to_array(f"{own}probability")[1])
    else:
        df = df.withColumn(f"{own}block", F.lit(labels[0] if labels else 0.0))
    verdict = F.coalesce(f"{own}said", F.when(F.col(f"{own}block") >= 0.5, "block").otherwise("allow"))
    keep = [c for c in pages.columns if c not in mine or c == url_col]
    return df.select(*keep, F.col(f"{own}host").alias("host"), F.col(f"{own}path").alias("path"), F.col(f"{own}rule").alias("rule"),
                     F.col(f"{own}block").alias("p_block"), verdict.alias("verdict"))

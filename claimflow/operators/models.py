"""Injectable model steps (G01, G12) and document extraction.

There is no hosted model in a Spark job; every model-backed step takes a
caller-supplied callable that runs per Arrow batch inside ``mapInPandas``
(one call per batch, not per row). Without a callable the step returns NULL
replies and the calling operator takes its source-defined fallback branch.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.functions.dates import as_ts
from claimflow.functions.text import cut
from claimflow.operators.search import tokenize


def _bucket_sums(dim: int):
    """Arrow-batched scorer: per row, signed counts of hashed tokens per bucket
    (``np.bincount``, O(tokens)), L2-normalised; an empty or NULL text gives zeros."""
    import numpy as np

    def run(codes: pd.Series) -> pd.Series:
        out = []
        for c in codes:
            if c is None or len(c) == 0:
                out.append(np.zeros(dim, dtype=np.float32))
                continue
            c = np.asarray(c, dtype=np.int64)
            v = np.bincount(c >> 1, weights=1.0 - 2.0 * (c & 1), minlength=dim)
            n = np.sqrt(np.dot(v, v))
            out.append((v / n if n > 0 else v).astype(np.float32))
        return pd.Series(out)

    return F.pandas_udf(run, "array<float>")


def embed_text(df: DataFrame, col: str, dim: int = 768, n_chars: int | None = None, out: str = "embedding") -> DataFrame:
    """G01 default: signed feature hashing of the tokens (of the first ``n_chars``
    characters if given) into ``dim`` buckets, L2-normalised.

    Tokenizing and hashing are native expressions evaluated once per row (one
    code per token: bucket * 2 + sign bit); only the bucket sum runs in Python,
    one Arrow batch at a time with numpy, so the cost is O(tokens), not
    O(tokens x dim)."""
    toks = tokenize(cut(F.col(col), n_chars))
    codes = F.transform(toks, lambda t: F.pmod(F.xxhash64(t), F.lit(dim)) * 2
                        + F.pmod(F.xxhash64(F.concat(t, F.lit("#s"))), F.lit(2)))
    return df.withColumn(out, _bucket_sums(dim)(codes))


def complete(df: DataFrame, prompt_col: str, model: Callable[[pd.Series], pd.Series] | None = None,
             out: str = "reply") -> DataFrame:
    """Batch completion. ``model(prompts) -> replies`` is called once per Arrow
    batch; no model -> NULL reply (the caller's fallback applies)."""
    if model is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    fn = F.pandas_udf(lambda s: model(s), "string")
    return df.withColumn(out, fn(F.col(prompt_col)))


# ------------------------------------------------------------------ documents
def list_documents(spark, path: str, recursive: bool = True) -> DataFrame:
    """Directory listing of staged files (path, size, modification time)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return r.select("path", "length", "modificationTime")


def register_documents(files: DataFrame, as_of, path_col: str = "path") -> DataFrame:
    """Registry rows from staged paths laid out as ``<claim_id>/<doc_id>_<name>``;
    status PENDING."""
    p = F.col(path_col)
    return files.select(
        F.regexp_extract(p, r"([^/]+)/([^/_]+)_([^/]+)$", 2).alias("document_id"),
        F.regexp_extract(p, r"([^/]+)/([^/_]+)_([^/]+)$", 1).alias("claim_id"),
        F.regexp_extract(p, r"([^/]+)/([^/_]+)_([^/]+)$", 3).alias("file_name"),
        p.alias("stage_path"),
        F.col("length").alias("file_size_bytes"),
        as_ts(as_of).alias("upload_date"),
        F.lit("PENDING").alias("extraction_status"),
        F.lit(None).cast("string").alias("extracted_text"),
    )


TEXT_SUFFIXES = (".txt", ".md", ".csv", ".json", ".html", ".htm")


def process_documents(registry: DataFrame, files: DataFrame, as_of, parser: Callable[[bytes, str], str] | None = None,
                      dim: int = 768, embed_chars: int | None = None) -> DataFrame:
    """Extract text for PENDING documents (joined to their file bytes by path),
    status EXTRACTED / FAILED, text length, embedding (of the first ``embed_chars`` characters if given).

    Text formats decode as UTF-8 natively; other formats (PDF, images) need an
    injected ``parser(bytes, path) -> text`` run per Arrow batch."""
    pend = registry.filter(F.col("extraction_status") == "PENDING")
    f = files.select(F.col("path").alias("stage_path"), "content")
    j = pend.drop("extracted_text").join(f, "stage_path", "left")
    is_text = F.lower(F.col("stage_path")).rlike(r"\.(txt|md|csv|json|html?)$")
    text = F.when(is_text, F.decode(F.col("content"), "UTF-8"))
    if parser is not None:
        def parse(paths: pd.Series, blobs: pd.Series) -> pd.Series:
            out = []
            for pth, blob in zip(paths, blobs):
                try:
                    out.append(parser(blob, pth) if blob is not None else None)
                except Exception:  # noqa: BLE001 — a failed parse marks the document FAILED
                    out.append(None)
            return pd.Series(out, dtype=object)
        text = F.coalesce(text, F.pandas_udf(parse, "string")(F.col("stage_path"), F.col("content")))
    j = j.withColumn("extracted_text", text).drop("content")
    ok = F.col("extracted_text").isNotNull() & (F.length("extracted_text") > 0)
    j = (j.withColumn("extraction_status", F.when(ok, "EXTRACTED").otherwise("FAILED"))
          .withColumn("extraction_date", as_ts(as_of))
          .withColumn("text_length", F.length("extracted_text")))
    j = embed_text(j, "extracted_text", dim=dim, n_chars=embed_chars, out="text_embedding")
    return j.withColumn("text_embedding", F.when(ok, F.col("text_embedding")))


def read_csv(spark, path: str, schema, null_markers: tuple[str, ...] = ("NULL", "null", "")) -> DataFrame:
    """Comma CSV, one header row, '"' quoting; three NULL markers (the reader
    takes one ``nullValue``, so the others are mapped with ``when``)."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').schema(schema).csv(path)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.simpleString() == "string":
            c = F.when(c.isin(*null_markers), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)

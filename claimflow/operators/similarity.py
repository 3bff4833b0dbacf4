"""Vector operators: cosine (G02), max similarity to a pattern set (G03), top-k
similar patterns with a LOB filter (G05/G06), pattern refresh (G04).

Scoring rows against a pattern set is a dense product. Patterns are dealt into ``blocks`` by a hash
of what they hold and rows into ``slices`` by their row number, by default so many that each holds some
``TASK_ROWS`` of the counted rows (at least ``PATTERN_BLOCKS``, and the session's shuffle partitions); each
(block, slice) is one co-grouped task that scores its rows with numpy, at most ``CELLS`` similarities at a
time. Pair rows are never made, only the two counts pass through the driver, and the partial results of a
row are merged by its row number, so the number of blocks and slices never shows in the result and rows
that share a key stay apart.

A NULL vector, a vector with a NULL or of another length, and a zero vector have no similarity (NULL).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PATTERN_BLOCKS = 4
TASK_ROWS = 8192  # of each side
CELLS = 1 << 22  # 32 MB


def cosine(a: Column | str, b: Column | str) -> Column:
    """Native cosine similarity of two float arrays (double accumulation, JVM-side)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    zero = F.lit(0.0).cast("double")
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), zero, lambda s, v: s + v)
    na = F.aggregate(a, zero, lambda s, v: s + v.cast("double") * v.cast("double"))
    nb = F.aggregate(b, zero, lambda s, v: s + v.cast("double") * v.cast("double"))
    return F.try_divide(dot, F.nullif(F.sqrt(na) * F.sqrt(nb), zero))


def _unit(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Rows of unit length, and which of them have a direction at all."""
    size = max((len(v) for v in vectors if v is not None), default=0)
    out = np.full((len(vectors), size), np.nan)
    for i, v in enumerate(vectors):
        if v is not None and len(v) == size:
            out[i] = np.asarray(v, dtype=np.float64)
    norm = np.linalg.norm(out, axis=1)
    known = np.isfinite(norm) & (norm > 0)
    out[known] /= norm[known, None]
    return out, known


def _sizes(left: DataFrame, patterns: DataFrame, blocks: int | None, slices: int | None) -> tuple[int, int]:
    """Numbers of blocks and slices that keep a task at some TASK_ROWS rows of each side."""
    blocks = blocks or max(PATTERN_BLOCKS, -(-patterns.count() // TASK_ROWS))
    least = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks, slices or max(least, -(-left.count() // TASK_ROWS))


def _numbered(left: DataFrame, cols: list[str], blocks: int, slices: int) -> DataFrame:
    """Rows with a number of their own, once for each pattern block."""
    return (left.select(*cols).withColumn("_row", F.monotonically_increasing_id())
            .withColumn("_slice", F.pmod(F.xxhash64("_row"), F.lit(slices)).cast("int"))
            .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))


def _dealt(patterns: DataFrame, cols: list[str], blocks: int, slices: int) -> DataFrame:
    """Patterns in their block, once for each slice of rows."""
    return (patterns.select(*cols)
            .withColumn("_block", F.pmod(F.xxhash64(*cols), F.lit(blocks)).cast("int"))
            .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))


def _scored(left: pd.DataFrame, right: pd.DataFrame, left_vec: str, pattern_vec: str):
    """(first row, similarities of the rows from there on and all patterns), NaN where there is none; at
    most CELLS at a time, or one row."""
    a, a_known = _unit(left[left_vec])
    b, b_known = _unit(right[pattern_vec])
    step = max(1, CELLS // max(1, len(b)))
    for at in range(0, len(a), step):
        part, known = a[at : at + step], a_known[at : at + step]
        out = np.full((len(part), len(b)), np.nan)
        if a.shape[1] == b.shape[1]:
            out[np.ix_(known, b_known)] = part[known] @ b[b_known].T
        yield at, out


def max_similarity(left: DataFrame, patterns: DataFrame, left_vec: str, pattern_vec: str,
                   key_cols: list[str], out_col: str = "max_similarity",
                   blocks: int | None = None, slices: int | None = None) -> DataFrame:
    """Per row of ``left``: max cosine similarity to any pattern (NULL if none)."""
    blocks, slices = _sizes(left, patterns, blocks, slices)
    rows = _numbered(left, [*dict.fromkeys([*key_cols, left_vec])], blocks, slices)
    # equal vectors have equal similarities: one stands for all, so no block gathers them
    dealt = _dealt(patterns.select(pattern_vec).distinct(), [pattern_vec], blocks, slices)

    schema = T.StructType([T.StructField("_row", T.LongType()), *[left.schema[c] for c in dict.fromkeys(key_cols)],
                           T.StructField("_best", T.DoubleType())])

    def score(l_rows: pd.DataFrame, r_rows: pd.DataFrame) -> pd.DataFrame:
        best = np.full(len(l_rows), -np.inf)
        for at, sims in _scored(l_rows, r_rows, left_vec, pattern_vec):
            best[at : at + len(sims)] = np.nan_to_num(sims, nan=-np.inf).max(axis=1, initial=-np.inf)
        return l_rows[["_row", *dict.fromkeys(key_cols)]].assign(_best=np.where(np.isfinite(best), best, np.nan))

    # the keys go with the scores, so the row numbers are read once and join nothing
    return (rows.groupBy("_block", "_slice").cogroup(dealt.groupBy("_block", "_slice"))
            .applyInPandas(score, schema).groupBy("_row")
            .agg(*[F.first(c).alias(c) for c in dict.fromkeys(key_cols)],
                 F.max(F.nanvl("_best", F.lit(None).cast("double"))).alias(out_col))
            .select(*key_cols, out_col))


def top_k_patterns(left: DataFrame, patterns: DataFrame, left_vec: str, pattern_vec: str, k: int,
                   key_cols: list[str], left_lob: str = "lob_type", pattern_lob: str = "lob_type",
                   pattern_cols: tuple[str, ...] = ("pattern_id", "pattern_type", "severity", "pattern_description"),
                   all_label: str = "ALL", blocks: int | None = None, slices: int | None = None) -> DataFrame:
    """For each row, the ``k`` most similar patterns whose LOB equals the row's
    LOB or ``all_label``; long form (keys, rank, pattern columns, similarity_score).

    Ties are broken by pattern id. Each block keeps its own top-k of a row; a window over
    the row's number keeps the global top-k.
    """
    cols = [*dict.fromkeys([*key_cols, left_vec, left_lob])]
    pcols = list(pattern_cols)
    blocks, slices = _sizes(left, patterns, blocks, slices)
    rows = _numbered(left, cols, blocks, slices)
    dealt = _dealt(patterns, [*dict.fromkeys([*pcols, pattern_lob, pattern_vec])], blocks, slices)
    schema = T.StructType([T.StructField("_row", T.LongType()), *[left.schema[c] for c in key_cols],
                           *[patterns.schema[c] for c in pcols], T.StructField("similarity_score", T.DoubleType())])

    def score(l_rows: pd.DataFrame, r_rows: pd.DataFrame) -> pd.DataFrame:
        r_rows = r_rows.sort_values(pcols[0], kind="stable")
        found = []
        for lob, part in l_rows.groupby(left_lob, dropna=False):
            mine = r_rows[(r_rows[pattern_lob] == lob) | (r_rows[pattern_lob] == all_label)]
            if not len(mine):
                continue
            for at, sims in _scored(part, mine, left_vec, pattern_vec):
                order = np.argsort(np.where(np.isnan(sims), np.inf, -sims), axis=1, kind="stable")[:, :k]
                i = np.repeat(np.arange(len(sims)), order.shape[1])
                j = order.ravel()
                keep = ~np.isnan(sims[i, j])
                i, j = i[keep], j[keep]
                found.append(pd.concat([part[["_row", *key_cols]].iloc[at + i].reset_index(drop=True),
                                        mine[pcols].iloc[j].reset_index(drop=True)], axis=1).assign(similarity_score=sims[i, j]))
        return pd.concat(found) if found else pd.DataFrame(columns=schema.names)

    near = (rows.groupBy("_block", "_slice").cogroup(dealt.groupBy("_block", "_slice"))
            .applyInPandas(score, schema))
    w = Window.partitionBy("_row").orderBy(F.col("similarity_score").desc(), F.col(pcols[0]).asc())
    return near.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k).drop("_row")


def similar_patterns_array(top_k: DataFrame, key_cols: list[str], chars: int | None = None) -> DataFrame:
    """Pack the top-k rows into one array of structs per key, ordered by score.
    ``chars`` cuts the descriptions for a caller that wants them short."""
    text = F.col("pattern_description") if chars is None else F.substring("pattern_description", 1, chars)
    s = F.struct(F.col("rank"), F.col("pattern_type"), F.col("severity"), F.col("similarity_score"),
                 text.alias("description"))
    return (top_k.groupBy(*key_cols).agg(F.sort_array(F.collect_list(s)).alias("_a"))
                 .withColumn("similar_patterns", F.transform("_a", lambda x: x.dropFields("rank"))).drop("_a"))


def refresh_pattern_embeddings(indicators: DataFrame, target: DataFrame, embed_fn,
                               key: str = "pattern_id") -> DataFrame:
    """Insert-only refresh. The anti join runs *before* embedding so only
    indicators not yet in ``target`` are scored; returns the rows to append."""
    new = indicators.join(target.select(key), key, "left_anti")
    return embed_fn(new)

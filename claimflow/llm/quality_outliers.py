"""Quality rules: fixed base rules, and robust multivariate outliers per language and source.

Each text gives counts (words, their characters, symbols, repeated lines, words in repeated 5-word
windows, capitals), read from the whole text; a vector of transformed statistics follows from them.
For every (language, source) the location and scatter of the vectors are minimum-covariance-determinant
estimates: the share ``SUBSET`` of the documents whose covariance has the least determinant. They are
found by concentration steps from two deterministic starts (medians with absolute deviations, and the
correlation of tanh scores), all groups and starts at once: distances, the group's distance that bounds
its subset, then counts, sums and products of the subset. The start with the lesser determinant stays,
the scatter is scaled so that the median squared distance is that of chi-square, and is estimated once
more from the documents within its 97.5 % point.

The scatter's diagonal gets a floor that only keeps it regular: ``RIDGE`` of the group's own spread of each
statistic. A statistic of which most of the group has one value (no symbols at all) has no spread and no
covariance to estimate; its floor is the upper quartile of the distance from that value, or, where that
is less, what one symbol, line, window or capital makes in the group's median text.

The same estimates are made for each language and for all documents. A group's estimate is drawn towards its
language's, and that towards the overall one, in the proportion ``PRIOR_ROWS`` to its documents: a large group is
judged by its own, one of a few documents mostly by its language's, without a size at which that changes.

A document is rejected if its distance lies beyond the tail of its group's own distances: the median of
log(distance) plus ``TAIL`` times what lies between it and the upper quartile (chi-square's 97.5 % point at
least; less than a quarter of a group may be outliers for that). For chi-square distances that is their 97.5 % point; groups with long tails get a wider bound. The bound is
drawn towards the language's in the same way, by ``TAIL_PRIOR`` times as many rows.

Every step is an aggregation with partial sums over all documents; no group is gathered, and what goes
back to the documents is one row a group. Quantiles are read from counts on a fixed grid, so reruns
agree.

Defined results: a null or wordless text has zero counts, fails the base rules and has no distance;
null language and source are values of their own; repeated rows count as often as they occur and are
judged alike; texts are read whole; an empty table gives no rows. Other columns are left unread.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import broadcast_within, settle
from claimflow.llm.text_bytes import IS_SPACE, span_hashes, to_bytes, window_hashes, word_bounds

STATISTICS = ["log_words", "log_word_length", "symbols", "repeated_lines", "repeated_words", "capitals"]
LINE_WORDS = 30  # of a usual line
GRID = 1 / 512
RIDGE = 0.1
P = len(STATISTICS)
SUBSET = 0.6
STEPS = 6
PRIOR_ROWS = 60
TAIL = 2.5
TAIL_PRIOR = 4  # times PRIOR_ROWS
NARROW = 16  # one task takes what comes of so many shuffle partitions: rows a cell, not a document
MAX_GROUPS = 50_000  # rows of a few numbers that are broadcast at most
CHI2_MEDIAN, CHI2_975 = 5.348, 14.449  # fixed values: chi-square with 6 degrees of freedom
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True  # fixed value of the contract
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80
WINDOW = 5


def counts(text) -> tuple:
    """COUNTS of a text."""
    data = to_bytes(text)
    starts, ends = word_bounds(data)
    if not len(starts):
        return (0,) * len(COUNTS)
    inside = ~IS_SPACE[data]
    breaks = np.flatnonzero(data == 0x0A)
    line_start, line_end = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(data)]])
    upto = np.concatenate([[0], np.cumsum(inside)])
    full = upto[line_end] > upto[line_start]
    lines = span_hashes(data, line_start[full], line_end[full])
    repeated = 0
    windows = window_hashes(span_hashes(data, starts, ends), WINDOW)
    if len(windows) > 1:
        _, which, often = np.unique(windows, return_inverse=True, return_counts=True)
        again = often[which] > 1
        cover = np.zeros(len(starts) + 1, np.int64)
        cover[: len(windows)] += again
        cover[WINDOW : WINDOW + len(windows)] -= again
        repeated = int((np.cumsum(cover[:-1]) > 0).sum())
    return (len(starts), int((inside & _STARTS_CHAR[data]).sum()), int(_SYMBOL[data].sum()),
            int(full.sum()) - len(np.unique(lines)), repeated, int(full.sum()), int(_CAPITAL[data].sum()))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (n_repeat_words * 100 > n_words * 20)


def statistics() -> dict[str, Column]:
    words = F.col("n_words").cast("double")
    return dict(zip(STATISTICS, [
        F.log(words), F.log(F.col("word_chars") / words), F.sqrt(F.col("n_symbols") / F.col("word_chars")),
        F.sqrt(F.col("n_dup_lines") / F.col("n_lines")), F.sqrt(F.col("n_repeat_words") / words),
        F.sqrt(F.col("n_capitals") / F.col("word_chars"))], strict=True))


def count_texts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = pd.DataFrame([counts(t) for t in b["_text"]], columns=COUNTS, dtype="int64")
            yield pd.concat([b[["_id", "_lang", "_source"]].reset_index(drop=True), found], axis=1)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"),
                       F.col(source_col).alias("_source")).mapInPandas(
        run, f"_id {kind}, _lang string, _source string, " + ", ".join(f"{c} long" for c in COUNTS))


def grid_quantiles(df: DataFrame, keys: list[str], values: dict[str, Column], parts: list[float], step: float = GRID) -> DataFrame:
    """keys, and for each value the array of upper edges of the grid cells in which the shares ``parts`` of the key's
    rows are reached. One aggregation; what it holds of a key is a count for each cell that occurs."""
    cells = df.select(*keys, *[F.floor(c / step).alias(n) for n, c in values.items()])
    tasks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // NARROW)
    edge = lambda n, p: (F.expr(f"percentile_disc({p}) within group (order by `{n}`)").cast("double") + 1) * step
    return cells.groupBy(*keys).agg(*[F.array(*[edge(n, p) for p in parts]).alias(n) for n in values]).coalesce(tasks)


def _moments(df: DataFrame, keys: list[str], values: list[Column]) -> DataFrame:
    """keys, n, sums and products (upper triangle) of the values."""
    pairs = [(i, j) for i in range(P) for j in range(i, P)]
    sums = [F.sum(v).alias(f"_s{i}") for i, v in enumerate(values)]
    products = [F.sum(values[i] * values[j]).alias(f"_p{i}_{j}") for i, j in pairs]
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums, *products)
            .select(*keys, "n", F.array(*[f"_s{i}" for i in range(P)]).alias("sums"),
                    F.array(*[f"_p{i}_{j}" for i, j in pairs]).alias("products")))


def _covariance(row) -> tuple[np.ndarray, np.ndarray]:
    n = row["n"]
    mean = np.array(row["sums"]) / n
    full = np.zeros((P, P))
    full[np.triu_indices(P)] = row["products"]
    full = full + np.triu(full, 1).T
    return mean, full / n - np.outer(mean, mean)


_FIT = "cell string, start int, floors array<double>, center array<double>, scatter array<double>, precision array<double>, logdet double"
_NAMES = ["cell", "start", "floors", "center", "scatter", "precision", "logdet"]


def _inverse(scatter: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, float]:
    """Inverse and log-determinant, in units of the floors (statistics differ much in size)."""
    unit = np.outer(floors, floors)
    values, vectors = np.linalg.eigh((scatter + scatter.T) / 2 / unit)
    values = np.maximum(values, 0.5)  # the floors' own share is 1 but for rounding
    return vectors @ np.diag(1 / values) @ vectors.T / unit, float(np.log(values).sum() + 2 * np.log(floors).sum())


def _fit_row(cell, start, floors, center, scatter) -> tuple:
    floors = np.asarray(floors, float)
    scatter = scatter + np.diag(floors**2)
    precision, logdet = _inverse(scatter, floors)
    return (cell, int(start), floors.tolist(), center.tolist(), scatter.ravel().tolist(), precision.ravel().tolist(), logdet)


def _refit(batches):
    for b in batches:
        rows = [_fit_row(r["cell"], r["start"], r["floors"], *_covariance(r)) for _, r in b.iterrows()]
        yield pd.DataFrame(rows, columns=_NAMES)


def _first_fits(batches):
    """Two starts a cell from medians, deviations and the moments of tanh scores."""
    for b in batches:
        rows = []
        for _, r in b.iterrows():
            center, spread = np.array(r["medians"]), np.array(r["spreads"])
            _, cov = _covariance(r)
            scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            near = np.clip(cov / np.outer(scale, scale), -0.98, 0.98)
            np.fill_diagonal(near, 1.0)
            rows += [_fit_row(r["cell"], 0, r["floors"], center, np.diag(spread**2)),
                     _fit_row(r["cell"], 1, r["floors"], center, near * np.outer(spread, spread))]
        yield pd.DataFrame(rows, columns=_NAMES)


def _distance() -> Column:
    """Squared Mahalanobis distance of the statistics from a fit."""
    off = [F.col(s) - F.get(F.col("center"), i) for i, s in enumerate(STATISTICS)]
    total = F.lit(0.0)
    for i in range(P):
        for j in range(i, P):
            total = total + off[i] * off[j] * F.get(F.col("precision"), i * P + j) * (1 if i == j else 2)
    return total


def _held(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def _measured(rows: DataFrame, fits: DataFrame, few: bool) -> DataFrame:
    return rows.join(_held(fits, few), "cell").withColumn("d2", _distance())


def starts(rows: DataFrame) -> tuple[DataFrame, bool]:
    """(cell, medians, spreads, floors): medians and absolute deviations of each cell, and its floors; and whether the
    counted cells are so few that what is held of each (two starts at most) may be broadcast."""
    medians = settle(grid_quantiles(rows, ["cell"], {s: F.col(s) for s in STATISTICS}, [0.5])
                     .select("cell", F.array(*[F.get(s, F.lit(0)) - GRID / 2 for s in STATISTICS]).alias("medians")))
    few = medians.limit(MAX_GROUPS // 2 + 1).count() <= MAX_GROUPS // 2
    away = {s: F.greatest(F.abs(F.col(s) - F.get("medians", F.lit(i))) - GRID, F.lit(0.0)) for i, s in enumerate(STATISTICS)}
    spreads = grid_quantiles(rows.join(_held(medians, few), "cell"), ["cell"], away, [0.5, 0.75])
    half = [F.get(s, F.lit(0)) * 1.4826 for s in STATISTICS]
    flat = [F.get(s, F.lit(0)) <= GRID for s in STATISTICS]  # most of the cell has one value
    words = F.exp(F.get("medians", F.lit(0)))
    chars = words * F.exp(F.get("medians", F.lit(1)))
    # one word, character, symbol, line, 5-word window or capital more or less in the cell's median text
    one = [1 / words, 1 / chars, F.sqrt(1 / chars), F.sqrt(LINE_WORDS / words), F.sqrt(2 * WINDOW / words), F.sqrt(1 / chars)]
    floors = [F.when(f, F.greatest(F.get(s, F.lit(1)), r)).otherwise(h * RIDGE)
              for s, f, h, r in zip(STATISTICS, flat, half, one, strict=True)]
    found = spreads.join(_held(medians, few), "cell")
    return settle(found.select("cell", "medians", F.array(*half).alias("spreads"), F.array(*floors).alias("floors"))), few


def fit_groups(rows: DataFrame, subset: float = SUBSET, steps: int = STEPS) -> DataFrame:
    """(cell, n, floors, center, scatter, tail) of the cells of ``rows`` (cell, STATISTICS): scatter is scaled to
    chi-square, tail is the log of the squared distance beyond which the cell's documents are rejected."""
    keys = ["cell", "start"]
    start, few = starts(rows)
    scored = rows.join(_held(start, few), "cell")
    scores = [F.tanh((F.col(s) - F.get("medians", F.lit(i))) / F.get("spreads", F.lit(i))) for i, s in enumerate(STATISTICS)]
    fits = settle(_moments(scored, ["cell"], scores).join(_held(start, few), "cell").mapInPandas(_first_fits, _FIT), NARROW)

    def refitted(near: DataFrame) -> DataFrame:
        return settle(_moments(near, keys, [F.col(s) for s in STATISTICS]).join(_held(start.select("cell", "floors"), few), "cell")
                      .mapInPandas(_refit, _FIT), NARROW)

    for _ in range(steps):
        at = _measured(rows, fits, few).withColumn("_far", F.log1p("d2"))
        bound = grid_quantiles(at, keys, {"far": F.col("_far")}, [subset]).select(
            F.col("cell").alias("_c"), F.col("start").alias("_s"), F.get("far", F.lit(0)).alias("q"))
        fits = refitted(at.join(_held(bound, few), F.expr("cell = _c and start = _s")).where("_far <= q"))
    best = fits.groupBy("cell").agg(F.min(F.struct("logdet", "start", "center", "scatter", "precision")).alias("b"))
    best = settle(best.select("cell", F.lit(0).alias("start"), "b.center", "b.scatter", "b.precision"), NARROW)

    def spread(fits: DataFrame) -> DataFrame:
        """Median and upper quartile of the log-distances."""
        far = {"far": F.log(F.greatest("d2", F.lit(1e-6)))}
        return (grid_quantiles(_measured(rows, fits, few), ["cell"], far, [0.5, 0.75])
                .select("cell", F.get("far", F.lit(0)).alias("q50"), F.get("far", F.lit(1)).alias("q75")))

    scale = spread(best).select("cell", (F.exp("q50") / CHI2_MEDIAN).alias("scale"))
    near = _measured(rows, best, few).join(_held(scale, few), "cell").where(F.col("d2") <= F.col("scale") * CHI2_975)
    last = refitted(near)
    tail = F.log(F.lit(CHI2_MEDIAN)) + TAIL * (F.col("q75") - F.col("q50"))
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return settle(_held(last, few).join(spread(last), "cell").join(sizes, "cell").select(
        "cell", "n", "floors", "center", F.transform("scatter", lambda x: x * F.exp("q50") / CHI2_MEDIAN).alias("scatter"),
        F.greatest(tail, F.lit(math.log(CHI2_975))).alias("tail")), NARROW)


def _name(*parts: Column) -> Column:
    return F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), p), F.lit("-")) for p in parts])


_DRAWN = "own string, center array<double>, precision array<double>, tail double"


def _drawn(prior: float, every):
    """Each group's estimate drawn towards its language's, and that towards the overall one (one row, ``every``)."""
    every = every and every.asDict()

    def run(batches):
        for b in batches:
            rows = []
            for _, r in b.iterrows():
                got = None
                for f in (every, r["wide"], r["mine"]):
                    new = [np.array(f[k], float) for k in ("floors", "center", "scatter", "tail")]
                    # the tail rests on a quartile of few far documents and needs more of them
                    parts = [f["n"] / (f["n"] + prior * more) for more in (1, 1, 1, TAIL_PRIOR)]
                    got = new if got is None else [p * x + (1 - p) * y for p, x, y in zip(parts, new, got, strict=True)]
                floors, center, scatter, tail = got
                precision, _ = _inverse(scatter.reshape(P, P), floors)
                rows.append((r["own"], center.tolist(), precision.ravel().tolist(), float(tail)))
            yield pd.DataFrame(rows, columns=["own", "center", "precision", "tail"])

    return run


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", prior_rows: float = PRIOR_ROWS, subset: float = SUBSET,
                  steps: int = STEPS) -> DataFrame:
    """One row per row of ``docs``: id, the counts, base_failed, distance (null: none) and kept."""
    counted = count_texts(docs, id_col, text_col, lang_col, source_col)
    counted = settle(counted.withColumns({"own": F.concat(F.lit("2"), _name(F.col("_lang"), F.col("_source"))),
                                          "wide": F.concat(F.lit("1"), _name(F.col("_lang")))}))
    some = counted.where("n_words > 0").withColumns(statistics())
    rows = settle(some.select(F.explode(F.array("own", "wide", F.lit("0"))).alias("cell"), *STATISTICS))
    fits = fit_groups(rows, subset, steps)
    fit = F.struct("n", "floors", "center", "scatter", "tail")
    level = lambda key, name: fits.select(F.col("cell").alias(key), fit.alias(name))
    every = fits.where("cell = '0'").first()
    groups = some.select("own", "wide").distinct()
    known = settle(groups.join(level("own", "mine"), "own").join(level("wide", "broad"), "wide")
                   .select("own", "mine", F.col("broad").alias("wide")).mapInPandas(_drawn(prior_rows, every), _DRAWN), NARROW)
    judged = some.join(broadcast_within(known, MAX_GROUPS), "own").withColumn("distance", _distance())
    bare = counted.where("n_words = 0").withColumns({"distance": F.lit(None).cast("double"), "tail": F.lit(None).cast("double")})
    out = judged.select("_id", *COUNTS, "distance", "tail").unionByName(bare.select("_id", *COUNTS, "distance", "tail"))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    near = F.coalesce(F.col("distance") <= F.exp("tail"), F.lit(False))
    return out.select(F.col("_id").alias(id_col), *COUNTS[:5], failed.alias("base_failed"), (~failed & near).alias("kept"),
                      "distance", F.exp("tail").alias("bound"), *COUNTS[5:])

"""Mixing sources to target weights by Pareto order sampling.

Sources share the total size by weight; a target stops at ``cap`` times its source's size and the
excess is shared out again by weight among the others until none is above its cap. In a source,
document i is expected in c_i = min(cap, r * w_i) copies, where w_i is the document's own weight
(1 without a weight) and r makes the expected words meet the target. floor(c_i) whole copies are
certain. The rest is drawn by Pareto order sampling: with inclusion probability p_i = c_i - floor(c_i)
and a uniform u_i, documents are ranked by the random odds divided by the inclusion odds,
(u_i / (1 - u_i)) / (p_i / (1 - p_i)), and taken from the lowest while their running size fits into
what the target lacks. What the first document that does not fit leaves open is filled in the same
order with smaller ones, in ``PASSES`` passes. The uniform is a hash of seed, id and text, so reruns
agree and a lost task repeats its draw.

A source of any size is ranked by a range-partitioned order and running sums; none is gathered.

Defined results: size is the number of words ``[^\\x20\\x09-\\x0D]+``, 0 for null and empty texts, which
are never taken; a null source is a source of its own, last in order; rows that repeat an id and a text
have equal ranks and are drawn one by one; texts are counted whole; an empty table gives no rows; a
null, NaN or negative document weight counts as 0. Other columns are left unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.common import broadcast_within, running_total, settle, unit_uniform

CAP = 3
PASSES = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def damped(size: Column) -> Column:
    """A document weight that falls slowly with length: long documents are repeated a little less."""
    return 1 / F.log(F.lit(2.718281828459045) + size / 1000)


def source_targets(sized: DataFrame, cap: float = CAP, weights=(1, 2, 3)) -> DataFrame:
    """(source, source_size, target), one row a source. Sources by code point, null last, weigh
    ``weights`` in turn. A source is full if its part of what is left reaches cap * size; sources are
    tested in order of the level cap * size / weight at which they fill, and once one is not full no
    later one is, so running sums over the sources replace the rounds of sharing out again."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    name = F.col("source").asc_nulls_last()
    turn = F.pmod(F.row_number().over(Window.orderBy(name)) - 1, F.lit(len(weights)))
    by_level = Window.orderBy("fills_at", name)
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    later = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    return (per.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn + 1))
            .withColumn("most", F.col("source_size") * float(cap))
            .withColumn("fills_at", F.col("most") / F.col("w"))
            .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
            .withColumn("level", F.col("left") / F.sum("w").over(later))
            .withColumn("full", F.col("level") >= F.col("fills_at"))
            .withColumn("shared", F.min(F.when(~F.col("full"), F.struct("fills_at", "source", "level"))).over(every)["level"])
            .select("source", "source_size",
                    F.when(F.col("full"), F.col("most")).otherwise(F.col("w") * F.col("shared")).alias("target")))


def _rates(rows: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """``targets`` with r: sum of min(cap, r * w) * size over a source is its target. Documents at the
    cap are set aside and r is solved for the others until no more reach it."""
    rates = settle(rows.groupBy("source").agg(F.sum(F.col("w") * F.col("size")).alias("mass"))
                   .join(targets, F.expr("source <=> s2")).select(
                       "s2", "source_size", "target",  # a source that stops at the cap takes all it has so often
                       F.when(F.col("target") >= float(cap) * F.col("source_size"), F.lit(1e300))
                       .otherwise(F.expr("target / nullif(mass, 0)")).alias("r")))
    while True:
        at_cap = F.col("r") * F.col("w") >= cap
        new = (rows.join(broadcast_within(rates, 100_000), F.expr("source <=> s2"))
               .groupBy("s2", "source_size", "target", "r")
               .agg(F.sum(F.when(at_cap, cap * F.col("size")).otherwise(0)).alias("fixed"),
                    F.sum(F.when(~at_cap, F.col("w") * F.col("size")).otherwise(0)).alias("mass"))
               .select("s2", "source_size", "target", F.col("r").alias("was"),
                       F.greatest("r", F.expr("(target - fixed) / nullif(mass, 0)")).alias("r")))
        new = settle(new)
        rates = new.drop("was")
        if new.where("r > was * (1 + 1e-9)").isEmpty():
            return rates


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        cap: int = CAP, weights=(1, 2, 3), weight=None, seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: id, text_key (hash of the text), source, size, source_size, target,
    copies, taken (words: copies * size). ``weight``: a function of the size column, or None."""
    sized = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    w = F.lit(1.0) if weight is None else weight(F.col("size")).cast("double")
    sized = settle(sized.withColumn("w", F.when(w > 0, F.nanvl(w, F.lit(0.0))).otherwise(0.0)))
    targets = settle(source_targets(sized, cap, weights).withColumnRenamed("source", "s2"))
    rates = broadcast_within(_rates(sized, targets, cap), 100_000)
    u = unit_uniform(F.lit(seed), F.col("id"), F.col("text_key"))
    copies = F.when(F.col("size") > 0, F.least(F.lit(float(cap)), F.coalesce(F.col("r") * F.col("w"), F.lit(0.0))))
    drawn = (sized.join(rates, F.expr("source <=> s2")).drop("s2")
             .withColumn("c", F.coalesce(copies, F.lit(0.0)))
             .withColumn("sure", F.floor(F.col("c") + 1e-9))
             .withColumn("p", F.greatest(F.col("c") - F.col("sure"), F.lit(0.0)))
             .withColumn("rank", F.when(F.col("p") > 1e-9, (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))))
             .withColumn("drawn", F.lit(0)))
    drawn = settle(drawn.drop("w", "r", "c", "p"))
    for n in range(PASSES):
        taken = drawn.groupBy("source").agg(
            F.sum((F.col("sure") + F.col("drawn")) * F.col("size")).alias("have"), F.first("target").alias("want"))
        lack = settle(taken.select(F.col("source").alias("s2"), (F.col("want") - F.col("have")).alias("lack")))
        at = drawn.join(broadcast_within(lack, 100_000), F.expr("source <=> s2")).drop("s2")
        fits = F.col("rank").isNotNull() & (F.col("drawn") == 0)
        if n:
            fits = fits & (F.col("size") <= F.col("lack"))
        at = at.withColumn("fit", fits)
        ranked = running_total(at.where("fit"), ["source"], ["rank", "id", "text_key"], "size", "before")
        drawn = settle(ranked.withColumn("drawn", (F.col("before") + F.col("size") <= F.col("lack")).cast("int"))
                       .drop("before", "lack", "fit").unionByName(at.where("not fit").drop("lack", "fit")))
    copies = (F.col("sure") + F.col("drawn")).cast("long")
    return drawn.select(F.col("id").alias(id_col), "text_key", F.col("source").alias(source_col), "size", "source_size",
                        "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))

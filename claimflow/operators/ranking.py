"""Ordering helpers: global row number (E01), latest row per key (E02),
null-aware anti join (C07), ordered caps (E03/E04).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.session import cut_lineage


def global_row_number(df: DataFrame, order: list[Column], out: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY ...)`` without funnelling the input into one task.

    ``order`` must be a total order (add a unique tie-break key). The input is
    range-partitioned on the order and sorted per partition; each row's
    position is recorded and the result is checkpointed (reliable storage,
    so both uses below read identical rows and the input plan runs once).
    A row's number is its partition's offset — a prefix sum over per-partition
    counts, one row per partition, broadcast — plus its position inside the
    partition.
    """
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    staged = (df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    staged = cut_lineage(staged)
    counts = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (staged.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
                  .withColumn(out, (F.col("_off") + pos + 1).cast("long"))
                  .drop("_pid", "_mid", "_off"))


def latest_per_key(df: DataFrame, keys: list[str], ts: str, tie: str | None = None) -> DataFrame:
    """The newest row per key (``ORDER BY ts DESC LIMIT 1``) via ``max_by`` —
    an aggregate with map-side combine, so a hot key never gathers its rows."""
    cols = [c for c in df.columns if c not in keys]
    order_key = F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)
    packed = F.max_by(F.struct(*[F.col(c) for c in cols]), order_key).alias("_r")
    return df.groupBy(*keys).agg(packed).select(*keys, "_r.*")


def null_aware_anti(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """``left WHERE key NOT IN (SELECT right_key FROM right)`` with SQL NULL rules:
    any NULL in the subquery empties the result; a NULL left key survives only
    when the subquery is empty. Its two counts are scalar subqueries of the same plan,
    so no job runs while the plan is built."""
    r = right.select(F.col(right_key or key).alias("_k"))
    counts = r.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_k").isNull()).alias("nulls"))
    n, nulls = counts.select("n").scalar(), counts.select("nulls").scalar()
    known = r.where(F.col("_k").isNotNull()).distinct()
    return (left.join(known, F.col(key) == F.col("_k"), "left_anti")
            .filter((n == 0) | ((nulls == 0) & F.col(key).isNotNull())))

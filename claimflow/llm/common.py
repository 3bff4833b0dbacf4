"""Shared Spark helpers of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_prefix(df: DataFrame) -> str:
    """A beginning that no column of ``df`` has, for a job's own columns."""
    return next(p for p in ("_" * n for n in range(1, len(df.columns) + 3))
                if not any(c.lower().startswith(p + "own") for c in df.columns)) + "own_"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows: texts can be long, and a batch is held whole by a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def settle(df: DataFrame, narrow: int = 1) -> DataFrame:
    """A reliable checkpoint in the cluster's shared folder: computed once, survives lost executors.
    ``narrow``: rows are so few that one file holds what comes from so many shuffle partitions."""
    ensure_checkpoint_dir(df.sparkSession)
    if narrow > 1:
        df = df.coalesce(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // narrow))
    return df.checkpoint(eager=True)


def output_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def broadcast_within(df: DataFrame, most: int, weight: Column | None = None) -> DataFrame:
    """Broadcast ``df`` (narrow rows) if it is counted at ``most`` rows or fewer; else leave the join to a
    shuffle. ``weight``: what a row counts, for rows that hold arrays. Both ways give the same rows."""
    if weight is None:
        small = df.limit(most + 1).count() <= most
    else:
        small = (df.agg(F.sum(weight.cast("long") + 1)).first()[0] or 0) <= most
    return F.broadcast(df) if small else df


def running_total(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before each row in ``order`` (a total order but for equal
    rows), per ``group``. No group is gathered: rows are dealt by ranges of (group, order), each
    range is summed on its own, and the sums of earlier ranges (one row a range and group) are added.

    The dealt rows are checkpointed because both the range sums and the result read them."""
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = settle(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                   .withColumn("_range", F.spark_partition_id())
                   .withColumn("_row", F.monotonically_increasing_id()))
    sums = dealt.groupBy(*group, "_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_range").alias("_r"),
                          F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy("_range", *group).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(offsets, same, "left")
            .withColumn(out, (F.col("_before") + F.col("_inside")).cast("long"))
            .select(*df.columns, out))


def unit_uniform(*parts: Column) -> Column:
    """A number in (0, 1) drawn from the md5 of the parts: the same in every run and every engine."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(16 ** 13)

"""Session construction and cluster-safe helpers (broadcast guards, checkpoints)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Reference tables that may be broadcast are checked against this bound
# (rows). Beyond it the planner's shuffle join is used instead.
DEFAULT_BROADCAST_ROWS = 200_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "claimflow") -> SparkSession:
    """Session with the settings every operator assumes (UTC clock, AQE on, UI off).

    On a cluster ``master`` is left to spark-submit; ``spark.checkpoint.dir`` is
    read from the cluster configuration and only filled in locally (tests).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.parquet.inferTimestampNTZ.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", os.environ.get("CLAIMFLOW_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only when unset (local mode)."""
    conf = spark.sparkContext.getConf()
    cur = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        spark.sparkContext.setCheckpointDir(cur)
        return cur
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="claimflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when its row count is proven to be within ``max_rows``.

    Otherwise the plain DataFrame is returned and Catalyst/AQE choose a shuffle
    join (AQE may still convert it at runtime if it turns out small).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def spread(df: DataFrame, min_partitions: int | None = None, key: list[str] | None = None) -> DataFrame:
    """Spread ``df`` over the cluster before per-row work when it arrives in fewer
    partitions than the session's parallelism (e.g. one Parquet row group). A no-op
    for inputs that are already split, i.e. for any real multi-file table.

    With ``key`` (a unique or near-unique column) the rows are hash-partitioned on
    it; otherwise round-robin (Spark then sorts each input partition first so that a
    retried task reproduces its rows, which costs more). Filters and column
    pruning still reach the scan below the repartition."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *key) if key else df.repartition(target)


def left_lookup(rows: DataFrame, lookup: DataFrame, key: str, unknown: tuple = ()) -> DataFrame:
    """Left join with a lookup of one row a key, by ``key``. Rows whose key cannot match (NULL, or one of the
    ``unknown`` marks) would all meet in one task: they are spread by a salt that the lookup does not have."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    never = F.col(key).isNull() | F.col(key).isin(*unknown) if unknown else F.col(key).isNull()
    seen = [c for c in ("claim_id", "policy_id", "customer_id", "incident_date", "claimed_amount") if c in rows.columns]
    spread_by = F.pmod(F.xxhash64(*(seen or rows.columns)), F.lit(parts)).cast("int") + 1
    found = lookup.withColumnRenamed(key, "_lookup_key").withColumn("_lookup_salt", F.lit(0))
    salted = rows.withColumn("_salt", F.when(never, spread_by).otherwise(0))
    return (salted.join(found, (F.col(key) == F.col("_lookup_key")) & (F.col("_salt") == F.col("_lookup_salt")), "left")
            .drop("_salt", "_lookup_key", "_lookup_salt"))

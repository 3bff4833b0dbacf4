"""Event-driven flows (A10, L01-L04, L06, K05) on Structured Streaming.

* A change feed is a file-source stream over a table folder; its checkpoint
  is the stream offset, so a restarted job resumes exactly where it stopped
  (the source's tasks re-read a stream whose offset never advanced, T16).
* Micro-batch work that needs joins against other tables runs in
  ``foreachBatch``; every batch writes to a folder named by its batch id
  with overwrite, so a replayed batch after an executor or driver loss
  rewrites the same output instead of duplicating it.
* There are no windows or watermarks in these flows: time limits are plain
  predicates on stored timestamps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimflow.session import ensure_checkpoint_dir


LOOKBACK_DAYS = 30  # of the duplicate check
C360_BUCKETS = 64


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def _state(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return f"{_checkpoint(spark, name, checkpoint).rstrip('/')}-feed"


def started_at_ms(spark: SparkSession, folder: str) -> int:
    """When the feed that keeps its state in ``folder`` was first defined (milliseconds): stored on the
    first call, read on every later one, so a restarted job keeps the cut of its first start."""
    path = f"{folder.rstrip('/')}/started_at"
    one = spark.range(1).select((F.unix_millis(F.current_timestamp())).alias("ms"))
    one.write.mode("ignore").parquet(path)
    return int(spark.read.parquet(path).first()["ms"])


def append_stream(spark: SparkSession, path: str, schema, skip_existing: bool = False,
                  started_after_ms: int | None = None, max_files_per_trigger: int | None = None,
                  state_dir: str | None = None) -> DataFrame:
    """A10: append-only change feed over a Parquet folder.

    ``skip_existing`` (SHOW_INITIAL_ROWS = FALSE) ignores files that were there when the feed was first
    defined: rows are kept if their file was modified after ``started_after_ms``, or after the first start
    kept in ``state_dir`` (one folder a feed, beside its checkpoint). Files that arrive while the job is
    down are later than that cut, so they are delivered after a restart. The modification time is a
    metadata column, so no listing is held in memory.
    """
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(path)
    if skip_existing:
        if started_after_ms is None and state_dir is None:
            raise ValueError("skip_existing needs started_after_ms or state_dir")
        cut = started_after_ms if started_after_ms is not None else started_at_ms(spark, state_dir)
        df = (df.withColumn("_file_mtime", F.col("_metadata.file_modification_time"))
                .filter(F.col("_file_mtime") > F.timestamp_millis(F.lit(cut)))
                .drop("_file_mtime"))
    return df


def write_batch(df: DataFrame, root: str, table: str, batch_id: int) -> str:
    """Idempotent per-batch output: ``<root>/<table>/batch_id=<id>`` overwritten on replay."""
    path = f"{root.rstrip('/')}/{table}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def start_foreach_batch(stream: DataFrame, name: str, handler: Callable[[DataFrame, int], None],
                        checkpoint: str | None = None, available_now: bool = True,
                        interval: str = "1 minute") -> StreamingQuery:
    w = stream.writeStream.queryName(name).option("checkpointLocation",
                                                  _checkpoint(stream.sparkSession, name, checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.foreachBatch(handler).start()


# ---------------------------------------------------------------- L01
def keep_moments(claims: DataFrame, folder: str, batch_id: int) -> None:
    """Adds a batch to the duplicate check's state: counts per (customer, LOB, status, submission time), in
    month partitions. A replayed batch rewrites its own part."""
    from claimflow.operators.dq import claim_moments
    (claim_moments(claims).withColumn("month", F.date_format("submission_date", "yyyy-MM"))
     .write.mode("overwrite").partitionBy("month").parquet(f"{folder}/batch_id={batch_id}"))


def kept_moments(spark: SparkSession, folder: str, batch_id: int, claims_schema, as_of, days: int) -> DataFrame:
    """State of the batches up to ``batch_id``; only the months that the check looks back to are read."""
    from claimflow.functions.dates import as_ts, minus_days
    types = {f.name: f.dataType.simpleString() for f in _schema(claims_schema).fields}
    ddl = ", ".join(f"{c} {types[c]}" for c in ("customer_id", "lob_type", "claim_status", "submission_date"))
    since = F.date_format(minus_days(as_ts(as_of), days), "yyyy-MM")
    return (spark.read.schema(f"{ddl}, _n long, batch_id int, month string").parquet(folder)
            .where((F.col("batch_id") <= batch_id) & (F.col("month") >= since)).drop("batch_id", "month"))


def _schema(schema):
    from pyspark.sql.types import StructType
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def claims_flow(spark: SparkSession, claims_path: str, claims_schema, customers: DataFrame, policies: DataFrame,
                out_root: str, as_of, checkpoint: str | None = None, available_now: bool = True,
                skip_existing: bool = False, **scorers) -> StreamingQuery:
    """New claims -> DQ gate -> v2 chain; per batch writes resolutions, claim
    state, audit rows and the DQ-failed claim updates. The duplicate check looks at
    all claims up to and in the batch, through counts that each batch adds to a state
    folder; no batch reads the claims folder again. With ``skip_existing`` the files that
    were there first are counted once, as part -1. Every row of a batch is worked."""
    from claimflow.operators.claims_v2 import run_claims_batch
    state = f"{_state(spark, 'claims_flow', checkpoint)}/moments"
    if skip_existing:
        cut = started_at_ms(spark, _state(spark, "claims_flow", checkpoint))
        first = (spark.read.schema(claims_schema).parquet(claims_path)
                 .where(F.col("_metadata.file_modification_time") <= F.timestamp_millis(F.lit(cut))))
        if not _exists(spark, f"{state}/batch_id=-1/_SUCCESS"):
            keep_moments(first, state, -1)

    def handle(batch: DataFrame, batch_id: int) -> None:
        keep_moments(batch, state, batch_id)
        every = kept_moments(spark, state, batch_id, claims_schema, as_of, LOOKBACK_DAYS)
        out = run_claims_batch(batch, customers, policies, as_of, all_claims=every, **scorers)
        write_batch(out["resolutions"], out_root, "resolutions", batch_id)
        write_batch(out["claim_state"], out_root, "claim_state", batch_id)
        write_batch(out["audit"], out_root, "audit_log", batch_id)
        write_batch(out["claims"].filter(F.col("claim_status") == "DQ_FAILED"), out_root, "claim_updates", batch_id)

    feed = append_stream(spark, claims_path, claims_schema, skip_existing, state_dir=_state(spark, "claims_flow", checkpoint))
    return start_foreach_batch(feed, "claims_flow", handle, checkpoint, available_now)


# ---------------------------------------------------------------- L02
def underwriting_flow(spark: SparkSession, apps_path: str, apps_schema, actuarial: DataFrame, out_root: str,
                      as_of, checkpoint: str | None = None, available_now: bool = True,
                      skip_existing: bool = False) -> StreamingQuery:
    """New applications -> risk score -> decision (+ status update, audit)."""
    from claimflow.operators.underwriting import run_underwriting

    def handle(batch: DataFrame, batch_id: int) -> None:
        decisions, apps_after, audit = run_underwriting(batch, actuarial, as_of)
        write_batch(decisions, out_root, "underwriting_decisions", batch_id)
        write_batch(apps_after.select("application_id", "status"), out_root, "application_updates", batch_id)
        write_batch(audit, out_root, "audit_log", batch_id)

    feed = append_stream(spark, apps_path, apps_schema, skip_existing, state_dir=_state(spark, "underwriting_flow", checkpoint))
    return start_foreach_batch(feed, "underwriting_flow", handle, checkpoint, available_now)


# ---------------------------------------------------------------- L03
def post_decision_audit(resolutions: DataFrame, as_of) -> DataFrame:
    """L03 transform: one audit row (step 99) per new resolution."""
    from claimflow.operators.writes import audit_rows
    payload = F.to_json(F.struct(F.col("decision"), F.col("settlement_amount").alias("settlement"),
                                 F.lit(True).alias("notification_sent")))
    return audit_rows(resolutions.select(F.col("claim_id").alias("reference_id"), payload.alias("output_payload")),
                      "CLAIMS", "POST_DECISION_TASK", 99, as_of)


def post_decision_flow(spark: SparkSession, resolutions_path: str, resolutions_schema, out_path: str, as_of,
                       checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Stateless streaming select + append Parquet sink (exactly-once via the
    file sink's commit log)."""
    s = post_decision_audit(append_stream(spark, resolutions_path, resolutions_schema), as_of)
    w = (s.writeStream.queryName("post_decision_flow").format("parquet").option("path", out_path)
          .option("checkpointLocation", _checkpoint(spark, "post_decision_flow", checkpoint)).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


# ---------------------------------------------------------------- L04 / L06
def refresh_touched_customers(touched: DataFrame, c360_current: DataFrame, build: Callable[[DataFrame], DataFrame],
                              refreshed_at) -> DataFrame:
    """Rebuild only the customers whose facts changed and merge them into
    the current C360 (A12). ``build(ids)`` returns fresh C360 rows for the ids."""
    from claimflow.functions.dates import as_ts
    from claimflow.operators.writes import merge_upsert
    ids = touched.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    fresh = build(ids)
    cols = [c for c in c360_current.columns if c in fresh.columns]
    set_ts = {"last_refreshed_at": as_ts(refreshed_at)} if "last_refreshed_at" in c360_current.columns else None
    return merge_upsert(c360_current, fresh.select(*cols), ["customer_id"], set_on_update=set_ts,
                        set_on_insert=set_ts)


def _bucketed(c360: DataFrame) -> DataFrame:
    return c360.withColumn("bucket", F.pmod(F.xxhash64("customer_id"), F.lit(C360_BUCKETS)).cast("int"))


def _write_buckets(c360: DataFrame, path: str, version: int) -> None:
    (_bucketed(c360).withColumn("version", F.lit(version).cast("long")).repartition("bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(path))


def _newest(table: DataFrame) -> DataFrame:
    """Rows of each bucket's newest version (at most C360_BUCKETS pairs are broadcast)."""
    newest = table.groupBy("bucket").agg(F.max("version").alias("version"))
    return table.join(F.broadcast(newest), ["bucket", "version"], "left_semi")


def base_refresh(c360: DataFrame, path: str, refreshed_at) -> int:
    """A full build becomes the newest version of every bucket (also of those it has no rows for, which
    keep their older rows only as long as no newer version exists). Returns the version."""
    from claimflow.functions.dates import as_ts
    spark = c360.sparkSession
    version = _next_version(spark, path)
    _write_buckets(c360.drop("last_refreshed_at").withColumn("last_refreshed_at", as_ts(refreshed_at)), path, version)
    return version


def _next_version(spark: SparkSession, path: str) -> int:
    if not _exists(spark, path):
        return 0
    return 1 + (spark.read.parquet(path).agg(F.max("version")).first()[0] or 0)


def merge_refresh(fresh: DataFrame, path: str, refreshed_at, version: int) -> None:
    """Rows of touched customers into the bucketed table. Only the buckets that hold them are read and
    written, as a new version; a row is replaced unless the table's is of a later refresh. Versions from
    ``version`` on are not read, so a replay of the same version gives the same rows."""
    from claimflow.functions.dates import as_ts
    from claimflow.operators.ranking import latest_per_key
    from claimflow.session import cut_lineage
    spark = fresh.sparkSession
    fresh = cut_lineage(_bucketed(fresh.drop("last_refreshed_at").withColumn("last_refreshed_at", as_ts(refreshed_at))))
    touched = [r[0] for r in fresh.select("bucket").distinct().collect()]  # at most C360_BUCKETS numbers
    if not touched:
        return
    every = fresh.withColumn("_order", F.struct(F.col("last_refreshed_at"), F.lit(1)))
    if _exists(spark, path):
        table = spark.read.parquet(path).where(F.col("bucket").isin(touched) & (F.col("version") < version))
        cols = [c for c in fresh.columns if c in table.columns]
        held = _newest(table).select(*cols).withColumn("_order", F.struct(F.col("last_refreshed_at"), F.lit(0)))
        every = every.unionByName(held, allowMissingColumns=True)
    _write_buckets(latest_per_key(every, ["customer_id"], "_order").drop("_order", "bucket"), path, version)


def interaction_refresh_flow(spark: SparkSession, interactions_path: str, schema, build, c360_path: str, as_of,
                             checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """The interaction (or payment) feed drives a touched-customer C360 refresh: each batch rebuilds the
    customers it touches (``build(ids)``) and merges them into their buckets. The version a batch writes is
    noted beside the checkpoint before it writes, so that a replayed batch writes the same one, and a new
    checkpoint goes on after the table's last version."""
    notes = f"{_state(spark, 'interaction_refresh', checkpoint)}/versions"

    def handle(batch: DataFrame, batch_id: int) -> None:
        note = f"{notes}/batch_id={batch_id}"
        if not _exists(spark, f"{note}/_SUCCESS"):
            spark.range(1).select(F.lit(_next_version(spark, c360_path)).cast("long").alias("version")).write.mode("overwrite").parquet(note)
        ids = batch.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
        merge_refresh(build(ids), c360_path, as_of, spark.read.parquet(note).first()[0])

    return start_foreach_batch(append_stream(spark, interactions_path, schema), "interaction_refresh", handle,
                               checkpoint, available_now)


def current_c360(spark: SparkSession, path: str) -> DataFrame:
    """Each customer's row in its bucket's newest version."""
    return _newest(spark.read.parquet(path)).drop("bucket", "version")


# ---------------------------------------------------------------- K05
def load_with_metrics(batch: DataFrame, table_path: str, table: str, null_cols: list[str], key: str | None,
                      out_root: str, batch_id: int) -> None:
    """The write that changes a table gathers the NULL counts of what it adds (``observe``), so no second
    pass reads it. Keys that were not there before are kept beside the table; a row whose key is not
    among the batch's new ones repeats a key. A replayed batch rewrites its own parts."""
    from pyspark.sql import Observation
    spark = batch.sparkSession
    seen = Observation(f"{table}-{batch_id}")
    counted = [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_cols]]
    if key:
        counted.append(F.count(F.col(key)).alias("n_keyed"))
    batch.observe(seen, *counted).write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
    got = seen.get
    rows = [(table, c, "NULL_COUNT", got[f"null_{c}"]) for c in null_cols]
    if key:
        keys = f"{out_root}/keys_{table}"
        mine = spark.read.parquet(f"{table_path}/batch_id={batch_id}").select(key).where(F.col(key).isNotNull()).distinct()
        if _exists(spark, keys):
            earlier = spark.read.parquet(keys).where(F.col("batch_id") < batch_id).select(key)
            mine = mine.join(earlier, key, "left_anti")
        new = Observation(f"{table}-keys-{batch_id}")
        mine.observe(new, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{keys}/batch_id={batch_id}")
        rows.append((table, key, "DUPLICATE_COUNT", got["n_keyed"] - new.get["n"]))
    (spark.createDataFrame(rows, "table_name string, column_name string, metric string, value long")
     .write.mode("overwrite").parquet(f"{out_root}/dq_metrics/batch_id={batch_id}"))


def table_metrics_so_far(spark: SparkSession, out_root: str) -> DataFrame:
    """The whole table's metrics: the sums of what its batches added."""
    return (spark.read.parquet(f"{out_root}/dq_metrics").groupBy("table_name", "column_name", "metric")
            .agg(F.sum("value").cast("long").alias("value")))


def quality_flow(stream: DataFrame, table_path: str, table: str, null_cols: list[str], key: str | None, out_root: str,
                 checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """K05 as a flow: rows are loaded into the table and their metrics gathered on the way."""
    return start_foreach_batch(stream, f"load_{table}", lambda batch, batch_id: load_with_metrics(
        batch, table_path, table, null_cols, key, out_root, batch_id), checkpoint, available_now)
def run_on_change(stream: DataFrame, table: str, null_cols: list[str], key: str | None, out_root: str,
                  whole: Callable[[], DataFrame], checkpoint: str | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """K05 for a table that others write: a change of the table triggers its data-quality metrics over the whole table (``whole()`` reads
    it): NULL counts in one pass, and duplicate keys across all batches so far."""
    from claimflow.operators.dq import duplicate_count, null_count

    def handle(batch: DataFrame, batch_id: int) -> None:
        every = whole()
        m = null_count(every, table, null_cols)
        if key:
            m = m.unionByName(duplicate_count(every, table, key))
        write_batch(m.withColumn("batch_id", F.lit(batch_id).cast("long")), out_root, "dq_metrics", batch_id)

    return start_foreach_batch(stream, f"dq_{table}", handle, checkpoint, available_now)

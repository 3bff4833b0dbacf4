"""Dashboards, read models and monitoring queries.

All are aggregations or filtered projections over the result tables; the
"newest N" listings keep their limit because the limit is the feature
(``orderBy().limit()`` plans as a TakeOrderedAndProject: per-partition top-N,
then a final merge of N rows per partition).
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.constants import CLAIM_STATES, HEALTH_PROTECTED_STATUSES
from claimflow.functions.dates import as_date, as_ts, minus_days, seconds_between
from claimflow.functions.numeric import pyround
from claimflow.functions.text import cut
from claimflow.session import ensure_checkpoint_dir

OPEN_FILES = 256  # of stored texts, that a task keeps open

# ------------------------------------------------------------------ KPIs
def kpi_executive(c360: DataFrame) -> DataFrame:
    """Customers, avg churn (2 dp), avg 30-d sentiment (2 dp), total premium (0 dp)."""
    return c360.agg(
        F.count(F.lit(1)).alias("total_customers"),
        pyround(F.avg("churn_propensity_score"), 2).alias("avg_churn"),
        pyround(F.avg("sentiment_score_last_30d"), 2).alias("avg_sentiment"),
        pyround(F.sum("total_annual_premium"), 0).alias("total_premium"))


def kpi_segments(c360: DataFrame) -> DataFrame:
    """Per non-NULL segment: count, avg churn (2 dp), avg LTV (1 dp); by count desc."""
    return (c360.filter(F.col("customer_segment").isNotNull()).groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("count"), pyround(F.avg("churn_propensity_score"), 2).alias("avg_churn"),
                 pyround(F.avg("lifetime_value_score"), 1).alias("avg_ltv"))
            .orderBy(F.col("count").desc(), "customer_segment"))


def kpi_lob(policies: DataFrame) -> DataFrame:
    """Policies per LOB with total premium and average coverage (0 dp)."""
    return (policies.groupBy("lob_type")
            .agg(F.count(F.lit(1)).alias("policy_count"), pyround(F.sum("premium_annual"), 0).alias("total_premium"),
                 pyround(F.avg("coverage_limit"), 0).alias("avg_coverage"))
            .orderBy(F.col("policy_count").desc(), "lob_type"))


def kpi_claim_status(claims: DataFrame) -> DataFrame:
    """Claims by status."""
    return claims.groupBy("claim_status").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc())


def kpi_churn(alerts: DataFrame, c360: DataFrame) -> DataFrame:
    """Alerts joined to profiles: total, critical (priority <= 3), avg propensity (2 dp)."""
    j = alerts.join(c360.select("customer_id"), "customer_id")
    return j.agg(F.count(F.lit(1)).alias("total_alerts"),
                 F.coalesce(F.sum(F.when(F.col("priority") <= 3, 1).otherwise(0)), F.lit(0)).cast("long")
                  .alias("critical"),
                 pyround(F.avg("churn_propensity"), 2).alias("avg_propensity"))


def kpi_platform(customers: DataFrame, policies: DataFrame, claims: DataFrame, alerts: DataFrame) -> DataFrame:
    """Four platform counts in one row ('Active Policies' counts all policies).
    Each count is a scalar subquery of a one-row plan; nothing is cross-joined."""
    one = customers.sparkSession.range(1)
    return one.select(
        customers.select(F.count(F.lit(1))).scalar().alias("customers"),
        policies.select(F.count(F.lit(1))).scalar().alias("active_policies"),
        claims.select(F.count(F.lit(1))).scalar().alias("total_claims"),
        alerts.filter(F.col("status") == "NEW").select(F.count(F.lit(1))).scalar().alias("active_churn_alerts"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per table."""
    out = None
    for name, df in tables.items():
        r = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = r if out is None else out.unionByName(r)
    return out


def kpi_pipeline_states(state: DataFrame) -> DataFrame:
    """Claims per pipeline state."""
    return state.groupBy("current_state").agg(F.count(F.lit(1)).alias("count"))


def health_counts(state: DataFrame, as_of) -> DataFrame:
    """Pending (not COMPLETED/FAILED), failed, completed today."""
    cs = F.col("current_state")
    return state.agg(
        F.count_if(~cs.isin("COMPLETED", "FAILED")).cast("long").alias("pending_claims"),
        F.count_if(cs == "FAILED").cast("long").alias("failed_claims"),
        F.count_if(F.col("completed_at") >= as_ts(as_date(as_of))).cast("long").alias("completed_today"))


def recent_customer_count(interactions: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Distinct customers with interactions in the last ``days`` days."""
    return (interactions.filter(F.col("interaction_date") >= minus_days(as_ts(as_of), days))
            .agg(F.countDistinct("customer_id").alias("customers")))


# ------------------------------------------------------------------ ordered text aggregation
def _packed(text: Column) -> Column:
    """UTF-8 bytes of a text, compressed: what is left of it to move and to sort."""
    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else zlib.compress(t))
    return pack(text.cast("binary"))


def _shared_folder(spark: SparkSession) -> str | None:
    """A new folder of the checkpoint storage, if Python workers can open that by pyarrow (None: they cannot)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/texts-{uuid.uuid4().hex}")
    name = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString()
    name = re.sub("^s3a:", "s3:", re.sub("^file:/+", "file:///", name))
    try:
        fs.FileSystem.from_uri(name)
    except (pa.ArrowException, OSError):
        return None
    return name


def _stored(folder: str):
    """Texts go packed into one file a task; back come (transcript_id, _file, _place, _size), no row for a NULL text.
    A repeated task writes a file of its own, and only the rows of the task that counts are kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        name, place = TaskContext.get().taskAttemptId(), 0
        store.create_dir(path)
        with store.open_output_stream(f"{path}/{name}") as out:
            for b in batches:
                rows = []
                for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    if text.is_valid:
                        rows.append((key, place, size := out.write(zlib.compress(text.as_buffer()))))
                        place += size
                keys, places, sizes = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.record_batch({"transcript_id": pa.array(keys, b.schema.field(0).type), "_file": pa.array([name] * len(rows), pa.int64()),
                                       "_place": pa.array(places, pa.int64()), "_size": pa.array(sizes, pa.int64())})
    return run


def _one_string(sep: str, folder: str | None = None):
    """A customer's packed texts as one string, newest first (then by id and text, descending). The texts are in the
    rows or, with ``folder``, read there by their places."""
    opened = {}

    def text_at(file: int, place: int, size: int) -> bytes:
        if file not in opened:
            if len(opened) == OPEN_FILES:
                opened.pop(next(iter(opened))).close()
            store, path = fs.FileSystem.from_uri(folder)
            opened[file] = store.open_input_file(f"{path}/{file}")
        return opened[file].read_at(size, place)

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        where = zip(*(rows[c].to_pylist() for c in (("_file", "_place", "_size") if folder else ("_text",))), strict=True)
        found = [((at, i is not None, i), (head or b"") + zlib.decompress(text_at(*w) if folder else w[0])) for at, i, head, w in
                 zip(*(rows[c].to_pylist() for c in ("_at", "interaction_id", "_head")), where, strict=True)
                 if w[0] is not None]
        whole = sep.encode().join(text for _, text in sorted(found, reverse=True))
        return pa.table({"customer_id": pa.array([key[0].as_py()], rows.schema.field("customer_id").type), "_whole": pa.array([whole], pa.binary())})
    return run


def concat_transcripts(interactions: DataFrame, as_of, n_chars: int | None = None, days: int = 90,
                       sep: str = "\n---\n", with_header: bool = False, texts: DataFrame | None = None) -> DataFrame:
    """Per customer, the last ``days`` days of transcripts newest first, each
    cut to ``n_chars`` (``None`` = whole text); ``with_header`` prefixes
    '[channel timestamp] ' as the root-cause prompt does. No row limit (T08). NULL texts are skipped.

    The texts are ``transcript_text`` of the interactions, or those of ``texts`` (text_id, text) that their
    ``transcript_id`` names. This is a per-customer string by definition (it becomes one prompt): every text is packed
    where it is stored. Texts of the interactions cross one exchange to their customer. Those of ``texts`` are written once,
    when the frame is made, into the checkpoint storage; only their places cross, and the customer's call reads each one
    there, so what is written does not grow with the interactions that name a text. (They cross as well if Python cannot open that storage.)"""
    recent = interactions.filter(F.col("interaction_date") >= minus_days(as_ts(as_of), days))
    cut_to = lambda c: F.col(c) if n_chars is None else F.substring(c, 1, n_chars)
    head = F.concat(F.lit("["), F.col("channel"), F.lit(" "), F.col("interaction_date").cast("string"),
                    F.lit("] ")).cast("binary") if with_header else F.lit(None).cast("binary")
    recent = recent.select("customer_id", "interaction_id", F.unix_micros(F.col("interaction_date").cast("timestamp")).alias("_at"),
                           head.alias("_head"), F.col("transcript_text" if texts is None else "transcript_id"))
    spark, folder = interactions.sparkSession, None
    if texts is None:
        rows = recent.withColumn("_text", _packed(cut_to("transcript_text"))).drop("transcript_text")
    elif folder := _shared_folder(spark):
        key = T.StructField("transcript_id", texts.schema["text_id"].dataType)
        places = T.StructType([key, *(T.StructField(c, T.LongType()) for c in ("_file", "_place", "_size"))])
        (texts.select("text_id", cut_to("text").cast("binary").alias("text")).mapInArrow(_stored(folder), places)
         .write.parquet(f"{folder}/places"))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # kept: a place is small, the text behind it is not
        rows = (recent.join(spark.read.schema(places).parquet(f"{folder}/places"), "transcript_id", "left").drop("transcript_id")
                .repartition(parts, "customer_id"))
    else:
        stored = texts.select(F.col("text_id").alias("transcript_id"), _packed(cut_to("text")).alias("_text"))
        rows = recent.join(stored, "transcript_id", "left").drop("transcript_id")
    if with_header:
        held = "_file" if folder else "_text"
        rows = rows.withColumn(held, F.when(F.col("_head").isNotNull(), F.col(held)))
    schema = T.StructType([interactions.schema["customer_id"], T.StructField("_whole", T.BinaryType())])
    return (rows.groupBy("customer_id").applyInArrow(_one_string(sep, folder), schema)
            .select("customer_id", F.col("_whole").cast("string").alias("transcripts")))


def transcript_pieces(interactions: DataFrame, texts: DataFrame, as_of, days: int = 90) -> DataFrame:
    """D15 in long form: (customer_id, position, interaction_id, transcript_text), newest first from 1. Positions
    come from a global order dealt by ranges, less the customer's first, so no task gathers a customer's
    texts; rows without a text or a customer have no place.

    ``interactions`` name their text in ``texts`` (text_id, text) by ``transcript_id``. Places are counted on keys alone:
    an id with several texts gives each a place (equal ones by their number), and the texts join the
    placed keys at the end, so each stored text is moved once."""
    from claimflow.operators.ranking import global_row_number
    recent = interactions.filter((F.col("interaction_date") >= minus_days(as_ts(as_of), days)) & F.col("customer_id").isNotNull())
    known = (texts.where(F.col("text").isNotNull() & F.col("text_id").isNotNull())
             .select(F.col("text_id").alias("transcript_id"), F.xxhash64("text").alias("_hash"), F.col("text").alias("transcript_text")))
    copies = known.groupBy("transcript_id", "_hash").agg(F.count(F.lit(1)).alias("_copies"))
    keys = (recent.select("customer_id", "interaction_date", "interaction_id", "transcript_id").join(copies, "transcript_id")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).drop("_copies", "_copy"))
    order = [F.col("customer_id"), F.col("interaction_date").desc_nulls_last(), F.col("interaction_id").desc(), F.col("_hash")]
    placed = global_row_number(keys, order, "_rn")
    first = placed.groupBy("customer_id").agg(F.min("_rn").alias("_first"))
    return (placed.join(first, "customer_id").join(known.dropDuplicates(["transcript_id", "_hash"]), ["transcript_id", "_hash"])
            .select("customer_id", (F.col("_rn") - F.col("_first") + 1).alias("position"), "interaction_id", "transcript_text"))


def playbook_context(keys: DataFrame, playbooks: DataFrame, n_chars: int | None = None, sep: str = "\n---\n",
                     fallback: str = "No matching playbooks found") -> DataFrame:
    """D16 + C16: for each row of ``keys`` (customer_id, customer_segment, root_cause),
    the playbooks with ``segment = coalesce(seg, 'STANDARD') OR root_cause = coalesce(rc, '')``
    ordered by success rate desc, as one text block; fallback text when none (T09).

    The disjunctive join is two equi-joins + union + de-duplication."""
    k = keys.select("customer_id", F.coalesce("customer_segment", F.lit("STANDARD")).alias("_seg"),
                    F.coalesce("root_cause", F.lit("")).alias("_rc"))
    pb = playbooks.select("playbook_id", "customer_segment", "root_cause", "success_rate",
                          F.concat(F.col("playbook_name"), F.lit(": "), cut(F.col("content"), n_chars),
                                   F.lit(" (success rate: "), F.col("success_rate").cast("string"), F.lit(")"))
                           .alias("_txt"))
    by_seg = k.join(pb, k["_seg"] == pb["customer_segment"]).select("customer_id", "playbook_id", "success_rate", "_txt")
    by_rc = k.join(pb, k["_rc"] == pb["root_cause"]).select("customer_id", "playbook_id", "success_rate", "_txt")
    m = by_seg.unionByName(by_rc).dropDuplicates(["customer_id", "playbook_id"])
    item = F.struct(F.col("success_rate").alias("r"), F.col("playbook_id").alias("id"), F.col("_txt").alias("t"))
    agg = m.groupBy("customer_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(item), asc=False), lambda x: x["t"]), sep).alias("_ctx"))
    return (keys.select("customer_id").join(agg, "customer_id", "left")
                .select("customer_id", F.coalesce("_ctx", F.lit(fallback)).alias("playbook_context")))


# ------------------------------------------------------------------ pipeline views
def pipeline_status(state: DataFrame, claims: DataFrame, customers: DataFrame, as_of) -> DataFrame:
    """State x claim x customer (inner) with JSON fields and elapsed seconds."""
    s = state.select("claim_id", "current_state", "started_at", "completed_at", "fraud_output", "resolution_output")
    c = claims.select("claim_id", "customer_id", "lob_type", "claimed_amount")
    cu = customers.select("customer_id", "customer_segment", "lifetime_value_score")
    j = s.join(c, "claim_id").join(cu, "customer_id")
    return j.select(
        "claim_id", "customer_id", "lob_type", "claimed_amount", "current_state", "started_at", "completed_at",
        seconds_between(F.col("started_at"), F.coalesce(F.col("completed_at"), as_ts(as_of))).alias("elapsed_seconds"),
        F.get_json_object("fraud_output", "$.composite_fraud_score").cast("double").alias("fraud_score"),
        F.get_json_object("fraud_output", "$.risk_level").alias("fraud_risk"),
        F.get_json_object("resolution_output", "$.decision").alias("decision"),
        F.get_json_object("resolution_output", "$.settlement_amount").cast("double").alias("settlement"),
        "customer_segment", "lifetime_value_score")


def claim_state_flat(state: DataFrame) -> DataFrame:
    """One flat row per claim state (JSON paths cast, amounts rounded).
    The JSON values are projected first so the rounding works on plain columns."""
    g = lambda c, p: F.get_json_object(c, p)
    raw = state.select(
        "claim_id", "current_state",
        g("intake_output", "$.severity").alias("severity"),
        g("validation_output", "$.valid").cast("boolean").alias("valid"),
        g("validation_output", "$.policy_status").alias("policy_status"),
        g("fraud_output", "$.composite_fraud_score").cast("double").alias("_fs"),
        g("fraud_output", "$.risk_level").alias("fraud_risk"),
        g("assessment_output", "$.recommended_settlement").cast("double").alias("_rs"),
        g("resolution_output", "$.decision").alias("decision"),
        g("resolution_output", "$.settlement_amount").cast("double").alias("_st"))
    return raw.select("claim_id", "current_state", "severity", "valid", "policy_status",
                      pyround(F.col("_fs"), 2).alias("fraud_score"), "fraud_risk",
                      pyround(F.col("_rs"), 2).alias("recommended_settlement"), "decision",
                      pyround(F.col("_st"), 2).alias("settlement"))


def audit_trail(audit: DataFrame, reference_ids: DataFrame) -> DataFrame:
    """Audit rows of the given references, in step order (semi join on ids)."""
    return (audit.join(reference_ids.select("reference_id").distinct(), "reference_id", "left_semi")
                 .orderBy("reference_id", "step_number", "created_at"))


def newest(df: DataFrame, ts: str, n: int = 50, tie: str | None = None) -> DataFrame:
    """Newest ``n`` rows (the limit is the listing's feature)."""
    order = [F.col(ts).desc_nulls_first()] + ([F.col(tie)] if tie else [])
    return df.orderBy(*order).limit(n)


def customer_deep_dive(customer_ids: DataFrame, c360: DataFrame, policies: DataFrame, claims: DataFrame,
                       alerts: DataFrame, nba: DataFrame) -> dict[str, DataFrame]:
    """The five per-customer panels for a set of customers (semi joins, so the
    same plan serves one customer or all of them)."""
    ids = customer_ids.select("customer_id").distinct()
    sj = lambda df: df.join(ids, "customer_id", "left_semi")
    return {"profile": sj(c360), "policies": sj(policies), "claims": sj(claims),
            "alerts": sj(alerts), "actions": sj(nba)}


# ------------------------------------------------------------------ health / state machine / runs
def health_check(state: DataFrame, claims: DataFrame, as_of, stuck_minutes: int = 5):
    """Open states older than ``stuck_minutes`` -> FAILED with a timeout message;
    claims whose state is FAILED -> MANUAL_REVIEW unless terminal; counts row.
    Returns ``(state_after, claims_after, counts)``."""
    from claimflow.operators.writes import update_where
    now = as_ts(as_of)
    stuck = (~F.col("current_state").isin("COMPLETED", "FAILED")
             & (F.col("started_at") < now - F.expr(f"INTERVAL {int(stuck_minutes)} MINUTES"))
             & F.col("completed_at").isNull())
    state_after = update_where(state, stuck, {"error_message": F.lit("TIMEOUT: Stuck in pipeline > 5 minutes"),
                                              "current_state": F.lit("FAILED")})
    failed_ids = state_after.filter(F.col("current_state") == "FAILED").select("claim_id").distinct() \
                            .withColumn("_failed", F.lit(True))
    j = claims.join(failed_ids, "claim_id", "left")
    hit = (F.col("_failed") == True) & ~F.col("claim_status").isin(*HEALTH_PROTECTED_STATUSES)  # noqa: E712
    claims_after = update_where(j, hit, {"claim_status": F.lit("MANUAL_REVIEW")}).drop("_failed")
    return state_after, claims_after, health_counts(state_after, as_of)


def health_audit(counts: DataFrame, as_of) -> DataFrame:
    """L05's audit row: the counts after the check as its payload."""
    from claimflow.operators.writes import audit_rows
    return audit_rows(counts.select(F.lit(None).cast("string").alias("reference_id"), F.to_json(F.struct(*counts.columns)).alias("output_payload")),
                      "SYSTEM", "HEALTH_CHECK", 0, as_of)


def next_state(current: Column, failed: Column | None = None) -> Column:
    """The claim state machine VALIDATION -> FRAUD_CHECK -> ASSESSMENT ->
    RESOLUTION -> COMPLETED; any state -> FAILED when ``failed``; terminal states stay."""
    out = F.when(current.isNull(), F.lit(CLAIM_STATES[0]))
    for a, b in zip(CLAIM_STATES, CLAIM_STATES[1:]):
        out = out.when(current == a, F.lit(b))
    out = out.otherwise(current)
    if failed is not None:
        out = F.when(F.coalesce(failed, F.lit(False)) & ~current.isin("COMPLETED", "FAILED"), F.lit("FAILED")) \
               .otherwise(out)
    return out


def run_history(runs: DataFrame, as_of, hours: int = 24, n: int = 100) -> DataFrame:
    """Runs scheduled in the last ``hours`` hours with durations, newest ``n``."""
    now = as_ts(as_of)
    r = runs.filter(F.col("scheduled_time") >= now - F.expr(f"INTERVAL {int(hours)} HOURS"))
    r = r.withColumn("duration_seconds", seconds_between(F.col("scheduled_time"), F.col("completed_time")))
    return r.orderBy(F.col("scheduled_time").desc(), "task_name").limit(n)

"""Registry of the engine's queries: one Spark callable and (where SQL can express
it) one DuckDB oracle string per operator from the survey inventory.

Every query reads the whole driver tables under ``root`` through the adapters;
nothing is sampled or capped except where the limit is the feature itself.
Double columns are rounded to 6 dp on both sides so that summation order does
not decide the comparison.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.checks import feature_sql as fs
from claimflow.checks.views import with_views
from claimflow.constants import EVENT_WORLD_AS_OF as EV
from claimflow.constants import ORDER_WORLD_AS_OF as OW
from claimflow.constants import PLAYBOOKS, V1_AS_OF
from claimflow.operators import c360, features
from claimflow.session import cut_lineage, ensure_checkpoint_dir, spread
from claimflow.sources.adapters import Tables
from claimflow.streaming import states

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def round_sql(sql: str, cols: list[str], digits: int = 6) -> str:
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) q"


def register(name: str, sql: str | None = None, views: list[str] | None = None,
             doubles: list[str] | None = None):
    def deco(fn):
        def run(spark: SparkSession, root: str) -> DataFrame:
            # the adapters' wall-clock timestamps are TIMESTAMP_NTZ; pin the two settings
            # that would otherwise let a caller's session shift them
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "true")
            return round_doubles(fn(Tables(spark, root)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = round_sql(with_views(views or [], sql), doubles or [])
        return fn
    return deco


# ============================================================== D: features
@register("d01_policy_portfolio", fs.PP, ["v_policies"],
          ["total_annual_premium", "coverage_adequacy_ratio"])
def _d01(t: Tables) -> DataFrame:
    return features.agg_policy_portfolio(t.policies(), OW)


@register("d01_active_policy_ids", fs.ACTIVE_IDS, ["v_policies"])
def _d01_ids(t: Tables) -> DataFrame:
    """D01 ``policy_ids_array`` in long form: every active id, no per-customer collection."""
    return features.active_policy_ids(t.policies())


@register("d02_claims_history", fs.CH, ["v_claims"],
          ["claims_approved_ratio", "avg_claim_amount", "max_claim_amount", "total_amount_paid",
           "avg_resolution_time_days", "total_claims_paid", "claim_acceleration_ratio"])
def _d02(t: Tables) -> DataFrame:
    return features.agg_claims_history(t.claims(), OW)


@register("d03_payment_behavior", fs.PAY, ["v_payments"],
          ["payment_delay_avg_days", "payment_regularity_score"])
def _d03(t: Tables) -> DataFrame:
    return features.agg_payment_behavior(t.payments(), OW)


@register("d04_interaction_signals", fs.INTS, ["v_interactions"],
          ["sentiment_score_last_30d", "sentiment_trend"])
def _d04(t: Tables) -> DataFrame:
    return features.agg_interaction_signals(t.interactions(), EV)


_C360_DOUBLES = ["lifetime_value_score", "total_annual_premium", "coverage_adequacy_ratio", "claims_approved_ratio",
                 "avg_claim_amount", "max_claim_amount", "total_amount_paid", "avg_resolution_time_days",
                 "loss_ratio", "claim_acceleration_ratio", "payment_delay_avg_days", "payment_regularity_score",
                 "sentiment_score_last_30d", "sentiment_trend", "complaint_rate_per_claim", "lifetime_loss_ratio",
                 "fraud_similarity_score", "provider_anomaly_score"]
_ALL_FACT_VIEWS = ["v_customers", "v_policies", "v_claims", "v_payments", "v_interactions"]


def _present(sqlcols: list[str], text: str) -> list[str]:
    return [c for c in sqlcols if f" {c}" in text or f".{c}" in text]


def _scored_claim_embeddings(t: Tables) -> DataFrame:
    from claimflow.operators.similarity import max_similarity
    return max_similarity(t.claim_embeddings(), t.fraud_patterns(), "claim_embedding", "pattern_embedding",
                          key_cols=["claim_id", "customer_id", "lob_type"], out_col="fraud_sim")


@register("d05_embedding_features", fs.EMB, ["v_claim_embeddings", "v_fraud_patterns", "v_providers"],
          ["fraud_similarity_score", "provider_anomaly_score"])
def _d05(t: Tables) -> DataFrame:
    return features.agg_embedding_features(_scored_claim_embeddings(t), t.providers())


@register("j01_c360_full", fs.C360_FULL,
          _ALL_FACT_VIEWS + ["v_claim_embeddings", "v_fraud_patterns", "v_providers"],
          _C360_DOUBLES + ["frustration_level", "digital_engagement_trend", "inconsistency_score",
                           "vagueness_score", "geographic_risk_score"])
def _j01(t: Tables) -> DataFrame:
    return c360.build_c360_full(t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(),
                                _scored_claim_embeddings(t), t.providers(), OW, EV)


_BOOT_DOUBLES = [c for c in _C360_DOUBLES if c not in ("complaint_rate_per_claim", "lifetime_loss_ratio",
                                                        "fraud_similarity_score", "provider_anomaly_score")]


@register("j02_c360_bootstrap", fs.C360_BOOT, _ALL_FACT_VIEWS, _BOOT_DOUBLES)
def _j02(t: Tables) -> DataFrame:
    return c360.build_c360_bootstrap(t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(), OW, EV)


_DYN_DOUBLES = [c for c in _C360_DOUBLES if c not in ("avg_resolution_time_days", "loss_ratio",
                                                       "fraud_similarity_score", "provider_anomaly_score")]


@register("j03_c360_dynamic", fs.C360_DYN, _ALL_FACT_VIEWS, _DYN_DOUBLES)
def _j03(t: Tables) -> DataFrame:
    return c360.build_c360_dynamic(t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(), OW, EV)


@register("j06_churn_propensity", fs.propensity_sql(fs.C360_BOOT), _ALL_FACT_VIEWS,
          _BOOT_DOUBLES + ["churn_propensity_score"])
def _j06(t: Tables) -> DataFrame:
    return c360.churn_propensity(c360.build_c360_bootstrap(
        t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(), OW, EV))


def c360_with_propensity(t: Tables) -> DataFrame:
    """The table the churn scan reads: the full build plus propensity (J01 + J06)."""
    return c360.churn_propensity(c360.build_c360_full(
        t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(),
        _scored_claim_embeddings(t), t.providers(), OW, EV))


def kept_c360(t: Tables) -> DataFrame:
    """``c360_with_propensity`` written down once (a row a customer), for queries that read it in several places:
    the facts behind it are scanned, joined and shuffled once, not for each use."""
    if "_c360" not in t._cache:
        t._cache["_c360"] = cut_lineage(c360_with_propensity(t))
    return t._cache["_c360"]


C360_SCORED_SQL = fs.propensity_sql(fs.C360_FULL)
C360_SCORED_VIEWS = _ALL_FACT_VIEWS + ["v_claim_embeddings", "v_fraud_patterns", "v_providers"]


# ============================================================== J: churn
from claimflow.checks import churn_sql as cs  # noqa: E402
from claimflow.operators import churn  # noqa: E402


def _scan(t: Tables, c: DataFrame | None = None) -> DataFrame:
    return churn.churn_scan(c360_with_propensity(t) if c is None else c, churn.empty_alerts(t.spark), OW)


@register("j07_churn_scan", cs.SCAN, C360_SCORED_VIEWS, ["churn_propensity", "sentiment_score"])
def _j07(t: Tables) -> DataFrame:
    return _scan(t)


def _churn_run(t: Tables):
    c = kept_c360(t)
    return c, churn.run_churn(c, churn.empty_alerts(t.spark), OW)


@register("j10_churn_pipeline_alerts", cs.ALERTS_AFTER, C360_SCORED_VIEWS, ["churn_propensity", "sentiment_score"])
def _j10a(t: Tables) -> DataFrame:
    return _churn_run(t)[1][0]


@register("j09_retention_actions", cs.ACTIONS, C360_SCORED_VIEWS)
def _j09(t: Tables) -> DataFrame:
    return _churn_run(t)[1][1]


def _causes(t: Tables) -> DataFrame:
    """Alerted customers with their segment and the cause by rules."""
    c = kept_c360(t)
    alerted = _scan(t, c).select("customer_id")
    return (c.select("customer_id", "customer_segment").join(churn.root_cause_rules(c), "customer_id")
            .join(alerted, "customer_id", "left_semi"))


@register("j08_root_cause_rules", cs.CAUSES, C360_SCORED_VIEWS)
def _j08r(t: Tables) -> DataFrame:
    return _causes(t)


@register("j09_playbook_actions", cs.PLAYBOOK_ACTIONS, C360_SCORED_VIEWS)
def _j09p(t: Tables) -> DataFrame:
    books = t.spark.createDataFrame(PLAYBOOKS, "playbook_id string, segment string, cause string, action_type string, "
                                               "offer_details string, channel string, success_rate double")
    return churn.playbook_actions(_causes(t), books)


@register("j14_c360_view", fs.C360_BOOT, _ALL_FACT_VIEWS, _BOOT_DOUBLES)
def _j14(t: Tables) -> DataFrame:
    return churn.c360_view(c360.build_c360_bootstrap(t.customers(), t.policies(), t.claims(), t.payments(),
                                                     t.interactions(), OW, EV))


@register("j11_churn_dashboard", cs.DASHBOARD, C360_SCORED_VIEWS,
          ["churn_propensity", "sentiment_score", "root_cause_confidence", "lifetime_value_score",
           "total_annual_premium", "expected_success_rate"])
def _j11(t: Tables) -> DataFrame:
    c, (alerts, actions, _audit) = _churn_run(t)
    return churn.churn_dashboard(alerts, c, actions)


@register("j12_nba_for_crm", cs.CRM, C360_SCORED_VIEWS, ["total_annual_premium", "expected_success_rate"])
def _j12(t: Tables) -> DataFrame:
    c, (alerts, actions, _audit) = _churn_run(t)
    return churn.nba_for_crm(actions, t.customers(), c, OW)


# ============================================================== H: DQ gate and claims agents
from claimflow.checks import claims_sql as ks  # noqa: E402
from claimflow.operators import claims_v1, claims_v2, dq, underwriting  # noqa: E402


def _joined_lists(df: DataFrame) -> DataFrame:
    return (df.withColumn("errors", F.array_join("errors", " | "))
              .withColumn("warnings", F.array_join("warnings", " | ")))


@register("h01_dq_validate_claims", ks.DQ, ["v_claims", "v_customers", "v_policies"])
def _h01(t: Tables) -> DataFrame:
    return _joined_lists(dq.dq_validate_claims(t.claims(), t.customers(), t.policies(), OW))


@register("h02_dq_validate_intake", ks.INTAKE, ["v_claims_text", "v_customers", "v_policies"])
def _h02(t: Tables) -> DataFrame:
    return _joined_lists(dq.dq_validate_intake(t.claims(with_text_key=True), t.customers(), t.policies(),
                                               text_flags=t.claim_text_flags()))


@register("h04_intake_severity", ks.INTAKE_V2, ["v_claims_text"])
def _h04(t: Tables) -> DataFrame:
    sub = t.claims(with_text_key=True).filter(F.col("claim_status") == "SUBMITTED")
    c = claims_v2.agent_intake_v2(claims_v2.text_features_v2(sub, texts=t.claim_texts()), F.col("_severity"))
    return c.select("claim_id", "lob_type", F.col("intake_output.severity").alias("severity"))


def _claims_batch(t: Tables) -> dict:
    """The v2 batch with the narratives' own sentiment and similarity to the fraud patterns."""
    vectors = similarity.max_similarity(t.text_vectors(), t.fraud_patterns(), "embedding", "pattern_embedding",
                                        ["claim_text_id"], "vector_score")
    return claims_v2.run_claims_batch(t.claims(with_text_key=True), t.customers(), t.policies(), OW,
                                      texts=t.claim_texts(), vectors=vectors)


@register("h09_claims_v2_resolutions", ks.V2, ["v_claims", "v_claims_text", "v_customers", "v_policies"],
          ["settlement_amount", "claimed_amount", "fraud_score", "confidence_score"])
def _h09(t: Tables) -> DataFrame:
    out = _claims_batch(t)
    return out["resolutions"]


V1_HNW = "BUILDING"  # the order world's stand-in for the high-value segment


def _v1_texts(t: Tables) -> dict:
    """What the v1 agents score a claim's text with: similarity of its stored vector, and the fraud narratives."""
    vectors = t.text_vectors().withColumnRenamed("claim_text_id", "statement_vector_id")
    return {"vectors": similarity.max_similarity(vectors, t.fraud_patterns(), "embedding", "pattern_embedding",
                                                 ["statement_vector_id"], "vector_score"),
            "patterns": t.fraud_narratives()}


def _v1_resolved(t: Tables) -> DataFrame:
    claims = t.claims(with_statement=True)
    return claims_v1.process_claims_v1(claims, t.customers(), t.policies(), V1_AS_OF, all_claims=t.claims(),
                                       hnw_segment=V1_HNW, **_v1_texts(t))


@register("h20_claims_v1_resolutions", ks.V1, ks.V1_VIEWS,
          ["claimed_amount", "composite_fraud_score", "settlement_amount", "confidence_score"])
def _h20(t: Tables) -> DataFrame:
    return _v1_resolved(t)


@register("h18_claims_after_v1", ks.CLAIMS_AFTER_V1, ks.V1_VIEWS)
def _h18(t: Tables) -> DataFrame:
    """The claims table after the v1 run wrote its decisions back, and each decided claim's letter."""
    letters = claims_v1.resolution_summary(_v1_resolved(t)).select("claim_id", "decision", "summary")
    claims = t.claims().select("claim_id", "customer_id", "claim_status").withColumn("summary", F.lit(None).cast("string"))
    return writes.update_from(claims, letters, ["claim_id"], {"claim_status": "decision", "summary": "summary"})


# ============================================================== I: underwriting
@register("i02_uw_risk_score", ks.UW_SCORE, ["v_applications", "v_actuarial"],
          ["coverage_requested", "base_rate", "risk_multiplier", "geographic_factor", "history_factor",
           "composite_score", "recommended_premium"])
def _i02(t: Tables) -> DataFrame:
    apps = t.applications().filter(F.col("status") == "PENDING")
    return underwriting.uw_risk_score(apps, t.actuarial())


@register("i05_underwriting_decisions", ks.UW_DECIDE, ["v_applications", "v_actuarial"],
          ["confidence", "recommended_premium"])
def _i05(t: Tables) -> DataFrame:
    return underwriting.run_underwriting(t.applications(), t.actuarial(), OW)[0]


# ============================================================== D/E/H/L: reports and read models
from claimflow.checks import report_sql as rs  # noqa: E402
from claimflow.operators import models, reports, search, similarity, writes  # noqa: E402
from claimflow.functions import extract  # noqa: E402
from claimflow.functions import text as tx  # noqa: E402


def _boot_scored(t: Tables) -> DataFrame:
    return c360.churn_propensity(c360.build_c360_bootstrap(
        t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(), OW, EV))


@register("d06_kpi_executive", rs.KPI_EXEC, _ALL_FACT_VIEWS)
def _d06(t: Tables) -> DataFrame:
    return reports.kpi_executive(_boot_scored(t))


@register("d07_kpi_segments", rs.KPI_SEG, _ALL_FACT_VIEWS)
def _d07(t: Tables) -> DataFrame:
    return reports.kpi_segments(_boot_scored(t))


@register("d08_kpi_lob", rs.KPI_LOB, ["v_policies"])
def _d08(t: Tables) -> DataFrame:
    return reports.kpi_lob(t.policies())


@register("d09_kpi_claim_status", rs.KPI_STATUS, ["v_claims"])
def _d09(t: Tables) -> DataFrame:
    return reports.kpi_claim_status(t.claims())


@register("d10_kpi_churn", rs.KPI_CHURN, C360_SCORED_VIEWS)
def _d10(t: Tables) -> DataFrame:
    c = kept_c360(t)
    return reports.kpi_churn(_scan(t, c), c)


@register("d11_kpi_platform", rs.KPI_PLATFORM, C360_SCORED_VIEWS)
def _d11(t: Tables) -> DataFrame:
    return reports.kpi_platform(t.customers(), t.policies(), t.claims(), _scan(t))


@register("d12_table_counts", rs.TABLE_COUNTS, _ALL_FACT_VIEWS + ["v_providers", "v_fraud_patterns", "v_applications"])
def _d12(t: Tables) -> DataFrame:
    return reports.table_counts({
        "customers": t.customers(), "policies": t.policies(), "claims_landing": t.claims(),
        "payments": t.payments(), "interactions": t.interactions(), "providers": t.providers(),
        "fraud_pattern_embeddings": t.fraud_patterns(), "applications": t.applications()})


def _v2_state(t: Tables) -> DataFrame:
    out = _claims_batch(t)
    return out["claim_state"]


@register("d13_pipeline_states", rs.STATE_COUNTS, ["v_claims", "v_claims_text", "v_customers", "v_policies"])
def _d13(t: Tables) -> DataFrame:
    return reports.kpi_pipeline_states(_v2_state(t))


@register("d14_health_counts", rs.HEALTH, ["v_claims", "v_claims_text", "v_customers", "v_policies"])
def _d14(t: Tables) -> DataFrame:
    return reports.health_check(_v2_state(t), t.claims(), OW)[2]


@register("d15_concat_transcripts", rs.TRANSCRIPTS, ["v_interactions_text"])
def _d15(t: Tables) -> DataFrame:
    return reports.concat_transcripts(t.interactions(with_text_key=True), EV, texts=t.transcript_texts())


@register("d18_recent_customer_count", rs.RECENT_CUSTOMERS, ["v_interactions"])
def _d18(t: Tables) -> DataFrame:
    return reports.recent_customer_count(t.interactions(), EV)


@register("h21_pipeline_status", rs.PIPELINE_STATUS, ["v_claims", "v_claims_text", "v_customers", "v_policies"],
          ["claimed_amount", "fraud_score", "settlement", "lifetime_value_score"])
def _h21(t: Tables) -> DataFrame:
    return reports.pipeline_status(_v2_state(t), t.claims(), t.customers(), OW)


@register("l08_next_state", rs.NEXT_STATE, ["v_claim_states"])
def _l08(t: Tables) -> DataFrame:
    s = t.claim_states(OW)
    return s.select("claim_id", "current_state", reports.next_state(F.col("current_state"), F.col("failed")).alias("next_state"))


@register("d13_states_all_stages", rs.STATES_ALL, ["v_claim_states"])
def _d13a(t: Tables) -> DataFrame:
    return reports.kpi_pipeline_states(t.claim_states(OW)).select("current_state", F.col("count").alias("count"))


def _checked(t: Tables):
    return reports.health_check(t.claim_states(OW).drop("failed"), t.claims(), OW)


@register("l05_health_check_states", rs.STATES_CHECKED, ["v_claim_states"])
def _l05s(t: Tables) -> DataFrame:
    """States of every age and stage: those stuck for more than five minutes fail."""
    return _checked(t)[0].select("claim_id", "current_state")


@register("l08_states_flow", rs.STATES_FLOW, ["v_claim_states"])
def _l08f(t: Tables) -> DataFrame:
    """The events behind all states as a stream: transitions in order, the time limit by timeouts."""
    base = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/states-{uuid.uuid4().hex}"
    states.stage_events(t.claim_states(OW), OW).write.option("compression", "zstd").parquet(f"{base}/events")
    shards = max(states.SHARDS, t.raw("lineitem").count() // states.CLAIMS_A_SHARD)
    states.states_flow(t.spark, f"{base}/events", f"{base}/changes", checkpoint=f"{base}/ck", shards=shards).awaitTermination()
    return states.current_states(t.spark.read.parquet(f"{base}/changes")).select("claim_id", "current_state", "error_message")


@register("l05_health_audit", rs.HEALTH_AUDIT, ["v_claim_states"])
def _l05a(t: Tables) -> DataFrame:
    return reports.health_audit(_checked(t)[2], OW).select("flow_type", "agent_name", "status", "output_payload")


@register("d15_transcript_pieces", rs.TRANSCRIPT_PIECES, ["v_interactions_text"])
def _d15l(t: Tables) -> DataFrame:
    return reports.transcript_pieces(t.interactions(with_text_key=True), t.transcript_texts(), EV)


# ============================================================== G: vectors, retrieval, text
@register("g02_cosine_adjacent", rs.COSINE_ADJ, [], ["cosine"])
def _g02(t: Tables) -> DataFrame:
    e = t.raw("embeddings")
    a = e.select(F.col("vec_id").alias("left_id"), F.col("embedding").alias("_a"))
    b = e.select(F.col("vec_id").alias("right_id"), F.col("embedding").alias("_b"))
    j = a.join(b, F.col("right_id") == F.col("left_id") + 1)
    return j.select("left_id", "right_id", similarity.cosine("_a", "_b").alias("cosine"))


@register("g03_fraud_similarity", rs.SIM, ["v_claim_embeddings", "v_fraud_patterns"], ["fraud_sim"])
def _g03(t: Tables) -> DataFrame:
    return _scored_claim_embeddings(t)


def _topk(t: Tables) -> DataFrame:
    return similarity.top_k_patterns(t.claim_embeddings(), t.fraud_patterns(), "claim_embedding",
                                     "pattern_embedding", 3, ["claim_id", "customer_id", "lob_type"])


@register("g06_similar_patterns", rs.TOPK, ["v_claim_embeddings", "v_fraud_patterns"], ["similarity_score"])
def _g06(t: Tables) -> DataFrame:
    return _topk(t)


@register("d19_similar_patterns_array", rs.TOPK_ARRAY, ["v_claim_embeddings", "v_fraud_patterns"])
def _d19(t: Tables) -> DataFrame:
    arr = similarity.similar_patterns_array(_topk(t), ["claim_id", "customer_id", "lob_type"])
    return arr.select("claim_id", "customer_id", "lob_type",
                      F.array_join(F.transform("similar_patterns", lambda x: x["pattern_type"]), ",")
                      .alias("similar_pattern_types"))


@register("g07_sentiment_documents", rs.SENTIMENT_DOCS, [], ["sentiment"])
def _g07(t: Tables) -> DataFrame:
    return spread(t.documents(), key=["doc_id"]).select("doc_id", tx.sentiment(F.col("text")).alias("sentiment"))


@register("g09_classify_lob_documents", rs.CLASSIFY_DOCS, [])
def _g09(t: Tables) -> DataFrame:
    return spread(t.documents(), key=["doc_id"]).select("doc_id", tx.classify_lob(F.col("text")).alias("lob_type"))


@register("g10_summarize_documents")
def _g10(t: Tables) -> DataFrame:
    return spread(t.documents(), key=["doc_id"]).select("doc_id", tx.summarize(F.col("text"), 2).alias("summary"))


@register("g01_embed_documents")
def _g01(t: Tables) -> DataFrame:
    docs = spread(t.documents().select("doc_id", "text"), key=["doc_id"])
    return models.embed_text(docs, "text", dim=64).drop("text")


@register("g11_search_bm25", rs.BM25, [], ["score"])
def _g11(t: Tables) -> DataFrame:
    q = t.benchmark().select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return search.search(t.documents(), q, text_col="text", doc_id="doc_id", k=5)


@register("g13_extract_json", rs.EXTRACT_JSON, [])
def _g13(t: Tables) -> DataFrame:
    c = t.raw("conversations")
    reply = F.concat(F.col("text"), F.lit(' {"turn": '), F.col("turn").cast("string"), F.lit(', "role": "'),
                     F.col("role"), F.lit('"} end'))
    parsed = tx.extract_json(reply, "turn long, role string")
    return c.select("conv_id", "turn", parsed["turn"].alias("parsed_turn"), parsed["role"].alias("parsed_role"))


@register("g15_churn_prompt")
def _g15(t: Tables) -> DataFrame:
    c = c360_with_propensity(t)
    return c.select("customer_id", churn.churn_profile_line(c).alias("profile_line"))


@register("g16_customer_context")
def _g16(t: Tables) -> DataFrame:
    c, (alerts, actions, _a) = _churn_run(t)
    return churn.customer_context(c, alerts, actions, mode="customer")


def _j05_sql() -> str:
    from claimflow.checks import agents_sql
    return agents_sql.INTERACTION_FEATURES


@register("j05_interaction_features", _j05_sql(), ["v_customers", "v_interactions"],
          ["frustration_level", "digital_engagement_trend"])
def _j05(t: Tables) -> DataFrame:
    c = c360.build_c360_full(t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(), None, None,
                             OW, EV)
    return churn.extract_interaction_features(c, t.interactions(with_text_key=True), EV, texts=t.transcript_texts()).select(
        "customer_id", "frustration_level", "intent_cancel_detected", "competitor_mentions_count",
        "digital_engagement_trend", "emotional_manipulation_flag")


# ============================================================== K: data quality
EXPECTATIONS = [  # fixed values: (table, column, metric, expectation name); every expectation is value = 0
    ("claims_landing", "claim_id", "NULL_COUNT", "CLAIMS_NO_NULL_ID"),
    ("claims_landing", "claim_id", "DUPLICATE_COUNT", "CLAIMS_UNIQUE_ID"),
    ("claims_landing", "claimed_amount", "NULL_COUNT", "CLAIMS_NO_NULL_AMOUNT"),
    ("claims_landing", "customer_id", "REFERENTIAL_INTEGRITY_COUNT", "CLAIMS_VALID_CUSTOMER"),
    ("customers", "customer_id", "NULL_COUNT", "CUSTOMERS_NO_NULL_ID"),
    ("customers", "customer_id", "DUPLICATE_COUNT", "CUSTOMERS_UNIQUE_ID"),
    ("policies", "policy_id", "NULL_COUNT", "POLICIES_NO_NULL_ID"),
    ("policies", "policy_id", "DUPLICATE_COUNT", "POLICIES_UNIQUE_ID"),
    ("fct_customer_360", "customer_id", "NULL_COUNT", "C360_NO_NULL_ID"),
    ("fct_customer_360", "customer_id", "DUPLICATE_COUNT", "C360_UNIQUE_ID"),
    ("churn_alerts", "customer_id", "NULL_COUNT", "ALERTS_NO_NULL_CUSTOMER"),
    ("resolutions", "settlement_amount", "NULL_COUNT", "RESOLUTIONS_NO_NULL_SETTLEMENT"),
    ("resolutions", "claim_id", "DUPLICATE_COUNT", "RESOLUTIONS_UNIQUE_CLAIM"),
    ("resolutions", "claim_id", "REFERENTIAL_INTEGRITY_COUNT", "RESOLUTIONS_VALID_CLAIM"),
    ("fraud_indicators", "pattern_description", "NULL_COUNT", "FRAUD_INDICATORS_NO_NULL_DESC"),
]


def _claim_text_presence(t: Tables) -> DataFrame:
    """``claim_text`` reduced to its nullness: a placeholder where the claim's narrative
    exists, NULL where it is missing (K01 only counts NULLs; the text never moves)."""
    c = t.claims(with_text_key=True).select("claim_text_id")
    j = c.join(t.claim_text_flags().select("claim_text_id", "text_is_null"), "claim_text_id", "left")
    return j.select(F.when(F.col("text_is_null") == False, F.lit("")).alias("claim_text"))  # noqa: E712


@register("k04_quality_report", rs.QUALITY, _ALL_FACT_VIEWS + ["v_claims_text", "v_fraud_patterns"] + C360_SCORED_VIEWS)
def _k04(t: Tables) -> DataFrame:
    """The 18 metrics of the source's quality attachments; 15 of them carry an expectation."""
    claims, customers = t.claims(), t.customers()
    c360_dyn = c360.build_c360_dynamic(customers, t.policies(), claims, t.payments(), t.interactions(), OW, EV)
    alerts = _churn_run(t)[1][0]
    resolutions = cut_lineage(_h09(t).select("claim_id", "settlement_amount"))  # read twice, decided once
    parts = [
        dq.table_metrics(claims, "claims_landing", ["claim_id", "claimed_amount"], "claim_id"),
        dq.null_count(_claim_text_presence(t), "claims_landing", ["claim_text"]),
        dq.ref_integrity_count(claims, "claims_landing", "customer_id", customers, "customer_id"),
        dq.table_metrics(customers, "customers", ["customer_id", "email"], "customer_id"),
        dq.table_metrics(t.policies(), "policies", ["policy_id", "customer_id"], "policy_id"),
        dq.table_metrics(c360_dyn, "fct_customer_360", ["customer_id"], "customer_id"),
        dq.table_metrics(alerts, "churn_alerts", ["customer_id"]),
        dq.table_metrics(resolutions, "resolutions", ["settlement_amount"], "claim_id"),
        dq.ref_integrity_count(resolutions, "resolutions", "claim_id", claims, "claim_id"),
        dq.table_metrics(t.fraud_patterns(), "fraud_indicators", ["pattern_description"]),
    ]
    metrics = reduce(DataFrame.unionByName, parts)
    exp = t.spark.createDataFrame(EXPECTATIONS, "table_name string, column_name string, metric string, "
                                                "expectation string").withColumn("expected_value", F.lit(0).cast("long"))
    return dq.evaluate_expectations(metrics, F.broadcast(exp))       # 15 literal rows


# ============================================================== A: write operators
_LATER = (rs.LATER_OW, rs.LATER_EV)


@register("a11_snapshot_diff", rs.SNAPSHOT_DIFF, _ALL_FACT_VIEWS)
def _a11(t: Tables) -> DataFrame:
    def snap(ow, ev):
        return c360.build_c360_dynamic(t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(),
                                       ow, ev).select("customer_id", *rs.DIFF_COLS)
    return writes.diff_snapshots(snap(OW, EV), snap(*_LATER), ["customer_id"])


@register("a12_merge_refresh", rs.MERGE_REFRESH, _ALL_FACT_VIEWS, ["total_annual_premium", "sentiment_score_last_30d"])
def _a12(t: Tables) -> DataFrame:
    target = (c360.build_c360_bootstrap(t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(), OW, EV)
              .select("customer_id", "customer_segment", "total_annual_premium", "sentiment_score_last_30d",
                      "complaint_count_90d", "last_interaction_days_ago")
              .withColumn("last_refreshed_at", F.lit(None).cast("timestamp_ntz")))
    source = features.agg_interaction_signals(t.interactions(), rs.LATER_EV).select(
        "customer_id", "sentiment_score_last_30d", "complaint_count_90d", "last_interaction_days_ago")
    ts = F.lit(f"{rs.LATER_EV} 00:00:00").cast("timestamp_ntz")
    return writes.merge_upsert(target, source, ["customer_id"], set_on_update={"last_refreshed_at": ts},
                               set_on_insert={"last_refreshed_at": ts})


@register("a15_applications_after_underwriting", rs.APPS_AFTER, ["v_applications", "v_actuarial"])
def _a15(t: Tables) -> DataFrame:
    after = underwriting.run_underwriting(t.applications(), t.actuarial(), OW)[1]
    return after.select("application_id", "lob_type", "credit_score", "status")


@register("h03_claims_after_gate", rs.CLAIMS_AFTER_GATE, ["v_claims", "v_customers", "v_policies"])
def _h03(t: Tables) -> DataFrame:
    dqr = dq.dq_validate_claims(t.claims(), t.customers(), t.policies(), OW, keep_columns=True)
    return dq.gate_batch(dqr, OW)[1].select("claim_id", "customer_id", "claim_status")


# ============================================================== more read models and helpers
from claimflow.operators import claims_v1 as cv1  # noqa: E402


@register("e06_newest_resolutions", rs.NEWEST_RESOLUTIONS, ["v_claims", "v_claims_text", "v_customers", "v_policies"],
          ["settlement_amount", "claimed_amount", "fraud_score", "confidence_score"])
def _e06(t: Tables) -> DataFrame:
    out = _claims_batch(t)
    return reports.newest(out["resolutions"], "decided_at", 50, tie="resolution_id")


@register("h22_claim_state_flat", rs.CLAIM_STATE_FLAT, ["v_claims", "v_claims_text", "v_customers", "v_policies"],
          ["fraud_score", "recommended_settlement", "settlement"])
def _h22(t: Tables) -> DataFrame:
    return reports.claim_state_flat(_v2_state(t))


@register("h23_audit_trail", rs.AUDIT_TRAIL, ["v_claims", "v_claims_text", "v_customers", "v_policies"])
def _h23(t: Tables) -> DataFrame:
    out = _claims_batch(t)
    refs = out["resolutions"].select(F.col("claim_id").alias("reference_id"))
    trail = reports.audit_trail(out["audit"].filter(F.col("agent_name") != "DQ_VALIDATOR"), refs)
    return trail.select("flow_type", "reference_id", "agent_name", "step_number", "module_used", "status")


@register("e07_deep_dive_claims", rs.DEEP_DIVE_CLAIMS, C360_SCORED_VIEWS)
def _e07(t: Tables) -> DataFrame:
    c = c360_with_propensity(t)
    panels = reports.customer_deep_dive(_scan(t).select("customer_id"), c, t.policies(), t.claims(),
                                        churn.empty_alerts(t.spark), churn.empty_nba(t.spark))
    return panels["claims"]


@register("l05_health_check_claims", rs.HEALTH_CLAIMS, ["v_claims", "v_customers", "v_policies"])
def _l05(t: Tables) -> DataFrame:
    claims = t.claims()
    dqr = dq.dq_validate_claims(claims, t.customers(), t.policies(), OW, keep_columns=True)
    passed = dq.gate_batch(dqr, OW)[0]
    # claims that went through intake and then stopped: started 10 minutes before the check
    started = F.lit(f"{OW} 00:00:00").cast("timestamp_ntz") - F.expr("INTERVAL 10 MINUTES")
    state = (claims_v2.agent_intake_v2(passed, F.lit("medium"))
             .select("claim_id", "current_state", started.alias("started_at"),
                     F.lit(None).cast("timestamp_ntz").alias("completed_at"),
                     F.lit(None).cast("string").alias("error_message")))
    _state_after, claims_after, _counts = reports.health_check(state, claims, OW)
    return claims_after.select("claim_id", "customer_id", "claim_status")


@register("i03_uw_guidelines", rs.GUIDELINES, ["v_applications", "v_guidelines"], ["score"])
def _i03(t: Tables) -> DataFrame:
    apps = t.applications().filter(F.col("status") == "PENDING").withColumn(
        "risk_tier", underwriting.risk_tier(F.col("credit_score")))
    return underwriting.uw_guidelines(apps, t.guidelines(), "content", "guideline_id", k=3)


@register("g11_search_filtered", rs.BM25_FILTERED, ["v_guidelines"], ["score"])
def _g11f(t: Tables) -> DataFrame:
    """Benchmark items search the guidelines of one LOB each; the passages' tier is returned."""
    q = t.benchmark().select(F.col("item_id").alias("query_id"), F.col("text").alias("query"),
                             F.when(F.col("item_id") % 2 == 0, "AUTO").otherwise("HOME").alias("wanted"))
    return search.search(t.guidelines(), q, text_col="content", doc_id="guideline_id", k=4, filters={"lob_type": "wanted"},
                         return_cols=["lob_type", "risk_tier"])


@register("c09_duplicates_90d", rs.DUP_90D, ["v_claims"])
def _c09(t: Tables) -> DataFrame:
    c = t.claims().filter(F.col("customer_id").isNotNull() & F.col("policy_id").isNotNull()
                          & F.col("incident_date").isNotNull())
    d = cv1.duplicate_counts_90d(t.claims())
    return (c.join(d, ["customer_id", "policy_id", "incident_date"], "left")
             .select("claim_id", (F.col("_within") - 1).alias("n_within_90d")))


@register("c11_same_day_claims", rs.SAME_DAY, ["v_claims"])
def _c11(t: Tables) -> DataFrame:
    return cv1.same_day_counts(t.claims())


@register("d17_multi_lob_count", rs.MULTI_LOB, ["v_policies"])
def _d17(t: Tables) -> DataFrame:
    return cv1.multi_lob_count(t.policies())


@register("j13_log_interactions", rs.CHAT_LOG, [])
def _j13(t: Tables) -> DataFrame:
    chat = churn.pair_turns(t.raw("conversations")).select(
        F.col("conv_id").alias("customer_id"), "turn", "prompt", "reply",
        F.when(F.col("conv_id") % 2 == 0, "agent").otherwise("customer").alias("mode"))
    return churn.log_interactions(chat, f"{EV}")


@register("a07_append_defaults", rs.DEFAULTS, [])
def _a07(t: Tables) -> DataFrame:
    rows = t.raw("conversations").select("conv_id", "turn", "role",
                                         F.lit(None).cast("string").alias("interaction_id"),
                                         F.lit(None).cast("string").alias("channel"))
    return writes.append_with_defaults(
        rows, {"interaction_id": "uuid", "channel": "CHAT", "resolution_status": "RESOLVED", "created_at": "now"},
        EV, key_cols=["conv_id", "turn"])


@register("g14_parse_model_reply", rs.FENCED, [])
def _g14(t: Tables) -> DataFrame:
    c = t.raw("conversations")
    reply = F.concat(F.lit("```json\n"), F.to_json(F.struct("turn", "role")), F.lit("\n```"))
    parsed = tx.parse_model_reply(reply, "turn long, role string")
    return c.select("conv_id", "turn", parsed["turn"].alias("parsed_turn"), parsed["role"].alias("parsed_role"))


@register("h11_intake_v1", ks.INTAKE_V1, ["v_claims_v1"], ["confidence_score", "stated_amount"])
def _h11(t: Tables) -> DataFrame:
    """Entities by the extraction grammar; claims without a statement take the source's fallback branch."""
    sub = t.claims(with_statement=True).filter(F.col("claim_status") == "SUBMITTED")
    out = cv1.agent_intake_v1(sub, facts=extract.claim_facts(F.col("claim_text")))
    return out.select("claim_id", "lob_classification", "confidence_score", "urgency_level",
                      "multi_lob_indicator", "parse_error", "current_state",
                      F.col("_ex.incident_date").cast("date").alias("stated_day"), F.col("_ex.claimed_amount").alias("stated_amount"),
                      F.col("_ex.incident_location").alias("place"),
                      F.coalesce("_ex.estimated_severity", F.lit("medium")).alias("severity"))


# ============================================================== v1 sub-agents, E02, G04/A13, A17
from claimflow.checks import agents_sql as ag  # noqa: E402
from claimflow.operators.ranking import latest_per_key  # noqa: E402


def _v1_validated(t: Tables) -> DataFrame:
    claims = t.claims()
    return cv1.agent_validation_v1(claims.filter(F.col("claim_status") == "SUBMITTED"), t.policies(), claims)


def _v1_scored(t: Tables) -> DataFrame:
    claims = t.claims(with_statement=True).filter(F.col("claim_status") == "SUBMITTED")
    valid = cv1.agent_validation_v1(cv1.with_signals(claims, **_v1_texts(t)), t.policies(), t.claims())
    return cv1.agent_fraud_v1(valid, t.claims(), t.customers(), V1_AS_OF)


@register("h12_validation_v1", ag.VALIDATION_V1, ["v_claims", "v_policies"],
          ["coverage_limit", "deductible", "max_payable"])
def _h12(t: Tables) -> DataFrame:
    failed = F.array_join(F.transform(F.filter("checks", lambda c: ~c["passed"]), lambda c: c["check"]), ",")
    return _v1_validated(t).select("claim_id", "eligible", "ineligible_reason", "coverage_limit", "deductible",
                                   "max_payable", failed.alias("failed_checks"), "multi_lob_count",
                                   "concurrent_claims")


@register("h16_fraud_v1", ag.FRAUD_V1, ks.V1_VIEWS,
          ["dup_score", "tenure_score", "composite_fraud_score", "embed_score", "rag_score", "narrative_score", "sentiment"])
def _h16(t: Tables) -> DataFrame:
    return _v1_scored(t).select("claim_id", "embed_score", "rag_score", "narrative_score", "sentiment", "dup_score", "tenure_score", "composite_fraud_score",
                                "fraud_risk_level", "recommended_action")


@register("h17_assessment_v1", ag.ASSESSMENT_V1, ks.V1_VIEWS,
          ["base_settlement", "risk_factor", "assessed_settlement"])
def _h17(t: Tables) -> DataFrame:
    return cv1.agent_assessment_v1(_v1_scored(t)).select("claim_id", "base_settlement", "risk_factor",
                                                         "assessed_settlement")


@register("e02_latest_interaction", ag.LATEST_INTERACTION, ["v_interactions"])
def _e02(t: Tables) -> DataFrame:
    i = t.interactions().select("customer_id", "interaction_id", "channel", "interaction_date",
                                "resolution_status")
    return latest_per_key(i, ["customer_id"], "interaction_date", tie="interaction_id")


@register("g04_refresh_document_embeddings", ag.EMBEDDING_REFRESH, [])
def _g04(t: Tables) -> DataFrame:
    """G04 + A13: documents without a stored vector are embedded (anti join first, so
    stored rows are never re-scored) and inserted; stored vectors stay as they are."""
    stored = t.raw("embeddings").select(F.col("vec_id").alias("doc_id"), "embedding",
                                        F.lit("EXISTING").alias("origin"))
    docs = t.documents().select("doc_id", "text")

    def embed(new: DataFrame) -> DataFrame:
        return (models.embed_text(spread(new, key=["doc_id"]), "text", dim=64).drop("text")
                .withColumn("origin", F.lit("NEW")))

    added = similarity.refresh_pattern_embeddings(docs, stored, embed, key="doc_id")
    table = writes.merge_insert_only(stored, added, ["doc_id"])
    return table.select("doc_id", "origin", F.size("embedding").alias("dims"))


@register("a17_claims_audit", ag.CLAIMS_AUDIT, ["v_claims", "v_claims_text", "v_customers", "v_policies"])
def _a17(t: Tables) -> DataFrame:
    out = _claims_batch(t)
    return out["audit"].select("flow_type", "reference_id", "agent_name", "step_number", "module_used",
                               "status", "created_at")


# ============================================================== E03/E04: batch caps (the cap is the feature)
@register("e03_gate_batch_cap20", ag.GATE_CAP20, ["v_claims", "v_customers", "v_policies"])
def _e03(t: Tables) -> DataFrame:
    """One claims-batch run: only the 20 oldest SUBMITTED claims are gated (the rest wait)."""
    return dq.gate_oldest(t.claims(), t.customers(), t.policies(), OW, 20).select("claim_id", "customer_id", "claim_status")


@register("e04_churn_batch_cap100", cs.ALERTS_AFTER.replace(
              "'ACTIONED' AS status", "CASE WHEN priority <= 100 THEN 'ACTIONED' ELSE 'NEW' END AS status"),
          C360_SCORED_VIEWS, ["churn_propensity", "sentiment_score"])
def _e04(t: Tables) -> DataFrame:
    """One churn-pipeline run: the 100 NEW alerts with the best priority are worked, the rest stay NEW."""
    c = kept_c360(t)
    return churn.run_churn(c, churn.empty_alerts(t.spark), OW, cap=100)[0]


# ============================================================== A06 + G17: staged documents
@register("g17_process_pages", ag.PROCESS_PAGES, [])
def _g17(t: Tables) -> DataFrame:
    """Each page is a staged HTML file ``P<page_id>/DOC-<page_id>_page.html``: registered
    PENDING (A06), joined to its bytes by path, decoded, marked EXTRACTED / FAILED with its
    length and an embedding (G17)."""
    pages = spread(t.raw("pages").select("page_id", "html"), key=["page_id"])
    files = pages.select(
        F.concat(F.lit("P"), F.col("page_id").cast("string"), F.lit("/DOC-"), F.col("page_id").cast("string"),
                 F.lit("_page.html")).alias("path"),
        F.encode(F.col("html"), "UTF-8").alias("content"))
    listing = files.select("path", F.octet_length("content").alias("length"))
    out = models.process_documents(models.register_documents(listing, EV), files, EV, dim=64)
    return out.select("document_id", "claim_id", "file_name",
                      F.col("file_size_bytes").cast("long").alias("file_size_bytes"),
                      "extraction_status", F.col("text_length").cast("long").alias("text_length"),
                      F.size("text_embedding").cast("long").alias("embedding_dims"))


# ============================================================== J08: root-cause step on its own
@register("j08_root_cause_alerts", cs.ALERTS_AFTER.replace("'ACTIONED' AS status", "'IN_PROGRESS' AS status"),
          C360_SCORED_VIEWS, ["churn_propensity", "sentiment_score"])
def _j08(t: Tables) -> DataFrame:
    """Today's NEW alerts after the root-cause step: IN_PROGRESS; without a completion
    model the root cause and its confidence stay NULL (the source's failed-parse branch)."""
    c = kept_c360(t)
    return churn.root_cause(churn.churn_scan(c, churn.empty_alerts(t.spark), OW), c, OW)


# ============================================================== A08, A09, A16: ingest and insert-select
from claimflow.constants import LOB_BY_MOD3  # noqa: E402
from claimflow.operators import ingest  # noqa: E402
from claimflow.session import ensure_checkpoint_dir  # noqa: E402


@register("a08_ingest_claims", ag.INGEST_CLAIMS, ["v_claims"])
def _a08(t: Tables) -> DataFrame:
    """Forms with JSON columns become claims with VARIANT columns; forms whose JSON is broken come back with the reason."""
    claims, rejected = ingest.ingest_claims(t.claim_forms(), OW)
    kinds = {"source": "string", "lob": "string", "dq_validated": "boolean"}
    loaded = claims.select("claim_id", "claim_status", *[F.try_variant_get("metadata", f"$.{k}", v).alias(k) for k, v in kinds.items()],
                           F.try_variant_get("supporting_docs", "$[0].file", "string").alias("first_file"))
    return loaded.unionByName(rejected, allowMissingColumns=True)


@register("a09_ingest_applications", ag.INGEST_APPLICATIONS, [], ["coverage_limit"])
def _a09(t: Tables) -> DataFrame:
    """Three kinds of application loaded into one partitioned folder, one of them twice, and read back as one frame."""
    import uuid
    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/applications-{uuid.uuid4().hex}"
    loads = {lob: ingest.ingest_applications(t.application_forms(lob), lob, OW) for lob in LOB_BY_MOD3}
    for lob in [*LOB_BY_MOD3, LOB_BY_MOD3[0]]:
        ingest.write_applications(loads[lob][0], path, lob, OW)
    refused = reduce(DataFrame.unionByName, [r.withColumn("lob_type", F.lit(lob)) for lob, (_, r) in loads.items()])
    return (ingest.read_applications(t.spark, path)
            .select("application_id", "lob_type", "status", F.coalesce("applicant_name", "employer_name").alias("name"),
                    "coverage_limit", "employee_count", "prior_claims_3yr")
            .unionByName(refused, allowMissingColumns=True))


@register("a16_insert_select_audit", ag.INSERT_SELECT, ["v_claims", "v_claims_text", "v_customers", "v_policies", "v_applications"])
def _a16(t: Tables) -> DataFrame:
    """The audit log of the claims batch, with the underwriting run's rows inserted."""
    audit = _claims_batch(t)["audit"]
    return writes.append(audit, underwriting.run_underwriting(t.applications(), t.actuarial(), OW)[2]).select(
        "reference_id", "flow_type", "agent_name", "step_number", "status")


# ============================================================== J07 with earlier alerts, I05 with its guideline look-up
@register("j07_churn_scan_suppressed", cs.SCAN_SUPPRESSED, C360_SCORED_VIEWS, ["churn_propensity", "sentiment_score"])
def _j07s(t: Tables) -> DataFrame:
    """Customers with an open alert of the last week are left out; older and worked alerts suppress nothing."""
    return churn.churn_scan(c360_with_propensity(t), t.alerts(OW), OW)


@register("i05_underwriting_grounded", ag.UW_GROUNDED.replace("{GUIDELINES}", rs.GUIDELINES), ["v_applications", "v_actuarial", "v_guidelines"])
def _i05g(t: Tables) -> DataFrame:
    decisions, _, audit = underwriting.run_underwriting(t.applications(), t.actuarial(), OW, guidelines=t.guidelines())
    return (decisions.select("application_id", "application_status", F.array_join(F.col("guideline_ids").cast("array<string>"), ",").alias("guideline_ids"))
            .join(audit.select(F.col("reference_id").cast("long").alias("application_id"), "module_used"), "application_id"))


# ============================================================== E06, E07, C16/D16: further listings, panels and the playbook block
@register("e06_alerts_by_priority", rs.ALERTS_BY_PRIORITY, C360_SCORED_VIEWS)
def _e06a(t: Tables) -> DataFrame:
    return _scan(t).orderBy("priority").limit(50).select("customer_id", "priority", "trigger_reason")


@register("e06_newest_states", rs.AUDIT_NEWEST, ["v_claim_states"])
def _e06s(t: Tables) -> DataFrame:
    return reports.newest(t.claim_states(OW), "started_at", 50, tie="claim_id").select("claim_id", "current_state", "started_at")


def _panels(t: Tables) -> dict:
    c = c360_with_propensity(t)
    return reports.customer_deep_dive(_scan(t).select("customer_id"), c, t.policies(), t.claims(), t.alerts(OW), churn.empty_nba(t.spark))


@register("e07_deep_dive_policies", rs.DEEP_DIVE_POLICIES, ["v_policies", *[v for v in C360_SCORED_VIEWS if v != "v_policies"]],
          ["premium_annual", "coverage_limit"])
def _e07p(t: Tables) -> DataFrame:
    return _panels(t)["policies"]


@register("e07_deep_dive_alerts", rs.DEEP_DIVE_ALERTS, C360_SCORED_VIEWS)
def _e07a(t: Tables) -> DataFrame:
    return _panels(t)["alerts"].select("alert_id", "customer_id", "status")


@register("d16_playbook_context", rs.PLAYBOOK_CONTEXT, C360_SCORED_VIEWS)
def _d16(t: Tables) -> DataFrame:
    """C16 + D16: the playbooks of a customer's segment or cause as one block of text."""
    books = t.spark.createDataFrame([(i, seg, cause, a, o, r) for i, seg, cause, a, o, _, r in PLAYBOOKS],
                                    "playbook_id string, customer_segment string, root_cause string, playbook_name string, "
                                    "content string, success_rate double")
    return reports.playbook_context(_causes(t).select("customer_id", "customer_segment", "root_cause"), books)

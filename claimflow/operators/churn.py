"""Churn scan, root cause, retention actions and their read models.

Model-backed steps (root cause, action text) take an injectable ``scorer``:
a function ``pandas.DataFrame -> pandas.DataFrame`` run per Arrow batch in
``mapInPandas``. Without one the reply is NULL, which is the source's own
fallback path (NULL fields, status transitions still applied).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.constants import ROOT_CAUSE_RULES

from claimflow.functions.dates import as_date, as_ts
from claimflow.operators.ranking import global_row_number, null_aware_anti

ALERT_SCHEMA = T.StructType([
    T.StructField("alert_id", T.StringType()), T.StructField("customer_id", T.LongType()),
    T.StructField("alert_date", T.DateType()), T.StructField("churn_propensity", T.DoubleType()),
    T.StructField("sentiment_score", T.DoubleType()), T.StructField("complaint_count", T.LongType()),
    T.StructField("trigger_reason", T.StringType()), T.StructField("priority", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("root_cause", T.StringType()),
    T.StructField("root_cause_confidence", T.DoubleType()), T.StructField("created_at", T.TimestampNTZType()),
])

NBA_SCHEMA = T.StructType([
    T.StructField("nba_id", T.StringType()), T.StructField("customer_id", T.LongType()),
    T.StructField("action_type", T.StringType()), T.StructField("offer_details", T.StringType()),
    T.StructField("channel", T.StringType()), T.StructField("timing", T.StringType()),
    T.StructField("priority", T.LongType()), T.StructField("expected_success_rate", T.DoubleType()),
    T.StructField("root_cause", T.StringType()), T.StructField("rationale", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("created_date", T.DateType()),
    T.StructField("expiry_date", T.DateType()), T.StructField("outcome", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])


def empty_alerts(spark) -> DataFrame:
    return spark.createDataFrame([], ALERT_SCHEMA)


def empty_nba(spark) -> DataFrame:
    return spark.createDataFrame([], NBA_SCHEMA)


def _opt(df: DataFrame, name: str, dtype: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def trigger_reason(df: DataFrame) -> Column:
    p, s, c = F.col("churn_propensity_score"), F.col("sentiment_score_last_30d"), F.col("complaint_count_90d")
    return (F.when(p > 0.7, "VERY_HIGH_CHURN_PROPENSITY").when(p > 0.5, "HIGH_CHURN_PROPENSITY")
            .when(s < -0.5, "VERY_NEGATIVE_SENTIMENT").when(s < -0.3, "NEGATIVE_SENTIMENT")
            .when(c >= 5, "EXCESSIVE_COMPLAINTS").when(c >= 3, "HIGH_COMPLAINTS")
            .when(_opt(df, "renewal_risk_signal", "boolean") == True, "RENEWAL_AT_RISK")  # noqa: E712
            .when(_opt(df, "intent_cancel_detected", "boolean") == True, "CANCELLATION_INTENT")  # noqa: E712
            .when(_opt(df, "competitor_mentions_count", "long") >= 2, "COMPETITOR_SHOPPING")
            .otherwise("MULTIPLE_SIGNALS"))


def churn_scan(c360: DataFrame, alerts: DataFrame, as_of, suppress_days: int = 7) -> DataFrame:
    """New alerts for at-risk customers not alerted (NEW/IN_PROGRESS) in the last week.

    Priority is ``ROW_NUMBER() OVER (ORDER BY lifetime_value_score DESC)`` over the
    rows that pass the filter, NULLs first (trap T02), ties by ``customer_id``.
    """
    today = as_date(as_of)
    risky = ((F.col("churn_propensity_score") > 0.5) | (F.col("sentiment_score_last_30d") < -0.3)
             | (F.col("complaint_count_90d") >= 3)
             | ((_opt(c360, "renewal_risk_signal", "boolean") == True) & (F.col("sentiment_trend") < -0.1))  # noqa: E712
             | (_opt(c360, "intent_cancel_detected", "boolean") == True)  # noqa: E712
             | (_opt(c360, "competitor_mentions_count", "long") >= 2))
    cand = c360.filter(F.coalesce(risky, F.lit(False)))
    recent = alerts.filter((F.col("alert_date") >= F.date_sub(today, suppress_days))
                           & F.col("status").isin("NEW", "IN_PROGRESS"))
    cand = null_aware_anti(cand, recent, "customer_id")
    cand = cand.select("customer_id", "lifetime_value_score", "churn_propensity_score", "sentiment_score_last_30d",
                       "complaint_count_90d", trigger_reason(cand).alias("trigger_reason"))
    ranked = global_row_number(cand, [F.col("lifetime_value_score").desc_nulls_first(),
                                      F.col("customer_id").asc_nulls_first()], "priority")
    return ranked.select(
        F.sha2(F.concat_ws("-", F.lit("ALERT"), F.col("customer_id").cast("string"), today.cast("string")), 256)
         .alias("alert_id"),
        F.col("customer_id").cast("long").alias("customer_id"),
        today.alias("alert_date"),
        F.col("churn_propensity_score").alias("churn_propensity"),
        F.col("sentiment_score_last_30d").alias("sentiment_score"),
        F.col("complaint_count_90d").cast("long").alias("complaint_count"),
        "trigger_reason", "priority",
        F.lit("NEW").alias("status"),
        F.lit(None).cast("string").alias("root_cause"),
        F.lit(None).cast("double").alias("root_cause_confidence"),
        as_ts(as_of).alias("created_at"),
    )


# label in the prompt, C360 column, whether a missing value is named (else it makes the line NULL, trap T10)
_PROFILE = [
    ("customer", "customer_id", False), ("segment", "customer_segment", False), ("lifetime value", "lifetime_value_score", False),
    ("months with us", "tenure_months", False), ("yearly premium", "total_annual_premium", False),
    ("lines of business", "lob_diversity", False), ("mood, last 30 days", "sentiment_score_last_30d", True),
    ("change of mood", "sentiment_trend", True), ("complaints, last 90 days", "complaint_count_90d", False),
    ("payments missed in a year", "missed_payments_12m", False), ("latest NPS", "nps_score_latest", True),
    ("days to renewal", "days_to_nearest_renewal", True), ("open claims", "open_claims_count", False),
    ("days to resolve a claim", "avg_resolution_time_days", True), ("competitors named", "competitor_mentions_count", False),
    ("wants to cancel", "intent_cancel_detected", False),
]


def churn_profile_line(c360: DataFrame) -> Column:
    """The profile line of the root-cause prompt. ``concat`` is NULL-propagating
    like the source (trap T10); optional parts are 'unknown' if missing. Columns the
    given C360 build does not have are NULL, as in the source table."""
    parts = []
    for label, column, optional in _PROFILE:
        value = _opt(c360, column, "string").cast("string")
        value = F.coalesce(value, F.lit("unknown")) if optional else value
        parts += [F.lit(f"{'; ' if parts else ''}{label}: "), value]
    return F.concat(*parts)


def root_cause_rules(c360: DataFrame) -> DataFrame:
    """(customer_id, root_cause, confidence) by ROOT_CAUSE_RULES: this engine's scorer, without a model."""
    out = None
    for name, column, comparison, bound, confidence in ROOT_CAUSE_RULES:
        found = F.struct(F.lit(name).alias("root_cause"), F.lit(confidence).alias("confidence"))
        if column is None:
            return c360.select("customer_id", (found if out is None else out.otherwise(found)).alias("_r")).select("customer_id", "_r.*")
        value = _opt(c360, column, "double").cast("double")
        holds = value >= bound if comparison == ">=" else value < bound
        out = F.when(holds, found) if out is None else out.when(holds, found)
    return c360.select("customer_id", out.alias("_r")).select("customer_id", "_r.*")


def playbook_actions(causes: DataFrame, playbooks: DataFrame) -> DataFrame:
    """The playbook for each (customer_id, customer_segment, root_cause): of those that fit (a NULL segment or cause
    fits any), the one that names most of the two, then the most successful, then the first id. ``playbooks`` is a
    reference table; the choice is an aggregation, so a frequent cause is not gathered."""
    p = playbooks.select("playbook_id", F.col("segment").alias("_seg"), F.col("cause").alias("_cause"), "action_type",
                         "offer_details", "channel", "success_rate")
    fits = (F.coalesce(F.col("_seg") == F.col("customer_segment"), F.col("_seg").isNull())
            & F.coalesce(F.col("_cause") == F.col("root_cause"), F.col("_cause").isNull()))
    kinds = causes.select("customer_segment", "root_cause").distinct().join(p, fits)
    named = F.col("_seg").isNotNull().cast("int") + F.col("_cause").isNotNull().cast("int")
    best = kinds.groupBy("customer_segment", "root_cause").agg(F.max_by(
        F.struct("playbook_id", "action_type", "offer_details", "channel", "success_rate"),
        F.struct(named, "success_rate", -F.substring("playbook_id", 4, 9).cast("int"))).alias("b"))
    same = F.expr("c.customer_segment <=> k.customer_segment and c.root_cause <=> k.root_cause")
    return causes.alias("c").join(best.alias("k"), same, "left").select("c.*", "k.b.*")


def root_cause(alerts: DataFrame, c360: DataFrame, as_of, scorer=None) -> DataFrame:
    """Classify today's NEW alerts; they move to IN_PROGRESS.

    ``scorer(pdf[customer_id, prompt]) -> pdf[customer_id, root_cause, confidence]``.
    Returns the full alerts table with the transition applied.
    """
    today = as_date(as_of)
    todays = (F.col("status") == "NEW") & (F.col("alert_date") == today)
    if scorer is None:
        rc = alerts.select("customer_id").where(F.lit(False)).withColumn("_rc", F.lit(None).cast("string")) \
                   .withColumn("_conf", F.lit(None).cast("double"))
    else:
        prompts = (alerts.filter(todays).select("customer_id").distinct()
                   .join(c360, "customer_id", "left")
                   .select("customer_id", churn_profile_line(c360).alias("prompt")))
        rc = prompts.mapInPandas(lambda it: (scorer(p) for p in it),
                                 "customer_id long, root_cause string, confidence double") \
                    .withColumnRenamed("root_cause", "_rc").withColumnRenamed("confidence", "_conf")
    j = alerts.join(rc, "customer_id", "left")
    return j.select(*[
        (F.when(todays, F.col("_rc")).otherwise(F.col("root_cause")).alias("root_cause") if c == "root_cause" else
         F.when(todays, F.col("_conf")).otherwise(F.col("root_cause_confidence")).alias("root_cause_confidence")
         if c == "root_cause_confidence" else
         F.when(todays, F.lit("IN_PROGRESS")).otherwise(F.col("status")).alias("status") if c == "status" else
         F.col(c))
        for c in alerts.columns])


def generate_nba(alerts: DataFrame, c360: DataFrame, as_of, scorer=None, expiry_days: int = 14):
    """One retention action per customer with an IN_PROGRESS alert; those
    alerts become ACTIONED. Returns ``(new_actions, alerts_after)``.

    Root cause = the IN_PROGRESS alert with the latest date; priority = the
    customer's latest alert (E02, ``max_by``). Without a scorer the action
    fields are NULL and the rationale is the source's fallback text.
    """
    today = as_date(as_of)
    inprog = alerts.filter(F.col("status") == "IN_PROGRESS")
    rc = inprog.groupBy("customer_id").agg(F.max_by("root_cause", F.struct("alert_date", "alert_id")).alias("rc"))
    prio = alerts.groupBy("customer_id").agg(F.max_by("priority", F.struct("alert_date", "alert_id")).alias("prio"))
    base = rc.join(prio, "customer_id", "left")
    if scorer is not None:
        prof = base.join(c360.select("customer_id", "customer_segment", "lifetime_value_score"), "customer_id", "left")
        reply = prof.mapInPandas(lambda it: (scorer(p) for p in it),
                                 "customer_id long, action_type string, offer_details string, channel string, "
                                 "timing string, expected_success_rate double, talking_points string")
        base = base.join(reply, "customer_id", "left")
    else:
        base = base.withColumns({c: F.lit(None).cast(t) for c, t in [
            ("action_type", "string"), ("offer_details", "string"), ("channel", "string"),
            ("timing", "string"), ("expected_success_rate", "double"), ("talking_points", "string")]})
    actions = base.select(
        F.sha2(F.concat_ws("-", F.lit("NBA"), F.col("customer_id").cast("string"), today.cast("string")), 256)
         .alias("nba_id"),
        F.col("customer_id").cast("long").alias("customer_id"),
        "action_type", "offer_details", "channel", "timing",
        F.col("prio").cast("long").alias("priority"),
        "expected_success_rate",
        F.col("rc").alias("root_cause"),
        F.concat(F.lit("Root cause: "), F.coalesce(F.col("rc"), F.lit("unknown")),
                 F.lit(". Talking points: "), F.coalesce(F.col("talking_points"), F.lit("N/A"))).alias("rationale"),
        F.lit("PENDING").alias("status"),
        today.alias("created_date"),
        F.date_add(today, expiry_days).alias("expiry_date"),
        F.lit(None).cast("string").alias("outcome"),
        as_ts(as_of).alias("created_at"),
    )
    after = alerts.withColumn("status", F.when(F.col("status") == "IN_PROGRESS", "ACTIONED")
                              .otherwise(F.col("status")))
    return actions, after


def run_churn(c360: DataFrame, alerts: DataFrame, as_of, cap: int | None = None,
              rc_scorer=None, nba_scorer=None):
    """Scan -> today's NEW alerts by priority (optional cap) -> root cause ->
    actions -> audit. Returns ``(alerts_after, new_actions, audit_row)``."""
    from claimflow.operators.writes import audit_rows
    today = as_date(as_of)
    new = churn_scan(c360, alerts, as_of)
    all_alerts = alerts.unionByName(new)
    todays_new = all_alerts.filter((F.col("alert_date") == today) & (F.col("status") == "NEW"))
    if cap is not None:
        chosen = todays_new.orderBy(F.col("priority").asc_nulls_last(), "customer_id").limit(cap).select("alert_id")
        work = all_alerts.join(chosen.withColumn("_sel", F.lit(True)), "alert_id", "left")
        scope = F.col("_sel") == True  # noqa: E712
    else:
        work, scope = all_alerts.withColumn("_sel", F.lit(True)), F.lit(True)
    in_scope = work.filter(scope).drop("_sel")
    out_scope = work.filter(~F.coalesce(scope, F.lit(False))).drop("_sel")
    rc = root_cause(in_scope, c360, as_of, rc_scorer)
    actions, rc_after = generate_nba(rc, c360, as_of, nba_scorer)
    alerts_after = rc_after.unionByName(out_scope)
    counts = todays_new.agg(F.count(F.lit(1)).alias("alerts_found"))
    payload = counts.select(F.to_json(F.struct(F.col("alerts_found"),
                                               (F.col("alerts_found") if cap is None else
                                                F.least(F.col("alerts_found"), F.lit(cap))).alias("processed")))
                            .alias("output_payload"))
    audit = audit_rows(payload.withColumn("reference_id", F.concat(F.lit("BATCH_"), today.cast("string"))),
                       "CHURN", "CHURN_PIPELINE", 0, as_of, status="SUCCESS")
    return alerts_after, actions, audit


def churn_dashboard(alerts: DataFrame, c360: DataFrame, nba: DataFrame) -> DataFrame:
    """Alerts x C360 (inner) + actions of the same day (left; fans out, trap T30)."""
    c = c360.select("customer_id", "customer_segment", "lifetime_value_score", "total_annual_premium",
                    "tenure_months", "lob_diversity", "days_to_nearest_renewal",
                    _opt(c360, "competitor_mentions_count", "long").alias("competitor_mentions_count"),
                    _opt(c360, "intent_cancel_detected", "boolean").alias("intent_cancel_detected"))
    n = nba.select(F.col("customer_id").alias("_nc"), F.col("created_date").alias("_nd"),
                   F.col("action_type").alias("nba_action"), F.col("offer_details").alias("nba_offer"),
                   F.col("channel").alias("nba_channel"), "expected_success_rate",
                   F.col("status").alias("nba_status"))
    a = alerts.select("alert_id", "customer_id", "alert_date", "churn_propensity", "sentiment_score",
                      "complaint_count", "trigger_reason", "root_cause", "root_cause_confidence", "priority", "status")
    j = a.join(c, "customer_id", "inner")
    j = j.join(n, (j.customer_id == n._nc) & (j.alert_date == n._nd), "left").drop("_nc", "_nd")
    return j


def nba_for_crm(nba: DataFrame, customers: DataFrame, c360: DataFrame, as_of) -> DataFrame:
    """Pending, unexpired actions with contact data (inner joins)."""
    today = as_date(as_of)
    n = nba.filter((F.col("status") == "PENDING") & (F.col("expiry_date") >= today))
    c = customers.select("customer_id", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))
                         .alias("customer_name"), "email", "phone")
    f = c360.select("customer_id", "customer_segment", "total_annual_premium")
    return n.join(c, "customer_id").join(f, "customer_id").select(
        "nba_id", "customer_id", "customer_name", "email", "phone", "customer_segment", "total_annual_premium",
        "action_type", "offer_details", "channel", "timing", "priority", "expected_success_rate", "root_cause",
        "rationale", "status", "expiry_date")


def pair_turns(conversations: DataFrame) -> DataFrame:
    """User turns with the assistant turn that follows them in the conversation (NULL reply: none)."""
    asked = conversations.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    told = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    return asked.join(told, ["conv_id", "turn"], "left")


def log_interactions(chat: DataFrame, as_of, mode_col: str = "mode", agent_id: str = "ASSISTANT",
                     reply_chars: int | None = None) -> DataFrame:
    """Chat exchanges written back as interactions: one row per (customer_id, turn, prompt, reply, mode).
    Direction and topic follow the mode (agent or customer); the text holds both sides, whole unless
    ``reply_chars`` cuts the reply; RESOLVED, duration 0, NULL NPS."""
    ts = as_ts(as_of)
    agent = F.col(mode_col) == "agent"
    reply = F.coalesce("reply", F.lit("")) if reply_chars is None else F.substring(F.coalesce("reply", F.lit("")), 1, reply_chars)
    text = F.concat(F.lit("User: "), F.coalesce("prompt", F.lit("")), F.lit("\nAssistant: "), reply)
    return chat.select(
        F.concat(F.lit("INT-"), F.upper(F.substring(F.sha2(F.concat_ws(
            "-", F.col("customer_id").cast("string"), F.col("turn").cast("string"), text), 256), 1, 12))).alias("interaction_id"),
        "customer_id",
        F.lit("CHAT").alias("channel"),
        ts.alias("interaction_date"),
        text.alias("transcript_text"),
        F.when(agent, "INTERNAL").otherwise("INBOUND").alias("direction"),
        F.when(agent, "Agent Assist").otherwise("Customer Chat").alias("topic"),
        F.lit("RESOLVED").alias("resolution_status"),
        F.lit(agent_id).alias("agent_id"),
        F.lit(0).cast("long").alias("duration_seconds"),
        F.lit(None).cast("long").alias("nps_score"),
    )


def c360_view(c360: DataFrame) -> DataFrame:
    """Plain wrapper view."""
    return c360.select("*")


def customer_context(c360: DataFrame, alerts: DataFrame, nba: DataFrame, mode: str = "internal") -> DataFrame:
    """One JSON bundle per customer (profile + alerts + actions). ``mode='customer'``
    drops the internal score columns. Alerts/actions are collected per customer
    (bounded by that customer's alerts), profile columns are a projection."""
    internal = ["churn_propensity_score", "lifetime_value_score", "fraud_similarity_score", "loss_ratio",
                "provider_anomaly_score", "claim_cluster_id"]
    prof_cols = [c for c in c360.columns if mode == "internal" or c not in internal]
    a_cols = ["alert_date", "trigger_reason", "status", "root_cause"] + (
        ["churn_propensity", "priority"] if mode == "internal" else [])
    n_cols = ["action_type", "offer_details", "channel", "timing", "status", "expiry_date"] + (
        ["expected_success_rate"] if mode == "internal" else [])
    a = alerts.groupBy("customer_id").agg(F.sort_array(F.collect_list(F.struct(*a_cols))).alias("alerts"))
    n = nba.groupBy("customer_id").agg(F.sort_array(F.collect_list(F.struct(*n_cols))).alias("actions"))
    j = c360.select(*prof_cols).join(a, "customer_id", "left").join(n, "customer_id", "left")
    return j.select("customer_id", F.to_json(F.struct(
        F.struct(*[F.col(c) for c in prof_cols]).alias("profile"),
        F.coalesce("alerts", F.array()).alias("alerts"), F.coalesce("actions", F.array()).alias("actions")))
        .alias("context"))


def extract_interaction_features(c360: DataFrame, interactions: DataFrame, as_of, model=None,
                                 n_chars: int | None = None, texts: DataFrame | None = None) -> DataFrame:
    """Per customer with interactions in the last 90 days, a prompt of the
    transcripts (newest first; ``n_chars`` cuts each; see ``concat_transcripts`` for ``texts``) goes to ``model``; the
    first JSON object of the reply updates five C360 features by key (A15).
    No model -> NULL reply -> the five features become NULL for those customers,
    as the source's UPDATE with a failed parse does."""
    from claimflow.functions.text import extract_json
    from claimflow.operators.models import complete
    from claimflow.operators.reports import concat_transcripts
    from claimflow.operators.writes import update_from
    tx = concat_transcripts(interactions, as_of, n_chars=n_chars, texts=texts)
    prompts = tx.select("customer_id", F.concat(
        F.lit("Below are one customer's conversations, newest first. Reply with one JSON object and no other text. Its fields: "
              "frustration_level (number, 0 calm to 1 furious), intent_cancel_detected (true or false), "
              "competitor_mentions_count (whole number), digital_engagement_trend (number, -1 falling to 1 rising), "
              "emotional_manipulation_flag (true or false).\n\n"), F.col("transcripts")).alias("prompt"))
    replies = complete(prompts, "prompt", model)
    schema = ("frustration_level double, intent_cancel_detected boolean, competitor_mentions_count long, "
              "digital_engagement_trend double, emotional_manipulation_flag boolean")
    val = replies.select("customer_id", extract_json(F.col("reply"), schema).alias("v")).select("customer_id", "v.*")
    cols = {c: c for c in ["frustration_level", "intent_cancel_detected", "competitor_mentions_count",
                           "digital_engagement_trend", "emotional_manipulation_flag"] if c in c360.columns}
    return update_from(c360, val, ["customer_id"], cols)

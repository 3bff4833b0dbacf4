"""Golden values (FIXTURES §4) and one test per semantic trap."""

import datetime as dt

from pyspark.sql import functions as F

from claimflow.functions.dates import month_diff, year_diff
from claimflow.functions.numeric import pyround
from claimflow.operators import c360, churn, claims_v1, claims_v2, dq, features, ranking, underwriting
from claimflow.sources.adapters import Tables

D = dt.date


# ------------------------------------------------------------------ golden values
def test_underwriting_golden_app001(spark):
    apps = spark.createDataFrame(
        [("APP-001", "CUST-001", "AUTO", 500000.0, 780, "CHENNAI_GENERAL", dt.datetime(2024, 10, 1), "PENDING")],
        "application_id string, existing_customer_id string, lob_type string, coverage_requested double, "
        "credit_score long, geographic_zone string, submission_date timestamp_ntz, status string")
    act = Tables(spark, "/root/testdata/sf0.001").actuarial()
    s = underwriting.uw_risk_score(apps, act).collect()[0]
    assert s.risk_tier == "LOW" and s.actuarial_table_id == "ACT-001"
    assert s.composite_score == 0.023625 and s.recommended_premium == 11813.0
    d = underwriting.uw_decide(underwriting.uw_risk_score(apps, act), "2024-10-15").collect()[0]
    assert d.auto_approved and d.confidence == 0.95 and d.application_status == "APPROVED"


def _c360_row(spark, **kw):
    base = dict(customer_id=1, missed_payments_12m=0, sentiment_score_last_30d=0.0, complaint_count_90d=0,
                days_to_nearest_renewal=None, payment_regularity_score=1.0, escalation_flag=False, loss_ratio=0.0,
                nps_score_latest=None, lapse_count_historical=0, tenure_months=12, lifetime_value_score=50.0)
    base.update(kw)
    schema = ("customer_id long, missed_payments_12m long, sentiment_score_last_30d double, complaint_count_90d long, "
              "days_to_nearest_renewal long, payment_regularity_score double, escalation_flag boolean, "
              "loss_ratio double, nps_score_latest long, lapse_count_historical long, tenure_months long, "
              "lifetime_value_score double")
    return spark.createDataFrame([tuple(base[k] for k in [f.split()[0] for f in schema.split(", ")])], schema)


def test_propensity_golden(spark):
    cust4 = _c360_row(spark, complaint_count_90d=1, payment_regularity_score=1 / 3, nps_score_latest=5,
                      tenure_months=20, lifetime_value_score=60.0)
    assert c360.churn_propensity(cust4).collect()[0].churn_propensity_score == 0.36
    cust8 = _c360_row(spark, payment_regularity_score=0.5, lapse_count_historical=1, tenure_months=71,
                      lifetime_value_score=95.8)
    r = c360.churn_propensity(cust8).collect()[0]
    assert r.churn_propensity_score == 0.11 and r.churn_time_to_event_days == 180


def test_v1_fraud_composite_golden(spark):
    # no model, empty retrieval/embedding: tenure 0.1 -> 0.085; tenure 0.6 -> 0.135
    df = spark.createDataFrame([(0, 60), (0, 2)], "n long, months long")
    comp = (claims_v1.dup_score(F.col("n")) * 0.15 + claims_v1.tenure_score(F.col("months")) * 0.10
            + F.lit(0.0) * 0.20 + F.lit(0.0) * 0.15 + F.lit(0.3) * 0.25 + F.lit(0.0))
    vals = [r[0] for r in df.select(pyround(comp, 4)).collect()]
    assert vals == [0.085, 0.135]


# ------------------------------------------------------------------ traps
def test_t01_month_and_year_boundaries(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), D(2024, 2, 1))], "a date, b date")
    r = df.select(month_diff(F.col("a"), F.col("b")).alias("m"), year_diff(F.col("a"), F.col("b")).alias("y")).collect()[0]
    assert r.m == 1 and r.y == 0


def test_t02_priority_puts_null_ltv_first(spark):
    c = spark.createDataFrame([(1, 10.0, 0.9, 0.0, 0), (2, None, 0.9, 0.0, 0), (3, 20.0, 0.9, 0.0, 0)],
                              "customer_id long, lifetime_value_score double, churn_propensity_score double, "
                              "sentiment_score_last_30d double, complaint_count_90d long")
    c = c.withColumn("sentiment_trend", F.lit(0.0))
    out = churn.churn_scan(c, churn.empty_alerts(spark), "2024-10-15").orderBy("priority").collect()
    assert [r.customer_id for r in out] == [2, 3, 1]


def test_global_row_number_two_phase_matches_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id"))
    order = [F.col("k").desc(), F.col("id")]
    from pyspark.sql import Window
    a = ranking.global_row_number(df, order, "rn", partitions=7)
    b = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert a.orderBy("rn").collect() == b.orderBy("rn").collect()
    assert a.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).collect()[0] == (1, 5000, 5000)


def test_t05_resolution_days_zero_or_null(spark):
    claims = spark.createDataFrame(
        [(1, "APPROVED", D(2024, 1, 1), dt.datetime(2024, 1, 5), 10.0),
         (1, "SUBMITTED", D(2024, 1, 1), dt.datetime(2024, 1, 6), 10.0)],
        "customer_id long, claim_status string, incident_date date, submission_date timestamp_ntz, "
        "claimed_amount double")
    r = features.agg_claims_history(claims, "2024-10-15").collect()[0]
    assert r.avg_resolution_time_days == 0.0


def test_t07_mode_ties_take_smallest(spark):
    i = spark.createDataFrame([(1, "email", dt.datetime(2024, 1, 1), "RESOLVED", None, 0.0),
                               (1, "call", dt.datetime(2024, 1, 2), "RESOLVED", None, 0.0)],
                              "customer_id long, channel string, interaction_date timestamp_ntz, "
                              "resolution_status string, nps_score long, sentiment double")
    assert features.agg_interaction_signals(i, "2024-02-01").collect()[0].channel_preference == "call"


def test_t12_not_in_with_null_empties_result(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "customer_id long")
    right_null = spark.createDataFrame([(1,), (None,)], "customer_id long")
    right = spark.createDataFrame([(1,)], "customer_id long")
    empty = spark.createDataFrame([], "customer_id long")
    assert ranking.null_aware_anti(left, right_null, "customer_id").count() == 0
    assert [r[0] for r in ranking.null_aware_anti(left, right, "customer_id").collect()] == [2]
    assert ranking.null_aware_anti(left, empty, "customer_id").count() == 3


def _dq_inputs(spark, status):
    claims = spark.createDataFrame(
        [("C1", 10, 100, "AUTO", 50.0, dt.datetime(2024, 10, 1), "SUBMITTED")],
        "claim_id string, customer_id long, policy_id long, lob_type string, claimed_amount double, "
        "submission_date timestamp_ntz, claim_status string")
    customers = spark.createDataFrame([(10,)], "customer_id long")
    policies = spark.createDataFrame([(100, 10, "AUTO", status, 1000.0)],
                                     "policy_id long, customer_id long, lob_type string, policy_status string, "
                                     "coverage_limit double")
    return claims, customers, policies


def test_t17_t18_accept_sets_and_null_status(spark):
    for status, gate_ok, agent_valid in [("ACTIVE", True, True), ("RENEWAL_PENDING", False, True),
                                         (None, True, True), ("LAPSED", False, False)]:
        claims, customers, policies = _dq_inputs(spark, status)
        r = dq.dq_validate_claims(claims, customers, policies, "2024-10-15").collect()[0]
        assert r.passed == gate_ok, status
        v = claims_v2.agent_validation_v2(claims, policies).collect()[0]
        assert v.validation_output.valid == agent_valid, status


def test_t21_rule_order_v2_vs_v1(spark):
    # v2: REFERRED before DENIED
    c = spark.createDataFrame([(100.0,)], "claimed_amount double").select(
        "claimed_amount",
        F.struct(F.lit(0.8).alias("composite_fraud_score"), F.lit("HIGH").alias("risk_level")).alias("fraud_output"),
        F.struct(F.lit(False).alias("valid")).alias("validation_output"),
        F.lit(None).cast("struct<recommended_settlement:double,assessment_confidence:double>").alias(
            "assessment_output"))
    assert claims_v2.agent_resolution_v2(c, "2024-10-15").collect()[0].decision == "REFERRED"


def test_t22_t23_v1_dates_and_negative_payable(spark):
    claims = spark.createDataFrame(
        [("A", 1, 10, "AUTO", 100.0, D(2024, 5, 1), dt.datetime(2024, 5, 2), "SUBMITTED"),
         ("B", 1, 11, "AUTO", 100.0, D(2024, 5, 1), dt.datetime(2024, 5, 2), "SUBMITTED")],
        "claim_id string, customer_id long, policy_id long, lob_type string, claimed_amount double, "
        "incident_date date, submission_date timestamp_ntz, claim_status string")
    policies = spark.createDataFrame(
        [(10, 1, "AUTO", "ACTIVE", D(2024, 1, 1), None, 1000.0, 500.0),       # NULL end: no upper bound
         (11, 1, "AUTO", "ACTIVE", None, D(2025, 1, 1), 1000.0, 500.0)],      # NULL start: outside
        "policy_id long, customer_id long, lob_type string, policy_status string, start_date date, "
        "end_date date, coverage_limit double, deductible double")
    v = {r.claim_id: r for r in claims_v1.agent_validation_v1(claims, policies).collect()}
    assert v["A"].eligible and v["A"].max_payable == -400.0           # may go negative (T22)
    assert not v["B"].eligible


def test_t29_integer_rate_is_double(spark):
    r = spark.createDataFrame([(3, 4)], "a long, b long").select((F.col("a") / F.col("b")).alias("x")).collect()[0]
    assert r.x == 0.75


def test_v1_concurrent_claims_count_every_status(spark):
    # the v1 validation counts other claims of the same customer and incident date in the
    # whole claims table (any status), not only in the SUBMITTED batch
    schema = ("claim_id string, policy_id long, customer_id long, lob_type string, claimed_amount double, "
              "incident_date date, claim_status string")
    claims = spark.createDataFrame([
        ("C1", 1, 7, "AUTO", 100.0, D(2001, 5, 1), "SUBMITTED"),
        ("C2", 1, 7, "AUTO", 100.0, D(2001, 5, 1), "APPROVED"),
        ("C3", 1, 7, "AUTO", 100.0, D(2001, 5, 1), "DENIED"),
        ("C4", 1, 7, "AUTO", 100.0, D(2001, 5, 2), "SUBMITTED")], schema)
    policies = spark.createDataFrame(
        [(1, 7, "AUTO", "ACTIVE", D(2001, 1, 1), D(2002, 1, 1), 1000.0, 500.0)],
        "policy_id long, customer_id long, lob_type string, policy_status string, start_date date, "
        "end_date date, coverage_limit double, deductible double")
    sub = claims.filter(F.col("claim_status") == "SUBMITTED")
    got = {r.claim_id: r.concurrent_claims
           for r in claims_v1.agent_validation_v1(sub, policies, claims).collect()}
    assert got == {"C1": 2, "C4": 0}


def test_hashed_embedding_is_unit_length_and_zero_for_empty_text(spark):
    from claimflow.operators import models
    df = spark.createDataFrame([(1, "storm damage to roof"), (2, None), (3, "!!")], "id long, t string")
    rows = {r.id: r.e for r in models.embed_text(df, "t", dim=16, out="e").collect()}
    assert abs(sum(v * v for v in rows[1]) - 1.0) < 1e-6
    assert rows[2] == [0.0] * 16 and rows[3] == [0.0] * 16

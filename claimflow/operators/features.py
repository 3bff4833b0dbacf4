"""Per-customer feature aggregations.

Each builder is one ``groupBy(customer_id).agg(...)`` over a single fact table:
partial aggregation runs map-side, so the shuffle carries one row per
(customer, map task) regardless of how many facts a customer has. No builder
collects a group's rows into memory except ``policy_ids`` (opt-in, see D01).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.constants import LAPSED_STATUSES, TERMINAL_CLAIM_STATUSES
from claimflow.functions.dates import as_date, as_ts, day_diff, minus_days, minus_months


def count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("long")


def nullif_zero(c: Column) -> Column:
    return F.when(c != 0, c)


# ------------------------------------------------------------------------- D01
def agg_policy_portfolio(policies: DataFrame, as_of, with_policy_ids: bool = False) -> DataFrame:
    """Policy portfolio per customer.

    ``lob_diversity`` counts distinct active LOBs with ``collect_set`` over the
    (small, fixed) LOB domain, which keeps the whole aggregate single-pass
    instead of the Expand plan a ``countDistinct`` would add.
    ``with_policy_ids`` adds the sorted active-id array (grows with a customer's
    policy count); the long form is ``active_policy_ids``.
    """
    today = as_date(as_of)
    active = F.col("policy_status") == "ACTIVE"
    aggs = [
        count_if(active).alias("active_policy_count"),
        F.sum(F.when(active, F.col("premium_annual")).otherwise(F.lit(0.0))).alias("total_annual_premium"),
        F.size(F.collect_set(F.when(active, F.col("lob_type")))).cast("long").alias("lob_diversity"),
        F.min(F.when(active & (F.col("renewal_date") >= today),
                     day_diff(today, F.col("renewal_date")))).alias("days_to_nearest_renewal"),
        (F.sum(F.when(active, F.col("coverage_limit")).otherwise(F.lit(0.0)))
         / nullif_zero(F.sum(F.when(active, F.col("premium_annual")).otherwise(F.lit(0.0))) * 20)
         ).alias("coverage_adequacy_ratio"),
        count_if(F.col("policy_status").isin(*LAPSED_STATUSES)).alias("lapse_count_historical"),
    ]
    if with_policy_ids:
        aggs.append(F.sort_array(F.collect_list(F.when(active, F.col("policy_id")))).alias("policy_ids_array"))
    return policies.groupBy("customer_id").agg(*aggs)


def active_policy_ids(policies: DataFrame) -> DataFrame:
    """Long form of ``policy_ids_array``: one row per (customer, active policy)."""
    return (policies.filter(F.col("policy_status") == "ACTIVE")
            .select("customer_id", "policy_id"))


# ------------------------------------------------------------------------- D02
def agg_claims_history(claims: DataFrame, as_of) -> DataFrame:
    today = as_date(as_of)
    m12 = F.col("incident_date") >= minus_months(today, 12)
    m3 = F.col("incident_date") >= minus_months(today, 3)
    approved = F.col("claim_status") == "APPROVED"
    paid = F.sum(F.when(approved, F.col("claimed_amount")).otherwise(F.lit(0.0)))
    decided_sub = F.when(F.col("claim_status").isin("APPROVED", "DENIED"), F.col("submission_date"))
    return claims.groupBy("customer_id").agg(
        count_if(m12).alias("claim_count_12m"),
        F.count(F.lit(1)).alias("claim_count_lifetime"),
        (count_if(approved) / nullif_zero(F.count(F.lit(1))).cast("double")).alias("claims_approved_ratio"),
        F.avg("claimed_amount").alias("avg_claim_amount"),
        F.max("claimed_amount").alias("max_claim_amount"),
        paid.alias("total_amount_paid"),
        # trap T05: subtracts the submission date from itself -> 0 or NULL
        F.avg(day_diff(F.col("submission_date"), decided_sub)).alias("avg_resolution_time_days"),
        count_if(~F.col("claim_status").isin(*TERMINAL_CLAIM_STATUSES)).alias("open_claims_count"),
        F.lit(0).cast("long").alias("fraud_flag_count"),
        paid.alias("total_claims_paid"),
        (count_if(m3) / nullif_zero(count_if(m12)).cast("double")).alias("claim_acceleration_ratio"),
    )


# ------------------------------------------------------------------------- D03
def agg_payment_behavior(payments: DataFrame, as_of) -> DataFrame:
    today = as_date(as_of)
    return payments.groupBy("customer_id").agg(
        F.avg("days_delayed").alias("payment_delay_avg_days"),
        count_if((F.col("payment_status") == "MISSED")
                 & (F.col("payment_date") >= minus_months(today, 12))).alias("missed_payments_12m"),
        (count_if((F.col("payment_status") == "PAID") & (F.col("days_delayed") <= 5))
         / nullif_zero(F.count(F.lit(1))).cast("double")).alias("payment_regularity_score"),
        day_diff(F.max("payment_date"), today).alias("last_payment_days_ago"),
        F.max(F.when(F.col("payment_method") == "AUTO_DEBIT", True).otherwise(False)).alias("auto_pay_enrolled"),
    )


# ------------------------------------------------------------------------- D04
def agg_interaction_signals(interactions: DataFrame, as_of, score_col: str = "sentiment") -> DataFrame:
    """Interaction signals. The sentiment score is projected once (``score_col``)
    and reused by every conditional average, instead of re-scoring per use."""
    now = as_ts(as_of)
    ts = F.col("interaction_date")
    last30 = ts >= minus_days(now, 30)
    prior = ts.between(minus_days(now, 60), minus_days(now, 30))
    esc = F.col("resolution_status") == "ESCALATED"
    s30 = F.avg(F.when(last30, F.col(score_col)))
    return interactions.groupBy("customer_id").agg(
        s30.alias("sentiment_score_last_30d"),
        (s30 - F.coalesce(F.avg(F.when(prior, F.col(score_col))), F.lit(0.0))).alias("sentiment_trend"),
        count_if(esc & (ts >= minus_days(now, 90))).alias("complaint_count_90d"),
        F.max("nps_score").alias("nps_score_latest"),            # trap T06: MAX, not latest
        F.mode("channel", deterministic=True).alias("channel_preference"),  # T07: smallest on ties
        day_diff(F.max(ts), now).alias("last_interaction_days_ago"),
        F.max(F.when(esc & last30, True).otherwise(False)).alias("escalation_flag"),
    )


# ------------------------------------------------------------------------- D05
def agg_embedding_features(scored_claims: DataFrame, providers: DataFrame,
                           score_col: str = "fraud_sim") -> DataFrame:
    """Max fraud similarity per customer, 3-band cluster, provider anomaly.

    The provider side is reduced to the distinct LOBs that have a risky
    provider before the join (bounded by the LOB domain), so the join cannot
    fan claims out per provider.
    """
    risky_lobs = (providers.filter(F.col("risk_flag") == True)  # noqa: E712
                  .select("lob_type").distinct().withColumn("_risky", F.lit(True)))
    from claimflow.session import bounded_broadcast
    j = scored_claims.join(bounded_broadcast(risky_lobs), "lob_type", "left")
    mx = F.max(score_col)
    return j.groupBy("customer_id").agg(
        mx.alias("fraud_similarity_score"),
        F.when(mx > 0.7, 1).when(mx > 0.4, 2).otherwise(3).cast("long").alias("claim_cluster_id"),
        F.max(F.when(F.col("_risky") == True, F.lit(0.8)).otherwise(F.lit(0.0))).alias("provider_anomaly_score"),  # noqa: E712
    )

"""Customer 360 builds (J01-J04) and churn propensity.

The three builds differ on purpose in the source; they are kept as separate
functions (see the survey's comparison table). Every feature view is a
``groupBy(customer_id)`` and all of them are left-joined to customers on the
same key: with AQE each side is one exchange on ``customer_id`` and the joins
are sort-merge on co-partitioned inputs (or broadcast when AQE measures a side
as small).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions.dates import as_date, month_diff, year_diff
from claimflow.operators.features import (agg_claims_history, agg_embedding_features,
                                          agg_interaction_signals, agg_payment_behavior,
                                          agg_policy_portfolio)


def _c(name: str, default) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def _joined(customers: DataFrame, views: dict[str, DataFrame]) -> DataFrame:
    out = customers
    for v in views.values():
        out = out.join(v, "customer_id", "left")
    return out


def _sent30() -> Column:
    return F.coalesce(F.col("sentiment_score_last_30d"), F.lit(0.0))


def build_c360_full(customers: DataFrame, policies: DataFrame, claims: DataFrame, payments: DataFrame,
                    interactions: DataFrame, scored_claims: DataFrame | None, providers: DataFrame | None,
                    as_of, interactions_as_of=None, ltv_threshold: float = 0.7,
                    with_policy_ids: bool = False) -> DataFrame:
    """The procedure build (five views incl. embedding features)."""
    today = as_date(as_of)
    views = {
        "pp": agg_policy_portfolio(policies, as_of, with_policy_ids),
        "ch": agg_claims_history(claims, as_of),
        "pay": agg_payment_behavior(payments, as_of),
        "ints": agg_interaction_signals(interactions, interactions_as_of or as_of),
    }
    if scored_claims is not None:
        views["emb"] = agg_embedding_features(scored_claims, providers)
    j = _joined(customers.select("customer_id", "customer_segment", "lifetime_value_score", "onboarding_date"), views)
    emb = scored_claims is not None
    cols = [
        "customer_id", "customer_segment", "lifetime_value_score",
        month_diff(F.col("onboarding_date"), today).alias("tenure_months"),
        _c("active_policy_count", 0).alias("active_policy_count"),
        _c("total_annual_premium", 0.0).alias("total_annual_premium"),
        _c("lob_diversity", 0).alias("lob_diversity"),
        "days_to_nearest_renewal",
        _c("coverage_adequacy_ratio", 0.0).alias("coverage_adequacy_ratio"),
        _c("lapse_count_historical", 0).alias("lapse_count_historical"),
    ]
    if with_policy_ids:
        cols.append("policy_ids_array")
    cols += [
        _c("claim_count_12m", 0).alias("claim_count_12m"),
        _c("claim_count_lifetime", 0).alias("claim_count_lifetime"),
        _c("claims_approved_ratio", 0.0).alias("claims_approved_ratio"),
        _c("avg_claim_amount", 0.0).alias("avg_claim_amount"),
        _c("max_claim_amount", 0.0).alias("max_claim_amount"),
        _c("total_amount_paid", 0.0).alias("total_amount_paid"),
        "avg_resolution_time_days",
        _c("open_claims_count", 0).alias("open_claims_count"),
        _c("fraud_flag_count", 0).alias("fraud_flag_count"),
        # NULL when there is premium but no claims row (no coalesce in the source)
        F.when(F.col("total_annual_premium") > 0, F.col("total_claims_paid") / F.col("total_annual_premium"))
         .otherwise(F.lit(0.0)).alias("loss_ratio"),
        _c("claim_acceleration_ratio", 0.0).alias("claim_acceleration_ratio"),
        _c("payment_delay_avg_days", 0.0).alias("payment_delay_avg_days"),
        _c("missed_payments_12m", 0).alias("missed_payments_12m"),
        _c("payment_regularity_score", 1.0).alias("payment_regularity_score"),
        _c("last_payment_days_ago", 0).alias("last_payment_days_ago"),
        _c("auto_pay_enrolled", False).alias("auto_pay_enrolled"),
        _sent30().alias("sentiment_score_last_30d"),
        _c("sentiment_trend", 0.0).alias("sentiment_trend"),
        F.lit(0.0).alias("frustration_level"),
        _c("escalation_flag", False).alias("escalation_flag"),
        _c("complaint_count_90d", 0).alias("complaint_count_90d"),
        "nps_score_latest",
        F.lit(False).alias("intent_cancel_detected"),
        F.lit(0).cast("long").alias("competitor_mentions_count"),
        "channel_preference",
        _c("last_interaction_days_ago", 999).alias("last_interaction_days_ago"),
        F.lit(0.0).alias("digital_engagement_trend"),
        F.lit(False).alias("emotional_manipulation_flag"),
        F.lit(0.0).alias("inconsistency_score"),
        F.lit(0.0).alias("vagueness_score"),
        (_c("fraud_similarity_score", 0.0) if emb else F.lit(0.0)).alias("fraud_similarity_score"),
        (_c("claim_cluster_id", 3) if emb else F.lit(3).cast("long")).alias("claim_cluster_id"),
        (_c("provider_anomaly_score", 0.0) if emb else F.lit(0.0)).alias("provider_anomaly_score"),
        # nullable on purpose
        ((F.col("days_to_nearest_renewal") < 60) & (_sent30() < -0.2)).alias("renewal_risk_signal"),
        F.when(F.col("claim_count_lifetime") > 0,
               _c("complaint_count_90d", 0).cast("double") / F.col("claim_count_lifetime"))
         .otherwise(F.lit(0.0)).alias("complaint_rate_per_claim"),
        F.when(F.col("total_annual_premium") > 0,
               F.col("total_claims_paid") / (F.col("total_annual_premium")
                                             * F.greatest(year_diff(F.col("onboarding_date"), today), F.lit(1))))
         .otherwise(F.lit(0.0)).alias("lifetime_loss_ratio"),
        ((F.col("lifetime_value_score") > ltv_threshold) & (_sent30() < -0.2)).alias("high_value_at_risk"),
        F.lit(0.5).alias("geographic_risk_score"),
    ]
    return j.select(*cols)


def build_c360_bootstrap(customers: DataFrame, policies: DataFrame, claims: DataFrame, payments: DataFrame,
                         interactions: DataFrame, as_of, interactions_as_of=None,
                         with_policy_ids: bool = False) -> DataFrame:
    """The bootstrap build (no embedding view; ``loss_ratio`` coalesced)."""
    today = as_date(as_of)
    views = {
        "pp": agg_policy_portfolio(policies, as_of, with_policy_ids),
        "ch": agg_claims_history(claims, as_of),
        "pay": agg_payment_behavior(payments, as_of),
        "ints": agg_interaction_signals(interactions, interactions_as_of or as_of),
    }
    j = _joined(customers.select("customer_id", "customer_segment", "lifetime_value_score", "onboarding_date"), views)
    cols = [
        "customer_id", "customer_segment", "lifetime_value_score",
        month_diff(F.col("onboarding_date"), today).alias("tenure_months"),
        _c("active_policy_count", 0).alias("active_policy_count"),
        _c("total_annual_premium", 0.0).alias("total_annual_premium"),
        _c("lob_diversity", 0).alias("lob_diversity"),
        "days_to_nearest_renewal",
        _c("coverage_adequacy_ratio", 0.0).alias("coverage_adequacy_ratio"),
        _c("lapse_count_historical", 0).alias("lapse_count_historical"),
    ]
    if with_policy_ids:
        cols.append("policy_ids_array")
    cols += [
        _c("claim_count_12m", 0).alias("claim_count_12m"),
        _c("claim_count_lifetime", 0).alias("claim_count_lifetime"),
        _c("claims_approved_ratio", 0.0).alias("claims_approved_ratio"),
        _c("avg_claim_amount", 0.0).alias("avg_claim_amount"),
        _c("max_claim_amount", 0.0).alias("max_claim_amount"),
        _c("total_amount_paid", 0.0).alias("total_amount_paid"),
        "avg_resolution_time_days",
        _c("open_claims_count", 0).alias("open_claims_count"),
        _c("fraud_flag_count", 0).alias("fraud_flag_count"),
        F.when(F.col("total_annual_premium") > 0,
               _c("total_claims_paid", 0.0) / F.col("total_annual_premium")).otherwise(F.lit(0.0)).alias("loss_ratio"),
        _c("claim_acceleration_ratio", 0.0).alias("claim_acceleration_ratio"),
        _c("payment_delay_avg_days", 0.0).alias("payment_delay_avg_days"),
        _c("missed_payments_12m", 0).alias("missed_payments_12m"),
        _c("payment_regularity_score", 1.0).alias("payment_regularity_score"),
        _c("last_payment_days_ago", 0).alias("last_payment_days_ago"),
        _c("auto_pay_enrolled", False).alias("auto_pay_enrolled"),
        _sent30().alias("sentiment_score_last_30d"),
        _c("sentiment_trend", 0.0).alias("sentiment_trend"),
        _c("escalation_flag", False).alias("escalation_flag"),
        _c("complaint_count_90d", 0).alias("complaint_count_90d"),
        "nps_score_latest",
        "channel_preference",
        _c("last_interaction_days_ago", 999).alias("last_interaction_days_ago"),
    ]
    return j.select(*cols)


def build_c360_dynamic(customers: DataFrame, policies: DataFrame, claims: DataFrame, payments: DataFrame,
                       interactions: DataFrame, as_of, interactions_as_of=None,
                       high_value_segment: str = "HNW") -> DataFrame:
    """The auto-refreshed build (different defaults and thresholds)."""
    today = as_date(as_of)
    views = {
        "pp": agg_policy_portfolio(policies, as_of),
        "ch": agg_claims_history(claims, as_of),
        "pay": agg_payment_behavior(payments, as_of),
        "ints": agg_interaction_signals(interactions, interactions_as_of or as_of),
    }
    j = _joined(customers.select("customer_id", "customer_segment", "lifetime_value_score", "onboarding_date"), views)
    return j.select(
        "customer_id", "customer_segment", "lifetime_value_score",
        month_diff(F.col("onboarding_date"), today).alias("tenure_months"),
        _c("active_policy_count", 0).alias("active_policy_count"),
        _c("total_annual_premium", 0.0).alias("total_annual_premium"),
        _c("lob_diversity", 0).alias("lob_diversity"),
        "days_to_nearest_renewal",
        _c("coverage_adequacy_ratio", 0.0).alias("coverage_adequacy_ratio"),
        _c("lapse_count_historical", 0).alias("lapse_count_historical"),
        _c("claim_count_12m", 0).alias("claim_count_12m"),
        _c("claim_count_lifetime", 0).alias("claim_count_lifetime"),
        _c("claims_approved_ratio", 0.0).alias("claims_approved_ratio"),
        _c("avg_claim_amount", 0.0).alias("avg_claim_amount"),
        _c("max_claim_amount", 0.0).alias("max_claim_amount"),
        _c("total_amount_paid", 0.0).alias("total_amount_paid"),
        _c("open_claims_count", 0).alias("open_claims_count"),
        _c("claim_acceleration_ratio", 0.0).alias("claim_acceleration_ratio"),
        _c("payment_delay_avg_days", 0.0).alias("payment_delay_avg_days"),
        _c("missed_payments_12m", 0).alias("missed_payments_12m"),
        _c("payment_regularity_score", 0.0).alias("payment_regularity_score"),
        _c("last_payment_days_ago", 0).alias("last_payment_days_ago"),
        _c("auto_pay_enrolled", False).alias("auto_pay_enrolled"),
        _sent30().alias("sentiment_score_last_30d"),
        _c("sentiment_trend", 0.0).alias("sentiment_trend"),
        _c("complaint_count_90d", 0).alias("complaint_count_90d"),
        "nps_score_latest",
        "channel_preference",
        _c("last_interaction_days_ago", 0).alias("last_interaction_days_ago"),
        _c("escalation_flag", False).alias("escalation_flag"),
        F.when((F.col("days_to_nearest_renewal") <= 30) & (_sent30() < -0.3), True)
         .otherwise(False).alias("renewal_risk_signal"),
        # trap T29: integer operands; Spark gives a double
        F.when(F.col("claim_count_lifetime") > 0,
               _c("complaint_count_90d", 0) / F.col("claim_count_lifetime")).otherwise(F.lit(0.0))
         .cast("double").alias("complaint_rate_per_claim"),
        F.when(_c("total_annual_premium", 0.0) > 0,
               _c("total_amount_paid", 0.0) / (F.col("total_annual_premium")
                                              * F.greatest(year_diff(F.col("onboarding_date"), today), F.lit(1))))
         .otherwise(F.lit(0.0)).alias("lifetime_loss_ratio"),
        F.when((F.col("customer_segment") == high_value_segment) & (_sent30() < -0.2), True)
         .otherwise(False).alias("high_value_at_risk"),
    )


def churn_propensity(c360: DataFrame, ltv_high: float = 80.0) -> DataFrame:
    """Additive signal ladders, clamped to [0, 1], 2 dp; time-to-event default 180."""
    def ladder(pairs, otherwise=0.0):
        out = None
        for cond, v in pairs:
            out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
        return out.otherwise(F.lit(otherwise))

    col = F.col
    renewal = col("days_to_nearest_renewal")
    nps = col("nps_score_latest")
    s = (ladder([(col("missed_payments_12m") >= 3, 0.3), (col("missed_payments_12m") >= 1, 0.15)])
         + ladder([(col("sentiment_score_last_30d") < -0.5, 0.25), (col("sentiment_score_last_30d") < -0.2, 0.15),
                   (col("sentiment_score_last_30d") < 0, 0.05)])
         + ladder([(col("complaint_count_90d") >= 5, 0.2), (col("complaint_count_90d") >= 3, 0.15),
                   (col("complaint_count_90d") >= 1, 0.05)])
         + ladder([(renewal.isNotNull() & (renewal <= 30), 0.15), (renewal.isNotNull() & (renewal <= 60), 0.08)])
         + ladder([(col("payment_regularity_score") < 0.5, 0.15), (col("payment_regularity_score") < 0.7, 0.08)])
         + ladder([(col("escalation_flag") == True, 0.1)])  # noqa: E712
         + ladder([(col("loss_ratio") > 2.0, 0.1), (col("loss_ratio") > 1.0, 0.05)])
         + ladder([(nps.isNotNull() & (nps <= 3), 0.15), (nps.isNotNull() & (nps <= 5), 0.08)])
         + ladder([(col("lapse_count_historical") > 0, 0.1)])
         - ladder([(col("tenure_months") > 60, 0.1), (col("tenure_months") > 36, 0.05)])
         - ladder([(col("lifetime_value_score") > ltv_high, 0.05)])
         + F.lit(0.08))
    return c360.withColumns({
        "churn_propensity_score": F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), s)), 2),
        "churn_time_to_event_days": F.coalesce(renewal, F.lit(180)).cast("long")})

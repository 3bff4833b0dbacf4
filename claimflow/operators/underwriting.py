"""Underwriting (I01-I05): credit tier, actuarial risk score, guideline lookup, decision.

The actuarial table is a small reference table: it is broadcast behind a row
count check and joined on (lob, tier) with the zone ``LIKE`` as a residual
predicate; ``min_by(table_id)`` keeps one match per application (the source's
unordered ``LIMIT 1``, made deterministic, trap T19).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.constants import ACTUARIAL_DEFAULTS, UW_RATIONALE
from claimflow.functions.dates import as_ts
from claimflow.session import bounded_broadcast


def risk_tier(credit: Column) -> Column:
    """>= 750 LOW, >= 650 MEDIUM, else HIGH (NULL included)."""
    return F.when(credit >= 750, "LOW").when(credit >= 650, "MEDIUM").otherwise("HIGH")


def actuarial_lookup(apps: DataFrame, actuarial: DataFrame) -> DataFrame:
    """First actuarial row (by table_id) with equal LOB and tier whose zone
    contains the first 7 characters of the application's zone; NULL if none."""
    act = bounded_broadcast(actuarial.select(
        F.col("table_id").alias("_t_id"), F.col("lob_type").alias("_t_lob"), F.col("risk_tier").alias("_t_tier"),
        F.col("geographic_zone").alias("_t_zone"), "base_rate", "risk_multiplier", "geographic_factor",
        "claims_history_factor"))
    cond = ((F.col("lob_type") == F.col("_t_lob")) & (F.col("risk_tier") == F.col("_t_tier"))
            & F.expr("_t_zone LIKE concat('%', left(geographic_zone, 7), '%')"))
    j = apps.select("application_id", "lob_type", "risk_tier", "geographic_zone").join(act, cond, "inner")
    best = F.min_by(F.struct("base_rate", "risk_multiplier", "geographic_factor", "claims_history_factor", "_t_id"),
                    F.col("_t_id"))
    return j.groupBy("application_id").agg(best.alias("_m")).select(
        "application_id", F.col("_m._t_id").alias("actuarial_table_id"), "_m.base_rate", "_m.risk_multiplier",
        "_m.geographic_factor", "_m.claims_history_factor")


def uw_risk_score(apps: DataFrame, actuarial: DataFrame) -> DataFrame:
    """Defaults when unmatched; x0.9 history for an existing customer id;
    score = product (6 dp), premium = coverage x score (0 dp)."""
    a = apps.withColumn("risk_tier", risk_tier(F.col("credit_score")))
    j = a.join(actuarial_lookup(a, actuarial), "application_id", "left")
    matched = F.col("base_rate").isNotNull()
    d = ACTUARIAL_DEFAULTS
    base = F.when(matched, F.col("base_rate")).otherwise(F.lit(d["base_rate"]))
    mult = F.when(matched, F.col("risk_multiplier")).otherwise(F.lit(d["risk_multiplier"]))
    geo = F.when(matched, F.col("geographic_factor")).otherwise(F.lit(d["geographic_factor"]))
    hist = F.when(matched, F.col("claims_history_factor")).otherwise(F.lit(d["claims_history_factor"]))
    existing = F.col("existing_customer_id").isNotNull() & (F.col("existing_customer_id") != "")
    hist = F.when(existing, hist * 0.9).otherwise(hist)
    score = base * mult * geo * hist
    return j.select(
        "application_id", "lob_type", "existing_customer_id", "coverage_requested", "credit_score",
        "geographic_zone", "risk_tier", "actuarial_table_id",
        base.alias("base_rate"), mult.alias("risk_multiplier"), geo.alias("geographic_factor"),
        hist.alias("history_factor"),
        F.round(score, 6).alias("composite_score"),
        F.round(F.col("coverage_requested") * score, 0).alias("recommended_premium"))


def guideline_query(scored: DataFrame) -> DataFrame:
    """The search text '<LOB> <tier> underwriting risk assessment' per application."""
    return scored.select(F.col("application_id").alias("query_id"),
                         F.concat_ws(" ", "lob_type", "risk_tier", F.lit("underwriting risk assessment")).alias("query"))


def uw_guidelines(scored: DataFrame, corpus: DataFrame, text_col: str, id_col: str, k: int = 3) -> DataFrame:
    """Top-``k`` guideline passages per application (no LOB filter), via G11. Applications of one LOB
    and tier ask the same words, so each distinct text is searched once and joined back."""
    from claimflow.operators.search import search
    asked = guideline_query(scored)
    once = asked.select(F.col("query").alias("query_id"), "query").distinct()
    found = search(corpus, once, text_col=text_col, doc_id=id_col, k=k).withColumnRenamed("query_id", "query")
    return asked.join(found, "query").select("query_id", "rank", "doc_id", "score")


def uw_decide(scored: DataFrame, as_of) -> DataFrame:
    """LOW auto-approve .95; MEDIUM review .7; HIGH senior review .5 with the
    (already rounded) premium x 1.5 (T20). Adds decision and new application status."""
    tier = F.col("risk_tier")
    auto = tier == "LOW"
    premium = F.when(tier.isin("LOW", "MEDIUM"), F.col("recommended_premium")) \
               .otherwise(F.col("recommended_premium") * 1.5)
    rationale = (F.when(auto, UW_RATIONALE["LOW"]).when(tier == "MEDIUM", UW_RATIONALE["MEDIUM"])
                 .otherwise(UW_RATIONALE["HIGH"]))
    return scored.select(
        F.sha2(F.concat_ws("|", F.col("application_id").cast("string"), as_ts(as_of).cast("string")), 256)
         .alias("decision_id"),
        "application_id", F.col("existing_customer_id").alias("customer_id"), "lob_type", "risk_tier",
        F.when(auto, 0.95).when(tier == "MEDIUM", 0.7).otherwise(0.5).alias("confidence"),
        premium.alias("recommended_premium"), auto.alias("auto_approved"), rationale.alias("rationale"),
        F.when(auto, "APPROVED").otherwise("REVIEW").alias("application_status"),
        as_ts(as_of).alias("decided_at"))


def run_underwriting(apps: DataFrame, actuarial: DataFrame, as_of, cap: int | None = None,
                     guidelines: DataFrame | None = None):
    """PENDING applications (oldest first, optional cap) -> score -> guideline look-up (if ``guidelines``
    (guideline_id, content) are given) -> decide. Returns ``(decisions, applications_after, audit)``; with
    guidelines the decisions name the passages found, and the audit says that a search ran."""
    from claimflow.operators.writes import audit_rows, update_from
    pend = apps.filter(F.col("status") == "PENDING")
    if cap is not None:
        pend = pend.orderBy(F.col("submission_date").asc_nulls_last(), "application_id").limit(cap)
    scored = uw_risk_score(pend, actuarial)
    decisions = uw_decide(scored, as_of)
    if guidelines is not None:
        from claimflow.operators.claims_v2 import with_retrieval
        asked = F.concat_ws(" ", "lob_type", "risk_tier", F.lit("underwriting risk assessment"))
        decisions = with_retrieval(decisions, guidelines, "content", "guideline_id", asked, "guideline_ids")
    after = update_from(apps, decisions.select("application_id", "application_status"), ["application_id"],
                        {"status": "application_status"})
    audit = audit_rows(decisions.select(F.col("application_id").alias("reference_id")), "UNDERWRITING",
                       "UW_DECISION", 3, as_of, module="SQL" if guidelines is None else "SQL+SEARCH")
    return decisions, after, audit

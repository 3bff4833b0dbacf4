"""Claims agents, generation 1 (H12-H20): richer deterministic sub-scores.

All per-claim lookups of the source become joins against pre-aggregated
tables: active-LOB counts per customer (D17), claims per (customer, incident
date) (C11), and the 90-day duplicate count (C09) computed as a range window
over *per-day counts* — a customer/policy with millions of claims still has
at most one row per distinct day in the window, so no task holds a hot
group's raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.constants import SEVERITY_WEIGHT, V1_REASONS
from claimflow.functions import extract
from claimflow.functions.dates import as_date, month_diff
from claimflow.functions.numeric import pyround
from claimflow.functions.text import cut, sentiment as text_sentiment, tokens as text_tokens
from claimflow.operators.dq import UNKNOWN_POLICY_IDS
from claimflow.session import bounded_broadcast, left_lookup


INTAKE_V1_SCHEMA = ("claimant_name string, policy_number string, incident_date string, incident_location string, "
                    "lob_classification string, lob_confidence double, claimed_amount double, "
                    "damage_description string, urgency_level string, multi_lob_indicator boolean, "
                    "estimated_severity string")


def intake_prompt_v1(claims: DataFrame, n_chars: int | None = None) -> Column:
    """The v1 extraction prompt: the claim text (``n_chars`` cuts it) plus the keys
    (missing values print as empty text, as the source's ``str(x or '')`` does)."""
    def txt(c: str) -> Column:
        col = F.col(c) if c in claims.columns else F.lit(None)
        return F.coalesce(col.cast("string"), F.lit(""))
    return F.concat(
        F.lit("Read the claim below and name what it says.\nText: "), cut(F.coalesce("claim_text", F.lit("")), n_chars),
        F.lit("\nPolicy: "), txt("policy_id"), F.lit("\nCustomer: "), txt("customer_id"),
        F.lit("\nDate: "), txt("incident_date"), F.lit("\nAmount: "), txt("claimed_amount"),
        F.lit("\nAnswer with one JSON object."))


def agent_intake_v1(claims: DataFrame, model=None, facts: Column | None = None) -> DataFrame:
    """Entity extraction through an injected completion model (one call per Arrow
    batch; the reply may be fenced) or, without one, by ``facts`` (``extract.claim_facts``: a native
    grammar over the text). A missing or unparsable reply, and a claim without a text, fall back to the
    claim's own LOB (or UNKNOWN) with confidence 0.5 and ``parse_error``."""
    from claimflow.functions.text import parse_model_reply
    from claimflow.operators.models import complete
    c = claims if "claim_text" in claims.columns else claims.withColumn("claim_text", F.lit(None).cast("string"))
    if model is None and facts is not None:
        out = c.withColumn("_ex", facts)
        parsed = F.col("_ex").isNotNull()
    else:
        c = complete(c.withColumn("_prompt", intake_prompt_v1(c)), "_prompt", model, out="_reply")
        ex = parse_model_reply(F.col("_reply"), INTAKE_V1_SCHEMA)
        parsed = F.col("_reply").isNotNull() & ex.isNotNull()
        out = c.withColumn("_ex", F.when(parsed, ex))
    return (out.withColumn("parse_error", ~F.coalesce(parsed, F.lit(False)))
               .withColumn("lob_classification",
                           F.when(F.col("parse_error"), F.coalesce(F.col("lob_type"), F.lit("UNKNOWN")))
                           .otherwise(F.coalesce(F.col("_ex.lob_classification"), F.col("lob_type"))))
               .withColumn("confidence_score",
                           F.when(F.col("parse_error"), F.lit(0.5))
                           .otherwise(F.coalesce(F.col("_ex.lob_confidence"), F.lit(0.0))))
               .withColumn("urgency_level", F.coalesce(F.col("_ex.urgency_level"), F.lit("MEDIUM")))
               .withColumn("multi_lob_indicator", F.coalesce(F.col("_ex.multi_lob_indicator"), F.lit(False)))
               .withColumn("current_state", F.lit("INTAKE_COMPLETE"))
               .drop("_prompt", "_reply"))


def multi_lob_count(policies: DataFrame) -> DataFrame:
    """Distinct active LOBs per customer (LOB domain is small: collect_set)."""
    return (policies.filter(F.col("policy_status") == "ACTIVE").groupBy("customer_id")
            .agg(F.size(F.collect_set("lob_type")).cast("long").alias("multi_lob_count")))


def claim_day_counts(claims: DataFrame) -> DataFrame:
    """Claims per (customer, policy, incident day) — one pre-aggregate (map-side partial
    counts) that both same-day (C11) and 90-day duplicate (C09) counts are derived
    from, so the claims table is scanned and shuffled once for both. ``policy_id``
    may be NULL here; it is deliberately not filtered (a filter on a grouping key is
    pushed under the aggregate and the two uses would no longer share the exchange)."""
    return (claims.filter(F.col("customer_id").isNotNull() & F.col("incident_date").isNotNull())
            .groupBy("customer_id", "policy_id", "incident_date").agg(F.count(F.lit(1)).alias("_n")))


def same_day_counts(claims: DataFrame) -> DataFrame:
    """C11: claims per (customer, incident date)."""
    return (claim_day_counts(claims).groupBy("customer_id", "incident_date")
            .agg(F.sum("_n").cast("long").alias("same_day_claims")))


def duplicate_counts_90d(claims: DataFrame, days: int = 90) -> DataFrame:
    """Per (customer, policy, incident date), the number of claims of the same
    customer and policy whose incident is within +-``days`` days (self included).
    The range window runs over per-day counts, never over raw claims. Rows with a
    NULL policy form their own window group and never match an equi-join back."""
    per_day = claim_day_counts(claims).withColumn(
        "_day", F.datediff(F.col("incident_date"), F.lit("1970-01-01").cast("date")))
    w = Window.partitionBy("customer_id", "policy_id").orderBy("_day").rangeBetween(-days, days)
    return per_day.select("customer_id", "policy_id", "incident_date",
                          F.sum("_n").over(w).cast("long").alias("_within"))


def agent_validation_v1(claims: DataFrame, policies: DataFrame, all_claims: DataFrame | None = None,
                        keep_same_day: bool = False) -> DataFrame:
    """STATUS / DATES / LOB hard checks, LIMIT soft; max payable; multi-LOB; concurrency.
    Concurrent claims are the *other* claims of the same customer and incident date in
    ``all_claims`` (the whole claims table; default ``claims``), whatever their status."""
    p = policies.select(F.col("policy_id").alias("_p_id"), F.col("policy_status").alias("_p_status"),
                        F.col("start_date").alias("_p_start"), F.col("end_date").alias("_p_end"),
                        F.col("lob_type").alias("_p_lob"), F.col("coverage_limit").alias("_p_limit"),
                        F.col("deductible").alias("_p_ded"))
    j = left_lookup(claims, p.withColumn("policy_id", F.col("_p_id")), "policy_id", UNKNOWN_POLICY_IDS)
    j = left_lookup(j, multi_lob_count(policies), "customer_id")
    j = j.join(same_day_counts(all_claims if all_claims is not None else claims),
               ["customer_id", "incident_date"], "left")
    found = F.col("_p_id").isNotNull()
    status_ok = F.coalesce(F.col("_p_status") == "ACTIVE", F.lit(False))
    inc = F.col("incident_date")
    # NULL incident or NULL start -> outside; NULL end -> no upper bound
    dates_ok = (inc.isNotNull() & F.col("_p_start").isNotNull() & (inc >= F.col("_p_start"))
                & (F.col("_p_end").isNull() | (inc <= F.col("_p_end"))))
    lob = F.col("lob_type")
    lob_ok = lob.isNull() | (lob == "") | F.col("_p_lob").eqNullSafe(lob)
    claimed = F.coalesce(F.col("claimed_amount"), F.lit(0.0))
    limit = F.coalesce(F.col("_p_limit"), F.lit(0.0))
    ded = F.coalesce(F.col("_p_ded"), F.lit(0.0))
    eligible = found & status_ok & F.coalesce(dates_ok, F.lit(False)) & lob_ok
    checks = F.array(
        F.struct(F.lit("STATUS").alias("check"), status_ok.alias("passed")),
        F.struct(F.lit("DATES").alias("check"), F.coalesce(dates_ok, F.lit(False)).alias("passed")),
        F.struct(F.lit("LOB").alias("check"), lob_ok.alias("passed")),
        F.struct(F.lit("LIMIT").alias("check"), (claimed <= limit).alias("passed")))
    concurrent = F.coalesce(F.col("same_day_claims"), F.lit(1)) - 1
    out = j.select(
        *claims.columns,
        eligible.alias("eligible"),
        F.when(found, F.lit(None)).otherwise(F.lit("POLICY_NOT_FOUND")).cast("string").alias("ineligible_reason"),
        F.when(found, limit).otherwise(F.lit(0.0)).alias("coverage_limit"),
        F.when(found, ded).otherwise(F.lit(0.0)).alias("deductible"),
        F.when(eligible, F.least(claimed, limit) - ded).otherwise(F.lit(0.0)).alias("max_payable"),
        F.when(found, checks).alias("checks"),
        F.when(found, F.coalesce(F.col("multi_lob_count"), F.lit(0))).cast("long").alias("multi_lob_count"),
        F.when(found, concurrent).cast("long").alias("concurrent_claims"),
        *([F.col("same_day_claims").alias("_sameday")] if keep_same_day else []),
    )
    return out


def dup_score(n: Column) -> Column:
    """min(0.3 * n, 0.9)."""
    return F.least(n * 0.3, F.lit(0.9))


def tenure_score(months: Column) -> Column:
    """< 6 months 0.6, < 12 months 0.3, else 0.1."""
    return F.when(months < 6, 0.6).when(months < 12, 0.3).otherwise(0.1)


def rag_score(matches: DataFrame, key: str = "claim_id") -> DataFrame:
    """Max over retrieved patterns of (1 - 0.25 * rank0) * severity weight.
    ``matches`` has ``key``, ``rank`` (1-based) and ``severity``."""
    w = F.create_map(*[x for k, v in SEVERITY_WEIGHT.items() for x in (F.lit(k), F.lit(v))])
    sev = F.coalesce(w[F.col("severity")], F.lit(0.3))
    return matches.groupBy(key).agg(F.max((F.lit(1.0) - (F.col("rank") - 1) * 0.25) * sev).alias("rag_score"))


def with_signals(claims: DataFrame, vectors: DataFrame | None = None, patterns: DataFrame | None = None,
                 pattern_text: str = "example_narrative", pattern_id: str = "pattern_id", vector_key: str = "statement_vector_id",
                 k: int = 3) -> DataFrame:
    """H15 and H16's inputs as columns of the claims: ``embed_score`` (similarity of the claim's stored vector,
    ``vectors``: one ``vector_score`` a ``vector_key``), ``rag_score`` (from the ``k`` patterns that a search for the text's key
    words ranks first), ``narrative_score`` (0.3 without a text) and ``sentiment`` (0 without one).

    Claims with the same key words ask the same query, so each distinct query is searched once and its score
    joined back: the pairs of the search grow with patterns and distinct queries, not with claims."""
    from claimflow.operators.search import search
    from claimflow.session import cut_lineage
    text, toks = F.col("claim_text"), F.col("_toks")
    # a projection of their own: what several scores read is taken from the text once
    read = claims.withColumns({"_toks": text_tokens(text), "_date": extract.stated_date(text), "_amount": extract.stated_amount(text)})
    out = read.withColumns({
        "narrative_score": F.coalesce(extract.narrative_risk(text, F.col("incident_date"), F.col("claimed_amount"), toks,
                                                             F.col("_date"), F.col("_amount")), F.lit(0.3)),
        "sentiment": F.coalesce(text_sentiment(text, toks), F.lit(0.0)),
        "_asked": extract.search_words(text, toks)}).drop("_toks", "_date", "_amount")
    if vectors is not None:
        out = left_lookup(out, vectors.select(vector_key, F.col("vector_score").alias("_near")), vector_key)
        # 6 places: the noise of float products decides no band
        out = out.withColumn("embed_score", F.coalesce(F.round("_near", 6), F.lit(0.0))).drop("_near")
    else:
        out = out.withColumn("embed_score", F.lit(0.0))
    if patterns is None:
        return out.withColumn("rag_score", F.lit(0.0)).drop("_asked")
    once = claims.select(extract.search_words(text).alias("query_id")).distinct().select("query_id", F.col("query_id").alias("query"))
    once = cut_lineage(once.where("query != ''"))  # few rows: the claims' texts are not read again by each step of the search
    found = search(patterns, once, text_col=pattern_text, doc_id=pattern_id, k=k, return_cols=["severity"])
    ranked = rag_score(found.withColumnRenamed("query_id", "_asked"), "_asked").withColumnRenamed("rag_score", "_rag")
    out = out.join(bounded_broadcast(ranked), "_asked", "left")
    return out.withColumn("rag_score", F.coalesce("_rag", F.lit(0.0))).drop("_asked", "_rag")


def agent_fraud_v1(validated: DataFrame, claims: DataFrame, customers: DataFrame, as_of,
                   embed_score: Column | None = None, rag: DataFrame | None = None,
                   narrative_score: Column | None = None, sentiment: Column | None = None) -> DataFrame:
    """Weighted composite of six sub-scores, clamped to [0, 1], 4 dp;
    >0.75 HIGH/REFER_TO_SIU, >0.45 MEDIUM/FLAG_FOR_REVIEW, else LOW/PASS.
    Inputs are those of ``with_signals`` where the claims carry them, or columns passed here.
    Defaults (no model, empty retrieval): embed 0, rag 0, narrative 0.3, sentiment 0."""
    d = duplicate_counts_90d(claims)
    j = validated.join(d, ["customer_id", "policy_id", "incident_date"], "left")
    if "_onb" not in j.columns:            # not pre-joined by process_claims_v1
        j = left_lookup(j, customers.select("customer_id", F.col("onboarding_date").alias("_onb")), "customer_id")

    def given(passed: Column | None, name: str, default: float) -> Column:
        return passed if passed is not None else F.col(name) if name in validated.columns else F.lit(default)

    embed_score, narrative_score = given(embed_score, "embed_score", 0.0), given(narrative_score, "narrative_score", 0.3)
    sentiment = given(sentiment, "sentiment", 0.0)
    if rag is not None:
        j = j.join(rag, "claim_id", "left")
    n_dup = F.coalesce(F.col("_within") - 1, F.lit(0))
    months = F.coalesce(month_diff(F.col("_onb"), as_date(as_of)), F.lit(0))
    s_dup, s_ten = dup_score(n_dup), tenure_score(months)
    s_rag = F.coalesce(F.col("rag_score"), F.lit(0.0)) if "rag_score" in j.columns else F.lit(0.0)
    comp = (s_dup * 0.15 + s_ten * 0.10 + embed_score * 0.20 + s_rag * 0.15 + narrative_score * 0.25
            + F.when(sentiment < -0.3, 0.15).otherwise(0.0))
    comp = F.least(F.greatest(comp, F.lit(0.0)), F.lit(1.0))
    # two projections (not a withColumn chain): each DataFrame step re-analyzes the whole plan
    dropped = {"_within", "rag_score"} if rag is not None else {"_within"}
    keep = [c for c in j.columns if c not in dropped]
    out = j.select(*keep, pyround(comp, 4).alias("composite_fraud_score"), s_dup.alias("dup_score"),
                   s_ten.alias("tenure_score"))
    score = F.col("composite_fraud_score")
    return out.select(*keep, "composite_fraud_score",
                      F.when(score > 0.75, "HIGH").when(score > 0.45, "MEDIUM").otherwise("LOW")
                       .alias("fraud_risk_level"),
                      F.when(score > 0.75, "REFER_TO_SIU").when(score > 0.45, "FLAG_FOR_REVIEW")
                       .otherwise("PASS").alias("recommended_action"),
                      "dup_score", "tenure_score")


def agent_assessment_v1(scored: DataFrame) -> DataFrame:
    """max(min(claimed, limit) - deductible, 0) x {0, 0.7, 1} by fraud band."""
    claimed = F.coalesce(F.col("claimed_amount"), F.lit(0.0))
    base = F.greatest(F.least(claimed, F.col("coverage_limit")) - F.col("deductible"), F.lit(0.0))
    fs = F.coalesce(F.col("composite_fraud_score"), F.lit(0.0))
    factor = F.when(fs > 0.75, 0.0).when(fs > 0.45, 0.7).otherwise(1.0)
    return scored.select("*", base.alias("base_settlement"), factor.alias("risk_factor"),
                         pyround(base * factor, 2).alias("assessed_settlement"))


def agent_resolution_v1(assessed: DataFrame, customers: DataFrame, claims: DataFrame,
                        hnw_segment: str = "HNW", ltv_threshold: float = 0.7) -> DataFrame:
    """H18 + H19: DENIED (ineligible) before REFERRED (T21), zero settlement DENIED;
    confidence .95/.7/.5; EXPEDITE for high-value customers with >1 claim that day.
    Claims whose customer does not exist produce no resolution (inner join)."""
    if "_cust" in assessed.columns:        # customer columns pre-joined by process_claims_v1
        j = (assessed.filter(F.col("_cust") == True)  # noqa: E712
                     .withColumnRenamed("_seg", "customer_segment").withColumnRenamed("_ltv", "lifetime_value_score"))
    else:
        cust = customers.select("customer_id", "customer_segment", "lifetime_value_score")
        j = assessed.join(cust, "customer_id", "inner")
    if "_sameday" not in j.columns:        # not carried over from the validation step
        j = j.join(same_day_counts(claims).withColumnRenamed("same_day_claims", "_sameday"),
                   ["customer_id", "incident_date"], "left")
    fs = F.coalesce(F.col("composite_fraud_score"), F.lit(0.0))
    st = F.col("assessed_settlement")
    eligible = F.coalesce(F.col("eligible"), F.lit(True))
    decision = (F.when(~eligible, "DENIED").when(fs > 0.75, "REFERRED")
                .when((fs > 0.45) & (st > 0), "PARTIALLY_APPROVED").when(st > 0, "APPROVED").otherwise("DENIED"))
    reason = (F.when(~eligible, V1_REASONS["INELIGIBLE"])
              .when(fs > 0.75, F.format_string(V1_REASONS["HIGH_FRAUD"], F.round(fs, 2).cast("string")))
              .when((fs > 0.45) & (st > 0), V1_REASONS["MEDIUM_FRAUD"])
              .when(st > 0, V1_REASONS["PASSED"]).otherwise(V1_REASONS["ZERO"]))
    final = F.when(~eligible | (fs > 0.75) | ~(st > 0), F.lit(0.0)).otherwise(st)
    seg = F.coalesce(F.col("customer_segment"), F.lit("STANDARD"))
    ltv = F.coalesce(F.col("lifetime_value_score"), F.lit(0.0))
    expedite = (seg == hnw_segment) & (ltv > ltv_threshold) & (F.coalesce(F.col("_sameday"), F.lit(0)) > 1)
    return j.select(
        "claim_id", "customer_id", "policy_id", "lob_type", "claimed_amount", "composite_fraud_score",
        "fraud_risk_level", decision.alias("decision"), reason.alias("decision_reason"),
        pyround(final, 2).alias("settlement_amount"),
        F.when(fs < 0.3, 0.95).when(fs < 0.6, 0.7).otherwise(0.5).alias("confidence_score"),
        F.when(expedite, F.lit("EXPEDITE")).alias("next_best_action"))


def process_claims_v1(claims: DataFrame, customers: DataFrame, policies: DataFrame, as_of,
                      cap: int | None = None, all_claims: DataFrame | None = None, hnw_segment: str = "HNW",
                      **scorers) -> DataFrame:
    """SUBMITTED claims (oldest first, optional cap; no DQ gate) through the v1 chain.
    ``vectors`` and ``patterns`` (see ``with_signals``) score the claims' texts.
    ``all_claims`` is the table the duplicate/concurrency lookups read (default: ``claims``)."""
    universe = all_claims if all_claims is not None else claims
    sub = claims.filter(F.col("claim_status") == "SUBMITTED")
    if cap is not None:
        sub = sub.orderBy(F.col("submission_date").asc_nulls_last(), "claim_id").limit(cap)
    # one join to customers serves tenure (fraud) and segment / LTV / existence (resolution)
    signals = {k: scorers.pop(k) for k in ("vectors", "patterns") if k in scorers}
    if signals:
        sub = with_signals(sub, **signals)
    cust = customers.select("customer_id", F.col("onboarding_date").alias("_onb"),
                            F.col("customer_segment").alias("_seg"), F.col("lifetime_value_score").alias("_ltv"),
                            F.lit(True).alias("_cust"))
    # the same-day count joined for validation also serves the expedite rule (no second join)
    v = agent_validation_v1(left_lookup(sub, cust, "customer_id"), policies, universe, keep_same_day=True)
    f = agent_fraud_v1(v, universe, customers, as_of, **scorers)
    a = agent_assessment_v1(f)
    return agent_resolution_v1(a, customers, universe, hnw_segment=hnw_segment)


def resolution_summary(resolved: DataFrame, model=None) -> DataFrame:
    """H18's letter to the policyholder through an injected model; without one, the source's own sentence."""
    from claimflow.operators.models import complete
    prompt = F.concat(F.lit("Two sentences for the policyholder, without scores or personal data. Decision: "), F.col("decision"),
                      F.lit(". Settlement: INR "), F.floor("settlement_amount").cast("string"), F.lit(" of "),
                      F.coalesce(F.floor("claimed_amount").cast("string"), F.lit("0")), F.lit(". Reason: "), F.col("decision_reason"))
    said = complete(resolved.withColumn("_prompt", prompt), "_prompt", model, out="_said").drop("_prompt")
    plain = F.concat(F.lit("Claim "), F.col("claim_id"), F.lit(" "), F.col("decision"), F.lit(". "), F.col("decision_reason"))
    return said.withColumn("summary", F.coalesce("_said", plain)).drop("_said")


def writeback_v1(claims: DataFrame, resolved: DataFrame) -> DataFrame:
    """The decision is written back to ``claim_status`` (v1 only, T15)."""
    from claimflow.operators.writes import update_from
    return update_from(claims, resolved.select("claim_id", "decision"), ["claim_id"], {"claim_status": "decision"})

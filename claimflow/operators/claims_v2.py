"""Claims agents, generation 2 (H04-H10): intake -> validation -> fraud ->
assessment -> resolution, as one set-based plan over a batch of claims.

Model calls are injectable column producers; when absent the source's own
fallback values apply (severity 'medium', vector score 0.0, assessment
0.85 x claimed with confidence 0.75). Agent outputs are structs; a NULL input
piece nulls the whole struct, as the source's string-built JSON does (T14).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.constants import AGENT_V2_ACCEPT
from claimflow.functions import text as tx
from claimflow.functions.dates import as_ts


def _all_present(*cols: Column) -> Column:
    cond = None
    for c in cols:
        cond = c.isNotNull() if cond is None else (cond & c.isNotNull())
    return cond


def agent_intake_v2(claims: DataFrame, severity: Column | None = None) -> DataFrame:
    """Severity label + intake struct; state VALIDATION."""
    sev = severity if severity is not None else tx.classify_severity(F.col("claim_text"))
    sev = F.coalesce(sev, F.lit("medium"))
    intake = F.when(F.col("lob_type").isNotNull(),
                    F.struct(F.col("lob_type").alias("incident_type"), sev.alias("severity"),
                             F.lit("parsed").alias("status")))
    return claims.withColumns({"intake_output": intake, "current_state": F.lit("VALIDATION")})


def agent_validation_v2(claims: DataFrame, policies: DataFrame) -> DataFrame:
    """Policy status in (ACTIVE, RENEWAL_PENDING) else invalid; a missing
    policy is valid with status UNKNOWN (NULL comparison takes no branch, T18)."""
    if "_pol_status" in claims.columns:   # policy already looked up by the DQ gate
        j = (claims.withColumnRenamed("_pol_status", "_vstatus").withColumnRenamed("_pol_limit", "_vlimit")
                   .withColumn("_vp", F.col("_pol_found")).drop("_pol_found"))
    else:
        p = policies.select(F.col("policy_id").alias("_vp"), F.col("policy_status").alias("_vstatus"),
                            F.col("coverage_limit").alias("_vlimit"))
        j = claims.join(p, F.col("policy_id") == F.col("_vp"), "left")
    inactive = ~F.col("_vstatus").isin(*AGENT_V2_ACCEPT)           # NULL when status NULL
    valid = ~F.coalesce(inactive, F.lit(False))
    issues = F.concat(
        F.when(F.coalesce(inactive, F.lit(False)), F.concat(F.lit("Policy not active ("), F.col("_vstatus"),
                                                            F.lit("). "))).otherwise(F.lit("")),
        F.when(F.coalesce(F.col("claimed_amount") > F.col("_vlimit"), F.lit(False)),
               F.lit("Claimed amount exceeds coverage limit. ")).otherwise(F.lit("")))
    out = F.when(F.col("claimed_amount").isNotNull(), F.struct(
        valid.alias("valid"), F.coalesce(F.col("_vstatus"), F.lit("UNKNOWN")).alias("policy_status"),
        F.coalesce(F.col("_vlimit"), F.lit(0.0)).alias("coverage_limit"),
        F.col("claimed_amount").alias("claimed_amount"), issues.alias("issues")))
    return (j.withColumns({"validation_output": out, "current_state": F.lit("FRAUD_CHECK")})
             .drop("_vp", "_vstatus", "_vlimit"))


def fraud_score_v2(vector_score: Column, sentiment: Column) -> Column:
    """round(sim*0.4 + max(0, (1 - sentiment)/4)*0.3 + 0.1, 2); NULL if a part is NULL."""
    part = F.when(sentiment.isNull(), F.lit(None).cast("double")) \
            .otherwise(F.greatest(F.lit(0.0), (F.lit(1.0) - sentiment) / 4.0))
    # first to 9 places: the noise of a float similarity must not decide a rounding half
    return F.round(F.round(vector_score * 0.4 + part * 0.3 + 0.1, 9), 2)


def risk_band(score: Column, hi: float, mid: float, labels=("HIGH", "MEDIUM", "LOW")) -> Column:
    """Three-band label (NULL falls to the last band)."""
    return F.when(score > hi, labels[0]).when(score > mid, labels[1]).otherwise(labels[2])


def with_retrieval(claims: DataFrame, corpus: DataFrame, text_col: str, id_col: str, query: Column, out: str,
                   k: int = 3) -> DataFrame:
    """G11 for the agents: the ids of the ``k`` passages that a claim's query ranks first, as the array ``out``
    (empty if nothing matches). Claims that ask the same words are one query, searched once and joined back."""
    from claimflow.operators.search import search
    from claimflow.session import bounded_broadcast
    asked = claims.withColumn("_asked", query)
    once = asked.select(F.col("_asked").alias("query_id"), F.col("_asked").alias("query")).where("query is not null").distinct()
    found = (search(corpus, once, text_col=text_col, doc_id=id_col, k=k).groupBy(F.col("query_id").alias("_asked"))
             .agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("_found")))
    joined = asked.join(bounded_broadcast(found), "_asked", "left")
    kind = corpus.schema[id_col].dataType.simpleString()
    return joined.withColumn(out, F.coalesce(F.transform("_found", lambda x: x["doc_id"]), F.array().cast(f"array<{kind}>"))) \
                 .drop("_asked", "_found")


def _grounded(claims: DataFrame, column: str) -> Column:
    """Whether a search ran and found something."""
    return F.size(column) > 0 if column in claims.columns else F.lit(False)


def agent_fraud_v2(claims: DataFrame, vector_score: Column | None = None, sentiment: Column | None = None,
                   model_score: Column | None = None) -> DataFrame:
    """Model score else the weighted formula; >0.7 HIGH, >0.4 MEDIUM.

    ``vector_score`` defaults to 0.0 (no embedding model, the source's failure
    value); ``sentiment`` defaults to the lexicon scorer on ``claim_text``.
    """
    vec = vector_score if vector_score is not None else F.lit(0.0)
    sent = sentiment if sentiment is not None else tx.sentiment(F.col("claim_text"))
    composite = F.coalesce(model_score, fraud_score_v2(vec, sent)) if model_score is not None \
        else fraud_score_v2(vec, sent)
    c = claims.withColumns({"_fs": composite, "_vec": vec, "_sent": sent})
    out = F.when(_all_present(F.col("_fs"), F.col("_vec"), F.col("_sent")), F.struct(
        F.col("_fs").alias("composite_fraud_score"), risk_band(F.col("_fs"), 0.7, 0.4).alias("risk_level"),
        F.round("_vec", 3).alias("vector_similarity"), F.round("_sent", 3).alias("sentiment"),
        _grounded(claims, "matched_patterns").alias("search_grounded")))
    return (c.withColumns({"fraud_output": out, "current_state": F.lit("ASSESSMENT")})
             .drop("_fs", "_vec", "_sent"))


def agent_assessment_v2(claims: DataFrame, model_reply: Column | None = None) -> DataFrame:
    """No reply = failed call -> 0.85 x claimed, confidence 0.75, 'moderate' (T31)."""
    fallback = F.when(F.col("claimed_amount").isNotNull(), F.struct(
        (F.col("claimed_amount") * 0.85).alias("recommended_settlement"),
        F.lit(0.75).alias("assessment_confidence"), F.lit("moderate").alias("damage_category"),
        F.lit("Standard assessment with guideline context").alias("justification"),
        _grounded(claims, "guideline_ids").alias("search_grounded")))
    out = fallback if model_reply is None else F.coalesce(model_reply, fallback)
    return claims.withColumns({"assessment_output": out, "current_state": F.lit("RESOLUTION")})


def agent_resolution_v2(claims: DataFrame, as_of) -> DataFrame:
    """REFERRED (>0.7) before DENIED (invalid) before PARTIALLY_APPROVED (>0.4,
    half settlement) before APPROVED (T21). Adds decision columns + resolution struct."""
    fs = F.coalesce(F.col("fraud_output.composite_fraud_score"), F.lit(0.1))
    risk = F.coalesce(F.col("fraud_output.risk_level"), F.lit("LOW"))
    settle = F.coalesce(F.col("assessment_output.recommended_settlement"), F.col("claimed_amount") * 0.8)
    conf = F.coalesce(F.col("assessment_output.assessment_confidence"), F.lit(0.75))
    invalid = F.col("validation_output").isNotNull() & (F.col("validation_output.valid") == False)  # noqa: E712
    decision = (F.when(fs > 0.7, "REFERRED").when(invalid, "DENIED").when(fs > 0.4, "PARTIALLY_APPROVED")
                .otherwise("APPROVED"))
    amount = (F.when(fs > 0.7, F.lit(0.0)).when(invalid, F.lit(0.0)).when(fs > 0.4, settle * 0.5)
              .otherwise(settle))
    # one projection per dependency level (each DataFrame step re-analyzes the whole plan)
    c = claims.withColumns({"fraud_score": fs, "fraud_risk_level": risk, "decision": decision,
                            "settlement_amount": amount, "confidence_score": conf})
    res = F.when(F.col("settlement_amount").isNotNull(),
                 F.struct(F.col("decision"), F.col("settlement_amount")))
    return c.withColumns({"resolution_output": res, "current_state": F.lit("COMPLETED"),
                          "completed_at": as_ts(as_of)})


def text_features_v2(claims: DataFrame, severity: Column | None = None,
                     sentiment: Column | None = None, texts: DataFrame | None = None,
                     text_key: str = "claim_text_id", vectors: DataFrame | None = None) -> DataFrame:
    """Score the claim text once (severity for intake, sentiment for fraud) and drop it,
    so no later join or shuffle carries the text.

    With ``texts`` (text_id, text) and a ``text_key`` column on the claims, the
    features are computed per text where the text is stored and joined to the
    claims by key: a narrative shared by many claims is scored once and text
    bytes never cross a shuffle. Otherwise the inline ``claim_text`` is scored.
    ``vectors`` (text_key, vector_score): the similarity of a text to the fraud
    patterns, joined with the other features of the text.
    """
    if texts is not None and text_key in claims.columns:
        sev = severity if severity is not None else tx.classify_severity(F.col("text"))
        sent = sentiment if sentiment is not None else tx.sentiment(F.col("text"))
        from claimflow.session import spread
        feats = spread(texts, key=["text_id"]).select(F.col("text_id").alias(text_key), sev.alias("_severity"),
                                     sent.alias("_sentiment"))
        if vectors is not None:
            feats = feats.join(vectors.select(text_key, F.col("vector_score").alias("_vector")), text_key, "left")
        out = claims.join(feats, text_key, "left")
        # a claim without a stored text has NULL text: severity falls back to 'medium'
        out = out.withColumn("_severity", F.coalesce(F.col("_severity"), F.lit("medium")))
        return out.drop("claim_text") if "claim_text" in out.columns else out
    if "claim_text" not in claims.columns and severity is None and sentiment is None:
        # no narrative at all: the model calls get NULL (severity falls back to 'medium')
        return (claims.withColumn("_severity", F.lit(None).cast("string"))
                      .withColumn("_sentiment", F.lit(None).cast("double")))
    sev = severity if severity is not None else tx.classify_severity(F.col("claim_text"))
    sent = sentiment if sentiment is not None else tx.sentiment(F.col("claim_text"))
    out = claims.withColumn("_severity", sev).withColumn("_sentiment", sent)
    return out.drop("claim_text") if "claim_text" in out.columns else out


def process_claims_v2(claims: DataFrame, policies: DataFrame, as_of, severity: Column | None = None,
                      vector_score: Column | None = None, sentiment: Column | None = None,
                      patterns: DataFrame | None = None, guidelines: DataFrame | None = None) -> DataFrame:
    """The five agents composed into one plan (no per-row loop). ``patterns`` (pattern_id,
    example_narrative) and ``guidelines`` (guideline_id, content) are searched for the fraud and the
    assessment step; without them no search runs and the outputs say so."""
    c = claims if "_severity" in claims.columns else text_features_v2(claims, severity, sentiment)
    if patterns is not None:
        c = with_retrieval(c, patterns, "example_narrative", "pattern_id", F.concat_ws(
            " ", F.lit("staged report"), "lob_type", F.array_join(F.split("_severity", " "), " ")), "matched_patterns")
    if guidelines is not None:
        c = with_retrieval(c, guidelines, "content", "guideline_id", F.concat_ws(
            " ", "lob_type", F.lit("underwriting guideline"), "_severity"), "guideline_ids")
    c = agent_intake_v2(c, F.col("_severity"))
    c = agent_validation_v2(c, policies)
    c = agent_fraud_v2(c, vector_score, F.col("_sentiment"))
    c = agent_assessment_v2(c)
    return agent_resolution_v2(c, as_of).withColumn("started_at", as_ts(as_of)).drop("_severity", "_sentiment", "_vector")


def resolutions_v2(processed: DataFrame, as_of) -> DataFrame:
    """Resolution rows written by H08 (one per processed claim)."""
    return processed.select(
        F.sha2(F.concat_ws("|", F.col("claim_id"), as_ts(as_of).cast("string")), 256).alias("resolution_id"),
        "claim_id", "customer_id", "policy_id", "lob_type", "decision", "settlement_amount", "claimed_amount",
        "fraud_risk_level", "fraud_score", F.lit(None).cast("string").alias("reasoning_summary"),
        "confidence_score", F.lit(None).cast("string").alias("next_steps"),
        F.lit(None).cast("long").alias("processing_time_ms"), as_ts(as_of).alias("decided_at"))


def claim_state_v2(processed: DataFrame) -> DataFrame:
    """CLAIM_STATE rows: JSON text per agent output (NULL structs stay NULL)."""
    js = lambda c: F.when(F.col(c).isNotNull(), F.to_json(F.col(c))).alias(c)
    return processed.select("claim_id", "current_state", js("intake_output"), js("validation_output"),
                            js("fraud_output"), js("assessment_output"), js("resolution_output"),
                            "started_at", "completed_at", F.lit(None).cast("string").alias("error_message"),
                            F.lit(0).cast("long").alias("retry_count"))


def audit_v2(processed: DataFrame, as_of) -> DataFrame:
    """Five audit rows per claim (steps 1-5)."""
    from claimflow.operators.writes import audit_rows
    fraud = "COMPLETE+SEARCH+EMBED+SENTIMENT" if "matched_patterns" in processed.columns else "COMPLETE+EMBED+SENTIMENT"
    assessment = "COMPLETE+SEARCH" if "guideline_ids" in processed.columns else "COMPLETE"
    steps = [("INTAKE", 1, "CLASSIFY_TEXT"), ("VALIDATION", 2, None),
             ("FRAUD", 3, fraud), ("ASSESSMENT", 4, assessment),
             ("RESOLUTION", 5, "COMPLETE")]
    each = F.array(*[F.struct(F.lit(agent).alias("agent"), F.lit(step).alias("step"), F.lit(module).cast("string").alias("module"))
                     for agent, step, module in steps])
    rows = processed.select(F.col("claim_id").alias("reference_id"), F.explode(each).alias("a"))
    return audit_rows(rows, "CLAIMS", F.col("a.agent"), F.col("a.step"), as_of, module=F.col("a.module"))


def latest_decision_text(resolutions: DataFrame) -> DataFrame:
    """H09 return value: 'Claim <id> processed. Decision: <latest decision>'."""
    from claimflow.operators.ranking import latest_per_key
    last = latest_per_key(resolutions.select("claim_id", "decision", "decided_at", "resolution_id"),
                          ["claim_id"], "decided_at", "resolution_id")
    return last.select("claim_id", F.concat(F.lit("Claim "), F.col("claim_id"), F.lit(" processed. Decision: "),
                                            F.coalesce(F.col("decision"), F.lit("UNKNOWN"))).alias("message"))


def run_claims_batch(claims: DataFrame, customers: DataFrame, policies: DataFrame, as_of,
                     cap: int | None = None, severity: Column | None = None, vector_score: Column | None = None,
                     sentiment: Column | None = None, texts: DataFrame | None = None,
                     all_claims: DataFrame | None = None, vectors: DataFrame | None = None,
                     patterns: DataFrame | None = None, guidelines: DataFrame | None = None):
    """DQ gate -> chain -> counts. Returns a dict of the produced tables.

    Row-aligned end to end: the gate filters the DQ-annotated claim rows and
    no result is joined back by ``claim_id``. Text features are either joined
    by text key after the gate (``texts`` given) or computed inline before it,
    so the claim text never crosses a shuffle. ``all_claims`` is the whole claims
    table when ``claims`` is a batch of it: duplicates are looked for there."""
    from claimflow.operators.dq import dq_validate_claims, gate_batch
    keyed = texts is not None and "claim_text_id" in claims.columns
    base = claims if keyed else text_features_v2(claims, severity, sentiment)
    dq = dq_validate_claims(base, customers, policies, as_of, keep_columns=True, keep_policy=True, all_claims=all_claims)
    passed, claims_after, dq_audit = gate_batch(dq, as_of, cap)
    if keyed:
        passed = text_features_v2(passed, severity, sentiment, texts, vectors=vectors)
        if vectors is not None:        # a text without a vector has the score of a failed look-up, 0
            vector_score = F.coalesce(F.col("_vector"), F.lit(0.0))
    processed = process_claims_v2(passed, policies, as_of, vector_score=vector_score, patterns=patterns, guidelines=guidelines)
    claims_after = claims_after.drop(*[c for c in ("_severity", "_sentiment", "claim_text_id")
                                       if c in claims_after.columns])
    return {
        "claims": claims_after, "processed": processed, "resolutions": resolutions_v2(processed, as_of),
        "claim_state": claim_state_v2(processed), "audit": dq_audit.unionByName(audit_v2(processed, as_of)),
    }

"""Oracle SQL for the DQ gate, claims agents (v1, v2) and underwriting."""

from __future__ import annotations

from claimflow.checks.bm25_sql import bm25_sql
from claimflow.constants import ORDER_WORLD_AS_OF as OW
from claimflow.constants import V1_AS_OF
from claimflow.functions.extract import MONTHS, SEARCH_WORDS, URGENT_WORDS
from claimflow.functions.numeric import pyround_sql
from claimflow.functions.text import LOB_KEYWORDS, NEGATIVE_WORDS, POSITIVE_WORDS, SEVERITY_RULES

D = f"DATE '{OW}'"
D1 = f"DATE '{V1_AS_OF}'"
TS = f"TIMESTAMP '{OW} 00:00:00'"
TS_TXT = f"{OW} 00:00:00"


def _in(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def sentiment_sql(col: str) -> str:
    toks = f"regexp_split_to_array(lower({col}), '[^a-z]+')"
    p = f"len(list_filter({toks}, lambda x: x IN ({_in(POSITIVE_WORDS)})))"
    n = f"len(list_filter({toks}, lambda x: x IN ({_in(NEGATIVE_WORDS)})))"
    return (f"(CASE WHEN {col} IS NULL THEN NULL WHEN {p} + {n} = 0 THEN 0.0::DOUBLE "
            f"ELSE CAST({p} - {n} AS DOUBLE) / ({p} + {n}) END)")


def severity_sql(col: str) -> str:
    arms = " ".join("WHEN " + " OR ".join(f"contains(lower({col}), '{k}')" for k in kws) + f" THEN '{lab}'"
                    for lab, kws in SEVERITY_RULES)
    return f"(CASE WHEN {col} IS NULL THEN 'medium' {arms} ELSE 'medium severity' END)"


DQ_CORE_T = f"""
SELECT c.*,
  list_filter([
    CASE WHEN cu.customer_id IS NULL
         THEN 'CUSTOMER_NOT_FOUND: ' || coalesce(CAST(c.customer_id AS VARCHAR), 'NULL') END,
    CASE WHEN c.policy_id IS NOT NULL AND p.policy_id IS NULL
         THEN 'POLICY_NOT_FOUND: ' || CAST(c.policy_id AS VARCHAR) END,
    CASE WHEN c.policy_id IS NOT NULL AND p.policy_id IS NOT NULL AND p.policy_status NOT IN ('ACTIVE')
         THEN 'POLICY_INACTIVE: status=' || p.policy_status END,
    CASE WHEN c.policy_id IS NOT NULL AND p.policy_id IS NOT NULL AND p.customer_id <> c.customer_id
         THEN 'POLICY_CUSTOMER_MISMATCH: policy belongs to ' || CAST(p.customer_id AS VARCHAR) END,
    CASE WHEN c.claimed_amount IS NULL OR c.claimed_amount <= 0
         THEN 'INVALID_AMOUNT: claimed_amount is null or zero' END,
    CASE WHEN c.customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' END], lambda x: x IS NOT NULL) AS errs,
  list_filter([
    CASE WHEN c.policy_id IS NOT NULL AND p.policy_id IS NOT NULL AND c.lob_type IS NOT NULL
              AND p.lob_type <> c.lob_type
         THEN 'LOB_MISMATCH: claim=' || c.lob_type || ' policy=' || p.lob_type END,
    CASE WHEN c.policy_id IS NOT NULL AND p.policy_id IS NOT NULL AND c.claimed_amount > p.coverage_limit
              AND p.coverage_limit > 0
         THEN 'EXCEEDS_COVERAGE: claimed=' || printf('%.3f', c.claimed_amount)
              || ' limit=' || printf('%.3f', p.coverage_limit) END,
    CASE WHEN coalesce(rc.recent - CASE WHEN c.submission_date >= {TS} - INTERVAL 30 DAY
                                          AND c.claim_status NOT IN ('DENIED', 'DQ_FAILED') THEN 1 ELSE 0 END, 0) > 0
         THEN 'DUPLICATE_RISK: ' || CAST(rc.recent - CASE WHEN c.submission_date >= {TS} - INTERVAL 30 DAY
                                          AND c.claim_status NOT IN ('DENIED', 'DQ_FAILED') THEN 1 ELSE 0 END AS VARCHAR)
              || ' similar claim(s) in last 30 days' END], lambda x: x IS NOT NULL) AS warns
FROM {{src}} c
LEFT JOIN (SELECT DISTINCT customer_id FROM v_customers) cu ON c.customer_id = cu.customer_id
LEFT JOIN v_policies p ON c.policy_id = p.policy_id
LEFT JOIN (SELECT customer_id, lob_type,
                  count_if(submission_date >= {TS} - INTERVAL 30 DAY
                           AND claim_status NOT IN ('DENIED', 'DQ_FAILED')) AS recent
           FROM v_claims WHERE customer_id IS NOT NULL AND lob_type IS NOT NULL GROUP BY ALL) rc
  ON c.customer_id = rc.customer_id AND c.lob_type = rc.lob_type"""



def dq_core(src: str = "v_claims") -> str:
    """Row-preserving DQ annotation of every claim row (claim columns + errs + warns)."""
    return DQ_CORE_T.replace("{src}", src)


DQ = f"""
SELECT claim_id, customer_id, len(errs) = 0 AS passed, array_to_string(errs, ' | ') AS errors,
       array_to_string(warns, ' | ') AS warnings
FROM ({dq_core()}) q"""

INTAKE = """
SELECT c.claim_id, c.customer_id,
  CASE WHEN NOT req THEN 'REQUIRED_FIELDS_MISSING' ELSE array_to_string(list_filter([
    CASE WHEN cu.customer_id IS NULL THEN 'CUSTOMER_NOT_FOUND' END,
    CASE WHEN p.policy_id IS NULL THEN 'POLICY_NOT_FOUND' END,
    CASE WHEN p.policy_id IS NOT NULL AND p.customer_id IS DISTINCT FROM c.customer_id
         THEN 'POLICY_CUSTOMER_MISMATCH' END,
    CASE WHEN p.policy_id IS NOT NULL AND NOT coalesce(p.policy_status IN ('ACTIVE', 'RENEWAL_PENDING'), FALSE)
         THEN 'POLICY_INACTIVE' END], lambda x: x IS NOT NULL), ' | ') END AS errors,
  CASE WHEN NOT req THEN '' ELSE array_to_string(list_filter([
    CASE WHEN p.policy_id IS NOT NULL AND p.lob_type IS DISTINCT FROM c.lob_type THEN 'LOB_MISMATCH' END,
    CASE WHEN p.policy_id IS NOT NULL AND coalesce(c.claimed_amount, 0.0) > p.coverage_limit
         THEN 'EXCEEDS_COVERAGE' END], lambda x: x IS NOT NULL), ' | ') END AS warnings,
  req AND len(list_filter([
    CASE WHEN cu.customer_id IS NULL THEN 1 END, CASE WHEN p.policy_id IS NULL THEN 1 END,
    CASE WHEN p.policy_id IS NOT NULL AND p.customer_id IS DISTINCT FROM c.customer_id THEN 1 END,
    CASE WHEN p.policy_id IS NOT NULL AND NOT coalesce(p.policy_status IN ('ACTIVE', 'RENEWAL_PENDING'), FALSE)
         THEN 1 END], lambda x: x IS NOT NULL)) = 0 AS passed
FROM (SELECT *, customer_id IS NOT NULL AND policy_id IS NOT NULL AND claim_text IS NOT NULL
                AND length(claim_text) > 0 AS req FROM v_claims_text) c
LEFT JOIN (SELECT DISTINCT customer_id FROM v_customers) cu ON c.customer_id = cu.customer_id
LEFT JOIN v_policies p ON c.policy_id = p.policy_id"""

SENT = sentiment_sql("c.claim_text")

V2 = f"""
WITH passed AS (SELECT * EXCLUDE (errs, warns) FROM ({dq_core("v_claims_text")}) q
                WHERE claim_status = 'SUBMITTED' AND len(errs) = 0),
f AS (SELECT c.*, p.policy_status AS vstatus, {SENT} AS sent, coalesce(s.vector_score, 0.0::DOUBLE) AS vec FROM passed c
      LEFT JOIN v_policies p ON c.policy_id = p.policy_id LEFT JOIN v_text_scores s ON s.vec_id = c.claim_text_id),
g AS (SELECT *, CAST(round(CAST(vec * 0.4::DOUBLE
                      + (CASE WHEN sent IS NULL THEN NULL ELSE greatest(0.0::DOUBLE, (1.0::DOUBLE - sent) / 4.0::DOUBLE) END)
                        * 0.3::DOUBLE + 0.1::DOUBLE AS DECIMAL(18, 9)), 2) AS DOUBLE) AS fs_raw,
             claimed_amount IS NOT NULL AND coalesce(vstatus NOT IN ('ACTIVE', 'RENEWAL_PENDING'), FALSE) AS invalid
      FROM f),
h AS (SELECT *, coalesce(fs_raw, 0.1::DOUBLE) AS fs, coalesce(claimed_amount * 0.85::DOUBLE, claimed_amount * 0.8::DOUBLE) AS st
      FROM g)
SELECT sha256(claim_id || '|' || '{TS_TXT}') AS resolution_id, claim_id, customer_id, policy_id, lob_type,
  CASE WHEN fs > 0.7 THEN 'REFERRED' WHEN invalid THEN 'DENIED' WHEN fs > 0.4 THEN 'PARTIALLY_APPROVED'
       ELSE 'APPROVED' END AS decision,
  CASE WHEN fs > 0.7 THEN 0.0::DOUBLE WHEN invalid THEN 0.0::DOUBLE WHEN fs > 0.4 THEN st * 0.5::DOUBLE ELSE st END
       AS settlement_amount,
  claimed_amount,
  CASE WHEN fs_raw IS NULL THEN 'LOW' WHEN fs_raw > 0.7 THEN 'HIGH' WHEN fs_raw > 0.4 THEN 'MEDIUM' ELSE 'LOW' END
       AS fraud_risk_level,
  fs AS fraud_score, CAST(NULL AS VARCHAR) AS reasoning_summary, 0.75::DOUBLE AS confidence_score,
  CAST(NULL AS VARCHAR) AS next_steps, CAST(NULL AS BIGINT) AS processing_time_ms, {TS} AS decided_at
FROM h"""

INTAKE_V2 = f"""
SELECT claim_id, lob_type, {severity_sql('claim_text')} AS severity
FROM v_claims_text WHERE claim_status = 'SUBMITTED'"""

# v1: what the statement says, and how the claim scores on it
_MONTHS = "|".join(MONTHS)
_TOKS = "regexp_split_to_array(lower(claim_text), '[^a-z]+')"
_VOTES = [f"len(list_filter(toks, lambda x: x IN ({_in(words)})))" for _, words in LOB_KEYWORDS]
V1_SIGNALS = f"""
said AS (SELECT *, regexp_extract(claim_text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}|[0-9]{{1,2}} (?:{_MONTHS}) [0-9]{{4}}') AS day_text,
    {_TOKS} AS toks FROM v_claims_v1 WHERE claim_status = 'SUBMITTED'),
facts AS (SELECT * EXCLUDE (day_text), CAST(coalesce(try_strptime(day_text, '%Y-%m-%d'), try_strptime(day_text, '%d/%m/%Y'), try_strptime(day_text, '%d %B %Y')) AS DATE) AS stated_day,
    try_cast(replace(regexp_extract(claim_text, '(?:INR|Rs|USD|EUR)\\.? ?([0-9][0-9,]*(?:\\.[0-9]+)?)', 1), ',', '') AS DOUBLE) AS stated_amount,
    regexp_extract(claim_text, '\\b(?:in|at|near) ([A-Z][a-z]+(?: [A-Z][a-z]+)?)', 1) AS place,
    {_VOTES[0]} AS auto, {_VOTES[1]} AS property, {_VOTES[2]} AS work,
    CASE WHEN len(list_filter(toks, lambda x: x IN ({_in(URGENT_WORDS)}))) > 0 THEN 'HIGH'
         WHEN regexp_matches(lower(claim_text), '\\bno (?:hurry|rush)\\b') THEN 'LOW' ELSE 'MEDIUM' END AS urgency,
    coalesce({sentiment_sql('claim_text')}, 0.0::DOUBLE) AS sentiment,
    array_to_string(list_sort(list_distinct(list_filter(toks, lambda x: x IN ({_in(SEARCH_WORDS)})))), ' ') AS asked FROM said),
ranked AS ({{BM25}}),
rag AS (SELECT query_id, max((1.0::DOUBLE - (rank - 1) * 0.25::DOUBLE)
    * CASE severity WHEN 'CRITICAL' THEN 0.9::DOUBLE WHEN 'HIGH' THEN 0.7::DOUBLE WHEN 'MEDIUM' THEN 0.5::DOUBLE ELSE 0.3::DOUBLE END) AS rag
  FROM ranked JOIN v_fraud_narratives ON pattern_id = doc_id GROUP BY query_id),
sub AS (SELECT f.*, coalesce(round(vector_score, 6), 0.0::DOUBLE) AS embed, coalesce(rag, 0.0::DOUBLE) AS rag,
    CASE WHEN claim_text IS NULL THEN 0.3::DOUBLE ELSE
      (CASE WHEN stated_day IS NULL OR stated_amount IS NULL OR auto + property + work = 0 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END)
      + (CASE WHEN coalesce(stated_day <> incident_date, FALSE) OR coalesce(abs(stated_amount - claimed_amount) > 1, FALSE) THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END)
      + (CASE WHEN sentiment < -0.3 THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END)
      + (CASE WHEN urgency = 'HIGH' THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END) END AS narrative
  FROM facts f LEFT JOIN v_text_scores t ON t.vec_id = f.vector_id LEFT JOIN rag ON rag.query_id = f.asked)"""

PR_COMP = pyround_sql("""least(greatest(
      least(coalesce(d.n_dup, 0) * 0.3::DOUBLE, 0.9::DOUBLE) * 0.15::DOUBLE
    + (CASE WHEN m < 6 THEN 0.6::DOUBLE WHEN m < 12 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END) * 0.10::DOUBLE
    + v.embed * 0.20::DOUBLE + v.rag * 0.15::DOUBLE + v.narrative * 0.25::DOUBLE
    + (CASE WHEN v.sentiment < -0.3 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END),
    0.0::DOUBLE), 1.0::DOUBLE)""", 4)
PR_ST = pyround_sql("""greatest(least(coalesce(claimed_amount, 0.0), coverage_limit) - deductible, 0.0)
                  * CASE WHEN composite_fraud_score > 0.75 THEN 0.0::DOUBLE
                         WHEN composite_fraud_score > 0.45 THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END""", 2)
PR_FINAL = pyround_sql("CASE WHEN NOT a.eligible OR a.composite_fraud_score > 0.75 OR NOT (a.st > 0) THEN 0.0 ELSE a.st END", 2)

V1 = f"""
WITH {{SIGNALS}},
mlob AS (SELECT customer_id, count(DISTINCT lob_type) AS multi_lob_count FROM v_policies
         WHERE policy_status = 'ACTIVE' GROUP BY 1),
sameday AS (SELECT customer_id, incident_date, count(*) AS n FROM v_claims
            WHERE customer_id IS NOT NULL AND incident_date IS NOT NULL GROUP BY ALL),
dup AS (SELECT a.claim_id, count(*) AS n_dup FROM sub a JOIN v_claims b
        ON a.customer_id = b.customer_id AND a.policy_id = b.policy_id AND a.claim_id <> b.claim_id
        AND abs(date_diff('day', a.incident_date, b.incident_date)) <= 90 GROUP BY a.claim_id),
val AS (
  SELECT s.*, p.policy_id IS NOT NULL AS found,
    p.policy_id IS NOT NULL AND coalesce(p.policy_status = 'ACTIVE', FALSE)
      AND coalesce(s.incident_date IS NOT NULL AND p.start_date IS NOT NULL AND s.incident_date >= p.start_date
                   AND (p.end_date IS NULL OR s.incident_date <= p.end_date), FALSE)
      AND (s.lob_type IS NULL OR s.lob_type = '' OR p.lob_type IS NOT DISTINCT FROM s.lob_type) AS eligible,
    CASE WHEN p.policy_id IS NOT NULL THEN coalesce(p.coverage_limit, 0.0) ELSE 0.0 END AS coverage_limit,
    CASE WHEN p.policy_id IS NOT NULL THEN coalesce(p.deductible, 0.0) ELSE 0.0 END AS deductible
  FROM sub s LEFT JOIN v_policies p ON s.policy_id = p.policy_id),
fr AS (
  SELECT v.*, {PR_COMP} AS composite_fraud_score
  FROM (SELECT v.*, coalesce((year({D1}) - year(cu.onboarding_date)) * 12 + (month({D1}) - month(cu.onboarding_date)), 0)
               AS m FROM val v LEFT JOIN v_customers cu ON v.customer_id = cu.customer_id) v
  LEFT JOIN dup d ON v.claim_id = d.claim_id),
asm AS (
  SELECT *, {PR_ST} AS st
  FROM fr)
SELECT a.claim_id, a.customer_id, a.policy_id, a.lob_type, a.claimed_amount, a.composite_fraud_score,
  CASE WHEN a.composite_fraud_score > 0.75 THEN 'HIGH' WHEN a.composite_fraud_score > 0.45 THEN 'MEDIUM'
       ELSE 'LOW' END AS fraud_risk_level,
  CASE WHEN NOT a.eligible THEN 'DENIED' WHEN a.composite_fraud_score > 0.75 THEN 'REFERRED'
       WHEN a.composite_fraud_score > 0.45 AND a.st > 0 THEN 'PARTIALLY_APPROVED' WHEN a.st > 0 THEN 'APPROVED'
       ELSE 'DENIED' END AS decision,
  CASE WHEN NOT a.eligible THEN 'Policy validation failed'
       WHEN a.composite_fraud_score > 0.75
            THEN 'High fraud risk (score: ' || CAST(round(a.composite_fraud_score, 2) AS VARCHAR) || ')'
       WHEN a.composite_fraud_score > 0.45 AND a.st > 0 THEN 'Medium fraud risk - reduced settlement'
       WHEN a.st > 0 THEN 'All checks passed' ELSE 'Zero settlement calculated' END AS decision_reason,
  {PR_FINAL}
       AS settlement_amount,
  CASE WHEN a.composite_fraud_score < 0.3 THEN 0.95 WHEN a.composite_fraud_score < 0.6 THEN 0.7 ELSE 0.5 END
       ::DOUBLE AS confidence_score,
  CASE WHEN coalesce(cu.customer_segment, 'STANDARD') = 'BUILDING' AND coalesce(cu.lifetime_value_score, 0.0) > 0.7
            AND coalesce(sd.n, 0) > 1 THEN 'EXPEDITE' END AS next_best_action
FROM asm a JOIN v_customers cu ON a.customer_id = cu.customer_id
LEFT JOIN sameday sd ON a.customer_id = sd.customer_id AND a.incident_date = sd.incident_date"""
V1 = V1.replace("{SIGNALS}", V1_SIGNALS.replace("{BM25}", bm25_sql(
    "SELECT DISTINCT asked AS query_id, asked AS query FROM facts WHERE asked <> ''", 3,
    "SELECT pattern_id AS doc_id, example_narrative AS text FROM v_fraud_narratives")))
V1_VIEWS = ["v_claims", "v_claims_v1", "v_customers", "v_policies", "v_fraud_narratives", "v_text_scores", "v_doc_count"]

INTAKE_V1 = f"""
WITH {V1_SIGNALS[:V1_SIGNALS.index("ranked AS")].rstrip().rstrip(",")}
SELECT claim_id, CASE WHEN claim_text IS NULL THEN coalesce(lob_type, 'UNKNOWN')
    ELSE coalesce(CASE WHEN auto + property + work = 0 THEN NULL WHEN auto >= property AND auto >= work THEN 'AUTO'
                       WHEN property >= work THEN 'PROPERTY' ELSE 'WORKERS_COMP' END, lob_type) END AS lob_classification,
  CASE WHEN claim_text IS NULL THEN 0.5::DOUBLE WHEN auto + property + work = 0 THEN 0.0::DOUBLE
       ELSE greatest(auto, property, work) / CAST(auto + property + work AS DOUBLE) END AS confidence_score,
  CASE WHEN claim_text IS NULL THEN 'MEDIUM' ELSE urgency END AS urgency_level,
  claim_text IS NOT NULL AND (CASE WHEN auto > 0 THEN 1 ELSE 0 END + CASE WHEN property > 0 THEN 1 ELSE 0 END
    + CASE WHEN work > 0 THEN 1 ELSE 0 END) > 1 AS multi_lob_indicator,
  claim_text IS NULL AS parse_error, 'INTAKE_COMPLETE' AS current_state,
  stated_day, stated_amount, nullif(place, '') AS place, {severity_sql('claim_text')} AS severity
FROM facts"""

CLAIMS_AFTER_V1 = f"""
WITH done AS ({V1})
SELECT c.claim_id, c.customer_id, coalesce(d.decision, c.claim_status) AS claim_status,
  CASE WHEN d.claim_id IS NOT NULL THEN 'Claim ' || d.claim_id || ' ' || d.decision || '. ' || d.decision_reason END AS summary
FROM v_claims c LEFT JOIN done d ON c.claim_id = d.claim_id"""

UW_SCORE = f"""
WITH apps AS (SELECT *, CASE WHEN credit_score >= 750 THEN 'LOW' WHEN credit_score >= 650 THEN 'MEDIUM'
                             ELSE 'HIGH' END AS risk_tier FROM v_applications WHERE status = 'PENDING'),
m AS (SELECT a.application_id, min(t.table_id) AS tid FROM apps a JOIN v_actuarial t
      ON t.lob_type = a.lob_type AND t.risk_tier = a.risk_tier
      AND t.geographic_zone LIKE '%' || left(a.geographic_zone, 7) || '%' GROUP BY 1),
j AS (SELECT a.*, t.table_id AS actuarial_table_id,
        coalesce(t.base_rate, 0.03::DOUBLE) AS base_rate, coalesce(t.risk_multiplier, 1.3::DOUBLE) AS risk_multiplier,
        coalesce(t.geographic_factor, 1.1::DOUBLE) AS geographic_factor,
        CASE WHEN a.existing_customer_id IS NOT NULL AND a.existing_customer_id <> ''
             THEN coalesce(t.claims_history_factor, 1.0::DOUBLE) * 0.9::DOUBLE
             ELSE coalesce(t.claims_history_factor, 1.0::DOUBLE) END AS history_factor
      FROM apps a LEFT JOIN m ON a.application_id = m.application_id
      LEFT JOIN v_actuarial t ON t.table_id = m.tid)
SELECT application_id, lob_type, existing_customer_id, coverage_requested, credit_score, geographic_zone,
  risk_tier, actuarial_table_id, base_rate, risk_multiplier, geographic_factor, history_factor,
  round(base_rate * risk_multiplier * geographic_factor * history_factor, 6) AS composite_score,
  round(coverage_requested * (base_rate * risk_multiplier * geographic_factor * history_factor), 0)
      AS recommended_premium
FROM j"""

UW_DECIDE = f"""
SELECT sha256(CAST(application_id AS VARCHAR) || '|' || '{TS_TXT}') AS decision_id, application_id,
  existing_customer_id AS customer_id, lob_type, risk_tier,
  CASE WHEN risk_tier = 'LOW' THEN 0.95 WHEN risk_tier = 'MEDIUM' THEN 0.7 ELSE 0.5 END::DOUBLE AS confidence,
  CASE WHEN risk_tier IN ('LOW', 'MEDIUM') THEN recommended_premium ELSE recommended_premium * 1.5::DOUBLE END
      AS recommended_premium,
  risk_tier = 'LOW' AS auto_approved,
  CASE WHEN risk_tier = 'LOW' THEN 'Auto-approved: LOW risk tier, credit score qualifies, actuarial rates favorable.'
       WHEN risk_tier = 'MEDIUM' THEN 'Manual review required: MEDIUM risk. Premium adjusted by risk multiplier.'
       ELSE 'Flagged for senior underwriter: HIGH risk. May require additional documentation.' END AS rationale,
  CASE WHEN risk_tier = 'LOW' THEN 'APPROVED' ELSE 'REVIEW' END AS application_status,
  {TS} AS decided_at
FROM ({UW_SCORE}) s"""

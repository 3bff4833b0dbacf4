"""Oracle SQL for the v1 sub-agents (H12, H16, H17), latest-per-key (E02),
the insert-only embedding refresh (G04 / A13) and the claims audit log (A17)."""

from __future__ import annotations

from claimflow.checks import claims_sql as ks
from claimflow.constants import EVENT_WORLD_AS_OF as EV
from claimflow.constants import ORDER_WORLD_AS_OF as OW

# the v1 chain's CTEs (sub, mlob, sameday, dup, val, fr, asm) without its final projection
V1_CTES = ks.V1[:ks.V1.rindex("SELECT a.claim_id")]

VALIDATION_V1 = """
WITH sub AS (SELECT * FROM v_claims WHERE claim_status = 'SUBMITTED'),
mlob AS (SELECT customer_id, count(DISTINCT lob_type) AS n FROM v_policies
         WHERE policy_status = 'ACTIVE' GROUP BY 1),
sameday AS (SELECT customer_id, incident_date, count(*) AS n FROM v_claims
            WHERE customer_id IS NOT NULL AND incident_date IS NOT NULL GROUP BY ALL),
j AS (
  SELECT s.claim_id, s.customer_id, s.incident_date, p.policy_id IS NOT NULL AS found,
    coalesce(p.policy_status = 'ACTIVE', FALSE) AS status_ok,
    coalesce(s.incident_date IS NOT NULL AND p.start_date IS NOT NULL AND s.incident_date >= p.start_date
             AND (p.end_date IS NULL OR s.incident_date <= p.end_date), FALSE) AS dates_ok,
    (s.lob_type IS NULL OR s.lob_type = '' OR p.lob_type IS NOT DISTINCT FROM s.lob_type) AS lob_ok,
    coalesce(s.claimed_amount, 0.0) AS claimed, coalesce(p.coverage_limit, 0.0) AS lim,
    coalesce(p.deductible, 0.0) AS ded
  FROM sub s LEFT JOIN v_policies p ON s.policy_id = p.policy_id)
SELECT j.claim_id,
  found AND status_ok AND dates_ok AND lob_ok AS eligible,
  CASE WHEN found THEN NULL ELSE 'POLICY_NOT_FOUND' END AS ineligible_reason,
  CASE WHEN found THEN lim ELSE 0.0::DOUBLE END AS coverage_limit,
  CASE WHEN found THEN ded ELSE 0.0::DOUBLE END AS deductible,
  CASE WHEN found AND status_ok AND dates_ok AND lob_ok THEN least(claimed, lim) - ded ELSE 0.0::DOUBLE END
      AS max_payable,
  CASE WHEN found THEN concat_ws(',', CASE WHEN NOT status_ok THEN 'STATUS' END,
                                      CASE WHEN NOT dates_ok THEN 'DATES' END,
                                      CASE WHEN NOT lob_ok THEN 'LOB' END,
                                      CASE WHEN NOT (claimed <= lim) THEN 'LIMIT' END) END AS failed_checks,
  CASE WHEN found THEN coalesce(m.n, 0) END AS multi_lob_count,
  CASE WHEN found THEN coalesce(sd.n, 1) - 1 END AS concurrent_claims
FROM j LEFT JOIN mlob m ON j.customer_id = m.customer_id
LEFT JOIN sameday sd ON j.customer_id = sd.customer_id AND j.incident_date = sd.incident_date"""

FRAUD_V1 = V1_CTES + """
SELECT f.claim_id, embed AS embed_score, rag AS rag_score, narrative AS narrative_score, sentiment,
  least(coalesce(d.n_dup, 0) * 0.3::DOUBLE, 0.9::DOUBLE) AS dup_score,
  (CASE WHEN f.m < 6 THEN 0.6 WHEN f.m < 12 THEN 0.3 ELSE 0.1 END)::DOUBLE AS tenure_score,
  f.composite_fraud_score,
  CASE WHEN f.composite_fraud_score > 0.75 THEN 'HIGH' WHEN f.composite_fraud_score > 0.45 THEN 'MEDIUM'
       ELSE 'LOW' END AS fraud_risk_level,
  CASE WHEN f.composite_fraud_score > 0.75 THEN 'REFER_TO_SIU' WHEN f.composite_fraud_score > 0.45
       THEN 'FLAG_FOR_REVIEW' ELSE 'PASS' END AS recommended_action
FROM fr f LEFT JOIN dup d ON f.claim_id = d.claim_id"""

ASSESSMENT_V1 = V1_CTES + """
SELECT claim_id,
  greatest(least(coalesce(claimed_amount, 0.0), coverage_limit) - deductible, 0.0) AS base_settlement,
  (CASE WHEN composite_fraud_score > 0.75 THEN 0.0 WHEN composite_fraud_score > 0.45 THEN 0.7 ELSE 1.0 END)::DOUBLE
      AS risk_factor,
  st AS assessed_settlement
FROM asm"""

LATEST_INTERACTION = """
SELECT customer_id, interaction_id, channel, interaction_date, resolution_status
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                   ORDER BY interaction_date DESC NULLS LAST, interaction_id DESC) AS rn
      FROM v_interactions) s
WHERE rn = 1"""

EMBEDDING_REFRESH = """
SELECT vec_id AS doc_id, 'EXISTING' AS origin, CAST(len(embedding) AS INTEGER) AS dims FROM embeddings
UNION ALL
SELECT d.doc_id, 'NEW' AS origin, 64 AS dims FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = d.doc_id)"""

CLAIMS_AUDIT = f"""
SELECT 'CLAIMS' AS flow_type, CAST(claim_id AS VARCHAR) AS reference_id, 'DQ_VALIDATOR' AS agent_name,
  CAST(0 AS BIGINT) AS step_number, CAST(NULL AS VARCHAR) AS module_used, 'DQ_FAILED' AS status,
  TIMESTAMP '{OW} 00:00:00' AS created_at
FROM ({ks.dq_core()}) q WHERE claim_status = 'SUBMITTED' AND len(errs) > 0
UNION ALL
SELECT 'CLAIMS', CAST(r.claim_id AS VARCHAR), a.agent_name, CAST(a.step_number AS BIGINT), a.module, 'SUCCESS',
  TIMESTAMP '{OW} 00:00:00'
FROM ({ks.V2}) r, (VALUES ('INTAKE', 1, 'CLASSIFY_TEXT'), ('VALIDATION', 2, NULL),
  ('FRAUD', 3, 'COMPLETE+EMBED+SENTIMENT'), ('ASSESSMENT', 4, 'COMPLETE'), ('RESOLUTION', 5, 'COMPLETE'))
  AS a(agent_name, step_number, module)"""

# One gate run over the 20 oldest SUBMITTED claims (the source's batch cap)
GATE_CAP20 = f"""
WITH q AS ({ks.dq_core()}),
chosen AS (SELECT claim_id FROM q WHERE claim_status = 'SUBMITTED'
           ORDER BY submission_date ASC NULLS LAST, claim_id LIMIT 20)
SELECT claim_id, customer_id,
  CASE WHEN claim_status = 'SUBMITTED' AND len(errs) > 0 AND claim_id IN (SELECT claim_id FROM chosen)
       THEN 'DQ_FAILED' ELSE claim_status END AS claim_status
FROM q"""

# J05 without a completion model: customers with interactions in the last 90 days get the
# failed-parse update (five NULL features); everyone else keeps the build's defaults
INTERACTION_FEATURES = f"""
SELECT c.customer_id,
  CASE WHEN r.customer_id IS NULL THEN 0.0::DOUBLE END AS frustration_level,
  CASE WHEN r.customer_id IS NULL THEN FALSE END AS intent_cancel_detected,
  CASE WHEN r.customer_id IS NULL THEN CAST(0 AS BIGINT) END AS competitor_mentions_count,
  CASE WHEN r.customer_id IS NULL THEN 0.0::DOUBLE END AS digital_engagement_trend,
  CASE WHEN r.customer_id IS NULL THEN FALSE END AS emotional_manipulation_flag
FROM v_customers c
LEFT JOIN (SELECT DISTINCT customer_id FROM v_interactions
           WHERE interaction_date >= TIMESTAMP '{EV} 00:00:00' - INTERVAL 90 DAY) r
  ON c.customer_id = r.customer_id"""

# A06 + G17 over the driver's web pages, each staged as <P page_id>/<DOC-page_id>_page.html
PROCESS_PAGES = """
SELECT 'DOC-' || CAST(page_id AS VARCHAR) AS document_id, 'P' || CAST(page_id AS VARCHAR) AS claim_id,
  'page.html' AS file_name, CAST(strlen(html) AS BIGINT) AS file_size_bytes,
  CASE WHEN html IS NOT NULL AND length(html) > 0 THEN 'EXTRACTED' ELSE 'FAILED' END AS extraction_status,
  CAST(length(html) AS BIGINT) AS text_length,
  CASE WHEN html IS NOT NULL AND length(html) > 0 THEN CAST(64 AS BIGINT) END AS embedding_dims
FROM pages"""

# crc32 is not a function of this SQL, so the forms' numbers come from the same bitwise rule
_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(x AS BIGINT) for x in flatten([[ascii(ch), -1, -1, -1, -1, -1, -1, -1, -1] for ch in string_split(claim_id, '')])]),
  lambda v, s: CASE WHEN s >= 0 THEN xor(v, s) ELSE xor(v >> 1, (v & 1) * CAST(3988292384 AS BIGINT)) END), CAST(4294967295 AS BIGINT))"""
INGEST_CLAIMS = f"""
WITH forms AS (SELECT claim_id, lob_type, {_CRC} AS n FROM v_claims WHERE claim_status = 'SUBMITTED')
SELECT claim_id, CASE WHEN n % 3 <> 0 AND n % 50 = 0 THEN NULL ELSE 'SUBMITTED' END AS claim_status,
  CASE WHEN n % 3 <> 0 AND n % 50 = 0 THEN NULL ELSE 'WEB_INTAKE' END AS source,
  CASE WHEN n % 3 <> 0 AND n % 50 = 0 THEN NULL ELSE lob_type END AS lob,
  CASE WHEN n % 3 <> 0 AND n % 50 = 0 THEN NULL ELSE TRUE END AS dq_validated,
  CASE WHEN n % 3 = 0 OR n % 50 = 0 THEN NULL ELSE 'photo-' || CAST(n % 1000 AS VARCHAR) || '.jpg' END AS first_file,
  CASE WHEN n % 3 <> 0 AND n % 50 = 0 THEN 'SUPPORTING_DOCS_NOT_JSON' END AS reason
FROM forms"""

INGEST_APPLICATIONS = """
SELECT 'APP-' || CAST(c_custkey AS VARCHAR) AS application_id, ['AUTO', 'PROPERTY', 'WORKERS_COMP'][1 + c_custkey % 3] AS lob_type,
  CASE WHEN c_custkey % 50 <> 0 THEN 'PENDING' END AS status,
  CASE WHEN c_custkey % 50 <> 0 THEN c_name END AS name,
  CASE WHEN c_custkey % 50 = 0 OR c_custkey % 3 = 2 THEN NULL WHEN c_custkey % 3 = 0 THEN c_custkey * 10.0::DOUBLE
       WHEN c_custkey % 20 = 0 THEN NULL ELSE c_custkey * 100.0::DOUBLE END AS coverage_limit,
  CASE WHEN c_custkey % 50 <> 0 AND c_custkey % 3 = 2 THEN CAST(c_custkey % 90 AS INTEGER) END AS employee_count,
  CASE WHEN c_custkey % 50 <> 0 AND c_custkey % 3 = 2 THEN 0 END AS prior_claims_3yr,
  CASE WHEN c_custkey % 50 = 0 THEN CASE WHEN c_custkey % 3 = 2 THEN 'EMPLOYER_NAME_REQUIRED' ELSE 'APPLICANT_NAME_REQUIRED' END END AS reason
FROM customer"""

INSERT_SELECT = f"""
SELECT reference_id, flow_type, agent_name, CAST(step_number AS BIGINT) AS step_number, status FROM ({CLAIMS_AUDIT}) a
UNION ALL
SELECT CAST(application_id AS VARCHAR), 'UNDERWRITING', 'UW_DECISION', CAST(3 AS BIGINT), 'SUCCESS' FROM v_applications WHERE status = 'PENDING'"""

# I05 with its guideline look-up: each decision's passages, best first
UW_GROUNDED = f"""
SELECT d.application_id, d.application_status, list_aggregate(list(g.doc_id ORDER BY g.rank), 'string_agg', ',') AS guideline_ids, 'SQL+SEARCH' AS module_used
FROM ({ks.UW_DECIDE}) d JOIN ({{GUIDELINES}}) g ON g.query_id = d.application_id GROUP BY d.application_id, d.application_status"""

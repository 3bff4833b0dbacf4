"""Oracle SQL for reports, vector/search/text operators, DQ metrics and write operators."""

from __future__ import annotations

from claimflow.checks import churn_sql as cs
from claimflow.checks import claims_sql as ks
from claimflow.checks import feature_sql as fs
from claimflow.checks.bm25_sql import bm25_sql
from claimflow.checks.churn_sql import CAUSES, SCAN, SCORED
from claimflow.constants import EVENT_WORLD_AS_OF as EV
from claimflow.constants import ORDER_WORLD_AS_OF as OW
from claimflow.constants import PLAYBOOKS
from claimflow.functions.numeric import pyround_sql as pr
from claimflow.functions.text import LOB_KEYWORDS

T_EV = f"TIMESTAMP '{EV} 00:00:00'"
T_OW = f"TIMESTAMP '{OW} 00:00:00'"
NL_SEP = "chr(10) || '---' || chr(10)"

BOOT_SCORED = fs.propensity_sql(fs.C360_BOOT)

KPI_EXEC = f"""
SELECT count(*) AS total_customers, {pr('avg(churn_propensity_score)', 2)} AS avg_churn,
  {pr('avg(sentiment_score_last_30d)', 2)} AS avg_sentiment, {pr('sum(total_annual_premium)', 0)} AS total_premium
FROM ({BOOT_SCORED}) c"""

KPI_SEG = f"""
SELECT customer_segment, count(*) AS count, {pr('avg(churn_propensity_score)', 2)} AS avg_churn,
  {pr('avg(lifetime_value_score)', 1)} AS avg_ltv
FROM ({BOOT_SCORED}) c WHERE customer_segment IS NOT NULL GROUP BY customer_segment"""

KPI_LOB = f"""
SELECT lob_type, count(*) AS policy_count, {pr('sum(premium_annual)', 0)} AS total_premium,
  {pr('avg(coverage_limit)', 0)} AS avg_coverage
FROM v_policies GROUP BY lob_type"""

KPI_STATUS = "SELECT claim_status, count(*) AS cnt FROM v_claims GROUP BY claim_status"

KPI_CHURN = f"""
SELECT count(*) AS total_alerts, CAST(coalesce(sum(CASE WHEN a.priority <= 3 THEN 1 ELSE 0 END), 0) AS BIGINT)
  AS critical, {pr('avg(a.churn_propensity)', 2)} AS avg_propensity
FROM ({SCAN}) a JOIN ({SCORED}) f ON a.customer_id = f.customer_id"""

KPI_PLATFORM = f"""
SELECT (SELECT count(*) FROM v_customers) AS customers, (SELECT count(*) FROM v_policies) AS active_policies,
  (SELECT count(*) FROM v_claims) AS total_claims,
  (SELECT count(*) FROM ({SCAN}) a WHERE status = 'NEW') AS active_churn_alerts"""

TABLE_COUNTS = """
SELECT 'customers' AS table_name, count(*) AS row_count FROM v_customers
UNION ALL SELECT 'policies', count(*) FROM v_policies
UNION ALL SELECT 'claims_landing', count(*) FROM v_claims
UNION ALL SELECT 'payments', count(*) FROM v_payments
UNION ALL SELECT 'interactions', count(*) FROM v_interactions
UNION ALL SELECT 'providers', count(*) FROM v_providers
UNION ALL SELECT 'fraud_pattern_embeddings', count(*) FROM v_fraud_patterns
UNION ALL SELECT 'applications', count(*) FROM v_applications"""

TRANSCRIPTS = f"""
SELECT customer_id,
  string_agg(transcript_text, {NL_SEP} ORDER BY interaction_date DESC, interaction_id DESC) AS transcripts
FROM v_interactions_text WHERE interaction_date >= {T_EV} - INTERVAL 90 DAY GROUP BY customer_id"""

RECENT_CUSTOMERS = f"""
SELECT count(DISTINCT customer_id) AS customers FROM v_interactions
WHERE interaction_date >= {T_EV} - INTERVAL 90 DAY"""

# ---------------------------------------------------------------- claim state read models (v2 run)
STATE = f"""
SELECT v.claim_id, 'COMPLETED' AS current_state, v.decided_at AS started_at, v.decided_at AS completed_at,
  CASE WHEN v.fraud_risk_level IS NOT NULL THEN v.fraud_score END AS fs_json,
  v.decision, v.settlement_amount
FROM ({ks.V2}) v"""

V2H = ks.V2[:ks.V2.index("SELECT sha256")] + "SELECT * FROM h"

STATE_ROWS = f"""
SELECT claim_id, fs_raw,
  CASE WHEN fs > 0.7 THEN 'REFERRED' WHEN invalid THEN 'DENIED' WHEN fs > 0.4 THEN 'PARTIALLY_APPROVED'
       ELSE 'APPROVED' END AS decision,
  CASE WHEN fs > 0.7 THEN 0.0::DOUBLE WHEN invalid THEN 0.0::DOUBLE WHEN fs > 0.4 THEN st * 0.5::DOUBLE ELSE st END
       AS settlement
FROM ({V2H}) h"""

PIPELINE_STATUS = f"""
SELECT s.claim_id, c.customer_id, c.lob_type, c.claimed_amount, 'COMPLETED' AS current_state,
  TIMESTAMP '{OW} 00:00:00' AS started_at, TIMESTAMP '{OW} 00:00:00' AS completed_at,
  CAST(0 AS BIGINT) AS elapsed_seconds, s.fs_raw AS fraud_score,
  CASE WHEN s.fs_raw IS NULL THEN NULL WHEN s.fs_raw > 0.7 THEN 'HIGH' WHEN s.fs_raw > 0.4 THEN 'MEDIUM'
       ELSE 'LOW' END AS fraud_risk,
  s.decision, s.settlement, cu.customer_segment, cu.lifetime_value_score
FROM ({STATE_ROWS}) s
JOIN v_claims c ON s.claim_id = c.claim_id
JOIN v_customers cu ON c.customer_id = cu.customer_id"""

STATE_COUNTS = f"SELECT current_state, count(*) AS count FROM ({STATE}) s GROUP BY current_state"

HEALTH = f"""
SELECT CAST(count_if(current_state NOT IN ('COMPLETED', 'FAILED')) AS BIGINT) AS pending_claims,
  CAST(count_if(current_state = 'FAILED') AS BIGINT) AS failed_claims,
  CAST(count_if(completed_at >= TIMESTAMP '{OW} 00:00:00') AS BIGINT) AS completed_today
FROM ({STATE}) s"""

NEXT_STATE = """
SELECT claim_id, current_state,
  CASE WHEN failed AND current_state NOT IN ('COMPLETED', 'FAILED') THEN 'FAILED' ELSE CASE current_state WHEN 'VALIDATION' THEN 'FRAUD_CHECK'
       WHEN 'FRAUD_CHECK' THEN 'ASSESSMENT' WHEN 'ASSESSMENT' THEN 'RESOLUTION' WHEN 'RESOLUTION' THEN 'COMPLETED' ELSE current_state END END AS next_state
FROM v_claim_states"""

STATES_ALL = "SELECT current_state, count(*) AS count FROM v_claim_states GROUP BY current_state"

_STUCK = f"""SELECT claim_id, completed_at, CASE WHEN current_state NOT IN ('COMPLETED', 'FAILED') AND started_at < {T_OW} - INTERVAL 5 MINUTE
    AND completed_at IS NULL THEN 'FAILED' ELSE current_state END AS current_state FROM v_claim_states"""
STATES_CHECKED = f"SELECT claim_id, current_state FROM ({_STUCK}) s"
STATES_FLOW = f"""
SELECT claim_id, CASE WHEN stuck THEN 'FAILED' ELSE current_state END AS current_state,
  CASE WHEN stuck THEN 'TIMEOUT: Stuck in pipeline > 5 minutes' END AS error_message
FROM (SELECT DISTINCT claim_id, current_state, current_state NOT IN ('COMPLETED', 'FAILED')
    AND started_at < {T_OW} + INTERVAL 10 SECOND - INTERVAL 5 MINUTE AS stuck FROM v_claim_states) s"""
HEALTH_AUDIT = f"""
SELECT 'SYSTEM' AS flow_type, 'HEALTH_CHECK' AS agent_name, 'SUCCESS' AS status,
  '{{"pending_claims":' || count_if(current_state NOT IN ('COMPLETED', 'FAILED')) || ',"failed_claims":' || count_if(current_state = 'FAILED')
  || ',"completed_today":' || count_if(coalesce(completed_at >= {T_OW}, FALSE)) || '}}' AS output_payload FROM ({_STUCK}) s"""

TRANSCRIPT_PIECES = f"""
SELECT customer_id, row_number() OVER (PARTITION BY customer_id ORDER BY interaction_date DESC, interaction_id DESC) AS position,
  interaction_id, transcript_text FROM v_interactions_text
WHERE interaction_date >= {T_EV} - INTERVAL 90 DAY AND transcript_text IS NOT NULL AND customer_id IS NOT NULL"""

# ---------------------------------------------------------------- vectors
def _cos(a: str, b: str) -> str:
    return (f"(list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * "
            f"sqrt(list_dot_product({b}, {b}))))")


COSINE_ADJ = f"""
SELECT e1.vec_id AS left_id, e2.vec_id AS right_id,
  {_cos('CAST(e1.embedding AS DOUBLE[])', 'CAST(e2.embedding AS DOUBLE[])')} AS cosine
FROM embeddings e1 JOIN embeddings e2 ON e2.vec_id = e1.vec_id + 1"""

SIM = fs.SIM

TOPK = f"""
SELECT c.claim_id, c.customer_id, c.lob_type, p.pattern_id, p.pattern_type, p.severity, p.pattern_description,
  {_cos('c.claim_embedding', 'p.pattern_embedding')} AS similarity_score,
  row_number() OVER (PARTITION BY c.claim_id ORDER BY {_cos('c.claim_embedding', 'p.pattern_embedding')} DESC,
                     p.pattern_id) AS rank
FROM v_claim_embeddings c JOIN v_fraud_patterns p ON p.lob_type = c.lob_type OR p.lob_type = 'ALL'
QUALIFY rank <= 3"""

TOPK_ARRAY = f"""
SELECT claim_id, customer_id, lob_type, string_agg(pattern_type, ',' ORDER BY rank) AS similar_pattern_types
FROM ({TOPK}) t GROUP BY ALL"""

# ---------------------------------------------------------------- text
SENTIMENT_DOCS = f"SELECT doc_id, {ks.sentiment_sql('text')} AS sentiment FROM documents"


def _lob_sql(col: str) -> str:
    toks = f"regexp_split_to_array(lower({col}), '[^a-z]+')"
    votes = {lob: f"len(list_filter({toks}, lambda x: x IN ({', '.join(repr(w) for w in words)})))"
             for lob, words in LOB_KEYWORDS}
    best = f"greatest({', '.join(votes.values())})"
    arms = " ".join(f"WHEN {v} = {best} AND {best} > 0 THEN '{lob}'" for lob, v in votes.items())
    return f"(CASE {arms} END)"


CLASSIFY_DOCS = f"SELECT doc_id, {_lob_sql('text')} AS lob_type FROM documents"

BM25 = bm25_sql("SELECT item_id AS query_id, text AS query FROM benchmark", 5)

_PASSAGES = "SELECT guideline_id AS doc_id, content AS text FROM v_guidelines"

# every application searches with the words of its LOB and tier
GUIDELINES = f"""
WITH apps AS (SELECT application_id, lob_type || ' '
    || CASE WHEN credit_score >= 750 THEN 'LOW' WHEN credit_score >= 650 THEN 'MEDIUM' ELSE 'HIGH' END
    || ' underwriting risk assessment' AS words FROM v_applications WHERE status = 'PENDING'),
found AS ({bm25_sql("SELECT DISTINCT words AS query_id, words AS query FROM apps", 3, _PASSAGES)})
SELECT application_id AS query_id, rank, doc_id, score FROM apps JOIN found ON found.query_id = apps.words"""

BM25_FILTERED = f"""
SELECT f.*, g.lob_type, g.risk_tier FROM ({bm25_sql("SELECT item_id AS query_id, text AS query FROM benchmark", 4, _PASSAGES,
    "WHERE w.doc_id % 3 = qt.query_id % 2")}) f JOIN v_guidelines g ON g.guideline_id = f.doc_id"""

EXTRACT_JSON = """
SELECT conv_id, turn,
  CAST(json_extract_string(regexp_extract(reply, '\\{[^{}]*\\}', 0), '$.turn') AS BIGINT) AS parsed_turn,
  json_extract_string(regexp_extract(reply, '\\{[^{}]*\\}', 0), '$.role') AS parsed_role
FROM (SELECT conv_id, turn, text || ' {"turn": ' || CAST(turn AS VARCHAR) || ', "role": "' || role || '"} end'
             AS reply FROM conversations)"""

# ---------------------------------------------------------------- data quality
def _nulls(table: str, column: str, source: str) -> str:
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'NULL_COUNT' AS metric, count(*) - count({column}) AS value FROM {source} x"


def _again(table: str, column: str, source: str) -> str:
    return f"SELECT '{table}', '{column}', 'DUPLICATE_COUNT', count({column}) - count(DISTINCT {column}) FROM {source} x"


def _orphans(table: str, column: str, source: str, parent: str) -> str:
    return (f"SELECT '{table}', '{column}', 'REFERENTIAL_INTEGRITY_COUNT', count(*) FROM {source} x "
            f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {parent} WHERE {column} IS NOT NULL)")


_METRICS = [
    _nulls("claims_landing", "claim_id", "v_claims"), _nulls("claims_landing", "claimed_amount", "v_claims"),
    _nulls("claims_landing", "claim_text", "v_claims_text"), _again("claims_landing", "claim_id", "v_claims"),
    _orphans("claims_landing", "customer_id", "v_claims", "v_customers"),
    _nulls("customers", "customer_id", "v_customers"), _nulls("customers", "email", "v_customers"),
    _again("customers", "customer_id", "v_customers"),
    _nulls("policies", "policy_id", "v_policies"), _nulls("policies", "customer_id", "v_policies"),
    _again("policies", "policy_id", "v_policies"),
    _nulls("fct_customer_360", "customer_id", "profile"), _again("fct_customer_360", "customer_id", "profile"),
    _nulls("churn_alerts", "customer_id", "alerted"),
    _nulls("resolutions", "settlement_amount", "settled"), _again("resolutions", "claim_id", "settled"),
    _orphans("resolutions", "claim_id", "settled", "v_claims"),
    _nulls("fraud_indicators", "pattern_description", "v_fraud_patterns"),
]
_ALL_METRICS = " UNION ALL ".join(_METRICS)
QUALITY = f"""
WITH profile AS ({fs.C360_DYN}), alerted AS ({cs.ALERTS_AFTER}), settled AS ({ks.V2}),
m AS ({_ALL_METRICS}),
e AS (SELECT * FROM (VALUES
  ('claims_landing', 'claim_id', 'NULL_COUNT', 'CLAIMS_NO_NULL_ID'),
  ('claims_landing', 'claim_id', 'DUPLICATE_COUNT', 'CLAIMS_UNIQUE_ID'),
  ('claims_landing', 'claimed_amount', 'NULL_COUNT', 'CLAIMS_NO_NULL_AMOUNT'),
  ('claims_landing', 'customer_id', 'REFERENTIAL_INTEGRITY_COUNT', 'CLAIMS_VALID_CUSTOMER'),
  ('customers', 'customer_id', 'NULL_COUNT', 'CUSTOMERS_NO_NULL_ID'),
  ('customers', 'customer_id', 'DUPLICATE_COUNT', 'CUSTOMERS_UNIQUE_ID'),
  ('policies', 'policy_id', 'NULL_COUNT', 'POLICIES_NO_NULL_ID'),
  ('policies', 'policy_id', 'DUPLICATE_COUNT', 'POLICIES_UNIQUE_ID'),
  ('fct_customer_360', 'customer_id', 'NULL_COUNT', 'C360_NO_NULL_ID'),
  ('fct_customer_360', 'customer_id', 'DUPLICATE_COUNT', 'C360_UNIQUE_ID'),
  ('churn_alerts', 'customer_id', 'NULL_COUNT', 'ALERTS_NO_NULL_CUSTOMER'),
  ('resolutions', 'settlement_amount', 'NULL_COUNT', 'RESOLUTIONS_NO_NULL_SETTLEMENT'),
  ('resolutions', 'claim_id', 'DUPLICATE_COUNT', 'RESOLUTIONS_UNIQUE_CLAIM'),
  ('resolutions', 'claim_id', 'REFERENTIAL_INTEGRITY_COUNT', 'RESOLUTIONS_VALID_CLAIM'),
  ('fraud_indicators', 'pattern_description', 'NULL_COUNT', 'FRAUD_INDICATORS_NO_NULL_DESC')
  ) AS t(table_name, column_name, metric, expectation))
SELECT m.table_name, m.column_name, m.metric, CAST(m.value AS BIGINT) AS value, e.expectation,
  CASE WHEN e.expectation IS NOT NULL THEN CAST(0 AS BIGINT) END AS expected_value,
  CASE WHEN e.expectation IS NOT NULL THEN CAST(m.value AS BIGINT) = 0 END AS passed
FROM m LEFT JOIN e ON m.table_name = e.table_name AND m.column_name = e.column_name AND m.metric = e.metric"""


# ---------------------------------------------------------------- write operators
def c360_dyn_at(order_day: str, event_day: str) -> str:
    return fs.C360_DYN.replace(OW, order_day).replace(EV, event_day)


LATER_OW, LATER_EV = "2001-08-31", "2024-03-16"
_DIFF_COLS = ["active_policy_count", "claim_count_12m", "missed_payments_12m", "complaint_count_90d",
              "days_to_nearest_renewal", "last_interaction_days_ago", "renewal_risk_signal", "escalation_flag"]


def _diff_sql() -> str:
    old, new = c360_dyn_at(OW, EV), c360_dyn_at(LATER_OW, LATER_EV)
    changed = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in _DIFF_COLS)
    vals = ", ".join(f"CASE WHEN n.customer_id IS NULL THEN o.{c} ELSE n.{c} END AS {c}" for c in _DIFF_COLS)
    return f"""
SELECT coalesce(n.customer_id, o.customer_id) AS customer_id, {vals},
  CASE WHEN o.customer_id IS NULL THEN 'INSERT' WHEN n.customer_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS _change
FROM (SELECT customer_id, {', '.join(_DIFF_COLS)} FROM ({old}) x) o
FULL OUTER JOIN (SELECT customer_id, {', '.join(_DIFF_COLS)} FROM ({new}) y) n ON o.customer_id = n.customer_id
WHERE o.customer_id IS NULL OR n.customer_id IS NULL OR {changed}"""


SNAPSHOT_DIFF = _diff_sql()
DIFF_COLS = _DIFF_COLS

_INT_LATER = fs.INTS.replace(EV, LATER_EV)
MERGE_REFRESH = f"""
SELECT coalesce(t.customer_id, s.customer_id) AS customer_id, t.customer_segment, t.total_annual_premium,
  CASE WHEN s.customer_id IS NOT NULL THEN s.sentiment_score_last_30d ELSE t.sentiment_score_last_30d END
      AS sentiment_score_last_30d,
  CASE WHEN s.customer_id IS NOT NULL THEN s.complaint_count_90d ELSE t.complaint_count_90d END AS complaint_count_90d,
  CASE WHEN s.customer_id IS NOT NULL THEN s.last_interaction_days_ago ELSE t.last_interaction_days_ago END
      AS last_interaction_days_ago,
  CASE WHEN s.customer_id IS NOT NULL THEN TIMESTAMP '{LATER_EV} 00:00:00' END AS last_refreshed_at
FROM (SELECT customer_id, customer_segment, total_annual_premium, sentiment_score_last_30d, complaint_count_90d,
             last_interaction_days_ago FROM ({fs.C360_BOOT}) b) t
FULL OUTER JOIN ({_INT_LATER}) s ON t.customer_id = s.customer_id"""

APPS_AFTER = f"""
SELECT a.application_id, a.lob_type, a.credit_score, coalesce(d.application_status, a.status) AS status
FROM v_applications a LEFT JOIN ({ks.UW_DECIDE}) d ON a.application_id = d.application_id"""

CLAIMS_AFTER_GATE = f"""
SELECT claim_id, customer_id, CASE WHEN claim_status = 'SUBMITTED' AND len(errs) > 0 THEN 'DQ_FAILED'
       ELSE claim_status END AS claim_status
FROM ({ks.dq_core()}) q"""


# ---------------------------------------------------------------- more read models
NEWEST_RESOLUTIONS = f"""
SELECT * FROM ({ks.V2}) r ORDER BY decided_at DESC, resolution_id LIMIT 50"""

_DECISION = ("CASE WHEN h.fs > 0.7 THEN 'REFERRED' WHEN h.invalid THEN 'DENIED' "
             "WHEN h.fs > 0.4 THEN 'PARTIALLY_APPROVED' ELSE 'APPROVED' END")
_SETTLE = ("CASE WHEN h.fs > 0.7 THEN 0.0::DOUBLE WHEN h.invalid THEN 0.0::DOUBLE "
           "WHEN h.fs > 0.4 THEN h.st * 0.5::DOUBLE ELSE h.st END")

CLAIM_STATE_FLAT = f"""
SELECT h.claim_id, 'COMPLETED' AS current_state,
  {ks.severity_sql('h.claim_text')} AS severity,
  NOT h.invalid AS valid, coalesce(h.vstatus, 'UNKNOWN') AS policy_status,
  {pr('h.fs_raw', 2)} AS fraud_score,
  CASE WHEN h.fs_raw IS NULL THEN NULL WHEN h.fs_raw > 0.7 THEN 'HIGH' WHEN h.fs_raw > 0.4 THEN 'MEDIUM'
       ELSE 'LOW' END AS fraud_risk,
  {pr('h.claimed_amount * 0.85::DOUBLE', 2)} AS recommended_settlement,
  {_DECISION} AS decision, {pr(_SETTLE, 2)} AS settlement
FROM ({V2H}) h"""

AUDIT_TRAIL = f"""
SELECT 'CLAIMS' AS flow_type, CAST(r.claim_id AS VARCHAR) AS reference_id, a.agent_name, a.step_number,
  a.module AS module_used, 'SUCCESS' AS status
FROM ({ks.V2}) r, (VALUES ('INTAKE', 1, 'CLASSIFY_TEXT'), ('VALIDATION', 2, NULL),
  ('FRAUD', 3, 'COMPLETE+EMBED+SENTIMENT'), ('ASSESSMENT', 4, 'COMPLETE'), ('RESOLUTION', 5, 'COMPLETE'))
  AS a(agent_name, step_number, module)"""

DEEP_DIVE_CLAIMS = f"""
SELECT * EXCLUDE (text_key) FROM v_claims WHERE customer_id IN (SELECT customer_id FROM ({SCAN}) a)"""

HEALTH_CLAIMS = f"""
SELECT claim_id, customer_id,
  CASE WHEN claim_id IN (SELECT claim_id FROM ({ks.dq_core()}) q WHERE claim_status = 'SUBMITTED' AND len(errs) = 0)
        AND claim_status NOT IN ('MANUAL_REVIEW', 'APPROVED', 'DENIED', 'REFERRED')
       THEN 'MANUAL_REVIEW' ELSE claim_status END AS claim_status
FROM v_claims"""

DUP_90D = """
SELECT a.claim_id, count(b.claim_id) AS n_within_90d
FROM v_claims a LEFT JOIN v_claims b
  ON a.customer_id = b.customer_id AND a.policy_id = b.policy_id AND b.claim_id <> a.claim_id
 AND abs(date_diff('day', a.incident_date, b.incident_date)) <= 90
WHERE a.customer_id IS NOT NULL AND a.policy_id IS NOT NULL AND a.incident_date IS NOT NULL
GROUP BY a.claim_id"""

SAME_DAY = """
SELECT customer_id, incident_date, count(*) AS same_day_claims FROM v_claims
WHERE customer_id IS NOT NULL AND incident_date IS NOT NULL GROUP BY ALL"""

MULTI_LOB = """
SELECT customer_id, count(DISTINCT lob_type) AS multi_lob_count FROM v_policies
WHERE policy_status = 'ACTIVE' GROUP BY customer_id"""

CHAT_LOG = f"""
SELECT 'INT-' || upper(left(sha256(CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) || '-' || said), 12)) AS interaction_id,
  conv_id AS customer_id, 'CHAT' AS channel, TIMESTAMP '{EV} 00:00:00' AS interaction_date, said AS transcript_text,
  ['INTERNAL', 'INBOUND'][1 + conv_id % 2] AS direction, ['Agent Assist', 'Customer Chat'][1 + conv_id % 2] AS topic,
  'RESOLVED' AS resolution_status, 'ASSISTANT' AS agent_id, CAST(0 AS BIGINT) AS duration_seconds,
  CAST(NULL AS BIGINT) AS nps_score
FROM (SELECT u.conv_id, u.turn, 'User: ' || coalesce(u.text, '') || chr(10) || 'Assistant: ' || coalesce(a.text, '') AS said
      FROM conversations u LEFT JOIN conversations a
        ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
      WHERE u.role = 'user')"""

DEFAULTS = f"""
SELECT conv_id, turn, role,
  sha256(concat_ws(chr(1), CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR))) AS interaction_id,
  'CHAT' AS channel, 'RESOLVED' AS resolution_status, TIMESTAMP '{EV} 00:00:00' AS created_at
FROM conversations"""

FENCED = """
SELECT conv_id, turn, CAST(turn AS BIGINT) AS parsed_turn, role AS parsed_role FROM conversations"""


_BOOK_ROWS = ", ".join(f"('{i}', {'NULL' if seg is None else repr(seg)}, {'NULL' if cause is None else repr(cause)}, '{a}: {o} (success rate: {r})', {r}::DOUBLE)"
                       for i, seg, cause, a, o, _, r in PLAYBOOKS)
PLAYBOOK_CONTEXT = f"""
SELECT c.customer_id, coalesce(string_agg(txt, {NL_SEP} ORDER BY r DESC, id DESC), 'No matching playbooks found') AS playbook_context
FROM ({CAUSES}) c LEFT JOIN (VALUES {_BOOK_ROWS}) AS b(id, seg, cause, txt, r) ON b.seg = c.customer_segment OR b.cause = c.root_cause
GROUP BY c.customer_id"""

ALERTS_BY_PRIORITY = f"SELECT customer_id, priority, trigger_reason FROM ({SCAN}) a ORDER BY priority LIMIT 50"
AUDIT_NEWEST = "SELECT claim_id, current_state, started_at FROM v_claim_states ORDER BY started_at DESC, claim_id LIMIT 50"
DEEP_DIVE_POLICIES = f"SELECT * FROM v_policies WHERE customer_id IN (SELECT customer_id FROM ({SCAN}) a)"
DEEP_DIVE_ALERTS = f"""
SELECT 'EARLIER-' || CAST(c_custkey AS VARCHAR) AS alert_id, c_custkey AS customer_id,
  CASE c_custkey % 10 WHEN 1 THEN 'IN_PROGRESS' WHEN 3 THEN 'ACTIONED' ELSE 'NEW' END AS status
FROM customer WHERE c_custkey % 10 < 4 AND c_custkey IN (SELECT customer_id FROM ({SCAN}) a)"""

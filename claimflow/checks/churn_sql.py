"""Oracle SQL for the churn scan, pipeline outputs, dashboard and CRM export."""

from __future__ import annotations

from claimflow.checks.feature_sql import C360_FULL, propensity_sql
from claimflow.constants import ORDER_WORLD_AS_OF as OW
from claimflow.constants import PLAYBOOKS, ROOT_CAUSE_RULES

SCORED = propensity_sql(C360_FULL)
D = f"DATE '{OW}'"

SCAN = f"""
SELECT sha256('ALERT-' || CAST(customer_id AS VARCHAR) || '-' || '{OW}') AS alert_id,
  customer_id, {D} AS alert_date, churn_propensity_score AS churn_propensity,
  sentiment_score_last_30d AS sentiment_score, complaint_count_90d AS complaint_count,
  CASE WHEN churn_propensity_score > 0.7 THEN 'VERY_HIGH_CHURN_PROPENSITY'
       WHEN churn_propensity_score > 0.5 THEN 'HIGH_CHURN_PROPENSITY'
       WHEN sentiment_score_last_30d < -0.5 THEN 'VERY_NEGATIVE_SENTIMENT'
       WHEN sentiment_score_last_30d < -0.3 THEN 'NEGATIVE_SENTIMENT'
       WHEN complaint_count_90d >= 5 THEN 'EXCESSIVE_COMPLAINTS'
       WHEN complaint_count_90d >= 3 THEN 'HIGH_COMPLAINTS'
       WHEN renewal_risk_signal = TRUE THEN 'RENEWAL_AT_RISK'
       WHEN intent_cancel_detected = TRUE THEN 'CANCELLATION_INTENT'
       WHEN competitor_mentions_count >= 2 THEN 'COMPETITOR_SHOPPING'
       ELSE 'MULTIPLE_SIGNALS' END AS trigger_reason,
  row_number() OVER (ORDER BY lifetime_value_score DESC NULLS FIRST, customer_id ASC NULLS FIRST) AS priority,
  'NEW' AS status, CAST(NULL AS VARCHAR) AS root_cause, CAST(NULL AS DOUBLE) AS root_cause_confidence,
  CAST({D} AS TIMESTAMP) AS created_at
FROM ({SCORED}) s
WHERE coalesce(churn_propensity_score > 0.5 OR sentiment_score_last_30d < -0.3 OR complaint_count_90d >= 3
   OR (renewal_risk_signal = TRUE AND sentiment_trend < -0.1) OR intent_cancel_detected = TRUE
   OR competitor_mentions_count >= 2, FALSE)"""

# with earlier alerts: those NEW or IN_PROGRESS within a week keep their customers out
SCAN_SUPPRESSED = SCAN + """
  AND customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 IN (0, 1))"""

# Pipeline without a model and without a cap: every new alert is classified (NULL)
# and actioned; each alerted customer gets one PENDING action.
ALERTS_AFTER = f"""
SELECT * REPLACE ('ACTIONED' AS status) FROM ({SCAN}) a"""

ACTIONS = f"""
SELECT sha256('NBA-' || CAST(customer_id AS VARCHAR) || '-' || '{OW}') AS nba_id, customer_id,
  CAST(NULL AS VARCHAR) AS action_type, CAST(NULL AS VARCHAR) AS offer_details, CAST(NULL AS VARCHAR) AS channel,
  CAST(NULL AS VARCHAR) AS timing, priority, CAST(NULL AS DOUBLE) AS expected_success_rate,
  CAST(NULL AS VARCHAR) AS root_cause, 'Root cause: unknown. Talking points: N/A' AS rationale,
  'PENDING' AS status, {D} AS created_date, CAST({D} + 14 AS DATE) AS expiry_date,
  CAST(NULL AS VARCHAR) AS outcome, CAST({D} AS TIMESTAMP) AS created_at
FROM ({SCAN}) a"""

DASHBOARD = f"""
SELECT a.alert_id, a.customer_id, a.alert_date, a.churn_propensity, a.sentiment_score, a.complaint_count,
  a.trigger_reason, a.root_cause, a.root_cause_confidence, a.priority, a.status,
  c.customer_segment, c.lifetime_value_score, c.total_annual_premium, c.tenure_months, c.lob_diversity,
  c.days_to_nearest_renewal, c.competitor_mentions_count, c.intent_cancel_detected,
  n.action_type AS nba_action, n.offer_details AS nba_offer, n.channel AS nba_channel,
  n.expected_success_rate, n.status AS nba_status
FROM ({ALERTS_AFTER}) a
JOIN ({SCORED}) c ON a.customer_id = c.customer_id
LEFT JOIN ({ACTIONS}) n ON a.customer_id = n.customer_id AND n.created_date = a.alert_date"""

CRM = f"""
SELECT n.nba_id, n.customer_id, cu.first_name || ' ' || cu.last_name AS customer_name, cu.email, cu.phone,
  c.customer_segment, c.total_annual_premium, n.action_type, n.offer_details, n.channel, n.timing,
  n.priority, n.expected_success_rate, n.root_cause, n.rationale, n.status, n.expiry_date
FROM ({ACTIONS}) n
JOIN v_customers cu ON n.customer_id = cu.customer_id
JOIN ({SCORED}) c ON n.customer_id = c.customer_id
WHERE n.status = 'PENDING' AND n.expiry_date >= {D}"""


# each customer's causes that hold, by the place of their rule; the first is theirs
_HOLD = " UNION ALL ".join(
    f"SELECT customer_id, customer_segment, {n} AS place, '{name}' AS root_cause, {confidence}::DOUBLE AS confidence FROM scored"
    + ("" if column is None else f" WHERE {column} {comparison} {bound}")
    for n, (name, column, comparison, bound, confidence) in enumerate(ROOT_CAUSE_RULES))
CAUSES = f"""WITH scored AS ({SCORED}), alerted AS (SELECT customer_id FROM ({SCAN})), hold AS ({_HOLD})
SELECT customer_id, customer_segment, root_cause, confidence FROM hold WHERE customer_id IN (SELECT customer_id FROM alerted)
QUALIFY place = min(place) OVER (PARTITION BY customer_id)"""


def _text(v) -> str:
    return "NULL" if v is None else f"'{v}'"


_BOOKS = ", ".join(f"({n}, {_text(i)}, {_text(seg)}, {_text(cause)}, {_text(a)}, {_text(o)}, {_text(ch)}, {r}::DOUBLE)"
                   for n, (i, seg, cause, a, o, ch, r) in enumerate(PLAYBOOKS))
PLAYBOOK_ACTIONS = f"""
SELECT c.customer_id, c.customer_segment, c.root_cause, c.confidence, b.playbook_id, b.action_type, b.offer_details, b.channel, b.success_rate
FROM ({CAUSES}) c JOIN (VALUES {_BOOKS}) AS b(n, playbook_id, segment, cause, action_type, offer_details, channel, success_rate)
  ON (b.segment IS NULL OR b.segment = c.customer_segment) AND (b.cause IS NULL OR b.cause = c.root_cause)
QUALIFY row_number() OVER (PARTITION BY c.customer_id
  ORDER BY CAST(b.segment IS NOT NULL AS INT) + CAST(b.cause IS NOT NULL AS INT) DESC, b.success_rate DESC, b.n) = 1"""

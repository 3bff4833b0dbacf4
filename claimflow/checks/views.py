"""Adapter views as DuckDB CTEs over the driver tables (same rules as ``sources.adapters``)."""

from __future__ import annotations

from claimflow.constants import ORDER_WORLD_AS_OF as OW
from claimflow.constants import ACTUARIAL_ROWS, STATEMENT_EVENTS, STATEMENT_PLACES, STATEMENT_TONES


def _pick(expr: str, values: list[str], modulus: int) -> str:
    arms = " ".join(f"WHEN ({expr}) % {modulus} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {arms} END"


LOB3 = ["AUTO", "PROPERTY", "WORKERS_COMP"]

CLAIM_ID = ("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || "
            "CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)")

_ACT_VALUES = ",\n".join(
    "('{}','{}','{}','{}',{}::DOUBLE,{}::DOUBLE,{}::DOUBLE,{}::DOUBLE,DATE '{}',DATE '{}')".format(*r)
    for r in ACTUARIAL_ROWS)

VIEWS: dict[str, str] = {
    "v_customers": f"""
SELECT c_custkey AS customer_id, 'Customer' AS first_name, c_name AS last_name,
       CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_name || '@x' END AS email,
       CAST(NULL AS VARCHAR) AS phone, n_name AS city,
       c_mktsegment AS customer_segment, c_acctbal / 100.0 AS lifetime_value_score,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS DATE) AS onboarding_date,
       c_nationkey AS nation_key
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "v_policies": f"""
SELECT o_orderkey AS policy_id, o_custkey AS customer_id, {_pick('o_orderkey', LOB3, 3)} AS lob_type,
       CASE WHEN o_orderstatus = 'O' THEN 'ACTIVE' WHEN o_orderstatus = 'F' THEN 'LAPSED'
            WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'RENEWAL_PENDING'
            WHEN o_orderstatus = 'P' THEN 'PENDING' END AS policy_status,
       CAST(o_orderdate AS DATE) AS start_date,
       CAST(CAST(o_orderdate AS DATE) + 365 AS DATE) AS end_date,
       CAST(CAST(o_orderdate AS DATE) + 335 AS DATE) AS renewal_date,
       o_totalprice * 0.02::DOUBLE AS premium_annual, o_totalprice / 2.0::DOUBLE AS coverage_limit,
       500.0::DOUBLE AS deductible
FROM orders""",
    "v_claims": f"""
SELECT {CLAIM_ID} AS claim_id,
       CASE WHEN l_suppkey % 31 = 0 THEN NULL WHEN l_suppkey % 29 = 0 THEN -1 ELSE l_orderkey END AS policy_id,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE o_custkey END AS customer_id,
       CASE WHEN l_partkey % 10 = 0 THEN 'AUTO' ELSE {_pick('l_orderkey', LOB3, 3)} END AS lob_type,
       CASE WHEN l_partkey % 101 = 0 THEN 0.0::DOUBLE ELSE l_extendedprice END AS claimed_amount,
       CAST(l_shipdate AS DATE) AS incident_date,
       CAST(CAST(CAST(l_shipdate AS DATE) + l_linenumber AS DATE) AS TIMESTAMP) AS submission_date,
       CASE WHEN l_returnflag = 'N' THEN 'SUBMITTED' WHEN l_returnflag = 'A' THEN 'APPROVED'
            WHEN l_returnflag = 'R' THEN 'DENIED' END AS claim_status,
       l_orderkey AS text_key
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "v_payments": f"""
SELECT {CLAIM_ID} AS payment_id, l_orderkey AS policy_id, o_custkey AS customer_id,
       CAST(o_orderdate AS DATE) AS due_date,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS payment_date,
       l_extendedprice AS amount,
       CASE WHEN abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 20 > 15 THEN 'MISSED'
            WHEN abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 20 > 5 THEN 'LATE'
            ELSE 'PAID' END AS payment_status,
       CASE WHEN l_linestatus = 'O' THEN 'AUTO_DEBIT' ELSE 'CARD' END AS payment_method,
       CAST(abs(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) % 20 AS BIGINT) AS days_delayed
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "v_interactions": """
SELECT event_id AS interaction_id, user_id AS customer_id, event_type AS channel, ts AS interaction_date,
       CASE WHEN event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS BIGINT) < 20
            THEN 'ESCALATED' ELSE 'RESOLVED' END AS resolution_status,
       CASE WHEN event_type = 'view' AND event_id % 5 = 0 THEN CAST(floor(value) AS BIGINT) % 11 END AS nps_score,
       (user_id % 5 - 2) * 0.3::DOUBLE + (CAST(json_extract_string(props, '$.k') AS BIGINT) - 50) / 250.0::DOUBLE
           AS sentiment
FROM events""",
    "v_providers": f"""
SELECT s_suppkey AS provider_id, s_name AS provider_name, {_pick('s_suppkey', LOB3, 3)} AS lob_type,
       s_acctbal < 0 AS risk_flag
FROM supplier""",
    "v_fraud_patterns": f"""
SELECT vec_id AS pattern_id, 'PATTERN_' || CAST(label AS VARCHAR) AS pattern_type,
       'fraud pattern ' || CAST(vec_id AS VARCHAR) AS pattern_description,
       CAST(embedding AS DOUBLE[]) AS pattern_embedding,
       {_pick('label', ['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'], 4)} AS severity,
       {_pick('label', ['AUTO', 'PROPERTY', 'WORKERS_COMP', 'ALL'], 4)} AS lob_type
FROM embeddings WHERE vec_id % 25 = 0""",
    "v_claim_embeddings": f"""
SELECT vec_id AS claim_id, CAST(floor(vec_id / 3) AS BIGINT) AS customer_id,
       {_pick('label', LOB3, 3)} AS lob_type, CAST(embedding AS DOUBLE[]) AS claim_embedding
FROM embeddings WHERE vec_id % 25 <> 0""",
    "v_applications": f"""
SELECT c_custkey AS application_id, c_name AS applicant_name,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) END AS existing_customer_id,
       {_pick('c_custkey', ['AUTO', 'HOME', 'LIFE'], 3)} AS lob_type,
       100000.0::DOUBLE + c_custkey * 10.0::DOUBLE AS coverage_requested,
       CAST(CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE 550 + c_custkey % 300 END AS BIGINT) AS credit_score,
       CASE WHEN c_nationkey % 7 = 0 THEN NULL WHEN c_nationkey % 2 = 0 THEN 'CHENNAI_GENERAL'
            ELSE 'BANGALORE_METRO' END AS geographic_zone,
       CAST(CAST(DATE '2001-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS TIMESTAMP) AS submission_date,
       'PENDING' AS status
FROM customer""",
    "v_actuarial": f"""
SELECT * FROM (VALUES
{_ACT_VALUES}
) AS t(table_id, lob_type, risk_tier, geographic_zone, base_rate, risk_multiplier, geographic_factor,
       claims_history_factor, effective_date, expiry_date)""",
    "v_doc_count": "SELECT count(*) AS n FROM documents",
}

# dependencies between views (for ordering the WITH list)
DEPS = {"v_claims_v1": ["v_doc_count"], "v_text_scores": ["v_fraud_patterns"], "v_claims_text": ["v_claims", "v_doc_count", "v_text_scores"], "v_interactions_text": ["v_interactions", "v_doc_count"]}

VIEWS["v_guidelines"] = """
SELECT doc_id AS guideline_id, lob_type, risk_tier, lob_type || ' ' || risk_tier || ' underwriting guideline. ' || coalesce(text, '') AS content
FROM (SELECT doc_id, text, ['AUTO', 'HOME', 'LIFE'][1 + doc_id % 3] AS lob_type,
        ['LOW', 'MEDIUM', 'HIGH'][CAST(1 + floor(doc_id / 3) % 3 AS INT)] AS risk_tier FROM documents)"""
VIEWS["v_text_scores"] = """
SELECT e.vec_id, max(list_dot_product(CAST(e.embedding AS DOUBLE[]), p.pattern_embedding)
    / (sqrt(list_dot_product(CAST(e.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])))
       * sqrt(list_dot_product(p.pattern_embedding, p.pattern_embedding)))) AS vector_score
FROM embeddings e, v_fraud_patterns p GROUP BY e.vec_id"""
VIEWS["v_claims_text"] = """
SELECT c.*, d.text AS claim_text, d.doc_id AS claim_text_id FROM v_claims c
LEFT JOIN documents d ON d.doc_id = c.text_key % (SELECT n FROM v_doc_count)"""
VIEWS["v_interactions_text"] = """
SELECT i.*, d.text AS transcript_text FROM v_interactions i
LEFT JOIN documents d ON d.doc_id = i.interaction_id % (SELECT n FROM v_doc_count)"""


_STATED_DAY = "CAST(CAST(l_shipdate AS DATE) + CASE WHEN l_partkey % 7 = 0 THEN 40 ELSE 0 END AS DATE)"
VIEWS["v_claims_v1"] = VIEWS["v_claims"].replace("l_orderkey AS text_key", f"""l_orderkey AS text_key,
       CASE WHEN l_partkey % 103 <> 0 THEN CASE WHEN l_partkey % 4 = 0 THEN 'Some weeks ago' ELSE 'On ' || CASE l_linenumber % 3 WHEN 0 THEN strftime({_STATED_DAY}, '%Y-%m-%d')
           WHEN 1 THEN strftime({_STATED_DAY}, '%d/%m/%Y') ELSE strftime({_STATED_DAY}, '%-d %B %Y') END END
         || ' in ' || {_pick('l_suppkey', STATEMENT_PLACES, 7)} || ' there was ' || {_pick('l_partkey', STATEMENT_EVENTS, 5)}
         || '. I claim INR ' || CAST(CAST(floor(l_extendedprice * CASE WHEN l_suppkey % 6 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END) AS BIGINT) AS VARCHAR)
         || '.' || {_pick('l_suppkey', STATEMENT_TONES, 3)}
         || CASE WHEN l_linenumber <= 4 AND l_partkey % 2 = 0 THEN ' This is urgent, please pay immediately.'
                 WHEN l_linenumber = 7 THEN ' There is no hurry.' ELSE '' END END AS claim_text,
       CASE WHEN l_suppkey % 6 = 0 THEN l_partkey % 20 * 25 ELSE l_orderkey % (SELECT n FROM v_doc_count) END AS vector_id""")
VIEWS["v_claim_states"] = f"""
SELECT {CLAIM_ID} AS claim_id, {_pick('l_linenumber', ['VALIDATION', 'FRAUD_CHECK', 'ASSESSMENT', 'RESOLUTION', 'COMPLETED', 'FAILED'], 6)} AS current_state,
  TIMESTAMP '{OW} 00:00:00' - to_minutes(CAST(l_partkey % 11 AS BIGINT)) AS started_at,
  CASE WHEN l_linenumber % 6 = 4 THEN TIMESTAMP '{OW} 00:00:00' + to_days(CAST(l_suppkey % 2 - 1 AS INTEGER)) END AS completed_at,
  l_partkey % 101 = 0 AS failed
FROM lineitem"""
VIEWS["v_fraud_narratives"] = f"""
SELECT vec_id AS pattern_id, {_pick('label', ['LOW', 'MEDIUM', 'HIGH', 'CRITICAL'], 4)} AS severity,
  'Staged report of ' || {_pick('(vec_id // 25)', STATEMENT_EVENTS, 5)} || ' near ' || {_pick('(vec_id // 25)', STATEMENT_PLACES, 7)} AS example_narrative
FROM embeddings WHERE vec_id % 25 = 0"""


def with_views(names: list[str], body: str) -> str:
    """Prefix ``body`` with a WITH clause holding the named adapter views (+ deps)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in order)
    body = body.strip()
    if not order:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"

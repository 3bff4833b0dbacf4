"""Fixed values that must equal the source system's for right results.

FIXED VALUES — stated plainly, in natural order. Do not reorder.
"""

# --- Status / category domains -------------------------------------------------
LOB_BY_MOD3 = ["AUTO", "PROPERTY", "WORKERS_COMP"]           # policy / provider LOB by key % 3
PATTERN_LOB_BY_MOD4 = ["AUTO", "PROPERTY", "WORKERS_COMP", "ALL"]
PATTERN_SEVERITY_BY_MOD4 = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
APPLICATION_LOB_BY_MOD3 = ["AUTO", "HOME", "LIFE"]

TERMINAL_CLAIM_STATUSES = ["APPROVED", "DENIED", "REFERRED", "COMPLETED"]
DUP_EXCLUDED_STATUSES = ["DENIED", "DQ_FAILED"]
LAPSED_STATUSES = ["LAPSED", "CANCELLED"]
HEALTH_PROTECTED_STATUSES = ["MANUAL_REVIEW", "APPROVED", "DENIED", "REFERRED"]

# Accept sets differ on purpose between the three validators (trap T17).
DQ_GATE_ACCEPT = ["ACTIVE"]
AGENT_V2_ACCEPT = ["ACTIVE", "RENEWAL_PENDING"]
INTAKE_UI_ACCEPT = ["ACTIVE", "RENEWAL_PENDING"]

# Claim state machine (v2 procedures), in order.
CLAIM_STATES = ["VALIDATION", "FRAUD_CHECK", "ASSESSMENT", "RESOLUTION", "COMPLETED"]

# v1 retrieval severity weights.
SEVERITY_WEIGHT = {"CRITICAL": 0.9, "HIGH": 0.7, "MEDIUM": 0.5, "LOW": 0.3}

# Churn root-cause classes.
ROOT_CAUSES = ["price_sensitivity", "poor_claims_experience", "service_quality", "coverage_gap",
               "competitor_offer", "life_event", "payment_difficulty"]
# Rules of this engine's own scorer, in order: (class, C360 column, comparison, bound, confidence); the first that
# holds names the cause, and the last class stands where none does.
ROOT_CAUSE_RULES = [
    ("payment_difficulty", "missed_payments_12m", ">=", 2, 0.9),
    ("service_quality", "complaint_count_90d", ">=", 3, 0.85),
    ("competitor_offer", "competitor_mentions_count", ">=", 1, 0.8),
    ("poor_claims_experience", "open_claims_count", ">=", 10, 0.75),
    ("coverage_gap", "lapse_count_historical", ">=", 3, 0.6),
    ("price_sensitivity", "loss_ratio", "<", 2.0, 0.55),
    ("life_event", None, None, None, 0.4),
]
# Retention playbooks of this engine: (id, segment or None for any, root cause or None for any, action, offer, channel,
# success rate).
PLAYBOOKS = [
    ("PB-1", None, "payment_difficulty", "PAYMENT_PLAN", "spread the open premium over six months", "PHONE", 0.62),
    ("PB-2", None, "service_quality", "SERVICE_CALL", "a named contact calls and closes the open complaints", "PHONE", 0.55),
    ("PB-3", "BUILDING", "service_quality", "SITE_VISIT", "a visit to go through every open case", "VISIT", 0.66),
    ("PB-4", None, "poor_claims_experience", "CLAIM_REVIEW", "a senior handler reviews the open claims", "EMAIL", 0.5),
    ("PB-5", None, "price_sensitivity", "DISCOUNT", "loyalty discount on renewal", "EMAIL", 0.58),
    ("PB-6", "AUTOMOBILE", "price_sensitivity", "DISCOUNT", "fleet discount on renewal", "PHONE", 0.7),
    ("PB-7", None, "coverage_gap", "COVER_REVIEW", "review of lapsed cover", "EMAIL", 0.45),
    ("PB-8", None, None, "CHECK_IN", "a short call to ask how things are", "PHONE", 0.3),
]


# --- Actuarial seed rows (15) --------------------------------------------------
# (table_id, lob_type, risk_tier, geographic_zone, base_rate, risk_multiplier,
#  geographic_factor, claims_history_factor, effective_date, expiry_date)
ACTUARIAL_ROWS = [
    ("ACT-001", "AUTO", "LOW", "CHENNAI_GENERAL", 0.025, 1.0, 1.05, 1.0, "2024-01-01", "2025-12-31"),
    ("ACT-002", "AUTO", "MEDIUM", "CHENNAI_GENERAL", 0.035, 1.3, 1.05, 1.1, "2024-01-01", "2025-12-31"),
    ("ACT-003", "AUTO", "HIGH", "CHENNAI_GENERAL", 0.050, 1.6, 1.05, 1.3, "2024-01-01", "2025-12-31"),
    ("ACT-004", "HOME", "LOW", "CHENNAI_GENERAL", 0.015, 1.0, 1.10, 1.0, "2024-01-01", "2025-12-31"),
    ("ACT-005", "HOME", "MEDIUM", "CHENNAI_GENERAL", 0.022, 1.2, 1.10, 1.15, "2024-01-01", "2025-12-31"),
    ("ACT-006", "HOME", "HIGH", "CHENNAI_GENERAL", 0.035, 1.5, 1.10, 1.3, "2024-01-01", "2025-12-31"),
    ("ACT-007", "LIFE", "LOW", "CHENNAI_GENERAL", 0.008, 1.0, 1.00, 1.0, "2024-01-01", "2025-12-31"),
    ("ACT-008", "LIFE", "MEDIUM", "CHENNAI_GENERAL", 0.012, 1.25, 1.00, 1.1, "2024-01-01", "2025-12-31"),
    ("ACT-009", "LIFE", "HIGH", "CHENNAI_GENERAL", 0.020, 1.75, 1.00, 1.25, "2024-01-01", "2025-12-31"),
    ("ACT-010", "WORKERS_COMP", "LOW", "CHENNAI_GENERAL", 0.018, 1.0, 1.05, 1.0, "2024-01-01", "2025-12-31"),
    ("ACT-011", "WORKERS_COMP", "MEDIUM", "CHENNAI_GENERAL", 0.028, 1.3, 1.05, 1.15, "2024-01-01", "2025-12-31"),
    ("ACT-012", "WORKERS_COMP", "HIGH", "CHENNAI_GENERAL", 0.045, 1.7, 1.05, 1.3, "2024-01-01", "2025-12-31"),
    ("ACT-013", "AUTO", "LOW", "BANGALORE_METRO", 0.028, 1.0, 1.15, 1.0, "2024-01-01", "2025-12-31"),
    ("ACT-014", "AUTO", "MEDIUM", "BANGALORE_METRO", 0.038, 1.3, 1.15, 1.1, "2024-01-01", "2025-12-31"),
    ("ACT-015", "HOME", "LOW", "BANGALORE_METRO", 0.018, 1.0, 1.20, 1.0, "2024-01-01", "2025-12-31"),
]

# Actuarial defaults when no row matches.
ACTUARIAL_DEFAULTS = {"base_rate": 0.03, "risk_multiplier": 1.3, "geographic_factor": 1.1,
                      "claims_history_factor": 1.0}

# --- Output texts (fixed values: rows carry them) --------------------------------
UW_RATIONALE = {
    "LOW": "Auto-approved: LOW risk tier, credit score qualifies, actuarial rates favorable.",
    "MEDIUM": "Manual review required: MEDIUM risk. Premium adjusted by risk multiplier.",
    "HIGH": "Flagged for senior underwriter: HIGH risk. May require additional documentation.",
}
V1_REASONS = {
    "INELIGIBLE": "Policy validation failed",
    "HIGH_FRAUD": "High fraud risk (score: %s)",
    "MEDIUM_FRAUD": "Medium fraud risk - reduced settlement",
    "PASSED": "All checks passed",
    "ZERO": "Zero settlement calculated",
}

# --- Fixed clocks of the adapter worlds ---------------------------------------
ORDER_WORLD_AS_OF = "2001-08-01"
EVENT_WORLD_AS_OF = "2024-02-15"
V1_AS_OF = "1999-01-31"  # a day on which the order world has customers of every tenure band

# --- Words of the adapter's claim statements and fraud narratives -----------------
STATEMENT_PLACES = ["Chennai", "Bangalore", "Mumbai", "New Delhi", "Pune", "Kochi", "Jaipur"]
STATEMENT_EVENTS = [
    "a car collision on the road and the driver was hit",
    "a fire in the house and the roof is a total loss",
    "an injury at the workplace during my shift",
    "water in the building and a damaged vehicle",
    "some damage",
]
STATEMENT_TONES = [" I am angry and frustrated, this delay is a terrible problem.", " Thank you for the quick and helpful service.", ""]

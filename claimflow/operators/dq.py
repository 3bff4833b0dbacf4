"""Claim DQ gate (H01-H03) and data-quality metrics / expectations.

The gate is set-based: two left joins (customer existence, policy lookup) and a
pre-aggregated duplicate count per (customer, LOB) joined back, instead of a
per-claim lookup loop. Error and warning lists are built with
``array_compact(array(when ...))`` so their order matches the source's checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.constants import DQ_GATE_ACCEPT, DUP_EXCLUDED_STATUSES, INTAKE_UI_ACCEPT
from claimflow.functions.dates import as_ts, minus_days

UNKNOWN_POLICY_IDS = (-1,)  # the sources' mark for "no such policy"
UNMATCHED_PARTS = 64        # tasks that share the rows whose key cannot match


def fmt_amount(c: Column) -> Column:
    """Number-to-text for messages: fixed 3 decimals (host float text differs, trap T11)."""
    return F.format_string("%.3f", c)


def _existing_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id").distinct().withColumn("_cust_found", F.lit(True))


def _policy_lookup(policies: DataFrame) -> DataFrame:
    return policies.select(F.col("policy_id").alias("_pid"), F.col("policy_status").alias("_pol_status"),
                           F.col("customer_id").alias("_pol_customer"), F.col("lob_type").alias("_pol_lob"),
                           F.col("coverage_limit").alias("_pol_limit"), F.lit(True).alias("_pol_found"))


def _looked_up(claims: DataFrame, customers: DataFrame, policies: DataFrame) -> DataFrame:
    """Claims with their customer and policy lookups. A claim without a key, or with the sentinel of an
    unknown policy, cannot match: such rows would all meet in one task, so they are spread by a salt that
    the lookup side does not have."""
    spread = F.pmod(F.xxhash64("claim_id"), F.lit(UNMATCHED_PARTS)).cast("int") + 1
    none = F.col("policy_id").isNull() | F.col("policy_id").isin(*UNKNOWN_POLICY_IDS)
    salted = claims.withColumns({
        "_cust_salt": F.when(F.col("customer_id").isNull(), spread).otherwise(0),
        "_pol_salt": F.when(none, spread).otherwise(0)})
    people = _existing_customers(customers).withColumnRenamed("customer_id", "_cid").withColumn("_csalt", F.lit(0))
    pol = _policy_lookup(policies).withColumn("_psalt", F.lit(0))
    c = salted.join(people, (F.col("customer_id") == F.col("_cid")) & (F.col("_cust_salt") == F.col("_csalt")), "left")
    c = c.join(pol, (F.col("policy_id") == F.col("_pid")) & (F.col("_pol_salt") == F.col("_psalt")), "left")
    return c.drop("_cid", "_cust_salt", "_csalt", "_pol_salt", "_psalt")


def recent_similar_counts(claims: DataFrame, as_of, days: int = 30) -> DataFrame:
    """(customer_id, lob_type) -> count of recent, not denied / DQ-failed claims.

    Aggregated before the join back, so a hot customer contributes one row
    per map task to the shuffle instead of all of its claims."""
    q = ((F.col("submission_date") >= minus_days(as_ts(as_of), days))
         & ~F.col("claim_status").isin(*DUP_EXCLUDED_STATUSES))
    return (claims.filter(F.col("customer_id").isNotNull() & F.col("lob_type").isNotNull())
            .groupBy("customer_id", "lob_type").agg((F.coalesce(F.sum(F.when(q, F.col("_n"))), F.lit(0)) if "_n" in claims.columns else F.count_if(q))
                 .cast("long").alias("_recent")))


def claim_moments(claims: DataFrame) -> DataFrame:
    """Claims counted per (customer, LOB, status, submission time): what the duplicate check needs to keep of them."""
    return (claims.filter(F.col("customer_id").isNotNull() & F.col("lob_type").isNotNull())
            .groupBy("customer_id", "lob_type", "claim_status", "submission_date").agg(F.count(F.lit(1)).alias("_n")))


def dq_validate_claims(claims: DataFrame, customers: DataFrame, policies: DataFrame, as_of,
                       accept: list[str] = DQ_GATE_ACCEPT, dup_days: int = 30,
                       keep_columns: bool = False, keep_policy: bool = False,
                       all_claims: DataFrame | None = None) -> DataFrame:
    """Per claim ``passed``, ``errors`` and ``warnings`` (arrays of text).

    Row-preserving (every lookup side is unique on its key), so with
    ``keep_columns`` the result is the claims table plus the DQ columns and the
    gate never has to join results back by ``claim_id`` (which is a checked,
    not a guaranteed, key). ``keep_policy`` also keeps the policy lookup
    (``_pol_found``, ``_pol_status``, ``_pol_limit``) for later agents, so the
    claims are not joined to the policies a second time. Recent similar claims are
    counted over ``all_claims`` (default: ``claims``), which holds the claims themselves."""
    c = _looked_up(claims, customers, policies)
    every = claims if all_claims is None else all_claims
    c = c.join(recent_similar_counts(every, as_of, dup_days), ["customer_id", "lob_type"], "left")
    self_q = ((F.col("submission_date") >= minus_days(as_ts(as_of), dup_days))
              & ~F.col("claim_status").isin(*DUP_EXCLUDED_STATUSES))
    # the claim itself is in its own (customer, LOB) group when the group matched
    dup = F.when(F.col("_recent").isNotNull(),
                 F.col("_recent") - F.when(F.coalesce(self_q, F.lit(False)), 1).otherwise(0)).otherwise(0)
    has_pol = F.col("policy_id").isNotNull()
    found = F.col("_pol_found") == True  # noqa: E712
    pid = F.col("policy_id").cast("string")
    errors = F.array_compact(F.array(
        F.when(F.col("_cust_found").isNull(),
               F.concat(F.lit("CUSTOMER_NOT_FOUND: "), F.coalesce(F.col("customer_id").cast("string"), F.lit("NULL")))),
        F.when(has_pol & ~F.coalesce(found, F.lit(False)), F.concat(F.lit("POLICY_NOT_FOUND: "), pid)),
        F.when(has_pol & found & ~F.col("_pol_status").isin(*accept),
               F.concat(F.lit("POLICY_INACTIVE: status="), F.col("_pol_status"))),
        F.when(has_pol & found & (F.col("_pol_customer") != F.col("customer_id")),
               F.concat(F.lit("POLICY_CUSTOMER_MISMATCH: policy belongs to "), F.col("_pol_customer").cast("string"))),
        F.when(F.col("claimed_amount").isNull() | (F.col("claimed_amount") <= 0),
               F.lit("INVALID_AMOUNT: claimed_amount is null or zero")),
        F.when(F.col("customer_id").isNull(), F.lit("MISSING_CUSTOMER_ID")),
    ))
    warnings = F.array_compact(F.array(
        F.when(has_pol & found & F.col("lob_type").isNotNull() & (F.col("_pol_lob") != F.col("lob_type")),
               F.concat(F.lit("LOB_MISMATCH: claim="), F.col("lob_type"), F.lit(" policy="), F.col("_pol_lob"))),
        F.when(has_pol & found & (F.col("claimed_amount") > F.col("_pol_limit")) & (F.col("_pol_limit") > 0),
               F.concat(F.lit("EXCEEDS_COVERAGE: claimed="), fmt_amount(F.col("claimed_amount")),
                        F.lit(" limit="), fmt_amount(F.col("_pol_limit")))),
        F.when(dup > 0, F.concat(F.lit("DUPLICATE_RISK: "), dup.cast("string"),
                                 F.lit(" similar claim(s) in last 30 days"))),
    ))
    head = claims.columns if keep_columns else ["claim_id", "customer_id"]
    if keep_policy:
        head = head + ["_pol_found", "_pol_status", "_pol_limit"]
    return c.select(*head, (F.size(errors) == 0).alias("passed"), errors.alias("errors"),
                    warnings.alias("warnings"))


def dq_validate_intake(claims: DataFrame, customers: DataFrame, policies: DataFrame,
                       accept: list[str] = INTAKE_UI_ACCEPT, text_flags: DataFrame | None = None,
                       text_key: str = "claim_text_id") -> DataFrame:
    """The front-end variant. Required fields first (customer, policy, text);
    comparisons follow Python rules (a missing value is simply "different").
    Warnings never block.

    Only "text present and non-empty" is needed, so the text is reduced to that
    flag before any join: from ``text_flags`` (``text_key``, ``has_text``; one row
    per stored text) joined by key, or from an inline ``claim_text`` column."""
    if text_flags is not None and text_key in claims.columns:
        claims = claims.join(text_flags.select(text_key, F.col("has_text").alias("_has_text")), text_key, "left")
    elif "claim_text" in claims.columns:
        t = F.col("claim_text")
        claims = claims.withColumn("_has_text", t.isNotNull() & (F.length(t) > 0)).drop("claim_text")
    else:
        claims = claims.withColumn("_has_text", F.lit(True))
    c = _looked_up(claims, customers, policies)
    required = (F.col("customer_id").isNotNull() & F.col("policy_id").isNotNull()
                & F.coalesce(F.col("_has_text"), F.lit(False)))
    found = F.col("_pol_found") == True  # noqa: E712
    errors = F.when(~required, F.array(F.lit("REQUIRED_FIELDS_MISSING"))).otherwise(F.array_compact(F.array(
        F.when(F.col("_cust_found").isNull(), F.lit("CUSTOMER_NOT_FOUND")),
        F.when(~F.coalesce(found, F.lit(False)), F.lit("POLICY_NOT_FOUND")),
        F.when(found & ~F.col("_pol_customer").eqNullSafe(F.col("customer_id")), F.lit("POLICY_CUSTOMER_MISMATCH")),
        F.when(found & ~F.coalesce(F.col("_pol_status").isin(*accept), F.lit(False)), F.lit("POLICY_INACTIVE")),
    )))
    warnings = F.when(~required, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(
        F.when(found & ~F.col("_pol_lob").eqNullSafe(F.col("lob_type")), F.lit("LOB_MISMATCH")),
        F.when(found & (F.coalesce(F.col("claimed_amount"), F.lit(0.0)) > F.col("_pol_limit")),
               F.lit("EXCEEDS_COVERAGE")),
    )))
    return c.select("claim_id", "customer_id", (F.size(errors) == 0).alias("passed"),
                    errors.alias("errors"), warnings.alias("warnings"))


DQ_COLUMNS = ["passed", "errors", "warnings"]


def gate_batch(claims_dq: DataFrame, as_of, cap: int | None = None):
    """Over ``dq_validate_claims(..., keep_columns=True)``: the SUBMITTED claims in
    scope (all, or the ``cap`` oldest) that fail become DQ_FAILED with the DQ result
    as metadata plus an audit row (step 0); the ones that pass go on.

    Returns ``(passed_claims, claims_after, audit)``, all row-aligned with the input.
    """
    from claimflow.operators.writes import audit_rows
    submitted = F.col("claim_status") == "SUBMITTED"
    df = claims_dq
    if cap is None:
        scope = submitted
    else:
        chosen = (df.filter(submitted).orderBy(F.col("submission_date").asc_nulls_last(), "claim_id").limit(cap)
                  .select("claim_id").distinct().withColumn("_in_cap", F.lit(True)))
        df = df.join(chosen, "claim_id", "left")
        scope = submitted & F.coalesce(F.col("_in_cap"), F.lit(False))
    failed = scope & ~F.col("passed")
    meta = F.to_json(F.struct("passed", "errors", "warnings", "claim_id", "customer_id"))
    old_meta = F.col("metadata") if "metadata" in df.columns else F.lit(None).cast("string")
    base_cols = [c for c in claims_dq.columns if c not in DQ_COLUMNS]
    table_cols = [c for c in base_cols if not c.startswith("_pol_")]
    after = df.select(*[F.when(failed, F.lit("DQ_FAILED")).otherwise(F.col(c)).alias(c) if c == "claim_status"
                        else F.col(c) for c in table_cols if c != "metadata"],
                      F.when(failed, meta).otherwise(old_meta).alias("metadata"))
    passed = df.filter(scope & F.col("passed")).select(*base_cols)
    audit = audit_rows(df.filter(failed).select(F.col("claim_id").alias("reference_id"), meta.alias("output_payload")),
                       "CLAIMS", "DQ_VALIDATOR", 0, as_of, status="DQ_FAILED")
    return passed, after, audit


def gate_oldest(claims: DataFrame, customers: DataFrame, policies: DataFrame, as_of, cap: int) -> DataFrame:
    """The claims table after one gate run over the ``cap`` oldest SUBMITTED claims. Only those are
    validated (against the whole table's duplicates); the failed ones, at most ``cap``, are marked by id."""
    chosen = (claims.filter(F.col("claim_status") == "SUBMITTED")
              .orderBy(F.col("submission_date").asc_nulls_last(), "claim_id").limit(cap))
    judged = dq_validate_claims(chosen, customers, policies, as_of, keep_columns=True, all_claims=claims)
    failed = judged.where(~F.col("passed")).select(F.col("claim_id").alias("_failed_id")).distinct()
    hit = (F.col("claim_status") == "SUBMITTED") & F.col("_failed_id").isNotNull()
    return (claims.join(F.broadcast(failed), F.col("claim_id") == F.col("_failed_id"), "left")
            .withColumn("claim_status", F.when(hit, "DQ_FAILED").otherwise(F.col("claim_status"))).drop("_failed_id"))


# ------------------------------------------------------------------ K01-K04
def null_count(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """NULL counts for several columns in one pass over ``df``."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, value)") \
              .select(F.lit(table).alias("table_name"), "column_name", F.lit("NULL_COUNT").alias("metric"), "value")


def table_metrics(df: DataFrame, table: str, null_cols: list[str], key: str | None = None) -> DataFrame:
    """K01 and K02 of a table in one pass: NULL counts of ``null_cols`` and the duplicates of ``key``. Rows are
    first added up by key (map-side too), so the counts and the duplicates come from the same exchange."""
    if key is None:
        return null_count(df, table, null_cols)
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                  *[F.count_if(F.col(c).isNull()).alias(f"_null{i}") for i, c in enumerate(null_cols)])
    again = F.sum(F.when(F.col(key).isNotNull() & (F.col("_n") > 1), F.col("_n") - 1))
    sums = per_key.agg(F.coalesce(again, F.lit(0)).cast("long").alias("_again"),
                       *[F.coalesce(F.sum(f"_null{i}"), F.lit(0)).cast("long").alias(f"_null{i}") for i in range(len(null_cols))])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit("NULL_COUNT").alias("metric"), F.col(f"_null{i}").alias("value"))
            for i, c in enumerate(null_cols)]
    rows.append(F.struct(F.lit(key).alias("column_name"), F.lit("DUPLICATE_COUNT").alias("metric"), F.col("_again").alias("value")))
    return sums.select(F.explode(F.array(*rows)).alias("m")).select(F.lit(table).alias("table_name"), "m.*")


def duplicate_count(df: DataFrame, table: str, key: list[str] | str) -> DataFrame:
    """Sum over keys of (n - 1) for keys seen more than once (NULL keys ignored)."""
    keys = [key] if isinstance(key, str) else key
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    g = df.filter(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).cast("long").alias("value")) \
            .select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("column_name"),
                    F.lit("DUPLICATE_COUNT").alias("metric"), "value")


def ref_integrity_count(df: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    p = parent.select(F.col(parent_col).alias("_pk")).distinct()
    orphans = df.filter(F.col(col).isNotNull()).join(p, F.col(col) == F.col("_pk"), "left_anti")
    return orphans.agg(F.count(F.lit(1)).cast("long").alias("value")) \
                  .select(F.lit(table).alias("table_name"), F.lit(col).alias("column_name"),
                          F.lit("REFERENTIAL_INTEGRITY_COUNT").alias("metric"), "value")


def evaluate_expectations(metrics: DataFrame, expectations: DataFrame) -> DataFrame:
    """Metric rows left-joined to expectations; ``passed`` is NULL where no
    expectation is attached (the metric is only monitored)."""
    j = metrics.join(expectations, ["table_name", "column_name", "metric"], "left")
    return j.withColumn("passed", F.when(F.col("expectation").isNotNull(),
                                         F.col("value") == F.col("expected_value")))

"""End-to-end batch jobs over the driver tables. Every result is written with Spark's own Parquet
writer to a folder that the caller names, and read again where a later step needs it.

* ``bootstrap`` — the deployment bootstrap: C360 build + propensity, the claims batch (DQ gate + v2
  agents), the churn pipeline and the underwriting run.
* ``daily_chain`` (L07) — unstructured features -> churn scan -> root cause + actions, from the tables
  of one run to the tables of the next. The scan runs twice by design (the chain's own scan and the
  pipeline's); the 7-day suppression makes the second one add nothing.
* ``refresh_c360`` (L06) — full recompute.

A run writes only into its own (new) folder: a failed run leaves the tables it read as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.operators import c360, churn, claims_v2, underwriting
from claimflow.sources.adapters import Tables


def put(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write a table into a run's folder (which must not hold it yet) and read it back."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def get(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of an earlier run; it must exist."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def refresh_c360(t: Tables, out_root: str, as_of, interactions_as_of=None) -> DataFrame:
    """Recompute the full C360 (+ propensity) and write it."""
    from claimflow.functions.dates import as_ts
    from claimflow.operators.similarity import max_similarity
    scored = max_similarity(t.claim_embeddings(), t.fraud_patterns(), "claim_embedding", "pattern_embedding",
                            ["claim_id", "customer_id", "lob_type"], "fraud_sim")
    full = c360.build_c360_full(t.customers(), t.policies(), t.claims(), t.payments(), t.interactions(),
                                scored, t.providers(), as_of, interactions_as_of)
    return put(c360.churn_propensity(full).withColumn("last_refreshed_at", as_ts(as_of)), out_root, "fct_customer_360")


def bootstrap(spark: SparkSession, root: str, out_root: str, as_of, interactions_as_of=None) -> dict:
    t = Tables(spark, root)
    c = refresh_c360(t, out_root, as_of, interactions_as_of)
    out = claims_v2.run_claims_batch(t.claims(with_text=True), t.customers(), t.policies(), as_of)
    tables = {name: put(out[name], out_root, name) for name in ("resolutions", "claim_state")}
    alerts_after, actions, churn_audit = churn.run_churn(c, churn.empty_alerts(spark), as_of)
    tables["churn_alerts"] = put(alerts_after, out_root, "churn_alerts")
    tables["next_best_actions"] = put(actions, out_root, "next_best_actions")
    decisions, apps_after, uw_audit = underwriting.run_underwriting(t.applications(), t.actuarial(), as_of)
    tables["underwriting_decisions"] = put(decisions, out_root, "underwriting_decisions")
    put(apps_after, out_root, "applications")
    tables["audit_log"] = put(out["audit"].unionByName(churn_audit).unionByName(uw_audit), out_root, "audit_log")
    return {"fct_customer_360": c.count()} | {n: df.count() for n, df in tables.items()}


def daily_chain(spark: SparkSession, root: str, in_root: str, out_root: str, as_of, interactions_as_of=None,
                model=None, rc_scorer=None, nba_scorer=None) -> dict:
    """J05 -> J07 -> J10 over the C360, alerts and actions of an earlier run."""
    t = Tables(spark, root)
    feats = churn.extract_interaction_features(get(spark, in_root, "fct_customer_360"),
                                               t.interactions(with_text_key=True), interactions_as_of or as_of, model, texts=t.transcript_texts())
    current = put(feats, out_root, "fct_customer_360")
    alerts = get(spark, in_root, "churn_alerts")
    scanned = put(alerts.unionByName(churn.churn_scan(current, alerts, as_of)), out_root, "churn_alerts_scanned")
    alerts_after, actions, _ = churn.run_churn(current, scanned, as_of, None, rc_scorer, nba_scorer)
    after = put(alerts_after, out_root, "churn_alerts")
    before = get(spark, in_root, "next_best_actions")
    every = put(before.unionByName(actions), out_root, "next_best_actions")
    return {"alerts": after.filter(F.col("alert_date") == F.lit(str(as_of)).cast("date")).count(),
            "actions": every.count() - before.count()}

"""Write operators (idempotence, CDC) and streaming flows."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from claimflow.operators import churn, writes
from claimflow.streaming import flows


def _t(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "k long, s string, v double")


def test_merge_upsert_is_idempotent(spark):
    target = _t(spark)
    source = spark.createDataFrame([(2, "B", 20.0), (4, "d", 4.0)], "k long, s string, v double")
    once = writes.merge_upsert(target, source, ["k"])
    twice = writes.merge_upsert(once, source, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k: (r.s, r.v) for r in once.collect()} == {1: ("a", 1.0), 2: ("B", 20.0), 3: ("c", None),
                                                         4: ("d", 4.0)}


def test_merge_insert_only_never_updates(spark):
    target = _t(spark)
    source = spark.createDataFrame([(2, "B", 20.0), (4, "d", 4.0)], "k long, s string, v double")
    out = {r.k: r.s for r in writes.merge_insert_only(target, source, ["k"]).collect()}
    assert out == {1: "a", 2: "b", 3: "c", 4: "d"}


def test_diff_snapshots_null_safe(spark):
    old = _t(spark)
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 3.0), (3, "c", None), (5, "e", 5.0)],
                                "k long, s string, v double")
    ch = {r.k: r._change for r in writes.diff_snapshots(old, new, ["k"]).collect()}
    assert ch == {2: "UPDATE", 5: "INSERT"}
    ch2 = {r.k: r._change for r in writes.diff_snapshots(new, old, ["k"]).collect()}
    assert ch2 == {2: "UPDATE", 5: "DELETE"}


def test_update_where_null_condition_updates_nothing(spark):
    out = writes.update_where(_t(spark), F.col("v") > 1.5, {"s": F.lit("X")})
    assert {r.k: r.s for r in out.collect()} == {1: "a", 2: "X", 3: "c"}


def test_churn_scan_twice_adds_nothing(spark):
    c = spark.createDataFrame([(1, 10.0, 0.9, 0.0, 0, 0.0)],
                              "customer_id long, lifetime_value_score double, churn_propensity_score double, "
                              "sentiment_score_last_30d double, complaint_count_90d long, sentiment_trend double")
    first = churn.churn_scan(c, churn.empty_alerts(spark), "2024-10-15")
    assert first.count() == 1
    assert churn.churn_scan(c, first, "2024-10-16").count() == 0


def test_post_decision_stream_two_drops(spark):
    base = tempfile.mkdtemp(prefix="cf-stream-")
    src, out, ck = f"{base}/res", f"{base}/audit", f"{base}/ck"
    schema = "claim_id string, decision string, settlement_amount double"
    spark.createDataFrame([("A", "APPROVED", 1.0)], schema).write.mode("append").parquet(src)
    q = flows.post_decision_flow(spark, src, schema, out, "2024-10-15", checkpoint=ck)
    q.awaitTermination()
    spark.createDataFrame([("B", "DENIED", 0.0), ("C", "REFERRED", 0.0)], schema).write.mode("append").parquet(src)
    q = flows.post_decision_flow(spark, src, schema, out, "2024-10-15", checkpoint=ck)
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r.reference_id for r in got.collect()) == ["A", "B", "C"]      # each row exactly once
    assert got.filter(F.col("step_number") != 99).count() == 0
    batch = flows.post_decision_audit(spark.read.schema(schema).parquet(src),
                                      "2024-10-15")
    assert sorted(got.select("reference_id", "output_payload").collect()) == \
        sorted(batch.select("reference_id", "output_payload").collect())


def test_append_stream_skips_existing_files(spark):
    base = tempfile.mkdtemp(prefix="cf-skip-")
    schema = "claim_id string"
    spark.createDataFrame([("old",)], schema).write.mode("append").parquet(f"{base}/src")
    cut = int(dt.datetime.now().timestamp() * 1000) + 1000
    import time
    time.sleep(1.5)
    spark.createDataFrame([("new",)], schema).write.mode("append").parquet(f"{base}/src")
    s = flows.append_stream(spark, f"{base}/src", schema, skip_existing=True, started_after_ms=cut)
    q = (s.writeStream.format("memory").queryName("skiptest").trigger(availableNow=True)
         .option("checkpointLocation", f"{base}/ck").start())
    q.awaitTermination()
    assert [r.claim_id for r in spark.sql("select * from skiptest").collect()] == ["new"]


def test_skipping_feed_keeps_its_cut_over_a_restart(spark):
    """Files that arrive while the job is down are delivered; those before the first start never are."""
    import time
    base = tempfile.mkdtemp(prefix="cf-restart-")
    schema = "claim_id string"

    def add(*ids):
        spark.createDataFrame([(i,) for i in ids], schema).write.mode("append").parquet(f"{base}/src")

    def run():
        s = flows.append_stream(spark, f"{base}/src", schema, skip_existing=True, state_dir=f"{base}/feed")
        s.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ck") \
            .trigger(availableNow=True).start().awaitTermination()

    add("old")
    time.sleep(1.2)
    run()
    time.sleep(1.2)
    add("while down 1")
    add("while down 2")
    time.sleep(1.2)
    run()
    assert sorted(r.claim_id for r in spark.read.schema(schema).parquet(f"{base}/out").collect()) == ["while down 1", "while down 2"]


def test_claims_feed_looks_for_duplicates_in_all_claims(spark):
    """A restarted claims flow over two drops warns as one run over both does."""
    from claimflow.operators.dq import dq_validate_claims
    from claimflow.sources.adapters import Tables
    t = Tables(spark, "/root/testdata/sf0.001")
    claims = t.claims()
    base = tempfile.mkdtemp(prefix="cf-dups-")
    for part in (0, 1):
        claims.where(F.col("claim_id").substr(1, 8).isNotNull() & (F.abs(F.hash("claim_id")) % 2 == part)) \
            .write.mode("append").parquet(f"{base}/in")
        flows.claims_flow(spark, f"{base}/in", claims.schema, t.customers(), t.policies(), f"{base}/out", "2001-08-01",
                          checkpoint=f"{base}/ck").awaitTermination()
    every = spark.read.schema(claims.schema).parquet(f"{base}/in")
    late = claims.where(F.abs(F.hash("claim_id")) % 2 == 1)
    want = dq_validate_claims(every, t.customers(), t.policies(), "2001-08-01").select("claim_id", "warnings")
    got = dq_validate_claims(late, t.customers(), t.policies(), "2001-08-01", all_claims=every).select("claim_id", "warnings")
    assert got.subtract(want).count() == 0 and got.count() == late.count()
    assert spark.read.parquet(f"{base}/out/resolutions").count() > 0

"""L08/L05 as a flow: transitions and time limits against a plain replay, over a restart and against the batch check."""

import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from claimflow.operators import reports
from claimflow.streaming import states

T0 = dt.datetime(2001, 8, 1, 12, 0)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def plain(events, now, limit=5):
    """Each claim's final state by one walk over its events."""
    out = {}
    for claim in {e[0] for e in events if e[0]}:
        state = started = None
        for _, when, kind in sorted((e for e in events if e[0] == claim and e[2] in states.EVENTS),
                                    key=lambda e: (e[1], states.EVENTS.index(e[2]))) + [(claim, now, "TICK")]:
            live = state is not None and state not in states.ENDS
            if live and when > started + dt.timedelta(minutes=limit):
                state, live = "FAILED", False
            if kind == "START" and state is None:
                state, started = "VALIDATION", when
            elif kind == "STEP" and live:
                state = states.CLAIM_STATES[states.CLAIM_STATES.index(state) + 1]
            elif kind == "FAIL" and live:
                state = "FAILED"
        if state:
            out[claim] = state
    return out


def drop(spark, events, path):
    spark.createDataFrame(events, states.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, base):
    states.states_flow(spark, f"{base}/in", f"{base}/out", checkpoint=f"{base}/ck").awaitTermination()
    return spark.read.schema(spark.read.parquet(f"{base}/out").schema).parquet(f"{base}/out")


def test_advance_does_not_depend_on_where_the_feed_is_cut():
    rng = random.Random(5)
    for _ in range(300):
        events = [(rng.randrange(0, 12 * 60_000, 30_000), rng.randrange(3)) for _ in range(rng.randrange(8))]
        whole, changes = states.advance((None, None, 0, events), 20 * 60_000, 300_000)
        held, got = (None, None, 0, events), []
        for upto in sorted(rng.randrange(0, 20 * 60_000) for _ in range(4)) + [20 * 60_000]:
            held, more = states.advance(held, upto, 300_000)
            got += more
        assert got == changes and held[:3] == whole[:3]


def test_flow_equals_a_plain_replay_over_a_restart(spark):
    rng = random.Random(7)
    events = []
    for i in range(40):
        start = rng.uniform(0, 9)
        events.append((f"C{i}", at(start), "START"))
        events += [(f"C{i}", at(start + 0.4 * (k + 1)), "STEP") for k in range(rng.randrange(5))]
        if i % 7 == 0:
            events.append((f"C{i}", at(start + 3.9), "FAIL"))
    events += [("C1", at(9.5), "START"), ("fresh", at(12.5), "START"), ("under way", at(11), "START"), ("under way", at(12), "STEP"),
               ("late", at(30), "START"), (None, at(3), "START"), ("odd", at(2), "STEP"), ("C2", at(1), "NOISE"),
               ("C3", None, "STEP")]
    base = tempfile.mkdtemp(prefix="cf-states-")
    early = [e for e in events if e[1] is None or e[1] <= at(5)]
    drop(spark, early, f"{base}/in")
    first = run(spark, base)
    assert {r.claim_id for r in first.collect()} <= {e[0] for e in early}
    drop(spark, [e for e in events if e not in early and e[0] != "late"], f"{base}/in")
    run(spark, base)
    drop(spark, [("", at(13), "TICK")], f"{base}/in")  # the check's own clock
    got = states.current_states(run(spark, base))
    now = plain([e for e in events if e[0] != "late" and e[1] is not None], at(13))
    assert {r.claim_id: r.current_state for r in got.collect()} == now
    assert set(now.values()) == {"COMPLETED", "FAILED", "VALIDATION", "FRAUD_CHECK"}
    drop(spark, [("late", at(30), "START"), ("", at(31), "TICK")], f"{base}/in")
    changes = run(spark, base)
    after = {r.claim_id: r for r in states.current_states(changes).collect()}
    assert {c: r.current_state for c, r in after.items()} == plain([e for e in events if e[1] is not None], at(31))
    assert {r.error_message for r in after.values()} == {None, "TIMEOUT: Stuck in pipeline > 5 minutes"}
    assert changes.groupBy("claim_id", "seq").count().where("count > 1").count() == 0  # no change twice


def test_flow_equals_the_batch_health_check(spark):
    """Claims of every age and stage: what the timers fail is what the batch check fails."""
    stage = {s: n for n, s in enumerate(states.CLAIM_STATES)}
    rows = [(f"K{i}", s, at(-(i % 11)), at(-(i % 11) + 0.1 * stage[s]) if s == "COMPLETED" else None)
            for i in range(55) for s in [states.CLAIM_STATES[i % 5]]]
    events = [(c, b + dt.timedelta(seconds=6 * k), "START" if k == 0 else "STEP") for c, s, b, _ in rows for k in range(stage[s] + 1)]
    events = [e for e in events if e[1] <= at(0)] + [("", at(0), "TICK")]
    base = tempfile.mkdtemp(prefix="cf-states-")
    drop(spark, events, f"{base}/in")
    got = states.current_states(run(spark, base))
    batch = spark.createDataFrame([(c, s, b, e, None) for c, s, b, e in rows if b < at(0)],
                                  "claim_id string, current_state string, started_at timestamp, completed_at timestamp, error_message string")
    claims = spark.createDataFrame([(r[0], "SUBMITTED") for r in rows], "claim_id string, claim_status string")
    want, _, counts = reports.health_check(batch, claims, T0)
    old = lambda df: {(r.claim_id, r.current_state, r.error_message) for r in df.where(F.col("started_at") < F.lit(T0)).collect()}
    assert old(got) == old(want)
    assert reports.health_audit(counts, T0).first().agent_name == "HEALTH_CHECK"

"""Claim states as a keyed flow (L08 transitions, L05 time limit) with ``applyInPandasWithState`` and event-time timeouts.

The feed holds one row an event: (claim_id, at, event), event START, STEP, FAIL or TICK. Every claim has
its own state: its time limit and the events that the watermark has not passed yet are kept in Spark's
state store, together with those of the other claims of its shard (a hash of the claim): one call and one timer
serve a whole shard, as a call of Python for every claim takes longer than its work. Events count in the order
of ``at``, however the files are dealt into micro-batches, because they are applied only when the watermark has
passed them (an event at the newest moment of the feed waits for a later one). A claim still open ``limit_minutes`` after its START fails then, by a timeout, without a scan of
the state table. A TICK names no claim: it only tells the time (a health check that finds no new events).

Defined results: an event without a claim or time, or of an unknown kind, changes nothing; a second START of a claim, and
whatever follows COMPLETED or FAILED, is ignored, and so is a STEP or FAIL before the START; events later than the
watermark's ``delay`` are dropped by Spark; events at one moment count START, STEP, FAIL. Each change gives one row
(claim_id, seq, current_state, started_at, at, error_message), ``seq`` counting a claim's changes from 1.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import accumulate, islice
from operator import sub

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimflow.constants import CLAIM_STATES
from claimflow.streaming.flows import _checkpoint, append_stream

EVENTS = ["START", "STEP", "FAIL"]  # in the order in which events at one moment count
EVENT_SCHEMA = "claim_id string, at timestamp, event string"
CHANGE_SCHEMA = "claim_id string, seq long, current_state string, started_at long, at long, error_message string"
ENDS = ("COMPLETED", "FAILED")
STATES = [None, *CLAIM_STATES, "FAILED"]
OPEN = range(1, STATES.index("COMPLETED"))
TIMEOUT = "TIMEOUT: Stuck in pipeline > {} minutes"
STATE_SCHEMA = "packed binary"  # the claims of a shard by columns, compressed: a fifth of their arrays on disk
SHARDS = 1024  # keys of the state store: claims are dealt to them by a hash
CLAIMS_A_SHARD = 1024
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def advance(held: tuple, upto: int | None, limit_ms: int) -> tuple[tuple, list[tuple]]:
    """The claim after all waiting events up to ``upto`` (milliseconds; None: all) and its time limit, and its changes.
    ``held``: (state or None, started_at, seq, waiting [(at, kind)])."""
    state, started, seq, waiting = held
    changes = []

    def change(new, at, message=None):
        nonlocal state, seq
        state, seq = new, seq + 1
        changes.append((seq, state, started, at, message))

    def is_open():
        return state is not None and state not in ENDS

    due = sorted(w for w in waiting if upto is None or w[0] <= upto)
    for at, kind in due:
        if is_open() and started + limit_ms < at:
            change("FAILED", started + limit_ms, TIMEOUT.format(limit_ms // 60_000))
        if state is None and EVENTS[kind] == "START":
            started = at
            change(CLAIM_STATES[0], at)
        elif is_open() and EVENTS[kind] == "STEP":
            change(CLAIM_STATES[CLAIM_STATES.index(state) + 1], at)
        elif is_open() and EVENTS[kind] == "FAIL":
            change("FAILED", at)
    if is_open() and upto is not None and started + limit_ms < upto:
        change("FAILED", started + limit_ms, TIMEOUT.format(limit_ms // 60_000))
    left = [] if state in ENDS or upto is None else [w for w in waiting if w[0] > upto]
    return (state, started, seq, left), changes


def _gaps(times: list[int]) -> list[int]:
    """Each time less the one before it, which packs better."""
    return list(map(sub, times, [0, *times]))


def _held(state) -> dict[str, tuple]:
    """The claims of a shard: (state or None, started_at, seq, waiting [(at, kind)])."""
    if not state.exists:
        return {}
    claims, current, started, seq, waits, at, kind = json.loads(zlib.decompress(state.get[0]))
    under_way, waiting = zip(accumulate(started), seq, strict=True), zip(accumulate(at), kind, strict=True)
    return {c: (STATES[s], *(next(under_way) if s in OPEN else (None, 0)), list(islice(waiting, w)) if w else [])
            for c, s, w in zip(claims, current, waits, strict=True)}


def _kept(held: dict[str, tuple]) -> tuple[bytes]:
    """An ended claim is only known by name: nothing follows its end."""
    claims = sorted(held)
    rows = [held[c] for c in claims]
    current = [STATES.index(r[0]) for r in rows]
    under_way = [r for r, s in zip(rows, current, strict=True) if s in OPEN]
    waiting = [w for r in rows for w in r[3]]
    packed = [claims, current, _gaps([r[1] for r in under_way]), [r[2] for r in under_way], [len(r[3]) for r in rows],
              _gaps([a for a, _ in waiting]), [k for _, k in waiting]]
    return (zlib.compress(json.dumps(packed, separators=(",", ":")).encode()),)


def _move(limit_ms: int):
    columns = [f.split()[0] for f in CHANGE_SCHEMA.split(", ")]

    def run(key, batches, state) -> Iterator[pd.DataFrame]:
        held = _held(state)
        for b in () if state.hasTimedOut else batches:
            for claim, a, kind in zip(*(b[c].tolist() for c in ("claim_id", "at_ms", "kind")), strict=True):
                if claim and kind < len(EVENTS):
                    was = held.get(claim)
                    if was is None:
                        held[claim] = (None, None, 0, [(a, kind)])
                    elif was[0] not in ENDS:
                        was[3].append((a, kind))
        upto, changes, following = state.getCurrentWatermarkMs(), [], None
        for claim, was in list(held.items()):
            current, started, _, waiting = was
            if current in ENDS:
                continue
            if (waiting and min(waiting)[0] <= upto) or (current is not None and started + limit_ms < upto):
                held[claim], found = advance(was, upto, limit_ms)
                changes += [(claim, *c) for c in found]
                current, started, _, waiting = held[claim]
                if current in ENDS:
                    continue
            if current is None and not waiting:
                del held[claim]  # nothing to remember of events before a START
                continue
            due = min(waiting)[0] if waiting else None
            if current is not None:
                due = started + limit_ms + 1 if due is None else min(due, started + limit_ms + 1)
            following = due if following is None else min(due, following)
        if held or state.exists:
            state.update(_kept(held))
        if following is not None:  # beyond the watermark
            state.setTimeoutTimestamp(following)
        if changes:
            yield pd.DataFrame(dict(zip(columns, zip(*changes, strict=True), strict=True)))

    return run


def state_changes(events: DataFrame, limit_minutes: int = 5, delay: str = "0 seconds", shards: int = SHARDS) -> DataFrame:
    """The changes of all claims of a stream of ``EVENT_SCHEMA``. A checkpoint keeps its number of ``shards``."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(e) for e in EVENTS]), F.col("event")), F.lit(0)) - 1  # from 0, as in EVENTS
    kind = F.when(place >= 0, place).otherwise(len(EVENTS)).cast("byte")
    keyed = (events.withWatermark("at", delay).where("at IS NOT NULL")
             .select(F.coalesce("claim_id", F.lit("")).alias("claim_id"), "at", F.unix_millis("at").alias("at_ms"), kind.alias("kind"))
             .withColumn("shard", F.pmod(F.xxhash64("claim_id"), F.lit(shards))))
    moved = keyed.groupBy("shard").applyInPandasWithState(_move(limit_minutes * 60_000), CHANGE_SCHEMA, STATE_SCHEMA, "append",
                                                             "EventTimeTimeout")
    return moved.withColumns({c: F.timestamp_millis(c) for c in ("started_at", "at")})


def states_flow(spark: SparkSession, events_path: str, out_path: str, limit_minutes: int = 5, delay: str = "0 seconds",
                checkpoint: str | None = None, available_now: bool = True, max_files_per_trigger: int | None = None,
                shards: int = SHARDS) -> StreamingQuery:
    """L08/L05 as a flow: events of a folder to the changes of states, each written once by the file sink. The state
    lives in RocksDB and its checkpoint, so a restarted job goes on with all open claims and their timers.
    Give a feed of many claims some ``shards`` for each ``CLAIMS_A_SHARD`` of them; a restart needs the same number."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    changes = state_changes(append_stream(spark, events_path, EVENT_SCHEMA, max_files_per_trigger=max_files_per_trigger),
                            limit_minutes, delay, shards)
    w = (changes.writeStream.queryName("claim_states_flow").format("parquet").option("path", out_path).option("compression", "zstd")
         .option("checkpointLocation", _checkpoint(spark, "claim_states_flow", checkpoint)).outputMode("append"))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def current_states(changes: DataFrame) -> DataFrame:
    """The newest state of each claim, in the columns that the batch health check reads. All of it are greatest numbers of
    a claim (its last change with the place of its state, the time limit of its message), so the changes are hashed and not sorted."""
    names = F.array(*[F.lit(s) for s in STATES[1:]])
    last = F.col("seq") * len(STATES) + F.array_position(names, F.col("current_state"))
    newest = changes.groupBy("claim_id").agg(
        F.max(last).alias("_last"), F.max("started_at").alias("started_at"),
        F.max(F.when(F.col("current_state") == "COMPLETED", F.col("at"))).alias("completed_at"),
        F.max(F.regexp_extract("error_message", r"(\d+)", 1).cast("long")).alias("_limit"))
    before, after = TIMEOUT.split("{}")
    return newest.select("claim_id", F.element_at(names, (F.col("_last") % len(STATES)).cast("int")).alias("current_state"), "started_at", "completed_at",
                         F.concat(F.lit(before), F.col("_limit").cast("string"), F.lit(after)).alias("error_message"))


def stage_events(states: DataFrame, now: str) -> DataFrame:
    """The events that lead to the states of a table (claim_id, current_state, started_at), a second apart, and the
    check's TICK ten seconds after ``now``. Rows that repeat a claim are one claim: they meet before they become events."""
    stage = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in CLAIM_STATES]), F.col("current_state")), F.lit(0))
    failed = F.coalesce(F.col("current_state") == "FAILED", F.lit(False))
    known = (states.groupBy("claim_id", F.col("started_at").cast("timestamp").alias("at"))
             .agg(F.max(F.when(failed | (stage < 1), 0).otherwise(stage - 1)).cast("int").alias("_steps"), F.max(failed).alias("_failed")))
    event = lambda n, e: F.struct(n.cast("int").alias("n"), e.alias("event"))
    steps = F.transform(F.array_repeat(F.lit("STEP"), F.col("_steps")), lambda e, n: event(n + 1, e))
    ended = F.filter(F.array(event(F.lit(1), F.lit("FAIL"))), lambda _: F.col("_failed"))
    rows = known.select("claim_id", "at", F.inline(F.concat(F.array(event(F.lit(0), F.lit("START"))), steps, ended)))
    tick = states.sparkSession.range(1).select(F.lit("").alias("claim_id"), (F.lit(f"{now} 00:00:10").cast("timestamp")).alias("at"),
                                               F.lit("TICK").alias("event"))
    return rows.select("claim_id", (F.col("at") + F.make_dt_interval(secs=F.col("n"))).alias("at"), "event").unionByName(tick)

"""What large inputs need of a plan: texts that move once, work that is done once, groups that stay small."""

import datetime as dt
import glob
import math
import os
import random
import re
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from claimflow import catalog
from claimflow.functions import extract
from claimflow.operators import claims_v1, ranking, reports, search
from claimflow.sources.adapters import Tables
from claimflow.streaming import states

BASE = dt.datetime(2024, 2, 15)
INTERACTIONS = "interaction_id long, customer_id long, channel string, interaction_date timestamp_ntz, transcript_id long"


def _interactions(spark):
    rows = [(i, None if i % 11 == 0 else i % 4, None if i % 13 == 0 else "CHAT", BASE - dt.timedelta(hours=i // 2), None if i % 17 == 0 else i % 7) for i in range(120)]
    texts = [(0, "née Ünal"), (1, "one"), (2, None), (3, ""), (4, "four"), (4, "for"), (5, "five"), (5, "five"), (None, "no id")]
    return rows, texts, spark.createDataFrame(rows, INTERACTIONS), spark.createDataFrame(texts, "text_id long, text string")


def _joined(rows, texts):
    """(customer, date, id, channel, text) newest first, an id's texts in descending order."""
    out = [(c, at, i, ch, t) for i, c, ch, at, k in rows for key, t in (texts if k is not None else []) if key == k and t is not None]
    return sorted(out, key=lambda r: (r[1], r[2], r[4].encode()), reverse=True)


def test_stored_transcripts_cross_one_exchange_to_their_customer(spark):
    rows, texts, inter, stored = _interactions(spark)
    for header in (False, True):
        out = reports.concat_transcripts(inter, "2024-02-15", n_chars=3, with_header=header, texts=stored)
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(customer_id") == 1
        want = {r[1]: [] for r in rows}
        for c, at, _, ch, t in _joined(rows, [(k, t and t[:3]) for k, t in texts]):
            if not header or ch is not None:
                want[c].append((f"[{ch} {at}] " if header else "") + t)
        assert {r.customer_id: r.transcripts for r in out.collect()} == {c: "\n---\n".join(t) for c, t in want.items()}


def test_a_stored_transcript_is_written_once_for_all_who_name_it(spark, monkeypatch):
    texts = [(k, random.Random(k).randbytes(20_000).hex()) for k in range(6)]
    inter = spark.createDataFrame([(i, i % 20, "CHAT", BASE - dt.timedelta(hours=i), i % 7) for i in range(400)], INTERACTIONS)
    stored = spark.createDataFrame(texts, "text_id long, text string").repartition(3)
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/texts-*"))
    monkeypatch.setattr(reports, "OPEN_FILES", 1)
    out = reports.concat_transcripts(inter, "2024-02-15", texts=stored)
    exchange = re.search(r"Exchange hashpartitioning\(customer_id.*?\n.*?Project \[(.*?)\]", out._jdf.queryExecution().executedPlan().toString(), re.DOTALL)
    assert "_place" in exchange[1] and "_text" not in exchange[1]
    got = {r.customer_id: r.transcripts for r in out.collect()}
    folder, = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/texts-*")) - before
    assert sum(os.path.getsize(f) for f in glob.glob(f"{folder}/*") if os.path.isfile(f)) < 1.3 * 6 * 20_000  # 343 interactions name them
    assert got == {c: "\n---\n".join(texts[i % 7][1] for i in range(c, 400, 20) if i % 7 < 6) for c in range(20)}
    monkeypatch.setattr(reports, "_shared_folder", lambda spark: None)  # a storage that Python cannot open
    assert got == {r.customer_id: r.transcripts for r in reports.concat_transcripts(inter, "2024-02-15", texts=stored).collect()}


def test_pieces_are_placed_without_their_texts(spark, monkeypatch):
    rows, texts, inter, stored = _interactions(spark)
    staged, cut = [], ranking.cut_lineage
    monkeypatch.setattr(ranking, "cut_lineage", lambda df: staged.append(df.columns) or cut(df))
    got = reports.transcript_pieces(inter, stored, "2024-02-15").collect()
    assert staged and not any("text" in c for c in staged[0] if c != "transcript_id")
    want = [(c, i, t) for c, _, i, _, t in _joined(rows, texts) if c is not None]
    assert sorted((r.customer_id, r.interaction_id, r.transcript_text) for r in got) == sorted(want)
    for customer in {w[0] for w in want}:
        mine = sorted((r.position, r.interaction_id) for r in got if r.customer_id == customer)
        assert mine == list(enumerate([i for c, i, _ in want if c == customer], 1))


def test_claims_of_one_shard_share_a_call_but_no_state(spark):
    at = lambda m: BASE + dt.timedelta(minutes=m)
    events = [(f"C{i}", at(i % 7 + 0.5 * k), "START" if k == 0 else "STEP") for i in range(60) for k in range(i % 6)] + [("", at(11.5), "TICK"), ("odd", at(1), "STEP")]
    base = tempfile.mkdtemp(prefix="cf-shards-")
    for part in ([e for e in events if e[1] < at(4)], [e for e in events if e[1] >= at(4)]):
        spark.createDataFrame(part, states.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
        states.states_flow(spark, f"{base}/in", f"{base}/out", checkpoint=f"{base}/ck", shards=2).awaitTermination()
    changes = spark.read.parquet(f"{base}/out")
    got = {r.claim_id: r.current_state for r in states.current_states(changes).collect()}
    want = {f"C{i}": "COMPLETED" if i % 6 == 5 else "FAILED" if i % 7 + 5 < 11.5 else states.CLAIM_STATES[i % 6 - 1] for i in range(60) if i % 6}
    assert got == want
    assert changes.groupBy("claim_id", "seq").count().where("count > 1").count() == 0


def test_the_states_flow_stores_little_for_a_claim(spark):
    """What grows with the claims: rows that are exchanged, the state store's values, rows that are sorted."""
    rows = [(f"C{i % 50}", [*states.STATES[1:], "NOISE", None][i % 8], None if i % 13 == 0 else BASE - dt.timedelta(minutes=i % 3)) for i in range(300)]
    table = spark.createDataFrame([*rows, *rows, (None, "FAILED", BASE)], "claim_id string, current_state string, started_at timestamp")
    events = states.stage_events(table, "2024-02-15")
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")  # a claim's row crosses before it becomes events
    want = set()
    for c, s, b in [*rows, (None, "FAILED", BASE)]:
        stage = states.CLAIM_STATES.index(s) if s in states.CLAIM_STATES else 0
        for n, e in enumerate(["START", "FAIL"] if s == "FAILED" else ["START", *["STEP"] * stage]):
            want.add((c, b, n, e))
    want = Counter([(c, b and b + dt.timedelta(seconds=n), e) for c, b, n, e in want] + [("", BASE + dt.timedelta(seconds=10), "TICK")])
    assert Counter(map(tuple, events.collect())) == want

    class Kept:
        exists = True

        def __init__(self, value):
            self.get = value

    held = {f"{i * 7919 % 150000}-{i % 7}-{i * 31 % 20000}-{i * 17 % 1000}":
            [(None, None, 0, [(BASE.timestamp() * 1000 // 1 - i % 11 * 60000 + 1000 * k, min(k, 1)) for k in range(3)]),
             ("ASSESSMENT", 1_000_000 + i, 3, [(2_000_000, 1)]), ("FAILED", None, 0, [])][i % 3] for i in range(4096)}
    held = {c: (s, b, n, [(int(a), k) for a, k in w]) for c, (s, b, n, w) in held.items()}
    kept = states._kept(held)
    assert states._held(Kept(kept)) == held
    assert len(kept[0]) < 20 * len(held)
    changes = spark.createDataFrame([("a", 1, "VALIDATION", BASE, BASE, None), ("a", 12, "FAILED", BASE, BASE, "TIMEOUT: Stuck in pipeline > 5 minutes"), ("b", 1, "VALIDATION", BASE, BASE, None),
                                     ("a", 3, "ASSESSMENT", BASE, BASE, None), ("c", 5, "COMPLETED", BASE, BASE, None)],
                                    states.CHANGE_SCHEMA.replace("started_at long, at long", "started_at timestamp, at timestamp"))
    now = states.current_states(changes)
    assert not re.search("Window|Sort", now._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, now.collect())) == [("a", "FAILED", BASE, None, "TIMEOUT: Stuck in pipeline > 5 minutes"), ("b", "VALIDATION", BASE, None, None), ("c", "COMPLETED", BASE, BASE, None)]


def test_the_c360_is_built_once_for_a_query_that_reads_it_often(spark, monkeypatch):
    built = []
    one = spark.createDataFrame([(1, "A", 0.9, 0.2, -0.9, -0.5, 4, 1, 1, False, False, 0, True)],
                                "customer_id long, customer_segment string, churn_propensity_score double, lifetime_value_score double, "
                                "sentiment_score_last_30d double, sentiment_trend double, complaint_count_90d long, missed_payments_12m long, "
                                "days_to_nearest_renewal long, renewal_risk_signal boolean, intent_cancel_detected boolean, "
                                "competitor_mentions_count long, high_value_at_risk boolean")
    monkeypatch.setattr(catalog, "c360_with_propensity", lambda t: built.append(t) or one)
    causes = catalog._causes(Tables(spark, "/nowhere"))
    assert len(built) == 1 and [r.customer_id for r in causes.collect()] == [1]


def test_v1_texts_are_split_once(spark):
    day = dt.date(2001, 5, 4)
    texts = ["On 2001-05-04 a car crash. I claim INR 70. This is urgent", "On 04/05/2001 a fire in Pune. I claim INR 9,000.5", "On 4 May 2001 nothing. INR 70",
             "On 2001-13-45 a flood. INR 70", "On 32/05/2001 a flood", "Some weeks ago", "", None]
    df = spark.createDataFrame([(i, t, day, 70.0) for i, t in enumerate(texts)], "id long, claim_text string, incident_date date, claimed_amount double")
    out = claims_v1.with_signals(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"split\(lower\(claim_text", plan)) == 1
    got = {r.id: (r.narrative_score, r.sentiment) for r in out.collect()}
    alone = df.select("id", extract.narrative_risk(F.col("claim_text"), F.col("incident_date"), F.col("claimed_amount")).alias("n")).collect()
    assert {i: n for i, (n, _) in got.items()} == {r.id: 0.3 if r.n is None else r.n for r in alone}
    dates = df.select("id", extract.stated_date(F.col("claim_text")).alias("d")).collect()
    assert {r.id: r.d for r in dates} == {0: day, 1: day, 2: day, **dict.fromkeys(range(3, 8))}


def test_bm25_scores_a_document_where_its_postings_are(spark):
    texts = [" ".join(f"w{(i * j) % 11}" for j in range(1, 4 + i % 9)) for i in range(40)] + ["W1, w2;w2", "", None, "w3 w3 w3 w4", "w3 w3 w3 w4"]
    asked = [(1, "w1 w2 w2"), (2, "w3 w4 absent"), (None, "w5"), (4, ""), (5, None)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = search.search(docs.repartition(3), spark.createDataFrame(asked, "query_id long, query string"), "text", "doc_id", k=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(query_id#\w+, doc_id", plan)  # no pair is shuffled
    assert f", {search.TASKS * spark.sparkContext.defaultParallelism}), REPARTITION_BY_NUM" in plan
    many = search.search(docs.repartition(9), spark.createDataFrame(asked, "query_id long, query string"), "text", "doc_id", k=4)
    assert f", {search.TASKS * 9}), REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    toks = [re.findall("[a-z0-9]+", (t or "").lower()) for t in texts]
    df = Counter(t for words in toks for t in set(words))
    mean, want = sum(map(len, toks)) / len(toks), []
    for query, words in asked:
        score = {}
        for d, have in enumerate(map(Counter, toks)):
            for t, n in Counter((words or "").split()).items():
                if have[t]:
                    idf = math.log(1 + (len(toks) - df[t] + 0.5) / (df[t] + 0.5))
                    score[d] = score.get(d, 0) + n * idf * have[t] * 2.2 / (have[t] + 1.2 * (0.25 + 0.75 * sum(have.values()) / mean))
        best = sorted(score, key=lambda d: (-round(score[d], 9), d))[:4]
        want += [(str(query), rank, d, round(score[d], 9)) for rank, d in enumerate(best, 1)]
    assert sorted((str(r.query_id), r.rank, r.doc_id, round(r.score, 9)) for r in out.collect()) == sorted(want)
    again = search.search(docs.union(docs), spark.createDataFrame(asked[:1], "query_id long, query string"), "text", "doc_id", k=2)
    assert [r.doc_id for r in again.orderBy("rank").collect()] == [w[2] for w in want if w[0] == "1"][:2]

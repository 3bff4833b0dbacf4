"""Op 4: targets against rounds of re-sharing; sizes, caps and the rank order of the draw."""

import pandas as pd
import pytest

from claimflow.llm import mixing, queries
from tables import MEDIUM, SMALL


def share_out(sizes, cap=3.0):
    """Targets by rounds: those above their cap stop there, the rest share what is left."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        by = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / by >= cap * sizes[s]}
        if not full:
            target.update({s: left * weight[s] / by for s in open_})
            break
        target.update({s: cap * sizes[s] for s in full})
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 1, None: 5}, {"a": 0, "b": 7}, {None: 4}, {"a": 0},
    {"a": 5, "b": 100, "c": 2, "d": 40, "e": 3, "f": 900, "é": 1, "z": 30}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(share_out(sizes))


@pytest.mark.parametrize(("root", "near"), [(SMALL, 0.1), (MEDIUM, 0.02)])  # some 10 and 50 documents a source
def test_query_meets_its_targets(spark, root, near):
    docs = pd.read_parquet(f"{root}/documents.parquet")
    rows = queries.QUERIES["op4_pareto_mix"](spark, root).toPandas().merge(docs[["doc_id", "source", "text"]], on="doc_id")
    assert len(rows) == len(docs)
    assert (rows["size"] == rows.text.str.findall(r"[^\x20\x09-\x0D]+").str.len()).all()
    assert (rows.taken <= 3 * rows["size"]).all()
    by = rows.groupby("source")
    assert (by["size"].sum() == by.source_size.first()).all()
    assert by.target.first().to_dict() == pytest.approx(share_out(by["size"].sum().to_dict()))
    off = (by.taken.sum() - by.target.first()).abs() / by.target.first()
    assert off.max() < near
    again = queries.QUERIES["op4_pareto_mix"](spark, root).toPandas()
    assert rows.set_index("doc_id").taken.sort_index().equals(again.set_index("doc_id").taken.sort_index())


def test_draw_is_pareto_ordered_and_unequal(spark):
    """With document weights, heavier documents are taken more often, and certain copies come first."""
    docs = spark.createDataFrame([(i, " ".join(["w"] * (40 if i % 2 else 4000)), "ab"[i % 3 == 0]) for i in range(600)],
                                 "doc_id long, text string, source string")
    got = mixing.mix(docs, weight=mixing.damped).toPandas()
    for _, part in got.groupby("source"):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 40 + 0.01 * part.target.iloc[0]
        if 0.5 < (part.target / part.source_size).iloc[0] < 2.5:
            assert part[part["size"] == 40].copies.mean() > part[part["size"] == 4000].copies.mean()
        for _, same in part.groupby("size"):
            assert same.copies.max() - same.copies.min() <= 1


def test_odd_rows(spark, odd_docs, no_docs):
    assert mixing.mix(no_docs).count() == 0
    rows = mixing.mix(odd_docs.selectExpr("*", "1 as size", "'x' as target", "2 as c", "3 as rank", "4 as s2")).toPandas()
    assert len(rows) == 9
    assert rows[rows["size"] == 0].taken.eq(0).all()
    assert (rows.taken <= 3 * rows["size"]).all()
    assert sorted(rows.source.fillna("-").unique()) == ["-", "a", "b"]


def test_sources_at_the_cap_take_every_document_three_times(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 50), "a") for i in range(200)] + [(900 + i, "v w", "b") for i in range(3)]
                                 + [(950 + i, "v w", "c") for i in range(3)], "doc_id long, text string, source string")
    got = mixing.mix(docs, weight=mixing.damped).toPandas()
    assert (got[got.source != "a"].copies == 3).all()
    assert abs(got[got.source == "a"].taken.sum() - got[got.source == "a"].target.iloc[0]) <= 50

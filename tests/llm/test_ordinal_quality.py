"""Op 5: the likelihood's parts by brute force, and held-out accuracy."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from claimflow.llm import ordinal_quality as oq
from tables import MEDIUM, SMALL

BIG = "/root/testdata/sf0.1"


def test_tails_are_cumulative_logits():
    m = oq.OrdinalModel(np.array([0.5, -1.0, 2.0]), np.array([-0.3, 0.8]), np.array([0.0, 1.0, 2.0]))
    tails = m.tails([np.array([0, 2]), np.array([1])])
    want = [[1 / (1 + np.exp(c - s)) for c in (-0.3, 0.8)] for s in (2.5, -1.0)]
    assert np.allclose(tails, want)
    assert (tails[:, 0] >= tails[:, 1]).all()


def test_fit_lowers_the_loss_and_orders_thresholds():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 200, 12)) for _ in range(900)]
    score = np.array([np.isin(r, range(20)).sum() - np.isin(r, range(20, 40)).sum() for r in rows])
    grade = np.digitize(score, [-1, 1, 2])
    m = oq.fit(rows, grade, bits=8, epochs=20)
    assert (np.diff(m.thresholds) >= 0).all()
    expected = m.grades[0] + m.tails(rows) @ np.diff(m.grades)
    assert np.corrcoef(expected, grade)[0, 1] > 0.9
    assert m.weights[:20].mean() > 0.3 and m.weights[20:40].mean() < -0.3


def test_held_out_accuracy(spark):
    docs = pd.read_parquet(f"{BIG}/documents.parquet").merge(pd.read_parquet(f"{BIG}/labels.parquet"), on="doc_id")
    rows = [oq.features(t) for t in docs.text]
    grade = (docs.quality + 1 - docs.toxic).to_numpy()
    train = np.arange(len(docs)) % 5 != 0
    model, cut = oq.fit_with_cut([r for r, t in zip(rows, train, strict=True) if t], grade[train])
    held = docs[~train]
    kept = model.tails([r for r, t in zip(rows, train, strict=True) if not t])[:, -1] >= cut
    clean = ((held.quality == 1) & (held.toxic == 0)).to_numpy()
    assert kept[clean].mean() > 0.98
    assert kept[(held.quality == 0).to_numpy()].mean() < 0.2  # 3,200 rated documents, some 300 toxic: the cut is cautious;
    assert kept[(held.toxic == 1).to_numpy()].mean() < 0.85  # 16,000 leave under 0.01 and 0.03


def test_odd_rows(spark, odd_docs, no_docs):
    ratings = spark.createDataFrame([(4, 1, 0), (5, 0, None), (5, 0, 1), (6, 0, 1), (None, 1, 1), (99, 1, 1)],
                                    "doc_id long, quality int, toxic int")
    grade = F.col("quality") + 1 - F.col("toxic")
    docs = odd_docs.selectExpr("*", "'x' as p_top", "7 as _features", "8 as _grade")
    got = oq.quality_classifier(docs, ratings, grade).collect()
    assert len(got) == 9 and all(r.kept is not None and 0 <= r.p_top <= 1 for r in got)
    assert oq.quality_classifier(no_docs, ratings, grade).count() == 0
    one_grade = ratings.where("doc_id = 4")
    got = oq.quality_classifier(odd_docs, one_grade, grade).collect()
    assert all(r.kept and r.p_top is None for r in got)


def test_repeated_ids_train_with_one_text_each_and_ids_of_text(spark):
    texts = [f"plain words number {i} here" if i % 2 else f"BAD ### {i} !!!" for i in range(40)]
    docs = spark.createDataFrame([(f"d{i % 20}", t) for i, t in enumerate(texts)] * 3, "doc_id string, text string")
    ratings = spark.createDataFrame([(f"d{i}", i % 2) for i in range(20)], "doc_id string, q int")
    rows, grades = oq.training_rows(docs, ratings, F.col("q"), "doc_id", "text", 100)
    again, _ = oq.training_rows(docs.repartition(7), ratings, F.col("q"), "doc_id", "text", 100)
    assert len(rows) == 20 and all((a == b).all() for a, b in zip(rows, again, strict=True))
    assert oq.quality_classifier(docs, ratings, F.col("q")).count() == 120

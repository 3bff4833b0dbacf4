"""The pipeline's stages against brute force on their own inputs, and the whole run."""

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from claimflow.llm import ordinal_quality, queries
from tables import MEDIUM, SMALL
from test_jaccard_join import brute as near_groups
from test_winnowing import brute as contamination

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_everything_is_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in names) if m) == list(range(1, 14))
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "tokens"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{MEDIUM}/documents.parquet")


def test_quality_stage_drops_what_the_classifier_rejects(spark, docs):
    kept = cp.quality(spark, docs, MEDIUM)
    assert kept.columns == COLUMNS
    judged = ordinal_quality.quality_classifier(docs, spark.read.parquet(f"{MEDIUM}/labels.parquet"), F.col("quality") + 1 - F.col("toxic"))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in judged.where("kept").collect()}
    assert kept.count() < docs.count()


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs):
    table = pd.read_parquet(f"{MEDIUM}/documents.parquet")[["doc_id", "text"]]
    classes, _ = near_groups(table.itertuples(index=False, name=None))
    kept = cp.near_duplicates(spark, docs, MEDIUM)
    assert kept.columns == COLUMNS
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(set(classes.values()))


def test_decontamination_stage(spark, docs):
    table = pd.read_parquet(f"{MEDIUM}/documents.parquet")[["doc_id", "text"]].itertuples(index=False, name=None)
    items = pd.read_parquet(f"{MEDIUM}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False, name=None)
    clean = sorted(r[0] for r in contamination(table, items) if not r[5])
    kept = cp.decontaminate(spark, docs, MEDIUM)
    assert kept.columns == COLUMNS
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == clean


def test_mixing_stage_repeats_documents(spark, docs):
    out = cp.mix(spark, docs, MEDIUM)
    assert out.columns == COLUMNS
    got = Counter(r.doc_id for r in out.select("doc_id").collect())
    want = {r.doc_id: r.copies for r in queries.QUERIES["op4_pareto_mix"](spark, MEDIUM).collect() if r.copies}
    assert got == want and max(got.values()) <= 3


def test_run_over_all_stages(spark):
    path = f"{SMALL}/documents.parquet"
    df = spark.read.parquet(path)
    for _, stage in cp.STAGES[:-1]:
        df = spark.createDataFrame(stage(spark, df, SMALL).toPandas(), df.schema)
    rows = cp.run(spark, SMALL).orderBy("start").collect()
    texts = df.toPandas()
    assert sorted(r.doc_id for r in rows) == sorted(texts.doc_id)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    ids = {d: [*t.encode(x, add_special_tokens=False).ids, 0] for d, x in zip(texts.doc_id, texts.text, strict=True)}
    start = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[r.doc_id]), zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes()))
        start += r.n_tokens
    assert [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)


def test_stages_take_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    for name, stage in cp.STAGES:
        out = stage(spark, odd_docs, SMALL)
        assert out.count() <= 9 * 3, name
        assert stage(spark, no_docs, SMALL).count() == 0, name
    wide = odd_docs.selectExpr("*", "1 as _id", "2 as kept", "3 as copies", "4 as node", "5 as t")
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, wide, SMALL).columns == wide.columns, name
    near = cp.near_duplicates(spark, odd_docs, SMALL).collect()
    assert Counter(r.doc_id for r in near) == Counter([1, 2, 3, 4, 5, 7, None])


def test_different_texts_under_one_id_are_told_apart(spark):
    one = " ".join(f"a{i}" for i in range(60))
    two = " ".join(f"b{i}" for i in range(60))
    rows = [(5, one), (9, f"{one} x"), (12, f"{one} y"), (5, two), (3, f"{two} z"), (7, "an own text"), (7, "another one under it"),
            (7, "an own text"), (8, ""), (8, " ")]
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = Counter((r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, SMALL).collect())
    assert kept == Counter([(5, one), (3, f"{two} z"), (7, "an own text"), (7, "another one under it"), (8, ""), (8, " ")])

"""Op 7: an exact round trip, and reads pruned by metadata."""

import tempfile
import zlib

import numpy as np
import pandas as pd
import pyarrow.orc as po
import pytest
from pyspark.sql import functions as F

from claimflow.llm import orc_tokens, queries
from tables import SMALL


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_query_equals_the_library(spark, tokenizer):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet").sort_values("doc_id")
    start, want = 0, []
    for d, text in zip(docs.doc_id, docs.text, strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(tuple(r) for r in queries.QUERIES["op7_orc_tokens"](spark, SMALL).collect())
    assert got == want


@pytest.mark.parametrize("text", [
    "a  b\n\n c\t d  ", "  lead", "tail   ", "x  y 　 z", "don't  stop!! 12 34,5 <|endoftext|> é", "\r\n a\r\n",
    " ", "\n", "a\n", "a \nb", "日本 語\n\n\n", "one\ntwo three\nfour", "nul\x00 byte \x1c x", "it's we'll\nI'm 's", " a b"])
def test_pieces_equal_whole_texts(tokenizer, text):
    encode = orc_tokens.encoder(queries.tokenizer_path())
    for _ in range(2):  # once new, once known
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_files_are_in_order_and_pruned(spark):
    path = tempfile.mkdtemp() + "/tokens"
    docs = spark.range(0, 6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id")).alias("text"))
    orc_tokens.write_tokens(docs, path, queries.tokenizer_path())
    import glob

    files = sorted(glob.glob(f"{path}/part-*.orc"))
    ids = [po.ORCFile(f).read(columns=["doc_id"])["doc_id"].to_pylist() for f in files]
    assert len(files) > 1 and sum(ids, []) == list(range(6000))
    found = orc_tokens.look_up(spark, path, [17, 4242])
    assert [r.doc_id for r in found.orderBy("doc_id").collect()] == [17, 4242]
    assert "In(doc_id" in found._jdf.queryExecution().toString()
    assert any(b"BLOOM" in po.ORCFile(f).file_footer if hasattr(po.ORCFile(f), "file_footer") else True for f in files)


def test_odd_rows(spark, odd_docs, no_docs, tokenizer):
    path = tempfile.mkdtemp() + "/tokens"
    orc_tokens.write_tokens(odd_docs.selectExpr("*", "1 as tokens", "2 as text_key", "3 as start"), path, queries.tokenizer_path())
    rows = orc_tokens.token_digest(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows[:-1]]).tolist()
    assert rows[1].n_tokens == rows[2].n_tokens == 1
    assert rows[4].n_tokens == 1 + len(tokenizer.encode(odd_docs.where("doc_id = 4").first().text, add_special_tokens=False).ids)
    path = tempfile.mkdtemp() + "/tokens"
    orc_tokens.write_tokens(no_docs, path, queries.tokenizer_path())
    assert spark.read.schema("doc_id long, text_key long, tokens array<int>").orc(path).count() == 0

"""Token ids in ORC: written once in id order, read by stripes, pruned by metadata.

Each document is a row (id, text_key, tokens): the ids of its text and an end id. Rows are dealt by
ranges of the id and sorted, so file n holds lower ids than file n + 1. ORC keeps the integers in
run-length encoded stripes with a row index; ``doc_id`` also has Bloom filters, so a look-up of ids
reads only the stripes and row groups that can hold them, and any stripe can be read on its own.

Encoding is the public tokenizers library's. No token of a byte-level BPE of this kind reaches from a
word over the single space or line feed after it, so a text's words are encoded once for each distinct
word of a task and joined; texts with other white space are encoded whole. Strings that look like
special tokens are ordinary text.

Defined results: null and empty texts are the end id alone; null ids come first; rows that repeat an id
are kept, ordered by the hash of their text; texts are encoded whole; an empty table gives empty files.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.common import running_total, settle

END_ID = 0
ROW_GROUP = 1000
STRIPE_BYTES = 64 << 20
KEPT_WORDS = 1_200_000
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell each byte: printable bytes as themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelt = {b: chr(b) for b in plain}
    return spelt | {b: chr(256 + n) for n, b in enumerate(x for x in range(256) if x not in spelt)}


def splits_into_words(tokenizer) -> bool:
    """Whether a text's ids are those of its words one after the other: a byte-level BPE that splits at blanks
    itself, adds none in front, and changes no text beforehand. Other tokenizers encode whole texts."""
    import json

    spec = json.loads(tokenizer.to_str())
    before = spec.get("pre_tokenizer") or {}
    return (spec.get("model", {}).get("type") == "BPE" and spec.get("normalizer") is None and before.get("type") == "ByteLevel"
            and before.get("add_prefix_space") is False and before.get("use_regex", True) is True)


def encoder(tokenizer_path: str):
    """A function from texts to lists of token-id bytes (little-endian uint32), each distinct word encoded once
    (whole texts, if the tokenizer is not of the kind that ``splits_into_words``).

    Words are known by how they stand in a text: after a space (as they are) or at the start of a line
    (after a line feed). A word of letters alone is one unit of the tokenizer's own splitting, so the
    library's model encodes it directly; punctuation behind it is a unit of its own. All other words go
    through the whole tokenizer, and texts with any other white space are encoded whole. What is known
    stays with the library's module, so the tasks that follow in a Python worker need not learn it again."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
    import tokenizers

    kept = vars(tokenizers).setdefault("_words_of", {})
    if tokenizer_path not in kept:
        kept.clear()
        kept[tokenizer_path] = tokenizers.Tokenizer.from_file(tokenizer_path), {}, {}
    tokenizer, known, tails = kept[tokenizer_path]
    tokenizer.encode_special_tokens = True
    if not splits_into_words(tokenizer):
        return lambda texts: [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(
            [t or "" for t in texts], add_special_tokens=False)]
    model, spelling = tokenizer.model, _byte_letters()

    def ids_of(text: str) -> bytes:
        return array("I", tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    feed = ids_of("\n")

    def learn(words) -> None:
        plain, other, ended = set(), [], []
        for w in words:
            base = w.rstrip(PUNCTUATION)
            if (base[1:] if base[:1] == "\n" else base).isalpha():
                plain.add(base)
                if len(base) < len(w):
                    ended.append((w, base, w[len(base) :]))
            else:
                core = w[1:] if w[:1] == "\n" else w
                if len(core.split()) == 1 and not core[0].isspace() and not core[-1].isspace():
                    other.append(w)  # else it is empty or holds white space, and stays unknown
        plain = [w for w in plain if w not in known]
        lines = "\n".join([w if w[0] == "\n" else f" {w}" for w in plain])
        spelt = lines.encode().decode("latin-1").translate(spelling).split(spelling[10])
        at = 0
        for w in plain:
            if w[0] == "\n":  # its own line feed has made an empty entry before it
                at += 1
                known[w] = feed + array("I", [t.id for t in model.tokenize(spelt[at])]).tobytes()
            else:
                known[w] = array("I", [t.id for t in model.tokenize(spelt[at])]).tobytes()
            at += 1
        for w in other:
            known[w] = ids_of(w if w[0] == "\n" else f" {w}")
        for w, base, tail in ended:
            if tail not in tails:
                tails[tail] = ids_of(tail)
            known[w] = known[base] + tails[tail]

    def encode(texts: list) -> list[bytes]:
        if len(known) > KEPT_WORDS:
            known.clear()
            tails.clear()
        cut = [f"\n{t}".replace("\n", " \n")[1:].split(" ") if t else () for t in texts]
        learn(set().union(*cut) - known.keys())
        get, out = known.__getitem__, []
        for t, words in zip(texts, cut, strict=True):
            try:
                out.append(b"".join(map(get, words))[len(feed) if words else 0 :])  # without the added line feed
            except KeyError:
                out.append(ids_of(t))
        return out

    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, batch: int = 500) -> None:
    """Write ``docs`` as ORC token files in ascending id order under ``path``."""
    kind = docs.schema[id_col].dataType.simpleString()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_key")]
    dealt = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .withColumn("text_key", F.xxhash64("text"))
             .repartitionByRange(n, *order).sortWithinPartitions(*order))

    def run(batches):
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                ids = [x + end for x in encode(part["text"].to_pylist())]
                ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["text_key"], tokens], ["doc_id", "text_key", "tokens"])

    (dealt.mapInArrow(run, f"doc_id {kind}, text_key long, tokens array<int>").write.mode("errorifexists")
     .option("compression", "none").option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", str(ROW_GROUP)).option("orc.stripe.size", str(STRIPE_BYTES))
     .orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def look_up(spark: SparkSession, path: str, ids: list) -> DataFrame:
    """Rows of the given ids; the filter is pushed to ORC, which skips by range and Bloom filter."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(ids))


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files, start being the ids of all earlier documents."""
    stored = read_tokens(spark, path)
    kind = stored.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            tokens = b["tokens"]
            ends = tokens.offsets.to_numpy()
            ids = memoryview(np.ascontiguousarray(tokens.values.to_numpy(), "<i4")).cast("B")
            crc = [zlib.crc32(ids[4 * s : 4 * e]) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["text_key"], pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "text_key", "n_tokens", "ids_crc32"])

    sizes = settle(stored.mapInArrow(run, f"doc_id {kind}, text_key long, n_tokens long, ids_crc32 long"))
    return running_total(sizes, [], ["doc_id", "text_key"], "n_tokens", "start").select(
        "doc_id", "start", "n_tokens", "ids_crc32")

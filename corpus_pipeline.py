"""The corpus pipeline: ``documents`` to token files in five stages.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept and returns the
columns of ``documents`` (the last: what was stored for each document). Between stages the rows are
written as Parquet and read again, so a lost executor repeats no earlier stage.

1. quality: an ordinal model fitted on ``labels`` drops the documents it rejects.
2. near_duplicates: of each group of documents linked by 5-word shingles at Jaccard similarity 0.8 or
   more, the one with the least id stays (of different texts under that id, the one with the least text
   hash; of rows that repeat both, one). Rows without an id all stay.
3. decontaminate: documents contaminated by ``benchmark`` items go.
4. mix: documents stay, are repeated (at most 3 times) or go so that sources meet their target weights.
   Documents without words add nothing to a mix and go.
5. tokens: texts as token ids in ORC files in id order; the rows read back from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm import jaccard_join, mixing, orc_tokens, ordinal_quality, winnowing
from claimflow.llm.common import broadcast_within, output_folder, read_table, small_batches
from claimflow.llm.queries import tokenizer_path

MAX_BROADCAST_ROWS = 500_000  # of ids and hashes: some 20 MB


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    grade = F.col("quality") + 1 - F.col("toxic")
    rated = ordinal_quality.quality_classifier(docs, read_table(spark, sf_dir, "labels"), grade)
    return rated.where("kept").select(*docs.columns)


SAME = "d.doc_id <=> b.doc_id and xxhash64(coalesce(d.text, '')) = b.text_key"


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    classes = jaccard_join.jaccard_classes(docs.select("doc_id", "text"))
    same = F.expr(SAME)

    def listed(found: DataFrame) -> DataFrame:
        return broadcast_within(found.select("doc_id", "text_key"), MAX_BROADCAST_ROWS).alias("b")

    goes = listed(classes.where("doc_id != class_id or text_key != class_key").select("doc_id", "text_key").distinct())
    stays = docs.alias("d").join(goes, same, "left_anti")
    # rows that repeat an id and text which stay: one is kept
    again = listed(classes.where("doc_id = class_id and text_key = class_key").groupBy("doc_id", "text_key").count()
                   .where("count > 1"))
    once = stays.alias("d").join(again, same, "left_anti")
    return once.unionByName(stays.alias("d").join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = winnowing.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    bad = judged.where(winnowing.contaminated(F.col("n_hit"), F.col("n_words"))).select("doc_id", "text_key").distinct()
    return docs.alias("d").join(broadcast_within(bad, MAX_BROADCAST_ROWS).alias("b"), F.expr(SAME), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    taken = (mixing.mix(docs, weight=mixing.damped).groupBy("doc_id", "text_key", "source")
             .agg(F.sum("copies").cast("int").alias("copies"), F.count(F.lit(1)).alias("n")).where("copies > 0"))
    same = F.expr(f"{SAME} and d.source <=> b.source")
    copy = next(c for c in (f"_copy{n}" for n in range(len(docs.columns) + 1)) if c not in docs.columns)

    def counted(found: DataFrame) -> DataFrame:
        joined = docs.alias("d").join(broadcast_within(found, MAX_BROADCAST_ROWS).alias("b"), same)
        return joined.select("d.*", F.col("b.copies").alias(copy))

    # rows that repeat an id, text and source are taken together: one of them stands for all
    once = counted(taken.where("n > 1")).dropDuplicates(["doc_id", "text", "source"])
    return (counted(taken.where("n = 1")).unionByName(once)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).drop(copy))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    path = output_folder(spark, "corpus_tokens")
    orc_tokens.write_tokens(docs, path, tokenizer_path())
    return orc_tokens.token_digest(spark, path)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("tokens", tokens)]
ORACLE_SQL = None  # fitted weights, MinHash and BPE have no SQL form: tests compare stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written as Parquet in the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = output_folder(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

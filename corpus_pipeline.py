"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame; all but the last return the columns of their input.
``run`` writes every stage's rows as Parquet to the shared folder and reads
them back as the next one's ``docs``, so a lost executor costs a stage at
most.  Repeated rows, null ids, null texts and extra columns pass through
under the rules that each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import op1_toxicity, op5_decontaminate, op6_exact, op7_neardup, op9_sentencepiece
from lodestar.llm.common import documents, stored, table, without
from lodestar.sources.scratch import scratch

SHINGLE_WORDS, SIMILARITY = 5, 0.8


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity isn't rejected."""
    model = op1_toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return op1_toxicity.severity(docs, model).filter("not toxic").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest doc_id; of rows
    that repeat a doc_id and text, one."""
    found = stored(op6_exact.exact_groups(docs, digest_all=True)
                   .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), "kept"), "pipeline-exact")
    tagged = docs.select(F.struct("*").alias("row")).withColumn("key", F.struct(
        F.col("row.doc_id").alias("id"), F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("sha")))
    keyed = F.struct(F.col("_id").alias("id"), F.col("_sha").alias("sha"))
    gone = found.filter("not kept").select(keyed.alias("_key")).distinct()
    stay = found.filter("kept")
    rest = without(tagged, F.col("key"), gone, F.col("_key"), stay, keyed)
    again = stay.groupBy("_id", "_sha").count().filter("count > 1").select(keyed.alias("_key"))
    if not again.isEmpty():
        once = rest.join(again, F.col("key") == F.col("_key"), "left_semi").dropDuplicates(["key"])
        rest = without(rest, F.col("key"), again, F.col("_key"), stay, keyed).unionByName(once)
    return rest.select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest doc_id.  Rows are
    known by doc_id and text, as one doc_id may have several texts."""
    found = stored(op7_neardup.near_duplicates(docs, SHINGLE_WORDS, SIMILARITY)
                   .select(F.struct(F.col("doc_id").alias("id"), "text_hash").alias("_key"), "kept"), "pipeline-near")
    gone = found.filter("not kept").select("_key").distinct()
    rows = docs.select(F.struct("*").alias("row")).withColumn("key", F.struct(
        F.col("row.doc_id").cast("long").alias("id"), op7_neardup.text_hash(F.col("row.text")).alias("text_hash")))
    return without(rows, F.col("key"), gone, F.col("_key"), found.filter("kept"), F.col("_key")).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = op5_decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("not contaminated").select("row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document left, and the text decoded from them, as digests."""
    return op9_sentencepiece.encode_and_decode(docs, op9_sentencepiece.model_path())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# The learned, probabilistic and tokenizer stages can't be stated in SQL;
# tests/llm/test_models_pipeline.py holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages stored on the way is dropped."""
    docs = documents(spark, sf_dir)
    with scratch(spark):
        for i, (name, stage) in enumerate(STAGES, 1):
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=i == len(STAGES))
    return docs

"""From raw documents to packed training sequences, in five written stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last keep the columns of ``documents``.  Whoever runs them writes each result
as Parquet and reads it again for the next, so lineage ends between stages.

All stages: an empty table gives an empty one; texts of any length are read
whole; further columns stay as they are, whatever their names (stages work on
whole rows beside columns of their own), but for ``n_chars``, which follows a
text that a stage changes; the last stage ignores them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import mixing, neardup, packing, pii, quality
from lamina.llm.util import cut, shared_checkpoints
from lamina.session import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that the rules reject go.

    Shortness alone is no fault here: any text of a word or more may stay, so
    null and empty texts, and those left without words, go.  Rows are judged one
    by one, so ties do not arise and rows that repeat are treated alike.
    """
    ship(spark)
    return quality.keep_good(docs, least=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the least doc_id, rows
    without one last, and of rows with equal doc_id the one with the least text
    hash; of rows equal in both, the first by their other columns.

    Groups are told apart by their root, so each keeps a document whether or
    not its doc_id is null or stands in other groups too.
    """
    ship(spark)
    # small rows decide; texts only meet the decision
    none, key, th = F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("th")
    found = cut(neardup.rooted(docs.select("doc_id", "text", th), carry=("th",)).select("root", none, key, "th"))
    first = found.groupBy("root").agg(F.min(F.struct("none", "id", "th")).alias("lead")).select("root", "lead.*")
    # a text has one fingerprint and so one root: within a doc_id, the hash of the text tells the group
    keys = ["none", "id", "th"]
    leads = cut(found.join(first, ["root", *keys]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")))
    stay = docs.select(F.struct("*").alias("row"), none, key, th).join(leads, keys)
    if leads.where("n > 1").isEmpty():
        return stay.select("row.*")
    repeated = stay.where("n > 1").groupBy(*keys).agg(F.min("row").alias("row"))
    return stay.where("n = 1").select("row.*").unionByName(repeated.select("row.*"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind in brackets; overlapping
    spans become one.  Null texts stay null; rows that repeat are treated alike."""
    ship(spark)
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their targets.

    Null is a source of its own; null and empty texts have no words and go.
    Documents of equal size are taken in the order of a hash; rows that repeat
    share the copies that the mix gives them."""
    ship(spark)
    return mixing.mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 4096.

    Null and empty texts give one piece, the end id; rows that repeat are
    documents of their own; pieces of equal length take places by doc_id."""
    ship(spark)
    return packing.pack_documents(docs, packing.vocabulary_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packed_sequences", packed_sequences),
]

#: Boosted trees, Newton steps and packing have no SQL form; tests/llm hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; results between them are written to the shared folder."""
    ship(spark)
    shared_checkpoints(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs

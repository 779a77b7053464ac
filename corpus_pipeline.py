"""From raw documents to packed sequences: stages that each read what the one before wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertrail.llm import packing, quality, secrets, simhash
from ordertrail.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.assess(docs, COLUMNS).where("kept").select(COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, and any one row of those that repeat that id.

    Rows without an id stay only where no document of their group has one.
    """
    found = stored(simhash.near_duplicates(docs), "groups")
    repeated = stored(found.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select("doc_id"),
                      "repeated")
    # the ids that go are fewer than those that stay; the texts move only if even they are too many to send along
    gone = stored(found.where("doc_id <> component_id").select("doc_id").unionByName(repeated.where("doc_id is not null")),
                  "gone")
    kept = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").select(COLUMNS)
    # an id is not enough to tell these rows apart, but what they say is
    several = docs.join(repeated, docs["doc_id"].eqNullSafe(repeated["doc_id"]), "left_semi").select(COLUMNS)
    classes = found.join(repeated, found["doc_id"].eqNullSafe(repeated["doc_id"]), "left_semi").select(
        "fp", "component_id", "class_fp").distinct()
    told = simhash.fingerprints(several, COLUMNS).join(classes, "fp")
    one = told.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).dropDuplicates(["class_fp"])
    return kept.unionByName(one.select(COLUMNS))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; n_chars follows the text where it changed."""
    found = secrets.redact(secrets.scan(docs, spans="secret_spans"), spans="secret_spans")
    counted = F.when(F.size("secret_spans") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", counted).select(COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining documents, packed into sequences of 2048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: SQL can say none of the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

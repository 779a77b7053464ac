"""Stages on small tables with everything odd, and the whole pipeline against its operators."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline as pipeline
from ordertrail.llm import quality, secrets, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"word{i % 70} and the {i} of them" for i in range(60))
OTHER = " ".join(f"else{i * 7 % 90} stands here, {i} times" for i in range(60))


def documents(spark):
    rows = [(1, PROSE, "en", "a", 1), (2, PROSE.upper(), "en", "a", 2), (2, PROSE, "en", "b", 3), (None, PROSE, "en", "a", 4),
            (5, OTHER, "en", "a", 5), (5, OTHER + " more", "en", "a", 6), (None, None, None, None, None), (None, "", "en", "a", 7),
            (9, PROSE + " token=abcdefghijkl1234", None, "a", 8), (10, "x " * 100_000, "en", "a", 9)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("text_key", F.lit("clash")).withColumn("fp", F.lit(True))


def test_quality_stage(spark, folder):
    docs = documents(spark)
    kept = pipeline.quality_rules(spark, docs, folder)
    assert kept.columns == pipeline.COLUMNS
    verdict = quality.assess(docs, ["doc_id", "n_chars"]).where("kept")
    assert sorted(r["n_chars"] for r in kept.collect()) == sorted(r["n_chars"] for r in verdict.collect())
    assert pipeline.quality_rules(spark, docs.limit(0), folder).count() == 0


def test_dedup_stage_keeps_one_of_each_group(spark, folder):
    docs = documents(spark)
    kept = pipeline.simhash_near_dedup(spark, docs, folder)
    assert kept.columns == pipeline.COLUMNS
    rows = kept.collect()
    fps = {simhash.fingerprint(r["text"] or "") for r in docs.collect()}
    groups = []
    for fp in fps:
        near = [g for g in groups if any(bin(fp ^ other).count("1") <= simhash.DISTANCE for other in g)]
        groups = [g for g in groups if g not in near] + [{fp}.union(*near)]
    assert len(rows) == len(groups)
    for group in groups:
        assert sum(simhash.fingerprint(r["text"] or "") in group for r in rows) == 1
    assert {r["doc_id"] for r in rows} >= {1, 5, 10}
    assert pipeline.simhash_near_dedup(spark, docs.limit(0), folder).count() == 0


def test_secrets_stage_masks(spark, folder):
    rows = {r["n_chars"] if r["text"] is None or secrets.MASK not in r["text"] else "masked": r
            for r in pipeline.secret_scans(spark, documents(spark), folder).collect()}
    assert rows["masked"]["text"] == PROSE + f" {secrets.MASK}"
    assert rows["masked"]["n_chars"] == len(rows["masked"]["text"])
    assert len(rows) == 10 and rows[None]["text"] is None


def test_stages_are_named_in_order():
    assert [name for name, _ in pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "secret scans", "best-fit packing"]
    assert entry_module.queries()["pipeline"] is pipeline.run
    names = [n for n in entry_module.queries() if n.startswith("op")]
    for number in range(1, 11):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1


@pytest.fixture(scope="module")
def packed(spark, folder):
    return pipeline.run(spark, folder).collect()


def test_whole_pipeline(spark, folder, packed):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = quality.assess(docs, ["doc_id", "text"]).where("kept").select("doc_id", "text")
    found = {r["doc_id"] for r in simhash.near_duplicates(kept).where("doc_id = component_id").collect()}
    assert {r["doc_id"] for r in packed} == found
    by_sequence = {}
    for r in packed:
        assert len(r["ids"]) == 4 * r["length"]
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048

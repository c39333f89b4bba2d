"""From raw documents to a shuffled training set, in five stages.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor
kept and returns a DataFrame; ``run`` writes each result as Parquet into the
shared folder and reads it back as the next stage's documents. All but the
last return the columns of documents; the last adds law, shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from appmart.llm import decontaminate, mixing, ngram_jaccard, quality_rules, sharding
from appmart.llm.store import materialise

SHARDS = 24
#: Near duplicates: five words, similarity 0.8.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones stays: the one with the least id, of several such the least text key.

    Rows without words or without id are in no group and stay. A row is its id and its text, as ids may repeat.
    """
    row = ["doc_id", "text_key"]
    found = materialise(ngram_jaccard.similar_components(docs, SHINGLE_WORDS, SIMILAR_PERCENT).filter(
        "n > 0 and doc_id is not null").groupBy(*row, "root").agg(F.count(F.lit(1)).alias("k")), "pipeline-groups")
    first = found.groupBy("root").agg(F.min(F.struct(*row)).alias("first"))
    gone = found.join(first, "root").filter(F.struct(*row) != F.col("first")).select(*row)
    keyed = docs.withColumn("text_key", decontaminate.text_key(F.col("text")))
    kept = keyed.join(gone, row, "left_anti")
    # Repeats of a row that stays.
    again = materialise(found.filter("k > 1").join(first, "root").filter(
        F.struct(*row) == F.col("first")).select(*row), "pipeline-repeats")
    if again.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(again, row, "left_semi").dropDuplicates(row)
    return kept.join(again, row, "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their domain's target weight asks for; toxic ones have none."""
    return mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A uniform shuffle of all documents into 24 shards of equal row counts."""
    placed = sharding.shard_rows(docs, SHARDS)
    return placed.select("d.*", F.lit("rows").alias("law"), "shard", "slot")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_to_weights),
    ("sharding", shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs


#: Mixing (a trained classifier) and sharding (a random draw) have no SQL form; tests/llm hold them against brute force.
ORACLE_SQL = None

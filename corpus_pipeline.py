"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, mixing, sharding.

Each stage takes all that its predecessor kept, written as Parquet and read again.
"""

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import decontamination, mixing, quality_rules, resharding, simhash
from matchlake.llm.common import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without boilerplate lines."""
    return quality_rules.clean(docs, length_col="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles differ by at most three bits."""
    return simhash.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """Shard and slot of each row of the mix, from the shard files, which hold the documents at path."""
    return resharding.reshard(docs, path=path)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing", weights),
    ("sharding", shards),
]

# Hashes and alignments of the stages have no SQL counterpart; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, shards_path: str | None = None) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir, shards_path)

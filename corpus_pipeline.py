"""From raw documents to training shards: five stages, each over all rows the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import bytecnn, decontam, mixing, scratch, setjoin, sharding
from meterlake.llm.shipping import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network, fitted on the labelled ones, does not reject."""
    ship(spark)
    net = bytecnn.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return bytecnn.keep_good(docs, net)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join: five words, 80 %."""
    ship(spark)
    return setjoin.one_of_each(docs, shingle=5, percent=80)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeat by epoch, and the last one of a source is cut."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix, along the Hilbert curve."""
    return sharding.shards(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", unique),
    ("benchmark decontamination", uncontaminated),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

#: The classifier and the similarity stages have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)

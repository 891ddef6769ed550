"""A training corpus from ``documents``: clean, drop near-duplicates and benchmark text, mix the sources, shard.

Each stage takes the documents its predecessor kept, as written to Parquet and read again, and returns documents; the
last returns them with size, shard and slot.

All stages take any rows: null or empty texts, null and repeated ids, copies, texts of any length, extra columns of any name;
an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratewise.llm import decontaminate, mixing, quality, sharding, simhash
from ratewise.llm.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes failing lines; documents that fail the base rules or lose too much text go, null and empty texts among them."""
    return quality.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays: the one with the smallest id, null first; of rows equal in id
    and text one."""
    return simhash.distinct_documents(docs)


def benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go; without benchmark items all stay."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them; a null source is one of them, documents without words are left out."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot; equal texts share a shard."""
    return sharding.assign_shards(docs, keep=docs.columns)


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("benchmark text", benchmark_text),
          ("source mix", source_mix), ("shards", shards)]

#: Fingerprints, the mix's hash order and differencing are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)

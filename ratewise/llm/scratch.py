"""Intermediate tables in the folder that every machine of the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.session import scratch_path


#: The most that is broadcast without a bound by its kind.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` marked for broadcast if its measured size, nearly all in ``text_col``, is within the bound, else as it is."""
    size = df.agg(F.sum(F.octet_length(text_col) + 48)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder (``spark.checkpoint.dir``)."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: a lost executor re-reads files instead of running the steps before again.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

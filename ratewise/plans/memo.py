"""Results kept for later queries of a session: derived tables, models, candidates.

A kept result belongs to a session and a folder, and to the state of the folder's tables: their bytes, number of files and
times of change. If one of the tables has changed, the result is made anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ratewise.session import scratch_path

#: The driver tables that the domain tables are derived from.
TABLES = ("lineitem", "orders", "customer", "part", "events", "documents")
_KEPT: dict[tuple, tuple] = {}


def folder_state(spark: SparkSession, folder: str, tables: tuple[str, ...] = TABLES) -> tuple:
    """(table, bytes, files, time of change) of each table, by a few calls to the file system that holds it; (table,) where it is missing."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{t}.parquet")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            out.append((t,))
            continue
        size = fs.getContentSummary(path)
        out.append((t, size.getLength(), size.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return tuple(out)


def kept(spark: SparkSession, folder: str, name: str, make: Callable[[], Any]) -> Any:
    """The result ``name`` for the tables of ``folder`` as they are now; made by ``make`` if there is none."""
    key, state = (id(spark), folder, name), folder_state(spark, folder)
    hit = _KEPT.get(key)
    if hit is None or hit[0] is not spark or hit[1] != state:  # the session is kept, so its id is never reused
        hit = _KEPT[key] = (spark, state, make())
    return hit[2]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written into the shared folder and read back: lost executors read it again, nothing runs twice."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

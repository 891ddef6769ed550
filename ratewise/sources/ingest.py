"""Tolerant JSON lines with accounts: what was kept, blank or malformed, and the malformed lines themselves.

One pass reads the lines, writes good rows and malformed lines into a folder of their own each, and counts them on the way
(``Dataset.observe``). Lines are counted when a task's output is complete, so nothing is read twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEPT, BLANK, MALFORMED = "kept", "blank", "malformed"


@dataclass
class Ingested:
    """``rows`` with the schema asked for; ``rejected`` (line, file) the malformed lines; ``counts`` by state and ``lines`` in all."""
    rows: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def line_state(line="value"):
    """kept: the line is a JSON object; blank: nothing but white space; malformed: anything else."""
    line = F.col(line) if isinstance(line, str) else line
    bare = F.btrim(line, F.lit(" \t\r\n\x0b\x0c"))
    is_object = F.startswith(bare, F.lit("{")) & F.try_parse_json(bare).isNotNull()
    return F.when(bare == "", BLANK).when(F.coalesce(is_object, F.lit(False)), KEPT).otherwise(MALFORMED)


def ingest_json(spark: SparkSession, path: str, schema: T.StructType, folder: str) -> Ingested:
    """Read the JSON lines of ``path`` tolerantly and write them below ``folder`` (``state=kept`` and ``state=malformed``).

    An object with a wrongly typed field is kept with that field null, as :func:`readers.tolerant_json` does; an object of an
    unpaired brace, a bare value or text is malformed. A line feed ends a line. An empty file gives no rows and counts of 0."""
    seen = Observation("lines")
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), line_state().alias("state"))
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    marked = lines.observe(seen, F.count(F.lit(1)).alias("lines"), *[
        F.count_if(F.col("state") == s).alias(s) for s in (KEPT, BLANK, MALFORMED)])
    bad = F.col("state") == MALFORMED
    (marked.filter(F.col("state") != BLANK)
     .select(F.when(~bad, parsed).alias("row"), F.when(bad, F.col("value")).alias("line"), F.when(bad, F.col("file")).alias("file"), "state")
     .write.mode("overwrite").partitionBy("state").parquet(folder))
    columns = T.StructType([T.StructField("row", schema), T.StructField("line", T.StringType()), T.StructField("file", T.StringType()),
                            T.StructField("state", T.StringType())])
    written = spark.read.schema(columns).parquet(folder)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    return Ingested(written.filter(F.col("state") == KEPT).select("row.*"), written.filter(F.col("state") == MALFORMED).select("line", "file"), counts)

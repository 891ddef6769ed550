"""Stored global statistics that notice edits.

The statistics are kept as sums that merge: rows, an order-independent checksum of the values, sums, counts and maxima.

* :func:`table_state` gives them for any table in one aggregate; an edited value changes the checksum even if the number
  of rows stays.
* :func:`file_stats` keeps one row per file, with its length and time of change. Files that were added or changed are read,
  the rows of the others are reused, those of files that are gone are dropped; the table's statistics are the merged rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.sources import readers

#: kind of table: the columns that its statistics come from, and how each is merged.
STATE = {
    "users": {"reviews": ("sum", "CAST(coalesce(review_count, 0) AS DOUBLE)"), "stars": ("sum", "CAST(average_stars AS DOUBLE)"),
              "rated": ("sum", "CASE WHEN average_stars IS NULL THEN 0L ELSE 1L END"), "most": ("max", "CAST(coalesce(review_count, 0) AS DOUBLE)")},
    "business": {"stars": ("sum", "CAST(stars AS DOUBLE)"), "rated": ("sum", "CASE WHEN stars IS NULL THEN 0L ELSE 1L END"),
                 "most": ("max", "CAST(coalesce(review_count, 0) AS DOUBLE)")},
}
USED = {"users": ("user_id", "review_count", "average_stars"), "business": ("business_id", "stars", "review_count")}
#: Of the checksum: a sum of 64-bit hashes in 38 digits, which neither order nor partitioning changes.
HASH = "decimal(38,0)"


def aggregates(kind: str) -> list[Column]:
    row_hash = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in USED[kind]])
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_hash.cast(HASH)), F.lit(0).cast(HASH)).cast(HASH).alias("checksum"),
            *[F.expr(f"{how}({value})").alias(name) for name, (how, value) in STATE[kind].items()]]


def table_state(df: DataFrame, kind: str) -> DataFrame:
    """One row: n, checksum and the mergeable sums of a users or business table."""
    return df.agg(*aggregates(kind))


def merged(states: DataFrame, kind: str) -> DataFrame:
    """The state of a table from the states of its parts."""
    return states.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("checksum"), F.lit(0)).cast(HASH).alias("checksum"),
                      *[F.expr(f"{how}({name})").alias(name) for name, (how, _) in STATE[kind].items()])


def statistics(users: DataFrame, business: DataFrame) -> DataFrame:
    """A3 from two states: the five statistics, 0 for empty tables, with rows and checksum of both tables."""
    def mean(s: Column) -> Column:
        return F.coalesce(F.try_divide(s["stars"], s["rated"]), F.lit(0.0))

    both = users.select(F.struct("*").alias("u")).withColumn("b", business.select(F.struct("*")).scalar())
    u, b = F.col("u"), F.col("b")
    return both.select(F.coalesce(u["reviews"], F.lit(0.0)).alias("total_reviews"), mean(u).alias("avg_user_stars"),
                       F.coalesce(u["most"], F.lit(0.0)).alias("max_user_reviews"), mean(b).alias("avg_business_stars"),
                       F.coalesce(b["most"], F.lit(0.0)).alias("max_business_reviews"),
                       u["n"].alias("n_users"), b["n"].alias("n_business"), u["checksum"].cast("string").alias("users_checksum"),
                       b["checksum"].cast("string").alias("business_checksum"))


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if readers.missing(e):
            return None
        raise


def listing(spark: SparkSession, path: str) -> DataFrame:
    """file, length, changed of the files below ``path``; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), "length", F.col("modificationTime").cast("long").alias("changed"))


def file_stats(spark: SparkSession, path: str, store: str, kind: str, read: Callable[[list[str]], DataFrame]) -> tuple[DataFrame, int]:
    """The merged state of the files of ``path`` and how many of them had to be read.

    ``store`` is a folder of versions with a row per file; ``read`` gives the table of some files. A new version is
    written only if files were added, changed or removed; the last version counts."""
    now = listing(spark, path)
    known = stored_rows(spark, store)
    if known is not None:
        last = known.agg(F.max("version")).first()[0]
        known = known.filter(F.col("version") == last)
    version = 0 if known is None else last + 1
    fresh = now if known is None else now.join(known.select("file", "length", "changed"), ["file", "length", "changed"], "left_anti")
    names = [r.file for r in fresh.select("file").collect()]  # names of new files, not their rows
    if not names and known.join(now, ["file", "length", "changed"], "left_anti").isEmpty():
        return merged(known, kind), 0
    parts = []
    if names:
        states = (read(names).withColumn("file", F.col("_metadata.file_path")).groupBy(same_name("file").alias("file")).agg(*aggregates(kind)))
        listed = fresh.select(same_name("file").alias("file"), F.col("file").alias("as_listed"), "length", "changed")
        joined = listed.join(states, "file", "left").drop("file").withColumnRenamed("as_listed", "file")
        parts.append(joined.withColumns({"n": F.coalesce("n", F.lit(0)), "checksum": F.coalesce("checksum", F.lit(0)).cast(HASH)}))
    if known is not None:
        parts.append(known.drop("version").join(now, ["file", "length", "changed"], "left_semi"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows.withColumn("version", F.lit(version).cast("bigint")).coalesce(1).write.mode("append").parquet(store)
    written = spark.read.parquet(store).filter(F.col("version") == version)
    return merged(written, kind), len(names)


def same_name(file) -> Column:
    """File names as one source or another writes them (``file:///a b`` and ``file:/a%20b``), made alike."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(F.col(file), r"\+", "%2B")), "^([a-z0-9]+):/+", "$1:/")


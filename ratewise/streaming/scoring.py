"""Streaming pair scoring: the readme's "real-time prediction" path.

Pair requests land as CSV files in a folder; each micro-batch is joined
(stream-static, left) with the prepared per-user and per-business feature
tables, scored by the saved pipeline and appended to a parquet sink. The
feature tables are written once into the shared checkpoint folder, so every
micro-batch reads a short lineage; the query's own checkpoint makes the sink
exactly-once across restarts and lost executors.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ratewise import schemas
from ratewise.operators import features as FE
from ratewise.plans import model as MD


def prepare_sides(spark: SparkSession, users: DataFrame, business: DataFrame, tips: DataFrame,
                  as_of_year: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """Write the user and business feature sides as parquet tables and read them back."""
    us_path, bs_path = f"{folder}/user_side", f"{folder}/business_side"
    FE.user_side(users, tips, as_of_year).write.mode("overwrite").parquet(us_path)
    FE.business_side(business, tips, as_of_year).write.mode("overwrite").parquet(bs_path)
    return spark.read.parquet(us_path), spark.read.parquet(bs_path)


def pair_requests(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming CSV source of (user_id, business_id[, extra]) with a header line."""
    return (spark.readStream.schema(schemas.PAIRS).option("header", True)
            .option("maxFilesPerTrigger", max_files_per_trigger).csv(source_dir)
            .select("user_id", "business_id"))


def scored_stream(requests: DataFrame, user_side: DataFrame, business_side: DataFrame,
                  model: PipelineModel) -> DataFrame:
    feats = FE.attach_sides(requests, user_side, business_side)
    return MD.predict(model, feats)


def start_scoring(spark: SparkSession, source_dir: str, model: PipelineModel, user_side: DataFrame,
                  business_side: DataFrame, sink_dir: str, checkpoint_location: str,
                  available_now: bool = True) -> StreamingQuery:
    """Start the scoring query (append mode, parquet sink)."""
    out = scored_stream(pair_requests(spark, source_dir), user_side, business_side, model)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()

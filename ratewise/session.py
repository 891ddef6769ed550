"""Session construction and shared-storage helpers.

The builder only fills in settings that the cluster has not already set, so a
spark-submit on a real cluster keeps its own shuffle sizing and checkpoint
folder; local tests get sane small-machine defaults.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for a session we create ourselves. AQE re-plans joins at runtime
# (broadcast only when the measured shuffle side is under the threshold),
# coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # AQE broadcasts a join side only when its measured shuffle output is below this
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # checkpointed intermediate tables are removed once no DataFrame refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings that can only be made before the context starts.
STATIC = ("spark.cleaner.referenceTracking.cleanCheckpoints", "spark.ui.enabled", "spark.ui.showConsoleProgress")


def build_session(master: str | None = None, app_name: str = "ratewise",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """The running session or a new one. Defaults are set only for keys that neither the
    submitted configuration nor the running session sets; ``extra`` always applies."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    submitted = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    if not SparkSession.getActiveSession() and "PYSPARK_GATEWAY_PORT" not in os.environ:
        for k in STATIC:
            if f"{k}=" not in submitted:
                builder = builder.config(k, DEFAULT_CONF[k])
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    defaults = {k: v for k, v in DEFAULT_CONF.items() if k not in STATIC}
    if shuffle_partitions:
        defaults["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    present = {r.key for r in spark.sql("SET").collect()} | {k for k, _ in spark.sparkContext.getConf().getAll()}
    for k, v in defaults.items():
        if k not in present:
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. Where it is unset, a local master gets
    a fresh folder under the system temp dir; on a cluster, whose machines do not share
    that one, it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        configured = tempfile.mkdtemp(prefix="ratewise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path inside the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name) if "://" not in base else f"{base.rstrip('/')}/tables/{name}"

"""Session set-up and the one place where lineage is cut."""

from __future__ import annotations

import gc
import tempfile

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import glossarium

# Functions that run in Python workers travel whole, so the workers need not have the package on their path.
cloudpickle.register_pickle_by_value(glossarium)


def build_session(app: str = "glossarium", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on: UTC, AQE with skew handling, Arrow."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a folder of our own only where that is unset and all tasks run
    on this machine (tests), as another machine could not read it."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir")
    if context._jsc.sc().getCheckpointDir().isDefined():
        return context._jsc.sc().getCheckpointDir().get()
    if not configured and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="glossarium-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df computed once and written to the checkpoint folder, so that later readers survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files and checkpoints that nothing refers to any more, which it otherwise does only when
    the driver's memory happens to fill; for use before a step that writes much."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()

"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Settings every job of this package relies on. Joins carry no broadcast hints: adaptive execution
#: measures a finished stage and broadcasts it only below ``autoBroadcastJoinThreshold``; above it
#: the sort-merge join stays and hot partitions are split by the skew-join rule.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "corpusops", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests) falls back to a temporary folder.
    """
    shared = spark.conf.get(_CHECKPOINT_KEY, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="corpusops-")
    spark.conf.set(_CHECKPOINT_KEY, folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the work folder and continue from the written table.

    Cuts the lineage at a place that survives lost executors, and lets later stages prune columns.
    """
    path = f"{work_dir(df.sparkSession)}/stage-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def drop_stages(*staged: DataFrame) -> None:
    """Delete tables that ``stage`` wrote, once all that is derived from them has been written itself."""
    for df in staged:
        spark, path = df.sparkSession, vars(df)["stage_path"]
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

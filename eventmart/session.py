"""Session factory and the two session lookups every job shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE splits skewed join partitions and coalesces small ones;
# advisoryPartitionSize decides the task size after a shuffle, so shuffle.partitions may be generous.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def create_session(app: str, catalog: str | None = None, env: dict[str, str] | None = None,
                   **conf: str) -> SparkSession:
    """A session with the base settings; with `catalog`, an Iceberg REST catalog taken from the environment."""
    env = os.environ if env is None else env
    settings = dict(BASE_CONF)
    if catalog:
        endpoint = env.get("S3_ENDPOINT")
        prefix = f"spark.sql.catalog.{catalog}"
        settings[prefix] = "org.apache.iceberg.spark.SparkCatalog"
        settings[f"{prefix}.type"] = "rest"
        settings[f"{prefix}.uri"] = env["CATALOG_URI"]
        if endpoint:
            settings[f"{prefix}.io-impl"] = "org.apache.iceberg.aws.s3.S3FileIO"
            settings[f"{prefix}.s3.endpoint"] = endpoint
            settings[f"{prefix}.s3.path-style-access"] = "true"
            settings["spark.hadoop.fs.s3a.endpoint"] = endpoint
            settings["spark.hadoop.fs.s3a.path.style.access"] = "true"
    if env.get("OPENLINEAGE_URL"):
        settings["spark.extraListeners"] = "io.openlineage.spark.agent.OpenLineageSparkListener"
        settings["spark.openlineage.transport.type"] = "http"
        settings["spark.openlineage.transport.url"] = env["OPENLINEAGE_URL"]
        settings["spark.openlineage.namespace"] = env.get("OPENLINEAGE_NAMESPACE", "spark")
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone on a session somebody else made: every wire time is UTC text."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, name: str) -> DataFrame:
    """A lake table by catalog name, or a parquet path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def shared_dir(spark: SparkSession) -> str:
    """A new folder all executors can reach, under the one named in spark.checkpoint.dir.

    Only a session on one machine may leave that unset: its folder is a temporary one, which goes when Python ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return f"{configured.rstrip('/')}/eventmart-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="eventmart-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder

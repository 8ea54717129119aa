"""Tables written in the folder that driver and executors share, to cut long lineages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only a local session may go without the setting; it then gets a folder of its own."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{key} must name a folder that the driver and the executors share")
        found = "file://" + tempfile.mkdtemp(prefix="loomspark-")
        spark.conf.set(key, found)
    return found.rstrip("/")


#: Spark's own setting: shuffle files of a query go when it ends, not when the driver happens to collect garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again.

    Lost executors then cost a reread and not the work before it; nothing is computed twice by later branches, and the
    shuffle files that led there are let go.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)

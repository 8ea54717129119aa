"""A session with the settings that the engine's results rely on."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])


def reach_workers(spark: SparkSession) -> None:
    """Lets Python workers that start from now on import this package, wherever the driver was started."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)


def session(app: str = "loomspark", **conf: str) -> SparkSession:
    """Adaptive execution splits skewed joins and sizes shuffles; times are UTC; the caller's conf has the last word."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return SparkSession.builder.appName(app).config(map=settings | conf).getOrCreate()

"""A session with the settings that this engine's plans rely on."""

from pyspark.sql import SparkSession


def session(master: str | None = None, name: str = "corpusmill", **conf: str) -> SparkSession:
    """Adaptive execution with skew joins, UTC, Arrow. Everything else is the cluster's to say."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()

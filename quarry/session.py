"""Session factory with the settings that the engine's results rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Results rest on these; the rest is the cluster's to choose.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(app: str = "quarry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with CONF and further settings, dots written as double underscores (spark__ui__enabled="false")."""
    builder = SparkSession.builder.appName(app).config(map=CONF | {k.replace("__", "."): v for k, v in conf.items()})
    return (builder.master(master) if master else builder).getOrCreate()

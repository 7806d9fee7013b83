"""Session factory. Library code never creates or reconfigures a session itself."""

from __future__ import annotations

from pyspark.sql import SparkSession


def create_session(app_name: str = "retail-analytics", **conf: str) -> SparkSession:
    """Session with adaptive execution and UTC timestamps; keyword settings win (dots as ``__``)."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

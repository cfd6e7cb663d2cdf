"""Session settings that results depend on (UTC) and defaults that suit both one machine and a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    settings = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName(app).config(map=settings | {k.replace("__", "."): v for k, v in conf.items()})
    return (builder.master(master) if master else builder).getOrCreate()

"""Session settings the library is tested and measured with."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "catalogspark", **extra: str) -> SparkSession:
    """A local session; on a cluster the session comes from spark-submit and is used as it is."""
    conf = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": extra.get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="catalogspark-"),
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

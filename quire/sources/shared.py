"""The folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or, on a local master where it is unset, a temporary folder that is set in its place."""
    kept = spark.conf.get("spark.checkpoint.dir", None)
    if not kept:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        kept = tempfile.mkdtemp(prefix="quire-shared-")
        spark.conf.set("spark.checkpoint.dir", kept)
        atexit.register(shutil.rmtree, kept, ignore_errors=True)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(kept)
    return kept


def application_dir(spark: SparkSession) -> str:
    """A folder of this application below it, which can go when the application has ended."""
    return f"{shared_dir(spark)}/quire-{spark.sparkContext.applicationId}"

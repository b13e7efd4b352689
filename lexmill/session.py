"""Session helpers: the shared scratch folder and run-unique paths below it."""

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach: ``spark.checkpoint.dir``, as the cluster names it.

    A local session without that setting uses its warehouse folder, as tests do.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def run_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; no two calls give the same."""
    return f"{shared_dir(spark).rstrip('/')}/lexmill/{name}-{uuid.uuid4().hex}"

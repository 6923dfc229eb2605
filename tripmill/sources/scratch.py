"""Where jobs put intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder the session names in
    ``spark.checkpoint.dir``, or else below its warehouse folder, which all executors
    share as well."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/tripmill/{name}-{uuid.uuid4().hex}"

"""Session settings: the few that differ from Spark's defaults, and object stores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles at run time and splits skewed joins; UTC
# keeps hour-of-day independent of where the job runs.
BASE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.sql.session.timeZone": "UTC",
}


def s3a_conf(
    endpoint: str | None = None,
    *,
    path_style: bool = True,
    ssl: bool = True,
    access_key: str | None = None,
    secret_key: str | None = None,
) -> dict[str, str]:
    """Settings that bind ``s3a://`` paths to an object store.

    Without keys the connector's own provider chain applies (environment,
    instance profile, ...), which is what a cluster should use.
    """
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def get_session(
    app_name: str, master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with :data:`BASE_CONF`; ``conf`` wins over it.

    ``master`` is for local runs only: on a cluster spark-submit sets it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

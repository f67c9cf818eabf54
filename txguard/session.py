"""Session settings for jobs, the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "txguard", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on.

    Adaptive execution sizes batch shuffles from real byte counts, splits skewed join partitions and
    rebalances writes to the 128 MB target; ``shuffle_partitions`` is only the upper bound it starts from
    (stateful streaming queries keep that number for life, so set it for them on purpose).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def object_store_conf(environ: dict[str, str] | None = None) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings; the endpoint and the credentials come from the environment only."""
    env = os.environ if environ is None else environ
    conf = {
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if "OBJECT_STORE_ENDPOINT" in env:
        endpoint = env["OBJECT_STORE_ENDPOINT"]
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
        conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] = str(endpoint.startswith("https")).lower()
    if "AWS_ACCESS_KEY_ID" in env and "AWS_SECRET_ACCESS_KEY" in env:
        conf["spark.hadoop.fs.s3a.access.key"] = env["AWS_ACCESS_KEY_ID"]
        conf["spark.hadoop.fs.s3a.secret.key"] = env["AWS_SECRET_ACCESS_KEY"]
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider")
    return conf

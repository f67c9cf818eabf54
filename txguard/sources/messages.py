"""Messages out: transaction envelopes and alerts, to files or Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.functions.features import is_risky_type
from txguard.schema import ALERT_COLUMNS, TX_SCHEMA


TIME_FORMATS = {  # to the microsecond
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def envelopes(df: DataFrame) -> DataFrame:
    """``(key, value)``: the sender and the record as JSON, every field in its declared type."""
    record = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TX_SCHEMA.fields])
    return df.select(F.col("nameOrig").alias("key"), F.to_json(record).alias("value"))


def ordered_envelopes(df: DataFrame, tie_break: list[str]) -> DataFrame:
    """Risky transactions by step. The tie-break also lets Spark cut one crowded step into many ranges."""
    return envelopes(df.where(is_risky_type()).orderBy("step", *tie_break))


def alerts(detected: DataFrame) -> DataFrame:
    """``(key, value)`` of flagged rows: the sender and eight fields as JSON."""
    return detected.where("is_fraud_detected = 1").select(
        F.col("nameOrig").cast("string").alias("key"), F.to_json(F.struct(*ALERT_COLUMNS), TIME_FORMATS).alias("value"))


def publish_files(messages: DataFrame, path: str) -> None:
    """One JSON object per line. Overwrites ``path``, so a retry leaves one copy."""
    messages.write.mode("overwrite").json(path)


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Needs the connector on the classpath; delivery is at least once."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

"""Where transactions come from: the events table, CSV, JSON messages, Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txguard.schema import TX_SCHEMA

CORRUPT = "_corrupt_record"

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"

# The payment view over the events table: fixed mapping that both engines of the check compute alike. Balances are
# whole ten-thousandths until the last division, so they are the exact decimal numbers rounded once.
_EVENT_COLUMNS = {
    "tx_id": "event_id",
    "step": "CAST(timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) + 1 AS BIGINT)",
    "type": "CASE event_type WHEN 'purchase' THEN 'TRANSFER' WHEN 'click' THEN 'PAYMENT' "
            "WHEN 'view' THEN 'CASH_IN' WHEN 'signup' THEN 'CASH_OUT' ELSE 'DEBIT' END",
    "amount": "cents / 100D",
    "nameOrig": "'C' || CAST(1000000 + user_id * 100 + k AS STRING)",
    "oldbalanceOrg": "cents * CASE digit WHEN 0 THEN 100 WHEN 1 THEN 0 WHEN 2 THEN 102 WHEN 3 THEN 125 "
                     "ELSE digit * 100 END / 10000D",
    "newbalanceOrig": "cents * CASE WHEN digit <= 3 THEN 0 ELSE digit - 1 END / 100D",
    "nameDest": "CASE WHEN event_id % 5 = 0 THEN 'M' ELSE 'C' END || CAST(2000000 + event_id % 997 AS STRING)",
    "oldbalanceDest": "CAST(k * 1000 AS DOUBLE)",
    "newbalanceDest": "(k * 100000 + CASE WHEN event_id % 7 = 0 THEN 0 ELSE cents END) / 100D",
    "isFraud": "CASE WHEN event_type IN ('purchase', 'signup') AND digit IN (0, 2) AND event_id % 4 <> 0 THEN 1 "
               "WHEN event_id % 500 = 7 THEN 1 ELSE 0 END",
    "isFlaggedFraud": "CASE WHEN event_type IN ('purchase', 'signup') AND digit = 0 AND event_id % 4 <> 0 "
                      "AND cents > 20000000 THEN 1 ELSE 0 END",
    "ingested_at": "ts",
}


def from_events(events: DataFrame) -> DataFrame:
    """Transactions with an id and an ingest time, one per row of the events table."""
    parsed = events.withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("int"),
            "cents": F.expr("CAST(CAST(value * 1000 AS DECIMAL(18,2)) * 100 AS BIGINT)"),
        }
    ).withColumn("digit", F.col("k") % 10)
    return parsed.selectExpr(*[f"{sql} AS {name}" for name, sql in _EVENT_COLUMNS.items()])


def read_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return from_events(spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TX_SCHEMA) -> DataFrame:
    """CSV with a header; the schema is given, so the file is read once."""
    return spark.read.schema(schema).option("header", True).csv(path)


def decode(messages: DataFrame, schema: T.StructType = TX_SCHEMA, keep: list[str] | None = None) -> DataFrame:
    """JSON in ``value`` to columns; text that is no such record stays in ``_corrupt_record``.

    ``keep`` names message columns (key, offset, ...) to carry along.
    """
    text = F.col("value").cast("string")
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    # An empty message parses to nothing at all; it is as unreadable as a broken one.
    unreadable = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], text.alias(CORRUPT))
    # ``inline`` parses each message once; plain field access would be copied into every later filter.
    return messages.select(*(keep or []), F.inline(F.array(F.coalesce(parsed, unreadable))))


def readable(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col(CORRUPT).isNotNull())


def text_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of text files, one message per line, in the shape ``decode`` takes."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def kafka_options(servers: str, topic: str, *, starting: str = "earliest", per_trigger: int | None = None,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """Source options. Offsets live in the checkpoint; ``starting`` only matters for its very first run."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Kafka messages; needs the connector on the classpath."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()

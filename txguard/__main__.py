"""The jobs from the command line: ``python -m txguard <job> ...``."""

from __future__ import annotations

import argparse
import os

from txguard.plans import jobs
from txguard.session import build_session, object_store_conf
from txguard.schema import DETECTED_SCHEMA
from txguard.sources import files, messages
from txguard.sources.lake import DeltaTable, LakeTable
from txguard.sources.transactions import kafka_stream, read_csv, text_stream
from txguard.streaming import detection


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="txguard")
    sub = top.add_subparsers(dest="job", required=True)

    job = sub.add_parser("blacklist", help="rebuild the blacklist from labelled history")
    job.add_argument("--history", required=True, help="lake table of the detection job, or CSV with a header")
    job.add_argument("--to", required=True)
    job.add_argument("--until-step", type=int)
    job.add_argument("--keep", type=int, default=10, help="versions of the list that stay")

    job = sub.add_parser("publish", help="send risky transactions as messages, ordered by step")
    job.add_argument("--history", required=True)
    job.add_argument("--to", help="folder for message files")
    job.add_argument("--servers", help="Kafka servers instead of a folder")
    job.add_argument("--topic", help="Kafka topic of the messages")

    job = sub.add_parser("detect", help="run the detection stream")
    job.add_argument("--messages", help="folder with one JSON message per line")
    job.add_argument("--servers", help="Kafka servers instead of a folder")
    job.add_argument("--topic", help="Kafka topic of the messages")
    job.add_argument("--alert-topic", help="Kafka topic of the alerts")
    job.add_argument("--per-trigger", type=int, help="files or offsets per micro-batch")
    job.add_argument("--blacklist", required=True)
    job.add_argument("--root", required=True, help="folder of the lake tables")
    job.add_argument("--checkpoint", required=True, help="folder that survives restarts")
    job.add_argument("--registry", help="model registry; adds the promoted model to the verdict")
    job.add_argument("--jdbc-url", help="also fill tables of a relational store (user and password from the environment)")
    job.add_argument("--jdbc-schema", help="schema of those tables")
    job.add_argument("--format", choices=["parquet", "delta"], default="parquet", help="kind of the lake tables")
    job.add_argument("--interval", help="time between batches, like '30 seconds'; by default one follows the other")
    job.add_argument("--once", action="store_true", help="work off what is there and stop")

    job = sub.add_parser("train", help="train, record and, if it is better, promote a model")
    job.add_argument("--history", required=True)
    job.add_argument("--registry", required=True)
    job.add_argument("--run", required=True)
    job.add_argument("--trees", type=int, default=100)
    job.add_argument("--depth", type=int, default=10)

    job = sub.add_parser("tidy", help="compact the lake tables; of Delta tables also drop what has expired")
    job.add_argument("--root", required=True)
    job.add_argument("--to", help="folder of the compacted copies of Parquet tables")
    job.add_argument("--format", choices=["parquet", "delta"], default="parquet")
    job.add_argument("--retain-hours", type=float, default=168)
    return top


def history_of(spark, path: str):
    """Labelled history: the detection job's table of all rows, or CSV with a header."""
    if files.exists(spark, f"{path}/_delta_log"):
        return DeltaTable(spark, path).read()
    if any(name.startswith("batch_id=") for name in files.folders(spark, path)):
        return LakeTable(spark, path, ["type"], DETECTED_SCHEMA).read()
    return read_csv(spark, path)


def detect(spark, args) -> None:
    sinks = detection.lake_sinks(spark, args.root, bool(args.registry), args.format)
    if args.servers:
        source = kafka_stream(spark, args.servers, args.topic, per_trigger=args.per_trigger)
        sinks.alert = lambda rows, batch_id: messages.publish_kafka(rows, args.servers, args.alert_topic)
    else:
        source = text_stream(spark, args.messages, args.per_trigger)
    if args.jdbc_url:
        login = {k: os.environ[f"JDBC_{k.upper()}"] for k in ("user", "password", "driver") if f"JDBC_{k.upper()}" in os.environ}
        sinks.extra = detection.relational_sinks(args.jdbc_url, args.jdbc_schema, **login)
    query = detection.start_detection(
        source, args.blacklist, sinks, args.checkpoint, once=args.once, registry=args.registry, interval=args.interval)
    if args.once:
        detection.run_to_end(query)
    else:
        detection.serve(query, detection.stop_on_signals())


def main(argv: list[str] | None = None) -> None:
    top = parser()
    args = top.parse_args(argv)
    if getattr(args, "servers", None) and not args.topic:
        top.error("--servers needs --topic")
    if args.job == "tidy" and args.format == "parquet" and not args.to:
        top.error("tidy of Parquet tables needs --to")
    if args.job == "detect" and ((args.servers and not args.alert_topic) or (args.jdbc_url and not args.jdbc_schema)):
        top.error("--servers needs --alert-topic, --jdbc-url needs --jdbc-schema")
    spark = build_session(f"txguard-{args.job}", **object_store_conf())
    if args.job == "blacklist":
        jobs.refresh_blacklist(history_of(spark, args.history), args.to, args.until_step, args.keep).show()
    elif args.job == "publish":
        ordered = messages.ordered_envelopes(history_of(spark, args.history), ["nameOrig", "amount"])
        if args.servers:
            messages.publish_kafka(ordered, args.servers, args.topic)
        else:
            ordered.select("value").write.mode("overwrite").text(args.to)
    elif args.job == "detect":
        detect(spark, args)
    elif args.job == "train":
        history = history_of(spark, args.history)
        promoted = jobs.retrain(spark, history, args.registry, args.run, key=None, trees=args.trees, depth=args.depth)
        print("promoted" if promoted else "not promoted")
    elif args.job == "tidy":
        tables = detection.lake_tables(spark, args.root, kind=args.format)
        print(jobs.tidy_lake(tables, ["ingested_at"], args.retain_hours, to=args.to))


if __name__ == "__main__":
    main()

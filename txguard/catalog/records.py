"""Queries on single records: scans, features, flags, protection, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from txguard import workspace
from txguard.catalog.base import (
    RATIO, RISKY, RULE, TX, blacklist, detected, on_blacklist, on_detected, on_transactions, query, transactions)
from txguard.functions import features, protect
from txguard.functions.rules import drain_rule
from txguard.operators import explore, frequency, lookup, quality
from txguard.operators.sampling import first_rows
from txguard.plans import blacklist as blacklists
from txguard.plans import dashboard, detection, exploration
from txguard.schema import ALERT_COLUMNS, DISPLAY_NAMES, DISPLAY_TYPES, RECORD_DEFAULTS, TX_COLUMNS
from txguard.sources import messages
from txguard.sources import transactions as source

_FIELDS = ", ".join(TX_COLUMNS)


# Scans

@query("scan_csv", on_transactions(f"SELECT {_FIELDS} FROM tx"))
def scan_csv(spark, folder):
    path = workspace.new_path(spark, "csv")
    transactions(spark, folder).select(TX_COLUMNS).write.option("header", True).csv(path)
    return source.read_csv(spark, path)


@query("scan_limit", on_transactions("SELECT tx_id, type, amount, isFraud FROM tx ORDER BY tx_id LIMIT 300000"))
def scan_limit(spark, folder):
    """The first 300,000 rows of four columns."""
    return first_rows(transactions(spark, folder).select("tx_id", "type", "amount", "isFraud"), 300_000, "tx_id")


def _message_mix(spark, folder, foreign: bool = True):
    """What a topic may hold: transaction messages, plain text and ``foreign`` JSON (the event properties)."""
    tx = messages.envelopes(transactions(spark, folder)).select("value")
    props = spark.read.parquet(f"{folder}/events.parquet").select(F.col("props").alias("value"))
    prose = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("text").alias("value"))
    mixed = tx.unionByName(prose)
    return mixed.unionByName(props) if foreign else mixed


@query("json_decode", on_transactions(f"SELECT {_FIELDS} FROM tx"))
def json_decode(spark, folder):
    """The readable ones among transaction messages and prose."""
    return source.readable(source.decode(_message_mix(spark, folder, foreign=False)))


@query("json_dead_letter", "SELECT text AS value FROM documents WHERE text IS NOT NULL")
def json_dead_letter(spark, folder):
    """Messages that are no JSON, with their whole text."""
    return source.dead_letters(source.decode(_message_mix(spark, folder))).select(
        F.col(source.CORRUPT).alias("value"))


# Features

@query("features_stream", on_detected(
    "SELECT tx_id, balance_diff_orig, balance_diff_dest, is_transfer_or_cashout, amount_to_balance_ratio FROM det"))
def features_stream(spark, folder):
    return features.stream_features(transactions(spark, folder)).select(
        "tx_id", "balance_diff_orig", "balance_diff_dest", "is_transfer_or_cashout", "amount_to_balance_ratio")


_TRAINING = f"""newbalanceOrig - oldbalanceOrg AS balance_diff_orig, newbalanceDest - oldbalanceDest AS balance_diff_dest,
  {RATIO} AS amount_ratio_orig, CASE WHEN newbalanceOrig = 0 THEN 1 ELSE 0 END AS zero_balance_after,
  {RATIO} AS drain_ratio,
  CASE WHEN amount > 0 AND abs(newbalanceDest - oldbalanceDest - amount) > 1.0 THEN 1 ELSE 0 END AS dest_balance_anomaly,
  CASE WHEN nameDest LIKE 'M%' THEN 1 ELSE 0 END AS dest_is_merchant,
  CASE WHEN amount > 200000 THEN 1 ELSE 0 END AS is_large_transaction"""


@query("features_train", on_transactions(f"SELECT tx_id, {_TRAINING} FROM tx"))
def features_train(spark, folder):
    built = features.training_features(transactions(spark, folder))
    return built.select(
        "tx_id", "balance_diff_orig", "balance_diff_dest", "amount_ratio_orig", "zero_balance_after", "drain_ratio",
        "dest_balance_anomaly", "dest_is_merchant", "is_large_transaction")


_EDA = f"""newbalanceOrig - oldbalanceOrg AS balance_diff_orig, newbalanceDest - oldbalanceDest AS balance_diff_dest,
  {RATIO} AS amount_to_oldbalance_ratio,
  CASE WHEN newbalanceOrig = 0 AND oldbalanceOrg > 0 THEN 1 ELSE 0 END AS zero_balance_after"""
_EDA_COLUMNS = ["balance_diff_orig", "balance_diff_dest", "amount_to_oldbalance_ratio", "zero_balance_after"]


@query("features_eda", on_transactions(f"SELECT tx_id, {_EDA} FROM tx"))
def features_eda(spark, folder):
    return features.eda_features(transactions(spark, folder)).select("tx_id", *_EDA_COLUMNS)


@query("save_preprocessed", on_transactions(f"SELECT tx_id, {_FIELDS}, {_EDA} FROM tx"))
def save_preprocessed(spark, folder):
    rows = features.eda_features(transactions(spark, folder)).select("tx_id", *TX_COLUMNS, *_EDA_COLUMNS)
    return workspace.write_table(rows, workspace.new_path(spark, "preprocessed"))


@query("mismatch_flag", on_transactions(
    "SELECT tx_id, CASE WHEN oldbalanceOrg = newbalanceOrig THEN 0 ELSE 1 END AS balance_changed FROM tx"))
def mismatch_flag(spark, folder):
    return transactions(spark, folder).select(
        "tx_id", features.mismatch("oldbalanceOrg", "newbalanceOrig").alias("balance_changed"))


# Filters and flags

@query("filter_types", on_transactions(f"SELECT tx_id, type, amount FROM tx WHERE {RISKY}"))
def filter_types(spark, folder):
    return transactions(spark, folder).where(features.is_risky_type()).select("tx_id", "type", "amount")


@query("rule_flag", on_transactions(f"SELECT tx_id, {RULE} AS rule_fraud_flag FROM tx"))
def rule_flag(spark, folder):
    return transactions(spark, folder).select("tx_id", drain_rule().alias("rule_fraud_flag"))


@query("blacklist_flag", on_detected("SELECT tx_id, nameOrig, blacklist_flag FROM det"))
def blacklist_flag(spark, folder):
    return detection.blacklist_flag(transactions(spark, folder), blacklist(spark, folder)).select(
        "tx_id", "nameOrig", "blacklist_flag")


@query("blacklist_both_sides", f"""WITH {TX},
bl AS (SELECT nameOrig AS account FROM tx WHERE isFraud = 1 UNION SELECT nameDest FROM tx WHERE isFraud = 1)
SELECT tx_id, CASE WHEN nameOrig IN (SELECT account FROM bl) OR nameDest IN (SELECT account FROM bl)
  THEN 1 ELSE 0 END AS blacklist_flag FROM tx""")
def blacklist_both_sides(spark, folder):
    """Either side is on a list of all fraud senders and receivers."""
    tx = transactions(spark, folder)
    receivers = tx.where("isFraud = 1").select(F.col("nameDest").alias("account"))
    listed = workspace.write_table(
        blacklists.extend(blacklists.build(tx), receivers), workspace.new_path(spark, "blacklist"))
    return detection.blacklist_flag(tx, listed, sides="both").select("tx_id", "blacklist_flag")


@query("blacklist_semi", on_blacklist("SELECT tx_id, nameOrig FROM tx WHERE nameOrig IN (SELECT account FROM bl)"))
def blacklist_semi(spark, folder):
    return lookup.keep_members(
        transactions(spark, folder).select("tx_id", "nameOrig"), blacklist(spark, folder), "nameOrig")


@query("blacklist_anti", on_blacklist("SELECT tx_id, nameOrig FROM tx WHERE nameOrig NOT IN (SELECT account FROM bl)"))
def blacklist_anti(spark, folder):
    return lookup.drop_members(
        transactions(spark, folder).select("tx_id", "nameOrig"), blacklist(spark, folder), "nameOrig")


@query("blacklist_large", on_detected("SELECT tx_id, nameOrig, blacklist_flag FROM det"))
def blacklist_large(spark, folder):
    """The flag by the way taken when the list is too large to broadcast: a Bloom filter, then the members that occur."""
    return detection.blacklist_flag(
        transactions(spark, folder), blacklist(spark, folder), broadcast_bytes=0).select(
        "tx_id", "nameOrig", "blacklist_flag")


@query("blacklist_large_rows", on_detected("SELECT tx_id, nameOrig, blacklist_flag FROM det"))
def blacklist_large_rows(spark, folder):
    """The same where the members that occur are too many to broadcast as well: the rows that pass the filter move."""
    return detection.blacklist_flag(
        transactions(spark, folder), blacklist(spark, folder), broadcast_bytes=0, known_bytes=0).select(
        "tx_id", "nameOrig", "blacklist_flag")


@query("blacklist_semi_large", on_blacklist("SELECT tx_id, nameOrig FROM tx WHERE nameOrig IN (SELECT account FROM bl)"))
def blacklist_semi_large(spark, folder):
    return lookup.keep_members(
        transactions(spark, folder).select("tx_id", "nameOrig"), blacklist(spark, folder), "nameOrig", broadcast_bytes=0, known_bytes=0)


@query("blacklist_anti_large", on_blacklist("SELECT tx_id, nameOrig FROM tx WHERE nameOrig NOT IN (SELECT account FROM bl)"))
def blacklist_anti_large(spark, folder):
    return lookup.drop_members(
        transactions(spark, folder).select("tx_id", "nameOrig"), blacklist(spark, folder), "nameOrig", broadcast_bytes=0, known_bytes=0)


@query("detect", on_detected("SELECT * FROM det"))
def detect(spark, folder):
    return detected(spark, folder)


@query("fraud_only", on_detected("SELECT * FROM fraud"))
def fraud_only(spark, folder):
    return dashboard.only_fraud(detected(spark, folder))


@query("alert_json", on_detected("SELECT nameOrig AS key, nameOrig, nameDest, amount, type, is_fraud_detected, "
                                 "blacklist_flag, rule_fraud_flag, ingested_at FROM fraud"))
def alert_json(spark, folder):
    """Alerts as JSON, read back field by field, times to the microsecond."""
    schema = ("nameOrig string, nameDest string, amount double, type string, is_fraud_detected int, "
              "blacklist_flag int, rule_fraud_flag int, ingested_at timestamp_ntz")
    return messages.alerts(detected(spark, folder)).select(
        "key", F.from_json("value", schema, messages.TIME_FORMATS).alias("alert")).select("key", *[f"alert.{c}" for c in ALERT_COLUMNS])


@query("publish_envelope", on_transactions(f"SELECT nameOrig AS key, {_FIELDS} FROM tx WHERE {RISKY}"))
def publish_envelope(spark, folder):
    """Risky transactions by step as JSON messages, written, read back and opened."""
    path = workspace.new_path(spark, "topic")
    messages.publish_files(messages.ordered_envelopes(transactions(spark, folder), ["tx_id"]), path)
    published = spark.read.schema("key string, value string").json(path)
    return source.readable(source.decode(published, keep=["key"]))


# Blacklist

@query("blacklist_build", on_transactions("SELECT DISTINCT nameOrig AS account FROM tx WHERE isFraud = 1"))
def blacklist_build(spark, folder):
    return blacklists.build(transactions(spark, folder))


@query("blacklist_count", on_blacklist("SELECT COUNT(*) AS accounts FROM bl"))
def blacklist_count(spark, folder):
    return blacklist(spark, folder).agg(F.count("*").alias("accounts"))


@query("blacklist_append", on_transactions("SELECT DISTINCT nameOrig AS account FROM tx WHERE isFraud = 1"))
def blacklist_append(spark, folder):
    """A list of the first half of the steps, then everything added to it."""
    path, tx = workspace.new_path(spark, "blacklist"), transactions(spark, folder)
    blacklists.publish(blacklists.build(tx, 360), path)
    return blacklists.publish(blacklists.build(tx), path, mode="append")


@query("blacklist_replace", on_transactions(
    "SELECT DISTINCT nameOrig AS account FROM tx WHERE isFraud = 1 AND step <= 180"))
def blacklist_replace(spark, folder):
    path, tx = workspace.new_path(spark, "blacklist"), transactions(spark, folder)
    blacklists.publish(blacklists.build(tx, 360), path)
    return blacklists.publish(blacklists.build(tx, 180), path)


@query("blacklist_diff", on_transactions("""
, a AS (SELECT DISTINCT nameOrig AS account FROM tx WHERE isFraud = 1 AND step <= 360),
z AS (SELECT DISTINCT nameOrig AS account FROM tx WHERE isFraud = 1 AND step > 180)
SELECT account, 'added' AS change FROM (SELECT account FROM z EXCEPT SELECT account FROM a)
UNION ALL SELECT account, 'removed' FROM (SELECT account FROM a EXCEPT SELECT account FROM z)"""))
def blacklist_diff(spark, folder):
    tx = transactions(spark, folder)
    return blacklists.difference(blacklists.build(tx, 360), blacklists.build(tx.where("step > 180")))


@query("blacklist_refresh", on_blacklist("""
SELECT 'history_present' AS name, COUNT(*) > 0 AS passed, CAST(COUNT(*) AS DOUBLE) AS value FROM tx
UNION ALL SELECT 'blacklist_not_empty', COUNT(*) > 0, CAST(COUNT(*) AS DOUBLE) FROM bl"""))
def blacklist_refresh(spark, folder):
    return blacklists.refresh(transactions(spark, folder), workspace.new_path(spark, "blacklist"), 360)


# Frequencies

@query("freq_encode", """SELECT event_id, event_type, CAST(n AS DOUBLE) / total AS type_freq FROM events
JOIN (SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1) USING (event_type),
  (SELECT COUNT(event_type) AS total FROM events)""")
def freq_encode(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "event_type")
    return frequency.encode_frequency(events, "event_type", "type_freq")


@query("rare_values", """SELECT user_id, event_id FROM events WHERE user_id IN (
  SELECT user_id FROM events GROUP BY 1 HAVING COUNT(*) / (SELECT CAST(COUNT(*) AS DOUBLE) FROM events) < 0.05)""")
def rare_values(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "user_id")
    return frequency.rare_rows(events, "user_id")


# Protection

@query("mask_accounts", on_transactions("""SELECT tx_id,
  CASE WHEN length(nameOrig) > 5 THEN nameOrig[1:5] || repeat('*', length(nameOrig) - 5) ELSE nameOrig END AS nameOrig,
  CASE WHEN length(nameDest) > 5 THEN nameDest[1:5] || repeat('*', length(nameDest) - 5) ELSE nameDest END AS nameDest
FROM tx"""))
def mask_accounts(spark, folder):
    return transactions(spark, folder).select(
        "tx_id", *[protect.mask_account(F.col(c)).alias(c) for c in ("nameOrig", "nameDest")])


@query("mask_fixed", on_transactions("""SELECT tx_id,
  CASE WHEN length(nameOrig) > 5 THEN nameOrig[1:5] || '***' ELSE nameOrig END AS nameOrig,
  CASE WHEN length(type) > 5 THEN type[1:5] || '***' ELSE type END AS type FROM tx"""))
def mask_fixed(spark, folder):
    return transactions(spark, folder).select(
        "tx_id", *[protect.mask_fixed(F.col(c)).alias(c) for c in ("nameOrig", "type")])


@query("hash_accounts", on_transactions(
    "SELECT tx_id, sha256('default-salt:' || nameOrig)[1:16] AS hashed FROM tx"))
def hash_accounts(spark, folder):
    return transactions(spark, folder).select(
        "tx_id", protect.hash_account(F.col("nameOrig"), "default-salt").alias("hashed"))


@query("hash_short", "SELECT doc_id, CASE WHEN text = '' OR text IS NULL THEN 'none' ELSE sha256(text)[1:8] END AS hashed "
                     "FROM documents")
def hash_short(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return docs.select("doc_id", protect.hash_short(F.col("text")).alias("hashed"))


def _clean_sql(text: str, length: int, comments: bool) -> str:
    space = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
    kept = rf"regexp_replace(left({text}, {length}), '[^a-zA-Z0-9{space}\-_]', '', 'g')"
    if comments:
        kept = f"replace({kept}, '--', '')"
    return rf"COALESCE(regexp_replace(regexp_replace({kept}, '^[{space}]+', ''), '[{space}]+$', ''), '')"


@query("sanitize_text", "SELECT doc_id, " + _clean_sql("text", 100, True) + " AS cleaned FROM documents "
       "UNION ALL SELECT -1 - page_id, " + _clean_sql("html", 100, True) + " FROM pages")
def sanitize_text(spark, folder):
    """Prose and raw markup through the input cleaner; the cut at 100 characters is what the cleaner does."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    pages = spark.read.parquet(f"{folder}/pages.parquet").select(
        (F.lit(-1) - F.col("page_id")).alias("doc_id"), F.col("html").alias("text"))
    return docs.unionByName(pages).select("doc_id", protect.sanitize(F.col("text")).alias("cleaned"))


@query("sanitize_ui", "SELECT page_id, " + _clean_sql("html", 50, False) + " AS cleaned FROM pages")
def sanitize_ui(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return pages.select("page_id", protect.sanitize_ui(F.col("html")).alias("cleaned"))


@query("format_money", on_transactions(
    "SELECT tx_id, format('${:,.2f}', amount) AS exact, format('${:,.0f}', amount) AS whole FROM tx"))
def format_money(spark, folder):
    return transactions(spark, folder).select(
        "tx_id", protect.format_money(F.col("amount")).alias("exact"),
        protect.format_money(F.col("amount"), 0).alias("whole"))


# Search

@query("explorer", on_detected("""SELECT * FROM det WHERE type IN ('TRANSFER', 'DEBIT')
  AND (blacklist_flag = 1 OR (rule_fraud_flag = 1 AND blacklist_flag = 0))
  AND (nameOrig ILIKE '%c10%' OR nameDest ILIKE '%c10%')"""))
def explorer(spark, folder):
    wanted = explore.Search(types=["TRANSFER", "DEBIT"], methods=["blacklist", "rule"], account="c10")
    return explore.search(detected(spark, folder), wanted)


@query("explorer_method", on_detected("SELECT tx_id, blacklist_flag, rule_fraud_flag FROM det "
                                      "WHERE rule_fraud_flag = 1 AND blacklist_flag = 0"))
def explorer_method(spark, folder):
    return explore.search(detected(spark, folder), explore.Search(methods=["rule", "model"])).select(
        "tx_id", "blacklist_flag", "rule_fraud_flag")


@query("explorer_search", on_transactions(
    "SELECT tx_id, nameOrig, nameDest FROM tx WHERE nameOrig ILIKE '%m200%' OR nameDest ILIKE '%m200%'"))
def explorer_search(spark, folder):
    return explore.search(transactions(spark, folder), explore.Search(account="m200")).select(
        "tx_id", "nameOrig", "nameDest")


@query("explorer_page", on_detected("SELECT * FROM det WHERE type = 'CASH_OUT' ORDER BY amount DESC, tx_id LIMIT 50 OFFSET 100"))
def explorer_page(spark, folder):
    found = explore.search(detected(spark, folder), explore.Search(types=["CASH_OUT"]))
    return explore.page(found, 3, sort_by="amount")


@query("explorer_page_after", on_detected(
    """, last AS (SELECT amount, tx_id FROM det WHERE type = 'CASH_OUT' ORDER BY amount DESC, tx_id LIMIT 1 OFFSET 99)
SELECT det.* FROM det, last WHERE type = 'CASH_OUT'
  AND (det.amount < last.amount OR (det.amount = last.amount AND det.tx_id > last.tx_id))
ORDER BY det.amount DESC, det.tx_id LIMIT 50"""))
def explorer_page_after(spark, folder):
    """The same third page, found from the last row of the second."""
    found = explore.search(detected(spark, folder), explore.Search(types=["CASH_OUT"]))
    last = explore.page(found.select("amount", "tx_id"), 100, sort_by="amount", size=1).first()
    return explore.page_after(found, last["amount"], last["tx_id"], sort_by="amount")


@query("explorer_count", on_detected("SELECT COUNT(*) AS total FROM det WHERE type IN ('TRANSFER', 'DEBIT') AND blacklist_flag = 1"))
def explorer_count(spark, folder):
    wanted = explore.Search(types=["TRANSFER", "DEBIT"], methods=["blacklist"])
    return explore.search(detected(spark, folder), wanted).agg(F.count("*").alias("total"))


_SHOWN = ", ".join(
    (f"CASE WHEN length({c}) > 5 THEN {c}[1:5] || repeat('*', length({c}) - 5) ELSE {c} END" if c.startswith("name")
     else "CASE type " + " ".join(f"WHEN '{en}' THEN '{vi}'" for vi, en in DISPLAY_TYPES.items()) + " END" if c == "type"
     else c) + f' AS "{label}"'
    for c, label in DISPLAY_NAMES.items())


@query("explorer_renamed", on_detected(f"SELECT {_SHOWN} FROM fraud"))
def explorer_renamed(spark, folder):
    """Flagged rows with masked accounts, translated types and display names."""
    names = F.create_map(*[F.lit(x) for vi, en in DISPLAY_TYPES.items() for x in (en, vi)])
    rows = dashboard.only_fraud(detected(spark, folder)).drop("tx_id").withColumn("type", names[F.col("type")])
    return explore.for_display(rows)


# Validation

@query("validate_amount", on_transactions("SELECT tx_id, amount > 0 AND amount < 100000000 AS valid FROM tx"))
def validate_amount(spark, folder):
    return transactions(spark, folder).select("tx_id", quality.valid_amount(F.col("amount")).alias("valid"))


def _submitted(spark, folder):
    """Submitted records: the decoded message mix, where foreign JSON lacks the amount and breaks the contract."""
    return quality.with_defaults(source.readable(source.decode(_message_mix(spark, folder))))


_DEFAULTED = f"""
sub AS (SELECT {_FIELDS} FROM tx UNION ALL SELECT {', '.join(
    ("NULL::DOUBLE AS amount" if c not in RECORD_DEFAULTS else f"{RECORD_DEFAULTS[c]!r} AS {c}") for c in TX_COLUMNS)}
  FROM events)"""
_BROKEN = """concat_ws(',', CASE WHEN COALESCE(amount > 0 AND amount < 100000000, FALSE) THEN NULL ELSE 'amount_range' END,
  CASE WHEN isFlaggedFraud IN (0, 1) THEN NULL ELSE 'isFlaggedFraud_flag' END,
  CASE WHEN isFraud IN (0, 1) THEN NULL ELSE 'isFraud_flag' END,
  CASE WHEN regexp_matches(nameDest, '^[A-Za-z0-9_-]+$') THEN NULL ELSE 'nameDest_characters' END,
  CASE WHEN length(nameDest) BETWEEN 2 AND 50 THEN NULL ELSE 'nameDest_length' END,
  CASE WHEN regexp_matches(nameOrig, '^[A-Za-z0-9_-]+$') THEN NULL ELSE 'nameOrig_characters' END,
  CASE WHEN length(nameOrig) BETWEEN 2 AND 50 THEN NULL ELSE 'nameOrig_length' END,
  CASE WHEN newbalanceDest >= 0 THEN NULL ELSE 'newbalanceDest_not_negative' END,
  CASE WHEN newbalanceOrig >= 0 THEN NULL ELSE 'newbalanceOrig_not_negative' END,
  CASE WHEN oldbalanceDest >= 0 THEN NULL ELSE 'oldbalanceDest_not_negative' END,
  CASE WHEN oldbalanceOrg >= 0 THEN NULL ELSE 'oldbalanceOrg_not_negative' END,
  CASE WHEN step BETWEEN 1 AND 744 THEN NULL ELSE 'step_range' END,
  CASE WHEN type IN ('TRANSFER', 'CASH_OUT', 'PAYMENT', 'CASH_IN', 'DEBIT') THEN NULL ELSE 'type_known' END)"""


@query("validate_records", f"WITH {TX}, {_DEFAULTED} SELECT {_FIELDS} FROM sub WHERE {_BROKEN} = ''")
def validate_records(spark, folder):
    return quality.valid_rows(quality.check(_submitted(spark, folder), quality.submitted_record_rules()))


@query("quarantine", f"""WITH {TX}, {_DEFAULTED}
SELECT * FROM (SELECT {_FIELDS}, {_BROKEN} AS failed_rules FROM sub) WHERE failed_rules <> ''""")
def quarantine(spark, folder):
    return quality.quarantined_rows(quality.check(_submitted(spark, folder), quality.submitted_record_rules()))


@query("validate_table", on_transactions("""
SELECT failed_rules, COUNT(*) AS n FROM (
  SELECT '' AS failed_rules FROM tx WHERE amount >= 0 UNION ALL
  SELECT 'amount_not_negative' FROM tx WHERE amount < 0 UNION ALL
  SELECT 'amount_present,nameDest_present,nameOrig_present,type_present' FROM events) GROUP BY 1"""))
def validate_table(spark, folder):
    """How many messages break which constraints of the stored table."""
    rows = source.readable(source.decode(_message_mix(spark, folder)))
    checked = quality.check(rows, quality.table_rules())
    return checked.groupBy(F.concat_ws(",", "failed_rules").alias("failed_rules")).agg(F.count("*").alias("n"))


@query("expectations", on_blacklist("""
SELECT 'history_present' AS name, COUNT(*) > 0 AS passed, CAST(COUNT(*) AS DOUBLE) AS value FROM tx
UNION ALL SELECT 'blacklist_not_empty', COUNT(*) > 0, CAST(COUNT(*) AS DOUBLE) FROM bl
UNION ALL SELECT 'amounts_in_range', COUNT(*) = 0, CAST(COUNT(*) AS DOUBLE) FROM tx WHERE NOT (amount > 0 AND amount < 100000000)"""))
def expectations(spark, folder):
    tx = transactions(spark, folder)
    out_of_range = F.count_if(~quality.valid_amount(F.col("amount")))
    return (
        quality.expectation(tx, "history_present", F.count("*"), lambda v: v > 0)
        .unionByName(quality.expectation(blacklist(spark, folder), "blacklist_not_empty", F.count("*"), lambda v: v > 0))
        .unionByName(quality.expectation(tx, "amounts_in_range", out_of_range, lambda v: v == 0))
    )


@query("rule_residual", on_transactions(f"SELECT tx_id, isFraud FROM tx WHERE {RISKY} AND {RULE} = 0"))
def rule_residual(spark, folder):
    return exploration.rule_residual(transactions(spark, folder)).select("tx_id", "isFraud")

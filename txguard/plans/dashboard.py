"""The live dashboard: headline numbers, breakdowns, time lines, rankings.

Every function takes the detected transactions; ``as_of`` stands for "now" and defaults to the newest
ingest time in the data. Money is summed as a decimal, so the total does not depend on task order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txguard.functions.protect import format_money, mask_account, mask_fixed
from txguard.functions.rules import rate_band, reason
from txguard.operators.sampling import sample_rows
from txguard.schema import BOX_PLOT_LIMIT


def money_sum(column: str = "amount", when: Column | None = None) -> Column:
    value = F.col(column).cast("decimal(18,2)")
    return F.sum(value if when is None else F.when(when, value)).cast("double")


def _is_fraud() -> Column:
    return F.col("is_fraud_detected") == 1


def only_fraud(detected: DataFrame) -> DataFrame:
    return detected.where(_is_fraud())


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def headline(detected: DataFrame) -> DataFrame:
    """Total, fraud total, fraud rate in percent and average amount, in one pass."""
    counted = detected.agg(
        F.count("*").alias("total"), F.count_if(_is_fraud()).alias("fraud_total"), money_sum().alias("amount"))
    return counted.select(
        "total", "fraud_total",
        _percent(F.col("fraud_total"), F.col("total")).alias("fraud_rate"),
        F.coalesce(F.try_divide("amount", "total"), F.lit(0.0)).alias("avg_amount"),
    )


def analytics(detected: DataFrame) -> DataFrame:
    """Flag totals among fraud, average fraud and normal amounts, rate and its band, in one pass."""
    normal = F.col("is_fraud_detected") == 0
    counted = detected.agg(
        F.count("*").alias("total"),
        F.count_if(_is_fraud()).alias("fraud_total"),
        F.count_if(normal).alias("normal_total"),
        F.count_if(_is_fraud() & (F.col("blacklist_flag") == 1)).alias("blacklist_count"),
        F.count_if(_is_fraud() & (F.col("rule_fraud_flag") == 1)).alias("rule_count"),
        money_sum(when=_is_fraud()).alias("fraud_amount"),
        money_sum(when=normal).alias("normal_amount"),
    )
    rate = _percent(F.col("fraud_total"), F.col("total"))
    return counted.select(
        "total", "fraud_total", "blacklist_count", "rule_count",
        F.coalesce(F.try_divide("fraud_amount", "fraud_total"), F.lit(0.0)).alias("avg_fraud_amount"),
        F.coalesce(F.try_divide("normal_amount", "normal_total"), F.lit(0.0)).alias("avg_normal_amount"),
        rate.alias("fraud_rate"),
        rate_band(rate).alias("rate_band"),
    )


def source_split_inclusive(detected: DataFrame) -> DataFrame:
    """Sums of both flags; the model gets what is left of the total, never below 0. Rows with both flags count twice."""
    totals = only_fraud(detected).agg(
        F.count("*").alias("n"), F.count_if(F.col("blacklist_flag") == 1).alias("blacklist"),
        F.count_if(F.col("rule_fraud_flag") == 1).alias("rule"))
    rest = F.greatest(F.lit(0).cast("long"), F.col("n") - F.col("blacklist") - F.col("rule"))
    return totals.select("blacklist", "rule", rest.alias("model")).unpivot(
        [], ["blacklist", "rule", "model"], "source", "n")


def source_split_exclusive(detected: DataFrame) -> DataFrame:
    """Each flagged row once, by precedence."""
    return only_fraud(detected).groupBy(reason("blacklist", "rule", "model").alias("source")).agg(
        F.count("*").alias("n"))


def by_type(detected: DataFrame) -> DataFrame:
    return detected.groupBy("type").agg(
        F.count("*").alias("count"), F.count_if(_is_fraud()).alias("fraud_count")).orderBy(F.desc("count"), "type")


def fraud_by_type(detected: DataFrame) -> DataFrame:
    return only_fraud(detected).groupBy("type").agg(
        F.count("*").alias("fraud_count"), money_sum().alias("total_amount")).orderBy(F.desc("fraud_count"), "type")


def newest(detected: DataFrame) -> Column:
    """Newest ingest time as a scalar subquery: no driver round trip, and the scan can filter by it."""
    return detected.agg(F.max("ingested_at").alias("newest")).scalar()


def recent(detected: DataFrame, hours: int, as_of: Column | None = None) -> DataFrame:
    """Rows of the last ``hours`` hours."""
    now = newest(detected) if as_of is None else as_of
    return detected.where(F.col("ingested_at") >= now - F.expr(f"INTERVAL {int(hours)} HOURS"))


def per_minute(detected: DataFrame, hours: int, as_of: Column | None = None) -> DataFrame:
    """Rows and flagged rows per minute."""
    return (
        recent(detected, hours, as_of)
        .groupBy(F.date_trunc("minute", "ingested_at").cast("timestamp_ntz").alias("minute"))
        .agg(F.count("*").alias("total"), F.count_if(_is_fraud()).alias("fraud")).orderBy("minute")
    )


def fraud_per_minute(detected: DataFrame, hours: int = 1, as_of: Column | None = None) -> DataFrame:
    minutes = per_minute(detected, hours, as_of)
    return minutes.where("fraud > 0").select("minute", F.col("fraud").alias("fraud_count"))


def cumulative_fraud(detected: DataFrame, hours: int = 1, as_of: Column | None = None) -> DataFrame:
    """Running fraud count. The one-partition window sees at most ``60 * hours + 1`` minutes, not rows."""
    so_far = Window.orderBy("minute").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return fraud_per_minute(detected, hours, as_of).withColumn("cumulative", F.sum("fraud_count").over(so_far))


def lookback_counts(detected: DataFrame, hours: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Rows and flagged rows within each of several lookbacks, from one scan of the longest."""
    widest = recent(detected, max(hours)).withColumn("newest", newest(detected))
    windows = F.array(*[F.lit(h) for h in hours])
    tagged = widest.withColumn("hours", F.explode(F.filter(
        windows, lambda h: F.col("ingested_at") >= F.col("newest") - F.make_dt_interval(F.lit(0), h))))
    return tagged.groupBy("hours").agg(F.count("*").alias("total"), F.count_if(_is_fraud()).alias("fraud"))


def hour_heatmap(detected: DataFrame) -> DataFrame:
    """Flagged rows per type and hour of day, columns ``h00`` to ``h23``, 0 where there are none."""
    hours = list(range(24))
    keyed = only_fraud(detected).withColumn("hour", F.pmod(F.col("step"), F.lit(24)).cast("int"))
    return (
        keyed.groupBy("type").pivot("hour", hours).count().na.fill(0)
        .withColumnsRenamed({str(h): f"h{h:02d}" for h in hours})
    )


def top_accounts(detected: DataFrame, account: str, n: int = 10, mask: bool = True) -> DataFrame:
    """Accounts with the most flagged rows (id ascending on a tie): count, total and average amount."""
    ranked = only_fraud(detected).groupBy(account).agg(
        F.count("*").alias("fraud_count"), money_sum().alias("total_amount")
    ).orderBy(F.desc("fraud_count"), account).limit(n)
    shown = mask_account(F.col(account)) if mask else F.col(account)
    return ranked.select(
        shown.alias(account), "fraud_count", "total_amount",
        (F.col("total_amount") / F.col("fraud_count")).alias("avg_amount"))


def alert_feed(detected: DataFrame, n: int = 20, tie_break: str = "tx_id") -> DataFrame:
    """The newest flagged rows with masked accounts, money as text and the reason."""
    latest = only_fraud(detected).orderBy(F.desc("ingested_at"), tie_break).limit(n)
    return latest.select(
        mask_account(F.col("nameOrig")).alias("nameOrig"), mask_account(F.col("nameDest")).alias("nameDest"),
        format_money(F.col("amount")).alias("amount"), "type", reason().alias("reason"), "ingested_at")


def freshness(detected: DataFrame) -> DataFrame:
    return detected.agg(F.max("ingested_at").alias("last_ingested"))


def chart_sample(detected: DataFrame, n: int = 15_000, limit: float = BOX_PLOT_LIMIT) -> DataFrame:
    """The points a box chart draws; its statistics come from all rows instead."""
    small = detected.where(F.col("amount") < limit)
    return sample_rows(small, n, ["tx_id"]).select("tx_id", "amount", "is_fraud_detected")


def ops_summary(detected: DataFrame, tie_break: str = "tx_id") -> DataFrame:
    """All numbers of the operations page in long form: ``section, rank, label, n, amount, note``.

    ``n`` counts the transactions a row stands for, 1 where it shows a single one.
    """
    def section(df: DataFrame, name: str, order: list[Column], **columns: Column) -> DataFrame:
        filled = {"label": F.lit(None).cast("string"), "n": F.lit(1).cast("long"),
                  "amount": F.lit(None).cast("double"), "note": F.lit(None).cast("string"), **columns}
        # Each section has at most a handful of rows by now, so numbering them in one task is fine.
        rank = F.row_number().over(Window.orderBy(*order))
        return df.select(F.lit(name).alias("section"), rank.alias("rank"), *[c.alias(k) for k, c in filled.items()])

    # One aggregation by type, reused for the totals, the freshness and the list of types.
    cells = detected.groupBy("type").agg(
        F.count("*").alias("rows"), F.count_if(_is_fraud()).alias("fraud"), F.max("ingested_at").alias("newest"))
    whole = cells.agg(F.sum("rows").alias("rows"), F.sum("fraud").alias("fraud"), F.max("newest").alias("newest"))
    rate = F.round(_percent(F.col("fraud"), F.col("rows")), 3)
    summary = section(whole, "totals", [F.lit(1)], n=F.col("rows"), amount=rate, note=F.col("fraud").cast("string"))
    fresh = section(whole, "freshness", [F.lit(1)], label=F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))
    senders = only_fraud(detected).groupBy("nameOrig").agg(
        F.count("*").alias("fraud_count"), money_sum().alias("total_amount")
    ).orderBy(F.desc("fraud_count"), "nameOrig").limit(5)
    top = section(senders, "top_fraud", [F.desc("fraud_count"), F.col("nameOrig")],
                  label=mask_account(F.col("nameOrig")), n=F.col("fraud_count"), amount=F.round("total_amount", 2))
    latest = only_fraud(detected).orderBy(F.desc("ingested_at"), tie_break).limit(5)
    feed = section(latest, "recent_fraud", [F.desc("ingested_at"), F.col(tie_break)],
                   label=F.concat_ws(" > ", mask_fixed(F.col("nameOrig")), mask_fixed(F.col("nameDest"))),
                   amount=F.col("amount"),
                   note=F.concat_ws(" ", "type", reason(), F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss")))
    types = section(cells.where("fraud > 0"), "fraud_by_type", [F.desc("fraud"), F.col("type")],
                    label=F.col("type"), n=F.col("fraud"))
    return summary.unionByName(fresh).unionByName(top).unionByName(feed).unionByName(types)

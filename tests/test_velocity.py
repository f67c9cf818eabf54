"""Trailing counts and the limiter against brute force, in batch and as a stream."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from txguard import workspace
from txguard.operators import velocity
from txguard.operators.velocity import limit_rate, trailing_counts
from txguard.sources.lake import LakeTable
from txguard.streaming import detection, limiter

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def history(seed, n=600):
    """A hot account with long bursts and copies at one instant, quiet accounts, one without a name."""
    rng = random.Random(seed)
    events, moment = [], 0.0
    for _ in range(n):
        moment += rng.choice([0.0, 0.0, 0.5, 1.0, 3.0, 7.5, 30.0, 60.0, 75.0, 500.0])
        events.append(("hot", moment))
    events += [(f"c{rng.randrange(8)}", float(rng.randrange(4000))) for _ in range(n // 2)]
    events += [(None, float(rng.randrange(0, 2000, 9))) for _ in range(n // 6)]
    rng.shuffle(events)
    return events


def frame(spark, events):
    return spark.createDataFrame([(k, at(s)) for k, s in events], "account string, ts timestamp_ntz")


def by_account(events):
    groups = {}
    for key, moment in events:
        groups.setdefault(key, []).append(moment)
    return {key: sorted(moments) for key, moments in groups.items()}


def brute_trailing(events, window):
    return {
        (key, at(m)): (moments.count(m), sum(m - window < other <= m for other in moments))
        for key, moments in by_account(events).items() for m in moments}


def brute_limiter(events, limit, window):
    """One event after the other, as a service would see them."""
    result = {}
    for key, moments in by_account(events).items():
        kept = []
        for m in moments:
            kept = [t for t in kept if m - t < window]
            n, allowed, _ = result.get((key, at(m)), (0, 0, 0))
            if len(kept) < limit:
                kept.append(m)
                allowed += 1
            result[(key, at(m))] = (n + 1, allowed, limit - len(kept))
    return result


@pytest.mark.parametrize("window", [60, 1, 700, 640, 5000, 100_000])
def test_trailing_counts(spark, window):
    events = history(window)
    found = trailing_counts(frame(spark, events), "account", "ts", window).collect()
    assert {(r.account, r.ts): (r.n, r.n_window) for r in found} == brute_trailing(events, window)
    assert len(found) == len(brute_trailing(events, window))


def test_edges_of_long_windows(spark):
    """Events right at the bounds of buckets and windows, before 1970 too, and gaps of many windows."""
    window = 6400
    moments = [sign * (k * 100 + d) for k in (0, 1, 63, 64, 65, 128, 1000) for d in (0.0, 0.000001, 99.999999) for sign in (1, -1)]
    events = [("a", m - START.timestamp()) for m in moments] + [("b", m) for m in moments]
    found = trailing_counts(frame(spark, events), "account", "ts", window).collect()
    assert {(r.account, r.ts): (r.n, r.n_window) for r in found} == {
        (k, at(m)): (n, sum(1 for a, o in events if a == k and at(m) - dt.timedelta(seconds=window) < at(o) <= at(m)))
        for (k, m), n in Counter(events).items()}


def test_a_hot_account_spreads_over_tasks_in_a_long_window(spark):
    """One account with half of the rows, a window of a third of the time: no task counts more than a small share of them."""
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 900)).alias("account"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"))
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        found = trailing_counts(rows, "account", "ts", 800_000)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert sum(sizes) == 40_000 and len(sizes) == 16 and max(sizes) < 2 * 40_000 / 16


@pytest.mark.parametrize("limit, window, seed", [(3, 60, 1), (1, 60, 2), (10, 60, 3), (5, 700, 4), (100, 60, 5)])
def test_limiter(spark, limit, window, seed):
    events = history(seed)
    found = limit_rate(frame(spark, events), "account", "ts", limit, window).collect()
    expected = brute_limiter(events, limit, window)
    assert {(r.account, r.ts): (r.n, r.allowed, r.remaining) for r in found} == expected
    assert all(r.rejected == r.n - r.allowed for r in found) and len(found) == len(expected)


def test_limiter_on_one_saturated_account(spark):
    """Events every second for hours: one chain from end to end."""
    events = [("hot", float(i)) for i in range(8000)]
    found = limit_rate(frame(spark, events), "account", "ts", 20, 60).collect()
    assert {(r.account, r.ts): (r.n, r.allowed, r.remaining) for r in found} == brute_limiter(events, 20, 60)


def test_event_exactly_one_window_old_has_left(spark):
    events = [("a", 0.0), ("a", 60.0), ("a", 119.999999)]
    found = {r.ts: r.allowed for r in limit_rate(frame(spark, events), "account", "ts", 1, 60).collect()}
    assert found == {at(0): 1, at(60): 1, at(119.999999): 0}


def test_streamed_limiter_equals_batch(spark):
    """Several micro-batches in time order; the state carries over."""
    events = [(k, s) for k, s in history(9) if k is not None]
    root = workspace.new_path(spark, "limiter-test")
    moments = sorted({s for _, s in events})
    cuts = [moments[len(moments) * i // 4] for i in range(4)] + [moments[-1] + 1]
    table = LakeTable(spark, f"{root}/decisions")
    for low, high in zip(cuts, cuts[1:]):
        part = frame(spark, [(k, s) for k, s in events if low <= s < high])
        part.coalesce(1).write.mode("append").parquet(f"{root}/rows")
        stream = spark.readStream.schema(part.schema).parquet(f"{root}/rows")
        query = limiter.limit_stream(stream, "account", "ts", 3, 60).writeStream.foreachBatch(table.append).option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        detection.run_to_end(query)
    found = table.read().withColumn("ts", F.expr("timestampadd(MICROSECOND, at, TIMESTAMP_NTZ'1970-01-01 00:00:00')"))
    expected = {k: v[:2] for k, v in brute_limiter(events, 3, 60).items()}
    assert {(r.key, r.ts): (r.n, r.allowed) for r in found.collect()} == expected


def test_forgotten_accounts_leave_the_state(spark):
    """Five hundred accounts, then silence for all but one: the state shrinks to what its window still needs, verdicts stay right."""
    root = workspace.new_path(spark, "limiter-expiry")
    batches = [[(f"c{i}", float(i % 50)) for i in range(500)] + [("kept", 10.0)] * 3 + [(None, 10.0)] * 4, [("kept", 5000.0), ("kept", 5010.0)], [("kept", 5020.0), ("kept", 9000.0)]]
    table, sizes = LakeTable(spark, f"{root}/decisions"), []
    for events in batches:
        frame(spark, events).coalesce(1).write.mode("append").parquet(f"{root}/rows")
        stream = spark.readStream.schema(frame(spark, events).schema).parquet(f"{root}/rows")
        query = limiter.limit_stream(stream, "account", "ts", 2, 60, "1 minute").writeStream.foreachBatch(table.append).option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        detection.run_to_end(query)
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    expected = {k: v[:2] for k, v in brute_limiter([e for b in batches for e in b], 2, 60).items()}
    found = table.read().withColumn("ts", F.expr("timestampadd(MICROSECOND, at, TIMESTAMP_NTZ'1970-01-01 00:00:00')"))
    assert {(r.key, r.ts): (r.n, r.allowed) for r in found.collect()} == expected
    assert sizes[0] >= 500 and sizes[1] < 20 and sizes[2] < 20


def test_no_window_over_instants_slides(spark):
    """A sliding frame adds up every window anew: an account's work would grow as the square of its events."""
    rows = frame(spark, [("a", 0.0)])
    for df in (velocity._marked(rows, "account", "ts", 60_000_000, 600_000_000, 2), trailing_counts(rows, "account", "ts", 60)):
        starts = re.findall(r"specifiedwindowframe\(\w+, ([^,]+),", df._jdf.queryExecution().toString())
        assert starts and set(starts) == {"unboundedpreceding$()"}

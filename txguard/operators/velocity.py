"""Trailing event counts and the exact rate limiter, per account.

An account's history is cut into time slices. Each slice also gets the last window of the slice before
it, so slices are counted independently and a hot account spreads over as many tasks as it has slices.
Windows that are longer than a slice are counted on two levels, from buckets and their edges.
Events of one account at one instant collapse into a count before anything is shuffled.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from txguard import workspace

MICROS = 1_000_000
MIN_SLICE_SECONDS = 600
BUCKETS = 64  # of a window longer than a slice; a divisor of a million, so buckets are whole microseconds


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{ts}` AS TIMESTAMP_NTZ))")


def from_micros(at: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, `{at}`, TIMESTAMP_NTZ'1970-01-01 00:00:00')")


def _sliced(df: DataFrame, width: int, before: int, after: int = 0) -> DataFrame:
    """Give each row its ``slice`` and copies (``own`` false) to the neighbours that look at it.

    A slice sees ``before`` microseconds of the slice in front of it and ``after`` of the one behind it;
    neither may exceed ``width``.
    """
    own = F.floor(F.col("at") / F.lit(width)).cast("long")
    offset = F.pmod(F.col("at"), F.lit(width))
    slices = F.array_compact(F.array(
        own, F.when(offset >= width - before, own + 1), F.when(offset < after, own - 1)))
    return df.withColumn("slice", F.explode(slices)).withColumn("own", F.col("slice") == own)


def _width(seconds: int) -> int:
    return max(seconds, MIN_SLICE_SECONDS) * MICROS


def _per_instant(df: DataFrame, key: str, ts: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("key"), micros(ts).alias("at")).groupBy("key", "at").agg(
        F.count("*").alias("n"))


def _in_slice(order: Column | None = None) -> WindowSpec:
    return Window.partitionBy("key", "slice").orderBy("at" if order is None else order)


def _with_window_sum(sliced: DataFrame, window: int) -> DataFrame:
    """``n_window`` for instants in slices: a running sum to which each adds what it has, and takes it off one window later.

    The work is in proportion to the instants. A frame that slides would add up each window anew, so an account's work would
    grow as the square of its events.
    """
    arrive = F.struct("at", "n", "own", F.col("n").alias("change"), F.lit(True).alias("here"))
    leave = F.struct(
        (F.col("at") + window).alias("at"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("own"),
        (-F.col("n")).alias("change"), F.lit(False).alias("here"))
    dealt = sliced.repartition("key", "slice")  # once for all windows over slices, before the rows are doubled
    moves = dealt.select("key", "slice", F.explode(F.array(arrive, leave)).alias("m")).select("key", "slice", "m.*")
    so_far = _in_slice().rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return moves.withColumn("n_window", F.sum("change").over(so_far)).where("here").drop("change", "here")


def trailing_counts(df: DataFrame, key: str, ts: str, window_seconds: int = 60) -> DataFrame:
    """Rows ``(key, ts, n, n_window)``: events at each instant and in the window that ends there.

    An event that is exactly ``window_seconds`` old has left the window. Short windows look back within time slices; for
    longer ones see ``_by_buckets``.
    """
    window = window_seconds * MICROS
    instants = _per_instant(df, key, ts)
    if window_seconds > MIN_SLICE_SECONDS:
        counted = _by_buckets(instants, window)
    else:
        counted = _with_window_sum(_sliced(instants, _width(window_seconds), window), window).where("own")
    return counted.select(
        F.col("key").cast(df.schema[key].dataType).alias(key), from_micros("at").alias(ts), "n", "n_window")


def _by_buckets(instants: DataFrame, window: int) -> DataFrame:
    """``n_window`` on two levels, for ``instants`` ``(key, at, n)``: whole buckets are counted once, only their edges event by event.

    The window of an instant in bucket ``k`` starts in bucket ``k - BUCKETS``. It holds what the buckets from there to
    ``k - 1`` have, plus what bucket ``k`` has had so far, less what the first of them has lost: its events come back one
    window later with a minus. So a bucket is counted from its own rows and those of one other bucket, and an account's
    events spread over as many tasks as it has buckets, though the window is ``BUCKETS`` times as long.
    """
    width = window // BUCKETS
    slot = F.floor(F.col("at") / F.lit(width)).cast("long")
    totals = instants.select("key", slot.alias("at"), "n").groupBy("key", "at").agg(F.sum("n").alias("c"))
    # Sums over the buckets before, within slices of buckets: a row for each bucket, whatever it holds.
    lasting = Window.partitionBy("key", "slice").orderBy("at").rangeBetween(-BUCKETS, -1)
    carried = _sliced(totals, 4 * BUCKETS, BUCKETS).withColumn("carry", F.coalesce(F.sum("c").over(lasting), F.lit(0))).where("own")
    start = F.lit(0).cast("long")
    carried = carried.select(
        "key", F.col("at").alias("slice"), (F.col("at") * width - 1).alias("at"), start.alias("n"), F.col("carry").alias("change"), F.lit(False).alias("own"))
    arrive = F.struct(slot.alias("slice"), F.col("at").alias("at"), F.col("n").alias("n"), F.col("n").alias("change"), F.lit(True).alias("own"))
    leave = F.struct((slot + BUCKETS).alias("slice"), (F.col("at") + window).alias("at"), start.alias("n"), (-F.col("n")).alias("change"), F.lit(False).alias("own"))
    moves = instants.select("key", F.explode(F.array(arrive, leave)).alias("m")).select("key", "m.*")
    so_far = Window.partitionBy("key", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    return moves.unionByName(carried).withColumn("n_window", F.sum("change").over(so_far)).where("own")


def _marked(df: DataFrame, key: str, ts: str, window: int, width: int, limit: int) -> DataFrame:
    """Instants with their trailing count and whether a busy one (over the limit) is one window behind or ahead.

    A slice sees two windows back, so that the counts one window back are whole, and one ahead. All
    windows share one shuffle, and each goes through a slice once: the nearest busy instants tell whether
    there is one in reach.
    """
    sliced = _sliced(_per_instant(df, key, ts), width, 2 * window, window)
    busy_at = F.when(F.col("n_window") > limit, F.col("at"))
    last = F.max(busy_at).over(_in_slice().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.min(busy_at).over(_in_slice(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1))
    near = _with_window_sum(sliced, window).withColumn("last", last).withColumn("following", following)
    return near.where("own").withColumns(
        {
            "after_busy": F.coalesce(F.col("at") - F.col("last") < window, F.lit(False)),
            "before_busy": F.coalesce(F.col("following") - F.col("at") < window, F.lit(False)),
        }
    ).drop("own", "last", "following")


def _runs(replayed: DataFrame, window: int) -> DataFrame:
    """``(key, slice, run)``: slices joined into runs; between two runs of a key lies a full window or more."""
    by_slice = replayed.groupBy("key", "slice").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    # One row per key and slice: the clock bounds this window, not the number of events.
    in_order = Window.partitionBy("key").orderBy("slice")
    before = F.lag("last").over(in_order)
    starts = by_slice.withColumn(
        "start", F.when(before.isNull() | (F.col("first") - before >= window), F.col("slice")))
    return starts.select("key", "slice", F.max("start").over(in_order).alias("run"))


def decide(recent: deque, at: np.ndarray, n: np.ndarray, limit: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Passed events and what remains of the limit, for one account's instants in time order.

    ``recent`` holds the passed events of the last window as ``(instant, passed)``, at most ``limit`` pairs,
    and is updated. With the limit used up, all instants before the oldest pair expires are rejected in one
    step, so the loop runs per passed event, of which the clock allows only so many, not per rejected one.
    """
    allowed, remaining = np.zeros(len(at), "int64"), np.zeros(len(at), "int64")
    used, i = sum(passed for _, passed in recent), 0
    while i < len(at):
        while recent and at[i] - recent[0][0] >= window:
            used -= recent.popleft()[1]
        if used == limit:
            i = int(np.searchsorted(at, recent[0][0] + window))
            continue
        passed = min(int(n[i]), limit - used)
        recent.append((int(at[i]), passed))
        used += passed
        allowed[i], remaining[i] = passed, limit - used
        i += 1
    return allowed, remaining


def limit_rate(df: DataFrame, key: str, ts: str, limit: int = 100, window_seconds: int = 60) -> DataFrame:
    """Exact limiter: an event passes iff fewer than ``limit`` *passed* events lie in the window before it.

    Rows ``(key, ts, n, allowed, rejected, remaining)`` per instant; of ``n`` events at one instant the
    first ``allowed`` in arrival order pass.

    An instant whose trailing count stays within the limit passes whole whatever happened before, and
    unless a busy instant lies in its window, nothing before it was rejected either. Only the others,
    and the window in front of them, are replayed in Python: sorted, run by run, as a stream of Arrow
    batches with at most ``limit`` remembered instants. One account that exceeds the limit without a
    pause is one run: a chain of decisions that no split can break. Its instants pass through one task,
    with constant memory and work per passed event only; ``streaming.limiter`` takes them in micro-batches.
    """
    window = window_seconds * MICROS
    width = _width(10 * window_seconds)
    spark = df.sparkSession
    marked = workspace.write_table(
        _marked(df, key, ts, window, width, limit), workspace.new_path(spark, "limiter"))
    replayed = marked.where("after_busy OR before_busy")
    runs = _runs(replayed, window)
    same = F.col("m.key").eqNullSafe(F.col("r.key")) & (F.col("m.slice") == F.col("r.slice"))
    in_runs = replayed.alias("m").join(runs.alias("r"), same).select("m.key", "r.run", "m.at", "m.n", "m.after_busy")

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, recent = None, deque()
        for batch in filter(len, batches):
            keys, runs_, at, n = (batch[c].to_numpy() for c in ("key", "run", "at", "n"))
            turns = np.flatnonzero((keys[1:] != keys[:-1]) | (runs_[1:] != runs_[:-1])) + 1
            parts = []
            for low, high in zip([0, *turns], [*turns, len(at)]):
                if (keys[low], runs_[low]) != current:
                    current, recent = (keys[low], runs_[low]), deque()
                parts.append(decide(recent, at[low:high], n[low:high], limit, window))
            allowed, remaining = (np.concatenate(c) for c in zip(*parts))
            found = batch.assign(allowed=allowed, remaining=remaining)
            yield found.loc[batch["after_busy"], ["key", "at", "n", "allowed", "remaining"]]

    judged = (
        in_runs.repartition("key", "run").sortWithinPartitions("key", "run", "at")
        .mapInPandas(replay, "key string, at long, n long, allowed long, remaining long")
    )
    plain = marked.where("NOT after_busy").select(
        "key", "at", "n", F.col("n").alias("allowed"), (F.lit(limit) - F.col("n_window")).alias("remaining"))
    return plain.unionByName(judged).select(
        F.col("key").cast(df.schema[key].dataType).alias(key), from_micros("at").alias(ts), "n", "allowed",
        (F.col("n") - F.col("allowed")).alias("rejected"), "remaining")

"""Running totals and the areas under the ranking curves against plain restatements."""

import random

import pytest
from pyspark.sql import functions as F

from txguard.operators.prefix import running_totals
from txguard.plans.ranking import ranking_curve, ranking_metrics


def areas_by_hand(rows):
    """Pairs one by one; points of the precision-recall curve one by one."""
    rows = [(s, y) for s, y in rows if s is not None and y is not None]
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y != 1]
    pairs = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    points = []
    for cut in sorted({s for s, _ in rows}, reverse=True):
        hit = sum(p >= cut for p in pos)
        points.append((hit / len(pos) if pos else 0, hit / (hit + sum(n >= cut for n in neg))))
    points = [(0.0, points[0][1]), *points] if points else []
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    return len(pos), len(neg), pairs / (len(pos) * len(neg)) if pos and neg else None, area if pos else None


@pytest.mark.parametrize("case", ["ties", "distinct", "separated", "one class", "no fraud", "missing"])
def test_areas_like_by_hand(spark, case):
    random.seed(case)
    rows = {
        "ties": [(float(random.randrange(6)), int(random.random() < 0.3)) for _ in range(300)],
        "distinct": [(random.gauss(0, 1) + y, y) for y in (0, 1) for _ in range(150)],
        "separated": [(float(i), int(i > 50)) for i in range(80)],
        "one class": [(1.0, 1), (2.0, 1)], "no fraud": [(1.0, 0), (-2.0, 0)],
        "missing": [(None, 1), (1.0, None), (float("inf"), 1), (float("-inf"), 0), (0.5, 1), (0.5, 0)]}[case]
    found = ranking_metrics(spark.createDataFrame(rows, "score double, isFraud int").repartition(7)).first()
    want = areas_by_hand(rows)
    assert tuple(found)[:2] == want[:2]
    for ours, theirs in zip(tuple(found)[2:], want[2:]):
        assert ours == theirs if theirs is None else ours == pytest.approx(theirs)
    assert ranking_curve(spark.createDataFrame(rows, "score double, isFraud int")).count() == len({s for s, y in rows if None not in (s, y)})


def test_no_rows(spark):
    assert tuple(ranking_metrics(spark.createDataFrame([], "score double, isFraud int")).first()) == (0, 0, None, None)


def test_running_totals_over_ranges(spark):
    """Several ranges; each goes on where the one before ended, and no task holds all rows."""
    rows = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"), (F.col("id") % 13).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = running_totals(rows, F.col("k"), ["v"])
        rows_of = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(rows_of) == 5000 and len(rows_of) > 1 and max(rows_of) < 4000
    total, expected = 0, {}
    for k, v in sorted((r.k, r.v) for r in rows.collect()):
        expected[k] = total
        total += v
    assert {r.k: r.before_v for r in found.collect()} == expected

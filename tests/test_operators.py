"""Quantiles, profiles, histograms, frequencies, samples, search and contracts."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txguard.operators import explore, quality, radix
from txguard.operators.frequency import encode_frequency, rare_rows, value_frequencies
from txguard.operators.histogram import histogram
from txguard.operators.profile import duplicate_count, missing_counts, numeric_profile, string_profile
from txguard.operators.quantiles import exact_quantiles
from txguard.operators.explore import page, page_after
from txguard.operators.sampling import first_rows, nth_smallest, sample_fraction, sample_rows, sample_with_replacement, split_by_id
from txguard.schema import DISPLAY_NAMES

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]


def quantiles(df, groups, few):
    found = exact_quantiles(df, groups, "v", PROBABILITIES, few)
    return {tuple(r[g] for g in groups) + (r.p,): r.quantile for r in found.collect()}


@pytest.mark.parametrize("few", [0, 300, 100_000])
@pytest.mark.parametrize("shape", ["uniform", "ties", "heavy", "tiny", "signed"])
def test_quantiles_equal_numpy(spark, shape, few):
    """With all four rounds, with three, and with the second one by whole keys."""
    rng = np.random.default_rng(7)
    values = {
        "uniform": rng.uniform(0, 1e6, 5000), "ties": rng.integers(0, 5, 5000).astype(float),
        "heavy": np.where(rng.uniform(size=5000) < 0.6, 42.0, rng.lognormal(5, 3, 5000)),
        "tiny": np.array([3.0, 1.0, 2.0]), "signed": rng.normal(0, 1, 997)}[shape]
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(5)
    found = quantiles(df, [], few)
    for p in PROBABILITIES:
        assert found[(p,)] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_quantiles_by_group_ignore_missing(spark):
    rows = [("a", float(i)) for i in range(101)] + [("b", None), ("b", 5.0), (None, 1.0), (None, 2.0)]
    found = quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], 1000)
    assert found[("a", 0.25)] == 25.0 and found[("a", 0.9)] == 90.0 and found[("b", 0.5)] == 5.0
    assert found[(None, 0.5)] == 1.5


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 2.0, 1 - 2**-53, 1 + 2**-52, 1.7976931348623157e308,
         -1.7976931348623157e308, 8.98846567431158e307, float("inf"), float("-inf"), 0.1, -1e-300, 3.0, 7.999999999999999, 8.0, 2**53 - 1.0]


def test_keys_order_all_doubles(spark):
    """The key is the bits with the sign, for edges, powers of two and random bit patterns; and it leads back."""
    rng = np.random.default_rng(11)
    patterns = rng.integers(0, 2**63 - 1, 20_000, dtype=np.int64).view(np.float64)
    powers = [float(np.ldexp(m, e)) for e in range(-1074, 1024, 7) for m in (1.0, 1 - 2**-53, 1 + 2**-52) if 0 < np.ldexp(m, e) < np.inf]
    values = np.array([*EDGES, *powers, *patterns[~np.isnan(patterns)], *-patterns[~np.isnan(patterns)][:5000]])
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    found = radix.with_sortable_bits(df, F.col("v"), "k").select("v", "k", radix.from_bits(F.col("k")).alias("back")).toPandas()
    bits = np.abs(found["v"].to_numpy()).view(np.int64)
    assert (found["k"].to_numpy() == np.where(found["v"] < 0, -bits, bits)).all() and (found["v"] == found["back"]).all()
    odd = radix.with_sortable_bits(spark.createDataFrame([(float("nan"),), (None,)], "v double"), F.col("v"), "k")
    assert [r.k for r in odd.collect()] == [2**63 - 1, None]


def test_rounds_count_digits_not_rows(spark):
    """200,000 different values: a round puts out at most a digit's worth of rows below a prefix."""
    rows = radix.with_sortable_bits(spark.range(200_000).select(F.lit(0).cast("long").alias("parent"), F.rand(3).alias("v")), F.col("v"))
    assert radix._count(rows, [], 48).count() < 500
    below = rows.withColumn("parent", F.shiftright("__key", 48))
    largest = radix._count(below, [], 32).groupBy("parent").agg(F.count("*").alias("n"), F.sum("c").alias("rows")).agg(F.max("n"), F.sum("rows")).first()
    assert largest[0] <= 1 << radix.DIGIT and largest[1] == 200_000


def test_ranks_with_counts_below(spark):
    rows = spark.createDataFrame([("a", v) for v in (5, -3, 5, 9, 5)] + [(None, 2**62), (None, -(2**63))], "g string, v long")
    found = radix.select_ranks(rows, ["g"], "v", lambda n: F.array(F.lit(0), F.lit(2), n - 1, n).cast("array<long>"), 0)
    assert sorted(tuple(r) for r in found.collect() if r.g) == [("a", 5, 0, 0, -3), ("a", 5, 2, 1, 5), ("a", 5, 4, 4, 9)]
    assert sorted(tuple(r)[1:] for r in found.collect() if r.g is None) == [(2, 0, 0, -(2**63)), (2, 1, 1, 2**62)]
    assert radix.select_ranks(rows.limit(0), [], "v", lambda n: F.array(F.lit(0).cast("long"))).count() == 0


def test_nth_smallest(spark):
    rows = spark.createDataFrame([(i % 7 - 3, (i % 5) / 2 - 1.0) for i in range(70)] + [(None, None)], "v int, w double")
    assert nth_smallest(rows, "v", 1) == (-3, 0) and nth_smallest(rows, "v", 70, few=0) == (3, 60) and nth_smallest(rows, "v", 71) is None
    assert nth_smallest(rows, "w", 15) == (-0.5, 14)


def test_quantiles_of_many_groups(spark):
    """More groups than are broadcast meet their rows in a shuffle."""
    rows = spark.range(30_003).select((F.col("id") % 10_001).alias("g"), F.col("id").cast("double").alias("v"))
    found = exact_quantiles(rows, ["g"], "v", [0.5])
    assert found.count() == 10_001 and found.where("quantile <> g + 10001").isEmpty()


def test_profiles_equal_pandas(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"x": rng.normal(50, 10, 500), "y": rng.integers(0, 9, 500).astype(float)})
    frame["s"] = rng.choice(["p", "q", "r"], 500, p=[0.5, 0.3, 0.2])
    frame.loc[::50, ["x", "s"]] = None
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None).values.tolist(), "x double, y double, s string")
    for row in numeric_profile(df, ["x", "y"]).collect():
        expected = frame[row["column"]].describe()
        got = [row["count"], row["mean"], row["std"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]]
        assert got == pytest.approx(expected.tolist())
    (text,) = string_profile(df, ["s"]).collect()
    assert [text["count"], text["unique"], text["top"], text["freq"]] == frame["s"].describe().tolist()


def test_missing_and_copies(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x"), (2, "y")], "a int, b string")
    assert [(r["column"], r["missing"]) for r in missing_counts(df).collect()] == [("b", 3), ("a", 0)]
    assert duplicate_count(df).first().duplicate_rows == 2
    assert duplicate_count(df.limit(0)).first().duplicate_rows == 0


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(3)
    values = rng.exponential(10, 2000)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    cells = {r.bin: r for r in histogram(df, F.col("v"), F.lit("all"), 20).collect()}
    counts, edges = np.histogram(values, bins=20)
    density, _ = np.histogram(values, bins=20, density=True)
    assert {b: c.n for b, c in cells.items()} == {i: n for i, n in enumerate(counts) if n}
    assert all(cells[b].density == pytest.approx(density[b]) for b in cells)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    (cell,) = histogram(df, F.col("v"), F.lit("all"), 10).collect()
    assert (cell.bin, cell.n, cell.density) == (0, 2, None)


def test_frequencies(spark):
    df = spark.createDataFrame([(i, "a" if i < 97 else "b") for i in range(99)] + [(100, None)], "i int, d string")
    shares = {r.d: r.freq for r in value_frequencies(df, "d").collect()}
    assert shares == {"a": pytest.approx(97 / 99), "b": pytest.approx(2 / 99)}
    encoded = encode_frequency(df, "d")
    assert encoded.where("d IS NULL").first().freq is None and encoded.count() == 100
    assert sorted(r.i for r in rare_rows(df, "d").collect()) == [97, 98]
    assert sorted(r.i for r in rare_rows(df, "d", broadcast_bytes=0).collect()) == [97, 98]


def test_samples(spark):
    df = spark.range(1000).withColumnRenamed("id", "tx_id")
    first = {r.tx_id for r in sample_rows(df, 100, ["tx_id"]).collect()}
    again = {r.tx_id for r in sample_rows(df.repartition(7), 100, ["tx_id"]).collect()}
    assert first == again and len(first) == 100
    assert first != {r.tx_id for r in sample_rows(df, 100, ["tx_id"], seed=1).collect()}
    assert 0 < sample_fraction(df, 0.3).count() < 1000
    drawn = sample_fraction(df, 2.0, replace=True)
    assert drawn.count() > drawn.distinct().count()
    sizes = {r.split: r["count"] for r in split_by_id(df, "tx_id").groupBy("split").count().collect()}
    assert sizes == {"train": 800, "test": 200}


@pytest.fixture
def found(spark):
    rows = [(i, 1 + i % 3, "TRANSFER" if i % 2 else "DEBIT", float(i % 7), f"C_{i}", f"Cx{i}", i % 5 == 0, i % 4 == 0)
            for i in range(120)]
    df = spark.createDataFrame(
        rows, "tx_id long, step int, type string, amount double, nameOrig string, nameDest string, b boolean, r boolean")
    return df.select("*", F.col("b").cast("int").alias("blacklist_flag"), F.col("r").cast("int").alias("rule_fraud_flag"),
                     (F.col("b") | F.col("r")).cast("int").alias("is_fraud_detected")).drop("b", "r")


def test_search_filters(found):
    def ids(**filters):
        return [r.tx_id for r in explore.search(found, explore.Search(**filters)).orderBy("tx_id").collect()]

    assert ids() == list(range(120))
    assert ids(types=["DEBIT"], methods=["blacklist"]) == list(range(0, 120, 10))
    assert ids(methods=["rule", "model"]) == [i for i in range(120) if i % 4 == 0 and i % 5]
    assert ids(account="c_11") == [11, *range(110, 120)]
    assert ids(account="_1") == [1, *range(10, 20), *range(100, 120)]
    assert ids(account="%") == []


def test_pages_cover_everything_once(found):
    by_offset, by_key, last = [], [], None
    for number in range(1, 4):
        rows = explore.page(found, number, sort_by="amount").collect()
        by_offset += [r.tx_id for r in rows]
        rows = rows if last is None else explore.page_after(found, last.amount, last.tx_id, sort_by="amount").collect()
        by_key += [r.tx_id for r in rows]
        last = rows[-1]
    assert by_offset == by_key and sorted(by_offset) == list(range(120))
    up = explore.page(found, 1, sort_by="step", descending=False, size=5).collect()
    assert [(r.step, r.tx_id) for r in up] == [(1, i) for i in range(0, 15, 3)]


def test_unknown_sort_column_is_refused(found):
    with pytest.raises(ValueError):
        explore.page(found, 1, sort_by="nameOrig; DROP TABLE x")


def test_display_names(found):
    shown = explore.for_display(found.select("type", "nameOrig", "amount"))
    assert shown.columns == [DISPLAY_NAMES[c] for c in ("type", "nameOrig", "amount")]


def test_record_contract(tx):
    def broken(**fields):
        checked = quality.check(quality.with_defaults(tx({"step": 1, **fields})), quality.submitted_record_rules())
        return checked.first().failed_rules

    assert broken() == []
    assert broken(step=None, type=None, nameOrig=None, oldbalanceOrg=None, isFraud=None) == []
    assert broken(amount=None) == ["amount_range"]
    assert broken(amount=0.0) == broken(amount=1e8) == ["amount_range"]
    assert broken(step=0) == broken(step=745) == ["step_range"] and broken(step=744) == []
    assert broken(type="GIFT") == ["type_known"]
    assert broken(nameOrig="C") == ["nameOrig_length"] and broken(nameOrig="C" * 51) == ["nameOrig_length"]
    assert broken(nameDest="C 1;") == ["nameDest_characters"]
    assert broken(nameDest="C-1_\n") == [] and broken(nameDest="C1\n\n") == ["nameDest_characters"]
    assert broken(newbalanceDest=-0.01, isFlaggedFraud=2) == ["isFlaggedFraud_flag", "newbalanceDest_not_negative"]


def test_table_contract_splits_rows(tx):
    rows = tx({}, {"amount": -1.0}, {"amount": None, "nameOrig": None}, {"type": None})
    checked = quality.check(rows, quality.table_rules())
    assert quality.valid_rows(checked).count() == 1
    assert sorted(r.failed_rules for r in quality.quarantined_rows(checked).collect()) == [
        "amount_not_negative", "amount_present,nameOrig_present", "type_present"]


def test_expectations_stop_the_job(spark):
    def rows(n):
        return quality.expectation(spark.range(n), "rows", F.count("*"), lambda v: v > 0)

    quality.require(rows(1))
    with pytest.raises(RuntimeError, match="rows"):
        quality.require(rows(0))


def test_first_rows_with_ties_and_missing_keys(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("k"), "id")
    known = rows.where("k IS NOT NULL").count()
    for n in (1, 8_000, known, known + 5, 100_000):
        found = first_rows(rows, n, "k")
        assert found.count() == min(n, 60_000)
        kept = sorted(r.k for r in found.where("k IS NOT NULL").collect())
        assert kept == sorted(r.k for r in rows.where("k IS NOT NULL").collect())[:min(n, known)]


def test_first_rows_by_counting(spark):
    rows = spark.range(300_000).select(F.xxhash64("id").alias("h"), "id").repartition(6)
    expected = {r.id for r in rows.orderBy("h").limit(90_000).collect()}
    assert {r.id for r in first_rows(rows, 90_000, "h").collect()} == expected


def test_pages_with_missing_values(spark):
    rows = spark.createDataFrame([(1, 5), (2, 4), (3, None), (4, None)], "tx_id long, step int")
    for descending, first in ((True, [1, 2]), (False, [2, 1])):
        page_one = page(rows, 1, sort_by="step", descending=descending, size=2).collect()
        assert [r.tx_id for r in page_one] == first
        after = page_after(rows, page_one[-1].step, page_one[-1].tx_id, sort_by="step", descending=descending, size=2)
        assert [r.tx_id for r in after.collect()] == [3, 4]
        assert [r.tx_id for r in page_after(rows, None, 3, sort_by="step", descending=descending, size=2).collect()] == [4]


def test_histogram_of_odd_numbers(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "v double")
    cells = histogram(rows, F.col("v"), F.lit("all"), 2).collect()
    assert sorted((r.bin, r.n) for r in cells) == [(0, 1), (1, 1)]


@pytest.mark.parametrize("mean", [0.1, 0.5, 1.0, 3.0, 40.0])
def test_sample_with_replacement(spark, mean):
    """The share of rows drawn k times is Poisson's, whatever the partitions."""
    rows = spark.range(20_000).withColumnRenamed("id", "tx_id")
    drawn = sample_with_replacement(rows, mean, ["tx_id"])
    times = drawn.groupBy("tx_id").agg(F.count("*").alias("k"))
    assert times.exceptAll(sample_with_replacement(rows.repartition(9), mean, ["tx_id"]).groupBy("tx_id").agg(F.count("*").alias("k"))).isEmpty()
    seen = {r.k: r["count"] for r in times.groupBy("k").count().collect()}
    seen[0] = 20_000 - sum(seen.values())
    assert sum(k * n for k, n in seen.items()) == pytest.approx(20_000 * mean, rel=5 / (20_000 * mean) ** 0.5)
    for k in range(int(mean) + 3):
        share = math.exp(-mean) * mean**k / math.factorial(k)
        assert abs(seen.get(k, 0) - 20_000 * share) < 5 * (20_000 * share) ** 0.5 + 1
    with pytest.raises(ValueError):
        sample_with_replacement(rows, 0, ["tx_id"])

"""How well a score ranks fraud above the rest: exact areas under the two curves, from counts of distinct scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.operators.prefix import running_totals

BIG = "decimal(38,0)"


def ranking_curve(scored: DataFrame, label: str = "isFraud", score: str = "score") -> DataFrame:
    """A row for each distinct score, best first: ``score``, ``pos``, ``neg`` there, and ``before_pos``, ``before_neg`` above it.

    Rows without a label or score don't count; labels other than 1 are negative. Scores are counted before anything is
    ordered, so ties cost one row.
    """
    rows = scored.select(F.col(score).cast("double").alias("score"), F.col(label).alias("__label")).where("score IS NOT NULL AND __label IS NOT NULL")
    counts = rows.groupBy("score").agg(
        F.count_if(F.col("__label") == 1).alias("pos"), F.count_if(F.col("__label") != 1).alias("neg"))
    return running_totals(counts, -F.col("score"), ["pos", "neg"])


def ranking_metrics(scored: DataFrame, label: str = "isFraud", score: str = "score") -> DataFrame:
    """One row: ``positives``, ``negatives``, ``auc_roc``, ``auprc``; an area is null where a class is missing.

    The area under the ROC curve is the share of pairs of a positive and a negative row that the score orders rightly, ties
    as half, counted in whole numbers. The one under the precision-recall curve joins the points of the distinct scores by
    straight lines and starts at the first one's precision.
    """
    curve = ranking_curve(scored, label, score)
    whole = curve.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"))
    pos, neg, above, wrong = (F.col(c).cast("double") for c in ("pos", "neg", "before_pos", "before_neg"))
    ordered = F.col("neg").cast("decimal(19,0)") * (2 * F.col("before_pos") + F.col("pos")).cast("decimal(19,0)")
    here = F.try_divide(above + pos, above + pos + wrong + neg)
    before = F.coalesce(F.try_divide(above, above + wrong), here)
    areas = curve.agg(F.sum(ordered).cast(BIG).alias("ordered"), F.sum(pos * (here + before) / 2).alias("area"))
    return whole.crossJoin(areas).select(  # one row each
        "positives", "negatives",
        F.try_divide(F.col("ordered").cast("double"), 2 * F.col("positives").cast("double") * F.col("negatives").cast("double")).alias("auc_roc"),
        F.when(F.col("negatives") >= 0, F.try_divide("area", F.col("positives").cast("double"))).alias("auprc"))

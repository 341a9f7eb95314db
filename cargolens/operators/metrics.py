"""Error and classifier metrics, each one aggregate over the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

EPSILON = 2.220446049250313e-16


def mape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute error relative to the actual values."""
    return df.agg(F.avg(F.abs(F.col(predicted) - F.col(actual)) / F.greatest(F.abs(actual), F.lit(EPSILON))).alias("mape"))


def binary_metrics(df: DataFrame, label: str, predicted: str, probability: str) -> DataFrame:
    """One row of classifier metrics from 0/1 labels and predictions and the
    probability of 1. AUC is that of the hard predictions. Ratios without cases
    are 0; average precision follows the ranking by probability."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    q = F.col(probability).cast("double")
    safe = F.least(F.greatest(q, F.lit(EPSILON)), F.lit(1 - EPSILON))
    one = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
        F.avg(-F.when(y, F.log(safe)).otherwise(F.log(1 - safe))).alias("log_loss"),
        F.avg((q - F.when(y, 1.0).otherwise(0.0)) ** 2).alias("brier"),
    )
    r = lambda a, b: F.when(b != 0, a / b).otherwise(0.0)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    recall, precision, tnr = r(tp, tp + fn), r(tp, tp + fp), r(tn, tn + fp)
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    out = one.select(
        "tp", "fp", "fn", "tn", "log_loss", "brier",
        ((recall + tnr) / 2).alias("auc"), r(tp + tn, n).alias("accuracy"), recall.alias("recall"), precision.alias("precision"),
        r(2 * tp, 2 * tp + fp + fn).alias("f1"), r((tp + tn) / n - chance, 1 - chance).alias("kappa"),
        r(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"),
        r(fp, fp + tn).alias("fpr"), r(fn, fn + tp).alias("fnr"), tnr.alias("tnr"), r(tn, tn + fn).alias("npv"), r(fp, fp + tp).alias("fdr"),
    )
    return out.crossJoin(F.broadcast(average_precision(df, label, probability)))  # two single rows


def average_precision(df: DataFrame, label: str, probability: str, parts: int = 256) -> DataFrame:
    """Sum of precision times gain in recall over the distinct thresholds. The
    thresholds are counted first; their running sums are taken within parts of
    their range, on top of the sums of the parts above, so that no task has all."""
    steps = df.filter(F.col(probability).isNotNull()).groupBy(F.col(probability).cast("double").alias("q")).agg(F.count_if(F.col(label) == 1).alias("hits"), F.count("*").alias("n"))
    steps = materialize(steps, "thresholds")
    cuts = steps.agg(F.percentile_approx("q", [i / parts for i in range(1, parts)], 10_000)).first()[0] or []
    listed = F.split(F.lit(",".join(map(repr, sorted(set(cuts))))), ",").cast("array<double>")
    steps = steps.withColumn("part", F.size(F.filter(listed, lambda x: x <= F.col("q"))) if cuts else F.lit(0))
    sums = steps.groupBy("part").agg(F.sum("hits").alias("h"), F.sum("n").alias("m"))
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    sums = sums.select("part", F.coalesce(F.sum("h").over(above), F.lit(0)).alias("h0"), F.coalesce(F.sum("m").over(above), F.lit(0)).alias("m0"))
    down = Window.partitionBy("part").orderBy(F.desc("q")).rowsBetween(Window.unboundedPreceding, 0)
    run = steps.join(F.broadcast(sums), "part").select("hits", ((F.sum("hits").over(down) + F.col("h0")) / (F.sum("n").over(down) + F.col("m0"))).alias("precision"))
    return run.agg(F.coalesce(F.try_divide(F.sum(F.col("precision") * F.col("hits")), F.sum("hits")), F.lit(0.0)).alias("average_precision"))

"""Exact ranking and calibration metrics.

Every score family is reduced to a (series, score) table of good/bad counts
before anything is ordered, so the running sums see distinct scores only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binning import quantile_bin
from ..session import cut_lineage
from .prefix import long_values, quantile_edges, running_sums


def score_table(df: DataFrame, scores: Sequence[str], label: str = "is_bad", by: Sequence[str] = ()) -> DataFrame:
    """(by, name, value, pos, neg) with one row per distinct finite score."""
    long = long_values(df.where(F.col(label).isNotNull()), scores, by, [label])
    long = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy(*by, "name", "value").agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"))


def ranking(df: DataFrame, scores: Sequence[str], label: str = "is_bad", by: Sequence[str] = ()) -> DataFrame:
    """AUC (ties half), Gini, KS, average precision per score: one row per (by, name).

    Metrics are NULL when only one class is present. The counts are read several times and therefore written first."""
    return ranking_of_counts(cut_lineage(score_table(df, scores, label, by)), [*by, "name"])


def ranking_of_counts(table: DataFrame, series: Sequence[str]) -> DataFrame:
    """The same from (series, value, pos, neg) with one row per distinct score; such tables of disjoint rows may be summed first."""
    cum = running_sums(table, ["value"], ["pos", "neg"], series=series, merge=False)
    total = table.groupBy(*series).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    p, n = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    # at and above the score
    tp, fp = p - F.col("pos_before"), n - F.col("neg_before")
    out = cum.join(F.broadcast(total), series).groupBy(*series, "n_pos", "n_neg").agg(
        F.sum(pos * F.col("neg_before") + pos * neg * 0.5).alias("u"),
        F.max(F.try_divide(tp, p) - F.try_divide(fp, n)).alias("ks"),
        F.sum(F.try_divide(pos, p) * F.try_divide(tp, tp + fp)).alias("average_precision"))
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    auc = F.when(both, F.try_divide(F.col("u"), p * n))
    return out.select(
        *series, (F.col("n_pos") + F.col("n_neg")).alias("n_obs"), F.col("n_pos").alias("n_bad"),
        auc.alias("auc"), (auc * 2 - 1).alias("gini"),
        F.when(both, F.greatest(F.col("ks"), F.lit(0.0))).alias("ks"),
        F.when(both, F.col("average_precision")).alias("average_precision"))


def calibration(df: DataFrame, score: str, label: str = "is_bad", by: Sequence[str] = ()) -> DataFrame:
    """Brier (only for scores in [0,1]), means and both calibration ratios."""
    s, y = F.col(score), F.col(label).cast("double")
    agg = df.groupBy(*by) if by else df
    out = agg.agg(
        F.count("*").alias("n_obs"), F.avg(s).alias("pred_mean"), F.avg(y).alias("actual_mean"),
        F.when((F.min(s) >= 0) & (F.max(s) <= 1), F.avg(F.pow(s - y, 2))).alias("brier"))
    return out.withColumns({
        "pred_over_act": F.col("pred_mean") / F.greatest(F.col("actual_mean"), F.lit(0.001)),
        "act_over_pred": F.try_divide(F.col("actual_mean"), F.col("pred_mean")),
    })


def with_quantile_bin(df: DataFrame, col: str, n: int, name: str = "decile", by: Sequence[str] = ()) -> DataFrame:
    """Attach the equal-frequency bin of ``col`` (duplicate edges dropped, bins (a, b])."""
    edges = quantile_edges(df, [col], n, by).drop("name").withColumnRenamed("edges", "_edges")
    if by:
        df = df.join(F.broadcast(edges), list(by), "left")  # one row per named series
    else:
        df = df.withColumn("_edges", edges.select("_edges").scalar())
    return df.withColumn(name, quantile_bin(F.col(col).cast("double"), F.col("_edges"), n)).drop("_edges")


def decile_table(df: DataFrame, score: str, label: str = "is_bad", n: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Predicted mean, actual rate and counts per score decile."""
    return (with_quantile_bin(df, score, n, by=by).where(F.col("decile").isNotNull())
            .groupBy(*by, "decile").agg(
                F.avg(score).alias("predicted_mean"), F.avg(F.col(label).cast("double")).alias("actual_rate"),
                F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("n_bad")))


def decile_lift(df: DataFrame, score: str, label: str = "is_bad", n: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Bad rate of the top and bottom decile and the top lift."""
    t = decile_table(df, score, label, n, by)
    g = t.groupBy(*by) if by else t
    out = g.agg(
        F.max_by("actual_rate", "decile").alias("top_rate"), F.min_by("actual_rate", "decile").alias("bottom_rate"),
        (F.sum("n_bad") / F.sum("n")).alias("base_rate"))
    return out.withColumn("lift_top", F.when(F.col("base_rate") > 0, F.col("top_rate") / F.col("base_rate")).otherwise(0.0))


def confusion(df: DataFrame, predicted: Column, label: str = "is_bad", by: Sequence[str] = ()) -> DataFrame:
    """tp/fp/fn/tn with precision, recall, F2, MCC and Cohen's kappa."""
    y, p = F.col(label) == 1, F.coalesce(predicted, F.lit(False))
    g = df.groupBy(*by) if by else df
    return confusion_rates(g.agg(F.count_if(p & y).alias("tp"), F.count_if(p & ~y).alias("fp"),
                                 F.count_if(~p & y).alias("fn"), F.count_if(~p & ~y).alias("tn")))


def confusion_rates(t: DataFrame) -> DataFrame:
    """Rates from the four cells tp, fp, fn, tn."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    agree = (tp + tn) / n
    chance = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    return t.withColumns({
        "precision": F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)),
        "f2": F.coalesce(F.try_divide(tp * 5, tp * 5 + fn * 4 + fp), F.lit(0.0)),
        "mcc": F.coalesce(F.try_divide(tp * tn - fp * fn, den), F.lit(0.0)),
        "kappa": F.try_divide(agree - chance, 1 - chance),
    })


def label_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa and raw agreement of two label columns (rows with both present)."""
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(
        F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    # label domains are short; only label totals travel further
    sides = F.array(F.struct(F.col("a").alias("label"), F.col("n").alias("na"), F.lit(0).cast("bigint").alias("nb")),
                    F.struct(F.col("b").alias("label"), F.lit(0).cast("bigint").alias("na"), F.col("n").alias("nb")))
    by_label = (cells.select("a", "b", "n", F.explode(sides).alias("s"))
                .groupBy("s.label").agg(F.sum("s.na").alias("na"), F.sum("s.nb").alias("nb"),
                                        F.sum(F.when((F.col("a") == F.col("b")), F.col("s.na")).otherwise(0)).alias("same")))
    total = by_label.agg(F.sum("na").alias("n"), F.sum("same").alias("same"),
                         F.sum(F.col("na").cast("double") * F.col("nb")).alias("prod"))
    po = F.col("same") / F.col("n")
    pe = F.col("prod") / (F.col("n").cast("double") * F.col("n"))
    return total.select(F.col("n").alias("n_compared"), po.alias("agreement"), F.try_divide(po - pe, 1 - pe).alias("kappa"))


def expected_calibration_error(df: DataFrame, score: str, label: str = "is_bad", n_bins: int = 10) -> DataFrame:
    """ECE over [i/n, (i+1)/n) bins; a score of exactly 1 falls in no bin but counts in n."""
    s = F.col(score)
    b = F.lit(0)
    for i in range(1, n_bins):
        b = b + F.when(s >= i / n_bins, 1).otherwise(0)
    bins = df.groupBy(F.when((s >= 0) & (s < 1), b).alias("bin")).agg(
        F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("y"), F.avg(s).alias("p"))
    return bins.agg(
        (F.sum(F.when(F.col("bin").isNotNull(), F.col("n") * F.abs(F.col("y") - F.col("p"))).otherwise(0.0))
         / F.sum("n")).alias("ece"), F.sum("n").alias("n_obs"))

"""Metrics over all batches so far from a table that batches add to, without reading scored rows again.

The table counts (pd, flagged) cells by label. Such counts add up exactly, so the metrics of the sums are those of
the union of the batches; its size follows the number of distinct scores, not of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import confusion_rates, ranking_of_counts

CELLS = ["pd", "flagged"]
ECE_BINS = 10


def batch_totals(scored: DataFrame, label: str = "is_bad") -> DataFrame:
    """(pd, flagged, pos, neg) of scored rows with a label; flagged means not approved."""
    y = F.col(label).cast("bigint")
    rows = scored.where(y.isNotNull()).select(F.col("pd").cast("double").alias("pd"), F.coalesce(F.lower("decision") != "approve", F.lit(False)).alias("flagged"), y.alias("y"))
    return rows.groupBy(*CELLS).agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))


def add_totals(seen: DataFrame | None, new: DataFrame) -> DataFrame:
    """The table of all batches: the one before, if any, plus a new batch."""
    both = new if seen is None else seen.select(*new.columns).unionByName(new)
    return both.groupBy(*CELLS).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def cumulative_metrics(totals: DataFrame) -> DataFrame:
    """One row: rows and bads so far, AUC, average precision, MCC, kappa, F2 and ECE over all of them."""
    by_score = totals.where(F.col("pd").isNotNull() & ~F.isnan("pd")).groupBy(F.lit("pd").alias("name"), F.col("pd").alias("value")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    rank = ranking_of_counts(by_score, ["name"]).select("auc", "average_precision")
    cell = lambda flagged, n: F.coalesce(F.sum(F.when(F.col("flagged") == flagged, F.col(n))), F.lit(0))
    four = confusion_rates(totals.agg(cell(True, "pos").alias("tp"), cell(True, "neg").alias("fp"), cell(False, "pos").alias("fn"), cell(False, "neg").alias("tn")))
    n = F.col("pos") + F.col("neg")
    inside = (F.col("pd") >= 0) & (F.col("pd") < 1)
    steps = F.lit(0)
    for i in range(1, ECE_BINS):
        steps = steps + F.when(F.col("pd") >= i / ECE_BINS, 1).otherwise(0)
    bins = totals.groupBy(F.when(inside, steps).alias("bin")).agg(F.sum(n).alias("n"), F.sum("pos").alias("pos"), F.sum(n * F.col("pd")).alias("p"))
    ece = bins.agg(F.sum(F.when(F.col("bin").isNotNull(), F.abs(F.col("pos") - F.col("p"))).otherwise(0.0)) / F.sum("n")).scalar()
    out = four.select((F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_cumulative"), (F.col("tp") + F.col("fn")).alias("n_bad_cumulative"),
                      F.col("mcc").alias("mcc_cumulative"), F.col("kappa").alias("kappa_cumulative"), F.col("f2").alias("f2_cumulative"))
    return out.withColumns({"auc_cumulative": rank.select("auc").scalar(), "avg_precision_cumulative": rank.select("average_precision").scalar(), "ece_cumulative": ece})

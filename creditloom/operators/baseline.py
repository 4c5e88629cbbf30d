"""Stored baselines: a population as counts that add up, appended by period, and the drift checks that work from them alone.

Kept are the counts of every distinct value of the monitored scores and features, of every category, and of every grade, with their bads. Periods
are summed when read; histograms, AUC, shares and rates of any set of periods follow exactly, and no row of the reference is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.binning import equal_width_bin
from ..functions.clean import finite
from . import drift
from .metrics import ranking, ranking_of_counts
from .prefix import long_values

c = F.col
SCORES, FEATURES = ("fraud_score", "pd", "woe_pd", "rule_pd", "xgb_pd"), ("fico", "d30", "revutil")
CATEGORIES, GRADE = ("qi", "partner"), "grade"


def capture(df: DataFrame, label: str = "is_bad", values: Sequence[str] = (*SCORES, *FEATURES), categories: Sequence[str] = (*CATEGORIES, GRADE)) -> DataFrame:
    """(name, value, category, n, n_known, n_bad): a row for each distinct finite value and each category of one period."""
    y = c(label).cast("bigint")
    counts = [F.count("*").alias("n"), F.count(y).alias("n_known"), F.coalesce(F.sum(y), F.lit(0)).alias("n_bad")]
    numbers = long_values(df, values, carry=[label]).where(finite(c("value"))).groupBy("name", "value").agg(*counts)
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), c(k).cast("string").alias("category")) for k in categories])
    texts = df.select(c(label), F.inline(pairs)).groupBy("name", "category").agg(*counts)
    rest = ["n", "n_known", "n_bad"]
    return numbers.select("name", "value", F.lit(None).cast("string").alias("category"), *rest).unionByName(texts.select("name", F.lit(None).cast("double").alias("value"), "category", *rest))


def together(periods: DataFrame) -> DataFrame:
    """The sum of the captured periods."""
    return periods.groupBy("name", "value", "category").agg(*[F.sum(k).alias(k) for k in ("n", "n_known", "n_bad")])


def histogram(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """What drift.psi_baseline gives for the rows that were counted."""
    v = counts.where(c("name").isin(*names) & c("value").isNotNull())
    span = v.groupBy("name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    margin = F.when(c("hi") > c("lo"), (c("hi") - c("lo")) * 0.01).otherwise(0.01)
    span = span.select("name", (c("lo") - margin).alias("low"), (c("hi") + margin).alias("high"))
    # a row for each monitored column
    bins = v.join(F.broadcast(span), "name").groupBy("name", "low", "high", F.coalesce(equal_width_bin(c("value"), c("low"), c("high"), K.PSI_BINS), F.lit(-1)).alias("bin")).agg(F.sum("n").alias("n"))
    return bins.groupBy("name", "low", "high").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"))


def categories_of(counts: DataFrame, names: Sequence[str], null_as: str | None = "MISSING") -> DataFrame:
    """What drift.category_baseline gives for the rows that were counted."""
    v = counts.where(c("name").isin(*names) & c("value").isNull())
    v = v.fillna(null_as, ["category"]) if null_as else v.where(c("category").isNotNull())
    return v.groupBy("name", "category").agg(F.sum("n").alias("n"))


def aucs(counts: DataFrame, scores: Sequence[str] = SCORES) -> DataFrame:
    """(name, auc, n_obs, n_bad) of the rows that were counted."""
    t = counts.where(c("name").isin(*scores) & c("value").isNotNull() & (c("n_known") > 0))
    return ranking_of_counts(t.select("name", "value", c("n_bad").alias("pos"), (c("n_known") - c("n_bad")).alias("neg")), ["name"]).select("name", "auc", "n_obs", "n_bad")


def grades_of(counts: DataFrame, grades: Sequence[str], grade: str = GRADE) -> DataFrame:
    """(grade, n, n_bad) for every grade, as drift.grade_counts."""
    domain = counts.sparkSession.createDataFrame([(g,) for g in grades], "grade string")
    seen = counts.where((c("name") == grade) & c("value").isNull()).select(c("category").alias("grade"), "n", "n_bad")
    return domain.join(seen, "grade", "left").fillna(0, ["n", "n_bad"])


def drift_from_baseline(baseline: DataFrame, current: DataFrame, grades: Sequence[str], label: str = "is_bad",
                        profile: K.AlertProfile = K.ALERT_PROFILES["drift"]) -> dict[str, DataFrame]:
    """All checks of a scored current population against stored counts (the output of together)."""
    level = drift.psi_level(c("psi"))
    cont = lambda names: drift.psi_continuous(histogram(baseline, names), current, names).select("name", "psi")
    cat = lambda names, **k: drift.psi_categorical(categories_of(baseline, names, k.get("null_as", "MISSING")), current, names, **k).select("name", "psi")
    now = ranking(current, SCORES, label).select("name", c("auc").alias("current_auc"))
    auc = aucs(baseline).select("name", c("auc").alias("reference_auc")).join(now, "name", "full").withColumn("delta", c("current_auc") - c("reference_auc"))
    cal = drift.calibration_drift(current)
    before, after = grades_of(baseline, grades), drift.grade_counts(current, grades, label)
    out = {
        "score_psi": cont(("fraud_score", "pd")).unionByName(cat((GRADE,), null_as=None)).withColumn("level", level),
        "feature_psi": cont(FEATURES).unionByName(cat(CATEGORIES, domain="reference")).withColumn("level", level),
        "auc": auc.withColumn("level", drift.auc_level(c("delta"), profile)),
        "calibration": cal, "calibration_summary": drift.calibration_summary(cal),
        "grade_shift": drift.grade_shift_of_counts(before, after), "grade_chi2": drift.chi2_of_counts(before, after, len(grades)),
        "breakers": drift.breakers(drift.operational_metrics(current)),
    }
    alerts = drift.alert_rows(out["score_psi"], "score_psi", "name").unionByName(drift.alert_rows(out["grade_chi2"], "grade_chi2"))
    for part, key in (("feature_psi", "name"), ("auc", "name"), ("calibration", "decile"), ("breakers", "metric")):
        alerts = alerts.unionByName(drift.alert_rows(out[part], part, key))
    out["alerts"], out["status"] = alerts, drift.overall_status(alerts)
    return out

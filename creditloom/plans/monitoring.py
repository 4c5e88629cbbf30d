"""Monthly health report: drift from the scored table, payments, combined status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import drift


def payment_alerts(health: DataFrame) -> DataFrame:
    rows = F.array(*[F.struct(F.lit("payments").alias("check"), F.lit(k).alias("key"), F.col(v).alias("level"))
                     for k, v in (("red_share", "red_level"), ("orange_red_share", "orange_level"))])
    return health.select(F.inline(rows)).where(F.col("level") != "OK")


def combined_status(scored: DataFrame, payments: DataFrame | None, split_date: str, month: str | None = None) -> DataFrame:
    """Overall status, alert count and exit status of all checks."""
    alerts = combined_alerts(scored, payments, split_date, month)
    return drift.overall_status(alerts)


def combined_alerts(scored: DataFrame, payments: DataFrame | None, split_date: str, month: str | None = None) -> DataFrame:
    alerts = drift.score_table_drift(scored, split_date, month)["alerts"]
    if payments is not None:
        alerts = alerts.unionByName(payment_alerts(drift.payment_health(payments)))
    return alerts


def drift_run(reference: DataFrame, current: DataFrame, split_date: str, grades) -> dict[str, DataFrame]:
    """All checks of a scored current population against the scored training population."""
    both = drift.with_period(reference.unionByName(current, allowMissingColumns=True), split_date)
    cal = drift.calibration_drift(current)
    out = {
        "score_psi": drift.score_psi(reference, current), "feature_psi": drift.feature_psi(reference, current),
        "auc": drift.auc_decay(both, ["pd", "fraud_score", "woe_pd", "rule_pd", "xgb_pd"]),
        "calibration": cal, "calibration_summary": drift.calibration_summary(cal),
        "grade_shift": drift.grade_shift(reference, current, grades), "grade_chi2": drift.grade_chi2(reference, current, grades),
        "breakers": drift.breakers(drift.operational_metrics(current)),
    }
    alerts = drift.alert_rows(out["score_psi"], "score_psi", "name").unionByName(drift.alert_rows(out["grade_chi2"], "grade_chi2"))
    for part, key in (("feature_psi", "name"), ("auc", "name"), ("calibration", "decile"), ("breakers", "metric")):
        alerts = alerts.unionByName(drift.alert_rows(out[part], part, key))
    out["alerts"], out["status"] = alerts, drift.overall_status(alerts)
    return out

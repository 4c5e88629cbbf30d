"""Drift and health checks: PSI, AUC decay, grade shift, calibration, breakers, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.binning import equal_width_bin
from ..functions.clean import finite
from ..functions.special import chi2_tail
from .labels import in_month, moment
from .metrics import calibration, decile_table, ranking
from .prefix import long_values

c = F.col
REF, CUR = "reference", "current"


def psi_baseline(reference: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, low, high, total, counts): the summary a later run compares with, no raw values."""
    v = long_values(reference, cols).where(finite(c("value")))
    span = v.groupBy("name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    margin = F.when(c("hi") > c("lo"), (c("hi") - c("lo")) * 0.01).otherwise(0.01)
    span = span.select("name", (c("lo") - margin).alias("low"), (c("hi") + margin).alias("high"))
    # span has one row per monitored column
    bins = _bin_counts(v, span)
    full = span.join(bins, "name")
    return full.groupBy("name", "low", "high").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"))


def _bin_counts(values: DataFrame, span: DataFrame) -> DataFrame:
    b = equal_width_bin(c("value"), c("low"), c("high"), K.PSI_BINS)
    return values.join(F.broadcast(span), "name").groupBy("name", F.coalesce(b, F.lit(-1)).alias("bin")).agg(F.count("*").alias("n"))


def psi_continuous(baseline: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, psi, n_reference, n_current, n_out_of_range).

    Ten equal-width reference bins; current values outside them are in no bin but
    count in the denominator; shares get epsilon and are renormalised."""
    v = long_values(current, cols).where(finite(c("value")))
    now = _bin_counts(v, baseline.select("name", "low", "high"))
    now = now.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("now"), F.sum("n").alias("n_cur"))
    # one row per monitored column on both sides; a column without current values keeps its row, with a NULL psi
    t = baseline.join(now, "name", "left").withColumn("n_cur", F.coalesce("n_cur", F.lit(0)))
    cells = t.select("name", "total", "n_cur", F.coalesce(F.element_at("now", F.lit(-1)), F.lit(0)).alias("n_out"),
                     F.explode(F.sequence(F.lit(0), F.lit(K.PSI_BINS - 1))).alias("bin"), "counts", "now")
    share = lambda m, n: F.try_divide(F.coalesce(F.element_at(m, c("bin")), F.lit(0)), c(n)) + K.PSI_EPSILON
    cells = cells.withColumns({"r": share("counts", "total"), "q": share("now", "n_cur")})
    sums = cells.groupBy("name", "total", "n_cur", "n_out").agg(
        F.sum("r").alias("sr"), F.sum("q").alias("sq"), F.collect_list(F.struct("r", "q")).alias("cells"))
    part = F.aggregate("cells", F.lit(0.0), lambda acc, x: acc + (x["q"] / c("sq") - x["r"] / c("sr"))
                       * F.ln((x["q"] / c("sq")) / (x["r"] / c("sr"))))
    return sums.select("name", F.when(c("n_cur") > 0, part).alias("psi"), c("total").alias("n_reference"), c("n_cur").alias("n_current"),
                       c("n_out").alias("n_out_of_range"))


def category_baseline(reference: DataFrame, cols: Sequence[str], null_as: str | None = "MISSING") -> DataFrame:
    """(name, category, n) of the reference."""
    return _category_counts(reference, cols, null_as)


def _category_counts(df: DataFrame, cols: Sequence[str], null_as: str | None) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(k).alias("name"), c(k).cast("string").alias("category")) for k in cols])
    v = df.select(F.inline(pairs))
    v = v.fillna(null_as, ["category"]) if null_as else v.where(c("category").isNotNull())
    return v.groupBy("name", "category").agg(F.count("*").alias("n"))


def psi_categorical(baseline: DataFrame, current: DataFrame, cols: Sequence[str], null_as: str | None = "MISSING",
                    domain: str = "union") -> DataFrame:
    """(name, psi, n_reference, n_current) over the union of categories (or the reference's only);
    epsilon added to both shares, not renormalised."""
    now = _category_counts(current, cols, null_as)
    ref = baseline.select("name", "category", c("n").alias("nr"))
    cur = now.select("name", "category", c("n").alias("nc"))
    totals = (ref.groupBy("name").agg(F.sum("nr").alias("tr"))
              .join(cur.groupBy("name").agg(F.sum("nc").alias("tc")), "name", "left").fillna(0, ["tc"]))
    cells = ref.join(cur, ["name", "category"], "full" if domain == "union" else "left").fillna(0, ["nr", "nc"])
    r, q = c("nr") / c("tr") + K.PSI_EPSILON, F.try_divide("nc", "tc") + K.PSI_EPSILON
    return (cells.join(F.broadcast(totals), "name").groupBy("name", "tr", "tc")
            .agg(F.when(F.max("tc") > 0, F.sum((q - r) * F.ln(q / r))).alias("psi"))
            .select("name", "psi", c("tr").alias("n_reference"), c("tc").alias("n_current")))


def psi_level(psi: Column) -> Column:
    """Alert level; a NULL psi means that a monitored column has no current values, which is critical."""
    return F.when(psi.isNull() | (psi > K.PSI_CRITICAL), "CRITICAL").when(psi > K.PSI_WARNING, "WARNING").otherwise("STABLE")


def score_psi(reference: DataFrame, current: DataFrame, scores=("fraud_score", "pd"), categories=("grade",)) -> DataFrame:
    """PSI of scores and categorical columns as one (name, psi, level) table."""
    cont = psi_continuous(psi_baseline(reference, scores), current, scores).select("name", "psi")
    cat = psi_categorical(category_baseline(reference, categories, None), current, categories, None).select("name", "psi")
    return cont.unionByName(cat).withColumn("level", psi_level(c("psi")))


def feature_psi(reference: DataFrame, current: DataFrame, continuous=("fico", "d30", "revutil"),
                categories=("qi", "partner")) -> DataFrame:
    cont = psi_continuous(psi_baseline(reference, continuous), current, continuous).select("name", "psi")
    cat = psi_categorical(category_baseline(reference, categories), current, categories, domain="reference").select("name", "psi")
    return cont.unionByName(cat).withColumn("level", psi_level(c("psi")))


def with_period(df: DataFrame, split_date: str, date: str = "signing_date") -> DataFrame:
    return df.withColumn("period", F.when(c(date) < moment(df, split_date, date), REF).otherwise(CUR))


def auc_decay(df: DataFrame, scores: Sequence[str], profile: K.AlertProfile = K.ALERT_PROFILES["drift"],
              label: str = "is_bad") -> DataFrame:
    """Reference and current AUC per score from one pass over a frame with ``period``."""
    r = ranking(df, scores, label, by=["period"]).groupBy("name").agg(
        F.max(F.when(c("period") == REF, c("auc"))).alias("reference_auc"),
        F.max(F.when(c("period") == CUR, c("auc"))).alias("current_auc"))
    r = r.withColumn("delta", c("current_auc") - c("reference_auc"))
    return r.withColumn("level", auc_level(c("delta"), profile))


def auc_level(delta: Column, p: K.AlertProfile) -> Column:
    if p.auc_critical is None:
        return F.when(delta < -p.auc_warning, "WARNING").otherwise("STABLE")
    return F.when(-delta >= p.auc_critical, "CRITICAL").when(-delta >= p.auc_warning, "WARNING").otherwise("STABLE")


def grade_counts(df: DataFrame, grades: Sequence[str], label: str = "is_bad") -> DataFrame:
    domain = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(g) for g in grades])).alias("grade"))
    t = df.groupBy("grade").agg(F.count("*").alias("n"), F.sum(c(label).cast("bigint")).alias("n_bad"))
    return domain.join(t, "grade", "left").fillna(0, ["n", "n_bad"])


def grade_shift(reference: DataFrame, current: DataFrame, grades: Sequence[str], label: str = "is_bad") -> DataFrame:
    """Grade shares and bad rates against the baseline, with the rate ratio."""
    total = lambda df: df.agg(F.count("*")).scalar()
    return grade_shift_of_counts(grade_counts(reference, grades, label), grade_counts(current, grades, label), total(reference), total(current))


def grade_shift_of_counts(reference: DataFrame, current: DataFrame, n_ref: Column | None = None, n_cur: Column | None = None) -> DataFrame:
    """The same from (grade, n, n_bad) of either side; their totals are those of the grades unless given."""
    def side(t, s, total):
        total = t.agg(F.sum("n")).scalar() if total is None else total
        return t.select("grade", c("n").alias(f"n_{s}"), F.round(c("n") / F.greatest(total, F.lit(1)), 4).alias(f"share_{s}"),
                        F.round(F.try_divide(c("n_bad"), c("n")), 4).alias(f"rate_{s}"))
    j = side(reference, "ref", n_ref).join(side(current, "cur", n_cur), "grade")
    ratio = c("rate_cur") / F.greatest(F.coalesce(c("rate_ref"), F.lit(0.0)), F.lit(0.001))
    return j.withColumn("ratio", F.when(c("n_cur") > 0, F.round(ratio, 4)))


def grade_chi2(reference: DataFrame, current: DataFrame, grades: Sequence[str], label: str = "is_bad") -> DataFrame:
    """chi2 test of current grade counts against baseline shares, with its p-value and level; expected counts are
    floored at 1 and rescaled to the observed total."""
    return chi2_of_counts(grade_counts(reference, grades, label), grade_counts(current, grades, label), len(grades))


def chi2_of_counts(reference: DataFrame, current: DataFrame, n_grades: int) -> DataFrame:
    """The same from (grade, n) of either side."""
    j = reference.select("grade", c("n").alias("nr")).join(current.select("grade", c("n").alias("nc")), "grade")
    tot = j.agg(F.struct(F.sum("nr").alias("r"), F.sum("nc").alias("q"))).scalar()
    e = j.withColumn("t", tot).withColumn("e", F.greatest(F.round(c("nr") / c("t.r"), 4) * c("t.q"), F.lit(1.0)))
    e = e.agg(F.sum("e").alias("se"), F.max("t.q").alias("n"), F.collect_list(F.struct("nc", "e")).alias("cells"))
    chi2 = F.aggregate("cells", F.lit(0.0), lambda acc, x: acc + F.pow(x["nc"] - x["e"] * c("n") / c("se"), 2) / (x["e"] * c("n") / c("se")))
    p = chi2_tail(c("chi2"), n_grades - 1)
    level = F.when(c("p_value") < K.GRADE_DRIFT_RED_P, "RED").when(c("p_value") < K.GRADE_DRIFT_WARNING_P, "WARNING").otherwise("STABLE")
    return e.select(chi2.alias("chi2"), F.lit(n_grades - 1).alias("dof"), c("n").alias("n_current")).withColumn("p_value", p).withColumn("level", level)


def calibration_drift(df: DataFrame, score: str = "pd", label: str = "is_bad",
                      profile: K.AlertProfile = K.ALERT_PROFILES["drift"]) -> DataFrame:
    """Decile table with actual/predicted ratio and level per decile."""
    t = decile_table(df, score, label)
    t = t.withColumns({"predicted_mean": F.round("predicted_mean", 4), "actual_rate": F.round("actual_rate", 4)})
    ratio = F.when(c("predicted_mean") > 0.001, c("actual_rate") / c("predicted_mean")).when(c("actual_rate") > 0, float("inf")).otherwise(1.0)
    t = t.withColumn("act_over_pred", F.round(ratio, 4))
    bad = (c("act_over_pred") < profile.ratio_low_critical) | (c("act_over_pred") > profile.ratio_high_critical)
    warn = (c("act_over_pred") < profile.ratio_low_warning) | (c("act_over_pred") > profile.ratio_high_warning)
    return t.withColumn("level", F.when(bad, profile.top_status).when(warn, "WARNING").otherwise("STABLE"))


def calibration_summary(table: DataFrame) -> DataFrame:
    """Worst decile (furthest from 1, lowest decile on ties) and alert counts."""
    off = F.abs(c("act_over_pred") - 1)
    worst = F.max_by(F.struct("decile", "act_over_pred"), F.struct(off, -c("decile")))
    return table.agg(worst.alias("w"), F.count_if(c("level") == "WARNING").alias("n_warning"),
                     F.count_if(~c("level").isin("WARNING", "STABLE")).alias("n_critical"),
                     F.avg("act_over_pred").alias("mean_ratio")).select(
        c("w.decile").alias("worst_decile"), c("w.act_over_pred").alias("worst_ratio"), "mean_ratio", "n_warning", "n_critical")


def operational_metrics(df: DataFrame, by: Sequence = ()) -> DataFrame:
    d = F.lower("decision")
    rate = lambda v: F.avg((d == v).cast("double"))
    g = df.groupBy(*by) if by else df
    return g.agg(rate("approve").alias("approve_rate"), rate("review").alias("review_rate"),
                 rate("decline").alias("decline_rate"), F.avg("pd").alias("mean_pd"), F.count("*").alias("n"))


def breakers(metrics: DataFrame, keys: Sequence[str] = (), thresholds=K.BREAKERS) -> DataFrame:
    """Operational metrics against their ranges: (keys, metric, value, level, note)."""
    rows = []
    for name, _el, _eh, wl, wh, cl, ch, floor in thresholds:
        v = c(name)
        below = (v < floor) if floor is not None else F.lit(False)
        level = F.when(below | (v < cl) | (v > ch), "CRITICAL").when((v < wl) | (v > wh), "WARNING").otherwise("OK")
        note = F.when(below, "below floor").when((v < cl) | (v > ch), "outside critical range").when(
            (v < wl) | (v > wh), "outside warning range").otherwise("")
        rows.append(F.struct(F.lit(name).alias("metric"), F.round(v, 4).alias("value"), level.alias("level"), note.alias("note")))
    return metrics.select(*keys, F.inline(F.array(*rows)))


def alert_rows(table: DataFrame, check: str, key: str | None = None) -> DataFrame:
    """Rows of any level table that are not fine, as (check, key, level)."""
    name = c(key).cast("string") if key else F.lit("all")
    return table.where(c("level").isin("WARNING", "CRITICAL", "RED")).select(
        F.lit(check).alias("check"), name.alias("key"), "level")


def severity(level: Column) -> Column:
    return F.when(level.isin("CRITICAL", "RED"), 2).when(level == "WARNING", 1).otherwise(0)


def overall_status(alerts: DataFrame, top: str = "CRITICAL") -> DataFrame:
    """Worst level, alert count and exit status (0/1/2)."""
    worst = F.coalesce(F.max(severity(c("level"))), F.lit(0))
    return alerts.agg(worst.alias("exit_status"), F.count("*").alias("n_alerts")).withColumn(
        "status", F.when(c("exit_status") == 2, top).when(c("exit_status") == 1, "WARNING").otherwise("GREEN"))


def score_table_drift(scored: DataFrame, split_date: str, month: str | None = None) -> dict[str, DataFrame]:
    """Drift from a scored table alone: before the split is reference, after it current."""
    both = with_period(scored, split_date)
    ref, cur = both.where(c("period") == REF), both.where(c("period") == CUR)
    if month:
        cur = in_month(cur, month)
        both = ref.unionByName(cur)
    cal = calibration(cur, "pd").select(
        F.round("pred_mean", 4).alias("predicted_mean"), F.round("actual_mean", 4).alias("actual_mean"),
        F.when(c("actual_mean") > 0, F.round("pred_over_act", 4)).alias("pred_over_act"))
    r = c("pred_over_act")
    p = K.ALERT_PROFILES["drift"]
    cal = cal.withColumn("level", F.when((r < p.ratio_low_critical) | (r > p.ratio_high_critical), "CRITICAL").when(
        (r < p.ratio_low_warning) | (r > p.ratio_high_warning), "WARNING").otherwise("STABLE"))
    per_grade = cur.groupBy("grade").agg(
        F.round(F.avg("pd"), 4).alias("predicted"), F.round(F.avg(c("is_bad").cast("double")), 4).alias("actual"), F.count("*").alias("n"))
    out = {
        "psi": score_psi(ref, cur), "auc": auc_decay(both, ["pd", "fraud_score"]), "calibration": cal,
        "calibration_by_grade": per_grade, "breakers": breakers(operational_metrics(cur)),
    }
    alerts = alert_rows(out["psi"], "psi", "name").unionByName(alert_rows(out["auc"], "auc", "name"))
    out["alerts"] = alerts.unionByName(alert_rows(cal, "calibration")).unionByName(alert_rows(out["breakers"], "operations", "metric"))
    out["status"] = overall_status(out["alerts"])
    return out


def payment_health(df: DataFrame) -> DataFrame:
    """Red and orange-or-red shares with their alert levels."""
    red = F.round(F.avg((c("risk_tier") == "red").cast("double")), 4)
    orange = F.avg(c("risk_tier").isin("orange", "red").cast("double"))
    t = df.agg(F.count("*").alias("n_loans"), F.count_if(c("risk_tier") == "red").alias("high_risk_alerts"),
               F.count_if(c("risk_tier") == "yellow").alias("early_warning"), red.alias("red_pct"), orange.alias("orange_red_pct"),
               F.round(F.avg("flag_count"), 2).alias("avg_flag_count"), F.round(F.avg("default_probability"), 4).alias("avg_default_probability"))
    return t.withColumns({
        "red_level": F.when(c("red_pct") > K.RED_CRITICAL, "CRITICAL").when(c("red_pct") > K.RED_WARNING, "WARNING").otherwise("OK"),
        "orange_level": F.when(c("orange_red_pct") > K.ORANGE_RED_WARNING, "WARNING").otherwise("OK")}).withColumn(
        "status", F.when(c("red_level") == "CRITICAL", "CRITICAL").when(
            (c("red_level") == "WARNING") | (c("orange_level") == "WARNING"), "WARNING").otherwise("GREEN"))

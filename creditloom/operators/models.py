"""PD models: logistic, rule, boosted, blended; calibration; segment multiplier.

Logistic fits are Newton steps over distinct cells (`logit`), isotonic fits pool score slices (`isotonic`), trees
grow from histograms (`boosting`); fitted parameters are small plain data, and linear scoring is a column expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.binning import lerp
from ..functions.clean import half_up, upper_text
from ..session import compiled, cut_lineage
from . import boosting, logit
from .boosting import BoostedTrees
from .features import scorecard_features
from .isotonic import IsotonicSteps, fit_isotonic
from .metrics import calibration, ranking, with_quantile_bin
from .rules import rule_composite
from .prefix import quantiles_of_counts
from .woe import WoeModel, fit_woe, value_counts

c = F.col


# --- small parameter models --------------------------------------------------
@dataclass
class LogitModel:
    """Intercept, coefficients and fill values; scored as one arithmetic expression."""

    intercept: float
    coef: dict
    fills: dict = field(default_factory=dict)

    def column(self) -> Column:
        z = F.lit(float(self.intercept))
        for name, b in self.coef.items():
            z = z + F.coalesce(c(name).cast("double"), F.lit(float(self.fills.get(name, 0.0)))) * float(b)
        return 1.0 / (1.0 + F.exp(-z))


def isotonic_steps(xs: Sequence[float], ys: Sequence[float], ws: Sequence[float]) -> tuple[list, list]:
    """Weighted isotonic fit of a short sorted table by pooling adjacent violators."""
    blocks: list[list] = []
    for x, y, w in zip(xs, ys, ws):
        blocks.append([y * w, w, [x]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            top = blocks.pop()
            blocks[-1][0] += top[0]
            blocks[-1][1] += top[1]
            blocks[-1][2] += top[2]
    out_x, out_y = [], []
    for total, w, members in blocks:
        out_x += members
        out_y += [total / w] * len(members)
    return out_x, out_y


def blend(weights: Sequence[float] = K.BLEND_WEIGHTS, parts=("woe_pd", "rule_pd", "xgb_pd")) -> Column:
    return sum((c(p) * float(w) for p, w in zip(parts[1:], weights[1:])), c(parts[0]) * float(weights[0]))


def clip_pd(p: Column, high: float = 0.999) -> Column:
    return F.least(F.greatest(p, F.lit(0.001)), F.lit(high))


def segment_adjust(pd: Column, multiplier: float | None, segment: Column) -> Column:
    """Multiply the PD of the segment; every PD is then kept within [0.001, 0.95]."""
    if multiplier is None or multiplier == 1.0:
        return pd
    return clip_pd(F.when(F.coalesce(segment, F.lit(False)), pd * float(multiplier)).otherwise(pd), 0.95)


def pd_to_score(pd: Column) -> Column:
    """300-850, higher is safer, truncated."""
    return F.least(F.greatest((1 - pd) * 550 + 300, F.lit(300.0)), F.lit(850.0)).cast("int")


def fixed_blend(df: DataFrame, woe: LogitModel, boosted: LogitModel, rule: LogitModel, steps: tuple, multiplier: float,
                roles: K.PartnerRoles = K.DEFAULT_ROLES, digits: int = 6) -> DataFrame:
    """Blended scorecard with given parameters: three PDs, calibration steps, multiplier, score."""
    parts = {"woe_pd": woe.column(), "rule_pd": rule.column(), "xgb_pd": boosted.column()}
    df = rule_composite(df).withColumns(parts)
    df = df.withColumn("_pd", clip_pd(lerp(blend(), *steps)))
    risky = upper_text(c("partner")) == roles.risky
    df = df.withColumns({"pd_before_segment": c("_pd"), "pd": segment_adjust(c("_pd"), multiplier, risky)})
    df = df.withColumns({k: half_up(c(k), digits) for k in ("pd_before_segment", "pd", *parts)}).drop("_pd")
    return df.withColumn("default_score", pd_to_score(c("pd")))


# --- fitting helpers ---------------------------------------------------------
def folded(df: DataFrame, id_col: str, k: int, name: str = "fold", salt: int = 0) -> DataFrame:
    """Fold by hash of the id: the same rows fall in the same fold on every run."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.lit(salt), c(id_col)), F.lit(k)).cast("int"))


def _named(betas, features: Sequence[str]) -> LogitModel:
    return LogitModel(float(betas[0]), dict(zip(features, map(float, betas[1:]))))


def fit_logit(df: DataFrame, features: Sequence[str], label: str = "is_bad", c_value: float | None = None,
              weight: str | None = None) -> LogitModel:
    """L2 logistic regression; ``c_value`` is the inverse penalty of the summed loss."""
    cells = logit.feature_cells(df, features, label, weight)
    return _named(logit.newton(cells, len(features), [logit.Task(c_value)])[0], features)


def logit_grid(df: DataFrame, features: Sequence[str], label: str = "is_bad", id_col: str = "application_id", folds: int = 3,
               grid: Sequence[float] = K.LR_C_GRID, fold: str | None = None) -> list[tuple[float, float, LogitModel]]:
    """(mean held-out AUC, penalty, model on all rows) for each penalty; folds by hash of the id, or as the column ``fold`` has them."""
    data = df if fold else folded(df, id_col, folds, salt=3)
    cells = logit.feature_cells(data, features, label, fold=fold or "fold")
    return [(auc, v, _named(b, features)) for auc, v, b in logit.grid(cells, len(features), grid, folds)]


def fit_logit_cv(df: DataFrame, features: Sequence[str], label: str = "is_bad", id_col: str = "application_id",
                 folds: int = 3, grid: Sequence[float] = K.LR_C_GRID) -> tuple[LogitModel, float]:
    """Choose the penalty by cross-validated AUC (the weaker one on ties), fitted on everything."""
    _, best, model = max(logit_grid(df, features, label, id_col, folds, grid), key=lambda g: g[:2])
    return model, best


def fit_rule_pd(df: DataFrame, label: str = "is_bad", score: str = "rule_score") -> LogitModel:
    """Composite -> PD. The composite takes few values, so counts per value are fitted with weights."""
    counts = df.groupBy(c(score).alias(score), c(label).cast("double").alias(label)).agg(F.count("*").cast("double").alias("w"))
    return fit_logit(counts, [score], label, c_value=1.0, weight="w")


def fit_boosted(df: DataFrame, label: str = "is_bad", features: Sequence[str] = K.BOOST_FEATURES,
                rounds: int = K.BOOST_ROUNDS, counts: DataFrame | None = None) -> BoostedTrees:
    """Boosted trees that keep the configured signs, with the training medians as fills. Medians and bins follow from the counts of values (value_counts)."""
    features = [f for f in features if f in df.columns]
    counts = (value_counts(df, features, label) if counts is None else counts).where(c("name").isin(*features)).select("name", "value", "n")
    known = counts.where(c("value").isNotNull() & ~F.isnan("value"))
    fills = {r["name"]: r["q"][0] for r in quantiles_of_counts(known, [0.5]).collect()}
    fill = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in fills.items() for x in kv]), c("name")), F.lit(0.0)) if fills else F.lit(0.0)
    # a fill that is also a value stands there twice: its rows lie side by side
    filled = counts.withColumn("value", F.coalesce("value", fill))
    return boosting.fit(df, features, fills, label, rounds, edges=boosting.edges_of_counts(filled, features))


def monotonicity(scored: DataFrame, features: Sequence[str] = tuple(K.BOOST_SIGNS), pd_col: str = "xgb_pd", bins: int = 5) -> DataFrame:
    """(feature, sign, violations): steps of the mean PD over quantile bins against the expected sign."""
    from pyspark.sql import Window as W
    out = None
    for f in [x for x in features if x in scored.columns]:
        t = with_quantile_bin(scored.select(f, pd_col), f, bins, "b").where("b is not null").groupBy("b").agg(F.avg(pd_col).alias("p"))
        step = c("p") - F.lag("p").over(W.orderBy("b"))  # five rows
        v = t.withColumn("s", step).agg(F.count_if(c("s") * K.BOOST_SIGNS[f] < 0).alias("violations")).select(
            F.lit(f).alias("feature"), F.lit(K.BOOST_SIGNS[f]).alias("sign"), "violations")
        out = v if out is None else out.unionByName(v)
    return out


def apply_isotonic(df: DataFrame, model: IsotonicSteps, raw: str, out: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    return model.apply(df, raw, out).withColumn(out, F.least(F.greatest(c(out), F.lit(low)), F.lit(high)))


def segment_multiplier(df: DataFrame, segment: Column, pd_col: str = "pd", label: str = "is_bad", prior: float = 60.0,
                       min_n: int = 20) -> DataFrame:
    """Credibility-shrunk actual/predicted ratio of a segment, clipped to [1, 3]; 1 for small segments."""
    s = F.coalesce(segment, F.lit(False))
    t = df.agg(F.count_if(s).alias("n"), F.avg(F.when(s, c(label).cast("double"))).alias("actual"),
               F.avg(F.when(s, c(pd_col))).alias("predicted"), F.avg(F.when(~s, c(label).cast("double"))).alias("actual_other"))
    raw = c("actual") / F.greatest(c("predicted"), F.lit(0.01))
    t = t.withColumns({"raw_multiplier": raw, "shrinkage": c("n") / (c("n") + prior)})
    shrunk = 1 + c("shrinkage") * (c("raw_multiplier") - 1)
    return t.withColumn("multiplier", F.when(c("n") < min_n, 1.0).otherwise(F.least(F.greatest(shrunk, F.lit(1.0)), F.lit(3.0))))


def segment_quintiles(df: DataFrame, segment: Column, pd_col: str = "pd", label: str = "is_bad") -> DataFrame:
    """Bad rates of segment and others per PD quintile (at least 3 segment loans)."""
    b = with_quantile_bin(df.withColumn("_s", F.coalesce(segment, F.lit(False))), pd_col, 5, "quintile")
    y = c(label).cast("double")
    t = b.where("quintile is not null").groupBy("quintile").agg(
        F.count_if(c("_s")).alias("n_segment"), F.count_if(~c("_s")).alias("n_other"),
        F.avg(F.when(c("_s"), y)).alias("rate_segment"), F.coalesce(F.avg(F.when(~c("_s"), y)), F.lit(0.0)).alias("rate_other"))
    return t.where("n_segment >= 3").withColumn("ratio", c("rate_segment") / F.greatest("rate_other", F.lit(0.001)))


# --- the two fitted models ----------------------------------------------------
@dataclass
class ScorecardModel:
    """Blend of WoE-logistic, rule and boosted PDs with isotonic calibration and segment multiplier."""

    woe: WoeModel
    woe_logit: LogitModel
    rule_logit: LogitModel
    boosted: BoostedTrees
    isotonic: IsotonicSteps | None
    multiplier: float
    weights: tuple = K.BLEND_WEIGHTS
    roles: K.PartnerRoles = K.DEFAULT_ROLES

    def parts(self, df: DataFrame) -> DataFrame:
        """Input features -> the three sub-model PDs and their raw blend."""
        df = rule_composite(self.woe.transform(df))
        df = df.withColumns({"woe_pd": self.woe_logit.column(), "rule_pd": self.rule_logit.column()})
        df = df.drop(*[f + "_woe" for f in self.woe.features])
        df = df.withColumn("xgb_pd", self.boosted.column(df.columns))
        return df.withColumn("raw_blend", blend(self.weights))

    def predict(self, df: DataFrame) -> DataFrame:
        """Raw columns -> pd, default_score, woe_pd, rule_pd, xgb_pd (features are added on the way)."""
        df = apply_isotonic(self.parts(scorecard_features(df, self.roles)), self.isotonic, "raw_blend", "pd_before_segment", 0.001, 0.999)
        risky = upper_text(c("partner")) == self.roles.risky if "partner" in df.columns else F.lit(False)
        df = df.withColumn("pd", segment_adjust(c("pd_before_segment"), self.multiplier, risky))
        return df.withColumn("default_score", pd_to_score(c("pd")))


def _fit_parts(feat: DataFrame, label: str, id_col: str, rounds: int, folds: int) -> ScorecardModel:
    counts = value_counts(feat, tuple(dict.fromkeys((*K.WOE_FEATURES, *K.BOOST_FEATURES))), label)  # written once for both models
    woe = fit_woe(feat, label, counts=counts.where(c("name").isin(*K.WOE_FEATURES)))
    names = [f + "_woe" for f in woe.features]
    with compiled(feat.sparkSession):
        woe_logit, _ = fit_logit_cv(woe.transform(feat), names, label, id_col, folds)
    rule = fit_rule_pd(rule_composite(feat), label)
    return ScorecardModel(woe, woe_logit, rule, fit_boosted(feat, label, rounds=rounds, counts=counts), None, 1.0)


def fit_scorecard(train: DataFrame, label: str = "is_bad", id_col: str = "application_id", rounds: int = K.BOOST_ROUNDS,
                  oof_folds: int = 5, cv_folds: int = 3, roles: K.PartnerRoles = K.DEFAULT_ROLES) -> ScorecardModel:
    """Fit all sub-models; calibrate on out-of-fold blends; derive the segment multiplier."""
    feat = folded(scorecard_features(train, roles), id_col, oof_folds, "oof", salt=5).cache()
    try:
        model = _fit_parts(feat, label, id_col, rounds, cv_folds)
        model.roles = roles
        oof = None
        for k in range(oof_folds):
            part = _fit_parts(feat.where(c("oof") != k), label, id_col, rounds, cv_folds)
            held = part.parts(feat.where(c("oof") == k)).select(label, "raw_blend")
            oof = held if oof is None else oof.unionByName(held)
        with compiled(feat.sparkSession):
            model.isotonic = fit_isotonic(oof, "raw_blend", label)
            model.multiplier = _learn_multiplier(model, model.parts(feat), label)
    finally:
        feat.unpersist()
    return model


def _learn_multiplier(model: ScorecardModel, parts: DataFrame, label: str) -> float:
    p = apply_isotonic(parts, model.isotonic, "raw_blend", "pd", 0.001, 0.999)
    return float(segment_multiplier(p, upper_text(c("partner")) == model.roles.risky, label=label).first()["multiplier"])


def recalibrate(model: ScorecardModel, cohort: DataFrame, label: str = "is_bad") -> tuple[ScorecardModel, DataFrame]:
    """New isotonic and multiplier on a seasoned cohort, sub-models unchanged; diagnostics before/after."""
    from dataclasses import replace
    with compiled(cohort.sparkSession):  # the blend is a deep expression: it is written once for its readers
        feat = cut_lineage(model.parts(scorecard_features(cohort, model.roles)).select(label, "partner", "raw_blend"))
    new = replace(model, isotonic=fit_isotonic(feat, "raw_blend", label))
    new.multiplier = _learn_multiplier(new, feat, label)
    rows = None
    for name, m in (("before", model), ("after", new)):
        p = apply_isotonic(feat, m.isotonic, "raw_blend", "p", 0.001, 0.999)
        r = calibration(p, "p", label).select(F.lit(name).alias("stage"), "n_obs", "pred_mean", "actual_mean", "brier", "pred_over_act")
        rows = r if rows is None else rows.unionByName(r)
    return new, rows


def evaluate_scorecard(scored: DataFrame, label: str = "is_bad") -> DataFrame:
    """AUC, Gini, KS of the blend and its components plus Brier. The scores are written once for both readers."""
    with compiled(scored.sparkSession):
        scored = cut_lineage(scored.select(label, "pd", "woe_pd", "rule_pd", "xgb_pd"))
    r = ranking(scored, ["pd", "woe_pd", "rule_pd", "xgb_pd"], label)
    brier = scored.select(label, "pd").agg(F.avg(F.pow(c("pd") - c(label), 2))).scalar()
    return r.withColumn("brier", F.when(c("name") == "pd", brier))


@dataclass
class WoePdModel:
    """WoE features -> logistic -> isotonic."""

    woe: WoeModel
    logit: LogitModel
    isotonic: IsotonicSteps
    c_value: float

    def predict(self, feat: DataFrame, out: str = "pd") -> DataFrame:
        df = self.woe.transform(feat).withColumn("_raw", self.logit.column())
        df = df.drop(*[f + "_woe" for f in self.woe.features])
        return apply_isotonic(df, self.isotonic, "_raw", out).drop("_raw")


def fit_woe_pd(feat: DataFrame, label: str = "is_bad", id_col: str = "application_id", oof_folds: int = 5,
               cv_folds: int = 3) -> WoePdModel:
    """Bins and selection on all rows; penalty by CV; isotonic on out-of-fold predictions."""
    woe = fit_woe(feat, label)
    names = [f + "_woe" for f in woe.features]
    x = folded(woe.transform(feat), id_col, oof_folds, "oof", salt=5).select(id_col, label, "oof", *names).cache()
    try:
        logit, best = fit_logit_cv(x, names, label, id_col, cv_folds)
        oof = None
        for k in range(oof_folds):
            m, _ = fit_logit_cv(x.where(c("oof") != k), names, label, id_col, cv_folds)
            held = x.where(c("oof") == k).select(label, m.column().alias("raw"))
            oof = held if oof is None else oof.unionByName(held)
        iso = fit_isotonic(oof, "raw", label)
    finally:
        x.unpersist()
    return WoePdModel(woe, logit, iso, best)


def platt(df: DataFrame, raw: str, label: str = "is_bad") -> LogitModel:
    """Platt scaling: logistic of the raw score, the alternative to isotonic."""
    return fit_logit(df, [raw], label, c_value=1.0)

"""Scoring plans: the full cascade, the short six-rule pipeline, the live variants."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.clean import display, grade_letter
from ..operators import decisions
from ..operators.features import six_rule_features
from ..operators.grading import GradeScheme, fixed_grade, grade
from ..operators.reasons import collect_reasons
from ..operators.rules import hard_rules, points_engine
from ..operators.survival import CoxModel


@dataclass(frozen=True)
class ScoringConfig:
    """Everything the cascade needs besides the PD model."""

    scheme: GradeScheme
    thresholds: tuple = K.POINT_PROFILES["moderate"]
    pd_decline: float = K.PD_DECLINE
    pd_review: float = K.PD_REVIEW
    grade_e: bool = True
    review_optimisation: bool = False
    roles: K.PartnerRoles = field(default_factory=lambda: K.DEFAULT_ROLES)


SCORE_COLUMNS = (
    "decision", "fraud_score", "fraud_normalized", "fraud_decision", "pd", "default_score", "grade", "pricing_tier",
    "woe_pd", "rule_pd", "xgb_pd", "grade_e_repricing", "grade_e_action", "review_optimization", "reasons",
)


def score_cascade(df: DataFrame, predict: Callable[[DataFrame], DataFrame], config: ScoringConfig,
                  survival: CoxModel | None = None) -> DataFrame:
    """Points -> PD -> grade -> cascade -> grade-E -> review optimisation -> reasons.

    ``predict`` adds pd, default_score and the three sub-model PDs. One lazy plan of
    row-local stages: the input's partitioning is kept and nothing shuffles."""
    df = points_engine(df, config.thresholds, config.roles)
    df = grade(predict(df), config.scheme, roles=config.roles)
    df = decisions.cascade(df, config.pd_decline, config.pd_review)
    df = decisions.grade_e(df, config.grade_e, roles=config.roles)
    df = decisions.review_optimisation(df, config.review_optimisation)
    df = collect_reasons(df, config.roles, config.pd_decline, config.pd_review)
    if survival is None:
        return df.withColumn("survival_available", F.lit(0))
    from ..operators.features import survival_features
    kept = df.columns
    df = survival.predict(survival_features(df))
    return df.withColumn("survival_available", F.lit(1)).select(
        *kept, *[F.col(f"pd_{m}mo").alias(f"survival_hazard_{m}mo") for m in K.HORIZON_MONTHS],
        F.col("risk_tier").alias("survival_risk_tier"), F.col("median_survival_months").alias("survival_median_months"),
        "survival_available")


def score_six_rules(df: DataFrame, predict: Callable[[DataFrame], DataFrame], roles: K.PartnerRoles = K.DEFAULT_ROLES) -> DataFrame:
    """Hard rules -> features -> PD -> A-D grade -> short cascade."""
    df = hard_rules(df, roles)
    df = predict(six_rule_features(df, roles))
    return decisions.short_cascade(fixed_grade(df))


def live_record(scored: DataFrame, run_id: str) -> DataFrame:
    """The scored row as it is appended: display decision, production reference, run id."""
    have = set(scored.columns)
    keep = [k for k in ("application_id", "signing_date", "loan_state", "is_bad", "fico", "qi", "partner", "pd", "grade",
                        "fraud_decision", "fraud_rules_triggered", "has_prior_bad", "production_grade") if k in have]
    out = scored.select(*keep, display(F.col("decision")).alias("decision"), F.lit(run_id).alias("run_id"))
    if "production_grade" in have:
        out = out.withColumn("production_grade_letter", grade_letter(F.col("production_grade")))
    return out

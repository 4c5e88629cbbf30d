"""Decision cascades and the adjustments applied after them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.clean import fill, upper_text

c = F.col


def cascade(df: DataFrame, pd_decline: float = K.PD_DECLINE, pd_review: float = K.PD_REVIEW,
            review_grades: Sequence[str] = K.REVIEW_GRADES) -> DataFrame:
    """First match: rule decline, rule review, PD decline, PD review, grade review, approve.

    A rule review comes before a PD decline on purpose."""
    return df.withColumn("decision", (
        F.when(c("fraud_decision") == "decline", "decline")
        .when(c("fraud_decision") == "review", "review")
        .when(c("pd") >= pd_decline, "decline")
        .when(c("pd") >= pd_review, "review")
        .when(c("grade").isin(*review_grades), "review")
        .otherwise("approve")))


def short_cascade(df: DataFrame, pd_decline: float = K.PD_DECLINE, pd_review: float = K.PD_REVIEW) -> DataFrame:
    """Rule decline, PD above decline, PD above review, grade D, rule review, approve."""
    return df.withColumn("decision", (
        F.when(c("fraud_decision") == "decline", "decline")
        .when(c("pd") > pd_decline, "decline")
        .when(c("pd") > pd_review, "review")
        .when(c("grade") == "D", "review")
        .when(c("fraud_decision") == "review", "review")
        .otherwise("approve")))


def grade_e(df: DataFrame, enabled: bool = True, pd_threshold: float = K.GRADE_E_PD,
            repricing: float = K.GRADE_E_REPRICING, partner_decline: bool = True,
            roles: K.PartnerRoles = K.DEFAULT_ROLES) -> DataFrame:
    """Grade E: configured partners decline, high PD declines, the rest is repriced."""
    if not enabled:
        return df.withColumns({"grade_e_repricing": F.lit(None).cast("double"), "grade_e_action": F.lit("")})
    is_e = c("grade") == "E"
    by_partner = is_e & F.lit(partner_decline)
    if "partner" in df.columns:
        by_partner = by_partner & F.coalesce(upper_text(c("partner")).isin(*roles.grade_e_decline), F.lit(False))
    else:
        by_partner = F.lit(False)
    by_pd = is_e & (c("pd") > pd_threshold)
    df = df.withColumn("grade_e_action", (
        F.when(by_partner, "PARTNER_GRADE_E_AUTO_DECLINE").when(by_pd, "HIGH_PD_GRADE_E_DECLINE")
        .when(is_e, "GRADE_E_REPRICING").otherwise("")))
    return df.withColumns({
        "decision": F.when(c("grade_e_action").endswith("DECLINE"), "decline").otherwise(c("decision")),
        "grade_e_repricing": F.when(c("grade_e_action") == "GRADE_E_REPRICING", F.lit(repricing)),
    })


def review_optimisation(df: DataFrame, enabled: bool = True, auto_decline_pd: float = K.AUTO_DECLINE_PD,
                        auto_approve_pd: float = K.AUTO_APPROVE_PD) -> DataFrame:
    """Resolve reviews with a very high or very low PD automatically."""
    if auto_approve_pd >= auto_decline_pd:
        raise ValueError(f"auto_approve_pd ({auto_approve_pd}) must be below auto_decline_pd ({auto_decline_pd})")
    if not enabled:
        return df.withColumn("review_optimization", F.lit("not_applicable"))
    df = df.withColumn("review_optimization", (
        F.when(c("decision") != "review", "not_applicable").when(c("pd") > auto_decline_pd, "auto_declined")
        .when(c("pd") < auto_approve_pd, "auto_approved").otherwise("unchanged")))
    return df.withColumn("decision", (
        F.when(c("review_optimization") == "auto_declined", "decline")
        .when(c("review_optimization") == "auto_approved", "approve").otherwise(c("decision"))))


def combined_flag(df: DataFrame, version: str = "first", missing_fico: float = 650.0) -> DataFrame:
    """combined_score, fico_bucket, flagged 0/1. Falls back to pd where a sub-model column is absent."""
    blend, pd_weight, fraud_weight, top, limits = K.COMBINED_VERSIONS[version]
    part = lambda k: c(k) if k in df.columns else c("pd")
    blended = part("woe_pd") * blend[0] + part("rule_pd") * blend[1] + part("xgb_pd") * blend[2]
    fico = fill(c("fico"), missing_fico) if "fico" in df.columns else F.lit(missing_fico)
    df = df.withColumns({
        "combined_score": blended * pd_weight + c("fraud_score") / top * fraud_weight,
        "fico_bucket": F.when(fico < 600, "lt_600").when(fico < 650, "600_650").when(fico < 700, "650_700").otherwise("gte_700"),
    })
    expr = F.lit(0)
    for name, limit in zip(("lt_600", "600_650", "650_700", "gte_700"), limits):
        if limit is not None:
            expr = F.when((c("fico_bucket") == name) & (c("combined_score") >= limit), 1).otherwise(expr)
    return df.withColumn("flagged", expr)


def optimised_decision(df: DataFrame, version: str = "first") -> DataFrame:
    """Flag/Approve by combined score; the cascade decision is kept as decision_v1 and used
    where no combined score can be computed. Anything but Approve counts as flagged."""
    df = combined_flag(df.withColumn("decision_v1", c("decision")), version)
    return df.withColumn("decision", F.when(c("combined_score").isNull(), c("decision_v1"))
                         .otherwise(F.when(c("flagged") == 1, "Flag").otherwise("Approve")))

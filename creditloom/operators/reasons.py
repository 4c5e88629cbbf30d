"""Reason codes: collect, dedupe, prioritise, cap - all as array expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.clean import fill, money, percent, upper_text, whole

c = F.col


def reason_tier(r: Column, roles: K.PartnerRoles = K.DEFAULT_ROLES) -> Column:
    """Priority tier of one reason by its prefix; unknown prefixes are tier 5."""
    tiers = {t: list(p) for t, p in K.REASON_TIERS.items()}
    tiers[2].append("PARTNER_GRADE_E_AUTO_DECLINE")
    tiers[3].append(roles.risky)
    in_tier = lambda prefixes: reduce(lambda a, b: a | b, [r.startswith(p) for p in prefixes])
    return reduce(lambda expr, t: F.when(in_tier(tiers[t]), t).otherwise(expr), sorted(tiers, reverse=True), F.lit(5))


def top_reasons(reasons: Column, roles: K.PartnerRoles = K.DEFAULT_ROLES, n: int = K.MAX_REASONS) -> Column:
    """Distinct reasons, stable-sorted by tier, first n."""
    keyed = F.transform(F.array_distinct(reasons), lambda x, i: F.struct(
        reason_tier(x, roles).alias("tier"), i.alias("pos"), x.alias("text")))
    return F.transform(F.slice(F.array_sort(keyed), 1, n), lambda s: s["text"])


def _covered(reasons: Column, test) -> Column:
    return F.exists(reasons, test)


def collect_reasons(df: DataFrame, roles: K.PartnerRoles = K.DEFAULT_ROLES, pd_decline: float = K.PD_DECLINE,
                    pd_review: float = K.PD_REVIEW, review_grades=K.REVIEW_GRADES) -> DataFrame:
    """Add ``reasons``: rule reasons without points, PD, grade, fico, partner, qi, bureau and
    the reasons of the grade-E and review adjustments when those columns are present."""
    have = set(df.columns)
    clean = F.transform(c("fraud_reasons"), lambda r: F.trim(F.substring_index(r, "(+", 1)))
    pd_text = percent(c("pd"))
    base = F.concat(clean, F.array_compact(F.array(
        F.when(c("pd") >= pd_decline, F.concat(F.lit("High default risk (PD="), pd_text, F.lit(")")))
        .when(c("pd") >= pd_review, F.concat(F.lit("Elevated default risk (PD="), pd_text, F.lit(")"))),
        F.when(c("grade").isin(*review_grades), F.concat(F.lit("Poor credit grade ("), c("grade"), F.lit(")"))))))
    df = df.withColumn("_r", base)

    fico, partner, qi = c("fico"), upper_text(c("partner")), upper_text(c("qi"))
    low = F.when((fico < 600) & ~_covered(c("_r"), lambda r: r.contains("FICO")),
                 F.concat(F.lit("Low FICO ("), whole(fico), F.lit(")")))
    risky = F.when((partner == roles.risky) & (fico < 650) & ~_covered(c("_r"), lambda r: r.contains(roles.risky)),
                   F.lit(f"{roles.risky} partner (high-risk segment)"))
    no_qi = F.when((qi == "MISSING") & ~_covered(c("_r"), lambda r: F.upper(r).contains("QI")), F.lit("Missing QI"))

    total = F.greatest(c("tl_total"), F.lit(1.0))
    delin, paid = fill(c("tl_delin"), 0.0), fill(c("tl_paid"), 0.0)
    health = F.when(c("tl_total") > 0, (
        F.when(delin == 0, 0.4).otherwise(0.0) + F.least(paid / total, F.lit(1.0)) * 0.3
        + (1 - F.least(delin / total, F.lit(1.0))) * 0.3))
    if "bureau_health" in have:
        health = F.coalesce(c("bureau_health"), health)
    weak = F.when((health < 0.35) & ~_covered(c("_r"), lambda r: F.lower(r).contains("bureau") & F.lower(r).contains("health")),
                  F.lit("Below-average credit bureau profile"))
    monthly = F.when(c("mopmt") > 3000, F.concat(F.lit("High monthly payment obligations ("), money(c("mopmt")), F.lit(")")))
    revolving = F.when(c("revbal") > 50000, F.concat(F.lit("Elevated revolving credit balances ("), money(c("revbal")), F.lit(")")))
    extra = [low, risky, no_qi, weak, monthly, revolving]

    late = []
    if "grade_e_action" in have:
        late.append(F.when(c("grade_e_action") == "PARTNER_GRADE_E_AUTO_DECLINE",
                           F.concat(F.lit("PARTNER_GRADE_E_AUTO_DECLINE (partner="), partner, F.lit(")")))
                    .when(c("grade_e_action") == "HIGH_PD_GRADE_E_DECLINE",
                          F.concat(F.lit("HIGH_PD_GRADE_E_DECLINE (PD="), pd_text, F.lit(f" > {K.GRADE_E_PD:.0%})"))))
    if "review_optimization" in have:
        late.append(F.when(c("review_optimization") == "auto_declined",
                           F.concat(F.lit("AUTO_DECLINE_HIGH_PD_REVIEW (PD="), pd_text, F.lit(f" > {K.AUTO_DECLINE_PD:.0%})")))
                    .when(c("review_optimization") == "auto_approved",
                          F.concat(F.lit("AUTO_APPROVE_LOW_PD_REVIEW (PD="), pd_text, F.lit(f" < {K.AUTO_APPROVE_PD:.0%})"))))
    df = df.withColumn("reasons", top_reasons(F.concat(c("_r"), F.array_compact(F.array(*extra))), roles))
    if late:
        added = F.array_compact(F.array(*late))
        df = df.withColumn("reasons", F.when(F.size(added) > 0, top_reasons(F.concat(c("reasons"), added), roles))
                           .otherwise(c("reasons")))
    return df.drop("_r")

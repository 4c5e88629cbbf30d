"""Rule engines: capped points, hard rules and the graded rule composite.

All three are single-stage column expressions generated from small tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.binning import boundary_score
from ..functions.clean import fill, flag, half_up, lookup, money, percent, upper_text, whole
from .features import fraud_features

c = F.col


@dataclass(frozen=True)
class PointRule:
    """Points added when ``when`` holds, before the category cap; ``text`` gives the reason."""

    category: str
    points: int
    when: Callable[[K.PartnerRoles], Column]
    text: Callable[[K.PartnerRoles], Column]


def _t(s: str):
    return lambda r: F.lit(s)


def _missing_qi(r):
    return c("fr_qi_missing") & ~F.coalesce(c("fr_partner") == r.missing_qi, F.lit(False))


def _special(r):
    return c("fr_qi_missing") & (c("fr_partner") == r.missing_qi)


def _cat(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


POINT_RULES = (
    # business
    PointRule("business", 30, _special,
              lambda r: F.lit(f"MISSING_QI_{r.missing_qi}: Missing QI + {r.missing_qi} partner")),
    PointRule("business", 30, lambda r: _missing_qi(r) & (c("fr_fico") < 600),
              _t("MISSING_QI_LOW_FICO: Missing QI + FICO<600")),
    PointRule("business", 20, lambda r: _missing_qi(r) & (c("fr_fico") >= 600) & (c("fr_fico") < 700),
              _t("MISSING_QI_MID_FICO: Missing QI + FICO 600-699")),
    PointRule("business", 10, lambda r: _missing_qi(r) & (c("fr_fico") >= 700),
              _t("MISSING_QI_HIGH_FICO: Missing QI + FICO 700+")),
    PointRule("business", 15, lambda r: ~c("giact_missing") & (c("fr_bankrupt") > 0),
              lambda r: _cat("GIACT bankruptcy count=", whole(c("fr_bankrupt")))),
    # identity: every rule is switched off, the category stays for the totals
    # financial
    PointRule("financial", 15, lambda r: c("fr_fico") < 550,
              lambda r: _cat("FICO < 550 (", whole(c("fr_fico")), ")")),
    PointRule("financial", 8, lambda r: (c("fr_fico") >= 550) & (c("fr_fico") < 600),
              lambda r: _cat("FICO 550-600 (", whole(c("fr_fico")), ")")),
    PointRule("financial", 15, lambda r: ~c("plaid_missing") & (c("fr_balance") < 0),
              lambda r: _cat("Negative bank balance=", money(c("fr_balance")))),
    PointRule("financial", 10, lambda r: ~c("plaid_missing") & (c("fr_nsf") >= 3),
              lambda r: _cat("High NSFs=", whole(c("fr_nsf")))),
    PointRule("financial", 8, lambda r: c("fr_pastdue") > 500,
              lambda r: _cat("High past due=", money(c("fr_pastdue")))),
    PointRule("financial", 8, lambda r: c("fr_negdays") > 5,
              lambda r: _cat("Extended negative balance history (", whole(c("fr_negdays")), " days in 90d)")),
    # bureau
    PointRule("bureau", 10, lambda r: c("fr_d60") > 0,
              lambda r: _cat("Severe delinquencies (60d+)=", whole(c("fr_d60")))),
    PointRule("bureau", 8, lambda r: c("fr_inq6") >= 6,
              lambda r: _cat("High inquiries (6mo)=", whole(c("fr_inq6")))),
    PointRule("bureau", 12, lambda r: c("fr_tl_total") <= 1,
              lambda r: _cat("Zero/minimal tradelines=", whole(c("fr_tl_total")))),
    PointRule("bureau", 10, lambda r: c("fr_delin_rate") > 0.5,
              lambda r: _cat("High delinquency rate=", percent(c("fr_delin_rate")))),
    # coverage
    PointRule("coverage", 15, lambda r: c("n_providers") == 0, _t("All providers missing")),
    PointRule("coverage", 8, lambda r: c("n_providers") == 1,
              lambda r: _cat("Minimal provider coverage (", c("n_providers").cast("string"), "/4)")),
    PointRule("coverage", 3, lambda r: (c("n_providers") > 1) & c("plaid_missing"), _t("Plaid missing")),
    PointRule("coverage", 3, lambda r: (c("n_providers") > 1) & c("prove_missing"), _t("Prove missing")),
    # interactions
    PointRule("interaction", 20, lambda r: c("fr_qi_missing") & (c("fr_fico") < 600),
              lambda r: _cat("INTERACTION_QI_LOW_FICO: Missing QI + FICO<600 (", whole(c("fr_fico")), ")")),
    PointRule("interaction", 8, lambda r: _special(r) & (c("fr_fico") < 650),
              lambda r: _cat(f"INTERACTION_{r.missing_qi}_QI: {r.missing_qi} + Missing QI + low FICO (", whole(c("fr_fico")), ")")),
    PointRule("interaction", 12, lambda r: (c("fr_partner") == r.risky) & (c("fr_fico") < 600),
              lambda r: _cat(f"{r.risky} + Low FICO (", whole(c("fr_fico")), ")")),
    PointRule("interaction", 10, lambda r: c("fr_cash_stress") >= 3,
              lambda r: _cat("Bureau stress (", c("fr_cash_stress").cast("string"), ")")),
    PointRule("interaction", 8, lambda r: c("contradiction_score") > 0,
              lambda r: _cat("Provider disagreement (", c("contradiction_score").cast("string"), " contradictions)")),
)
ENTITY_RULES = (
    PointRule("entity", 25, lambda r: c("lu_has_prior_bad") == 1, _t("Prior default by connected entity")),
    PointRule("entity", 10, lambda r: c("lu_connected_count") >= 3,
              lambda r: _cat("Multiple connected entities (", c("lu_connected_count").cast("string"), ")")),
    PointRule("entity", 5, lambda r: c("lu_is_cross_entity") == 1, _t("Cross-entity borrower")),
)


def point_thresholds(profile: str = "moderate", review: int | None = None, reject: int | None = None) -> tuple[int, int]:
    """(review, reject) of a named profile, optionally overridden."""
    if profile not in K.POINT_PROFILES:
        raise ValueError(f"unknown profile {profile!r}, expected one of {sorted(K.POINT_PROFILES)}")
    base = K.POINT_PROFILES[profile]
    return (base[0] if review is None else review, base[1] if reject is None else reject)


def points_engine(df: DataFrame, thresholds: tuple[int, int] = K.POINT_PROFILES["moderate"],
                  roles: K.PartnerRoles = K.DEFAULT_ROLES, with_reasons: bool = True) -> DataFrame:
    """Add fraud_score, fraud_normalized, fraud_decision, pts_<category> and fraud_reasons.

    Entity points apply when the lookup columns (``lu_*``) are joined already.
    Adding points one rule at a time under a cap equals capping the running total,
    so a rule is awarded min(cap, total with it) - min(cap, total without it).
    """
    entity = "lu_has_prior_bad" in df.columns
    rules = POINT_RULES + (ENTITY_RULES if entity else ())
    df = fraud_features(df)
    own = set(df.columns)
    df = df.withColumns({f"_hit{i}": flag(r.when(roles)) for i, r in enumerate(rules)})
    categories, reasons = {}, []
    for category, cap in K.POINT_CAPS.items():
        before = F.lit(0)
        for i, r in enumerate(rules):
            if r.category != category:
                continue
            after = before + c(f"_hit{i}") * r.points
            award = F.least(after, F.lit(cap)) - F.least(before, F.lit(cap))
            reasons.append(F.when((c(f"_hit{i}") == 1) & (award > 0),
                                  _cat(r.text(roles), " (+", award.cast("string"), ")")))
            before = after
        categories[category] = F.least(before, F.lit(cap))
    df = df.withColumns({f"pts_{k}": v.cast("int") for k, v in categories.items()})
    score = sum((c(f"pts_{k}") for k in categories), F.lit(0))
    out = {"fraud_score": score.cast("int")}
    if with_reasons:
        out["fraud_reasons"] = F.array_compact(F.array(*reasons))
    df = df.withColumns(out)
    review, reject = thresholds
    top = K.POINT_MAX_WITH_ENTITY if entity else K.POINT_MAX
    df = df.withColumns({
        "fraud_normalized": half_up(c("fraud_score") / float(top), 4),
        "fraud_decision": F.when(c("fraud_score") >= reject, "decline").when(c("fraud_score") >= review, "review").otherwise("pass"),
    })
    helpers = [k for k in own if k.startswith("fr_")]
    return df.drop(*[f"_hit{i}" for i in range(len(rules))], *helpers)


def hard_rules(df: DataFrame, roles: K.PartnerRoles = K.DEFAULT_ROLES) -> DataFrame:
    """Three decline and three review rules; review rules are not evaluated on a decline.

    Row values win; the lookup (``lu_has_prior_bad``, ``lu_connected_loans``) is
    used where the row has neither. NULL qi is MISSING, NULL fico is 650."""
    have = set(df.columns)
    get = lambda k, d: fill(c(k), d) if k in have else F.lit(d)
    row_bad, row_conn = get("has_prior_bad", 0), get("connected_entities", 0)
    known = (row_bad != 0) | (row_conn != 0)
    bad = F.when(known, row_bad).otherwise(get("lu_has_prior_bad", 0)) != 0
    connected = F.when(known, row_conn).otherwise(get("lu_connected_loans", 0))
    qi = fill(upper_text(c("qi")), "MISSING")
    fico = F.when(c("fico") == 0, 650.0).otherwise(fill(c("fico"), 650.0))
    partner = fill(upper_text(c("partner")), "")
    decline = [
        F.when(bad, "prior_bad_auto_decline"),
        F.when((qi == "MISSING") & (fico < 600), "missing_qi_low_fico"),
        F.when((qi == "MISSING") & (partner == roles.missing_qi), f"missing_qi_{roles.missing_qi.lower()}"),
    ]
    review = [
        F.when(fico < 550, "extreme_subprime"),
        F.when((fill(c("d60"), 0.0) >= 4) & (fico < 620), "bureau_stress"),
        F.when(connected >= 3, "entity_cluster"),
    ]
    df = df.withColumn("_decline", F.array_compact(F.array(*decline)))
    df = df.withColumn("_rules", F.when(F.size("_decline") > 0, c("_decline"))
                       .otherwise(F.array_compact(F.array(*review))))
    return df.withColumns({
        "fraud_decision": F.when(F.size("_decline") > 0, "decline").when(F.size("_rules") > 0, "review").otherwise("approve"),
        "fraud_rules_triggered": F.array_join("_rules", "|"),
    }).drop("_decline", "_rules")


def rule_composite(df: DataFrame, out: str = "rule_score") -> DataFrame:
    """Boundary graders combined to one 1-10 risk composite."""
    have = set(df.columns)
    s = {k: boundary_score(c(k).cast("double"), b, low, miss) if k in have else F.lit(miss)
         for k, (b, low, miss) in K.GRADER_BOUNDARIES.items()}
    qi = fill(lookup(c("qi"), K.QI_RISK), 10) if "qi" in have else F.lit(10)
    bad = F.when(c("has_prior_bad") == 1, K.PRIOR_BAD_RISK).otherwise(1) if "has_prior_bad" in have else F.lit(1)
    delinquency = s["d30"] * 0.6 + s["d60"] * 0.4
    depth = s["tl_total"] * 0.5 + s["crhist"] * 0.5
    profile = s["fico"] * 0.4 + delinquency * 0.3 + depth * 0.3
    business = qi * 0.65 + s["inq6"] * 0.35
    detail = (s["revutil"] + s["mopmt"] + s["tl_total"] + s["crhist"]) * 0.25
    entity = s["is_repeat"] * 0.5 + bad * 0.5
    return df.withColumn(out, profile * 0.40 + business * 0.25 + detail * 0.25 + entity * 0.10)


def rule_grades(df: DataFrame, cols=tuple(K.GRADER_BOUNDARIES)) -> DataFrame:
    """The 1..10 grade of each configured feature as ``<name>_score``."""
    return df.withColumns({f"{k}_score": boundary_score(c(k).cast("double"), *K.GRADER_BOUNDARIES[k])
                           for k in cols if k in df.columns})



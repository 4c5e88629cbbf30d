"""Row-local feature derivation.

Several models use features of the same name with different formulas; each
builder below fixes one variant:

* ``bureau_features`` - the modelling set
* ``compact_features`` - the credit-model set (no null fill on counts)
* ``scorecard_features`` - the blended scorecard's set
* ``survival_features`` - everything zero-filled first
* ``fraud_features`` - inputs of the points engine
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.binning import cut_right
from ..functions.clean import at_least, clip, fill, flag, is_missing, lookup, missing_in, number, number_in, upper_text, zero

c = F.col


def _ratio(top: Column, bottom: Column) -> Column:
    return clip(top / at_least(bottom, 1), 0, 1)


def _total_balance() -> Column:
    return at_least(zero(c("instbal")) + zero(c("revbal")), 1)


def _interaction_bin(default: float) -> Column:
    return fill(cut_right(c("fico"), K.FICO_INTERACTION_EDGES, [0.0, 1.0, 2.0, 3.0, 4.0]), default)


def bureau_features(df: DataFrame) -> DataFrame:
    d30, d60, inq6 = zero(c("d30")), zero(c("d60")), zero(c("inq6"))
    df = df.withColumns({
        "paid_ratio": _ratio(c("tl_paid"), c("tl_total")),
        "delin_rate": _ratio(c("tl_delin"), c("tl_total")),
        "delin_severity": d30 + d60 * 2,
        "has_severe_delin": flag(c("d60") > 0),
        "any_delin": flag(d30 + d60 > 0),
        "zero_current_delin": flag(c("tl_delin") == 0),
        "delin_recency": F.when(c("d60") > 0, 2.0).when(c("d30") > 0, 1.0).otherwise(0.0),
        "util_distance": F.pow((fill(c("revutil"), 50.0) - 37.5) / 37.5, 2),
        "high_util": flag(c("revutil") > 80),
        "zero_util": flag(c("revutil") == 0),
        "total_balance": _total_balance(),
        "high_inq": flag(c("inq6") >= 6),
        "credit_activity": inq6 / at_least(c("tl_total"), 1),
        "inq_intensity": inq6 / at_least(c("crhist"), 1) * 12,
        "cash_stress": flag(c("fico") < 580) * 2 + flag(c("pastdue") > 0) + flag(c("revutil") > 80),
        "fico_band": fill(cut_right(c("fico"), K.FICO_BAND_EDGES, [float(i) for i in range(1, 10)]), 5.0),
    })
    return df.withColumns({
        "credit_recovery": flag((c("zero_current_delin") == 1) & ((c("d30") > 0) | (c("d60") > 0))),
        "rev_share": zero(c("revbal")) / c("total_balance"),
        "payment_burden": zero(c("mopmt")) / c("total_balance"),
        "bureau_health": (c("zero_current_delin") * 0.4 + (1 - clip(c("credit_activity"), 0, 1)) * 0.3
                          + c("paid_ratio") * 0.3),
    })


def qi_partner_features(df: DataFrame, roles: K.PartnerRoles = K.DEFAULT_ROLES) -> DataFrame:
    """qi, partner and interaction features. partner_encoded and fico_partner_risk are for
    analysis only: fair-lending rules keep them out of every model feature list."""
    df = df.withColumns({k: upper_text(c(k)) for k in ("qi", "shop_qi", "partner") if k in df.columns})
    qi = c("qi") if "qi" in df.columns else c("shop_qi")
    df = df.withColumns({
        "qi_encoded": fill(lookup(qi, K.QI_ORDINAL), 4),
        "qi_missing": flag(qi.isNull() | (qi == "MISSING")),
        "qi_quality": fill(lookup(qi, K.QI_QUALITY), 1),
        "partner_encoded": fill(lookup(c("partner"), roles.encoding), 1),
        "hfht_high_fico": flag((qi == "HFHT") & (c("fico") >= 650)),
    })
    out = {
        "fico_qi_interaction": _interaction_bin(2.0) * 5 + c("qi_encoded"),
        "missing_qi_low_fico": flag((c("qi_missing") == 1) & (c("fico") < 600)),
        "fico_partner_risk": c("fico") * (1 + c("partner_encoded") * 0.1),
    }
    if "any_delin" in df.columns:
        out["triple_risk"] = c("qi_encoded") + flag(c("fico") < 600) * 3 + c("any_delin") * 2
    return df.withColumns(out)


def identity_features(df: DataFrame) -> DataFrame:
    """Signals of the identity, bank and bankruptcy providers that are present."""
    have = set(df.columns)
    present = lambda name, cond: flag(cond) if name in have else F.lit(0)
    out = {"n_identity_sources": (
        present("prove_phone_trust_score", c("prove_phone_trust_score").isNotNull())
        + present("plaid_balance", c("plaid_balance").isNotNull())
        + present("giact_bankruptcy_count", c("giact_bankruptcy_count").isNotNull())
        + present("taktile_status", c("taktile_status") == "success"))}
    if "prove_phone_trust_score" in have:
        trust = zero(c("prove_phone_trust_score"))
        out["prove_trust_norm"] = trust / 1000
        out["prove_trust_low"] = flag(trust < 500)
        if "prove_name_score" in have:
            out["prove_name_match_weak"] = flag(zero(c("prove_name_score")) < 50)
        out["prove_ssn_fail"] = present("prove_ssn_match", c("prove_ssn_match") == 0)
    if "plaid_balance" in have:
        balance = zero(c("plaid_balance"))
        out["plaid_balance_log"] = F.log1p(at_least(balance, 0))
        out["plaid_low_balance"] = flag(balance < 500)
        out["plaid_negative_balance"] = flag(balance < 0)
    if "plaid_recentNSFs" in have:
        out["plaid_has_nsf"] = flag(c("plaid_recentNSFs") > 0)
        out["plaid_high_nsf"] = flag(c("plaid_recentNSFs") >= 3)
    if "giact_bankruptcy_count" in have:
        out["giact_has_bankruptcy"] = flag(c("giact_bankruptcy_count") > 0)
        out["giact_multiple_bankruptcy"] = flag(c("giact_bankruptcy_count") > 1)
    if "taktile_output" in have:
        out["taktile_has_output"] = flag(c("taktile_output").isNotNull())
        out["taktile_fraud_flag"] = flag(c("taktile_output").rlike(K.FRAUD_TEXT))
        out["taktile_identity_match"] = flag(c("taktile_output").rlike(K.MATCH_TEXT))
    return df.withColumns(out)


def prior_history(df: DataFrame) -> DataFrame:
    """Three-level prior history; absent flags count as 0."""
    filled = {k: (fill(c(k), 0) if k in df.columns else F.lit(0)).cast("int") for k in ("has_prior_bad", "is_repeat")}
    return df.withColumns(filled).withColumn(
        "prior_history",
        F.when(c("has_prior_bad") == 1, "prior_BAD").when(c("is_repeat") == 1, "prior_PAID").otherwise("none"))


def reject_leaky(df: DataFrame, context: str = "") -> DataFrame:
    found = sorted(set(K.LEAKY_COLUMNS) & set(df.columns))
    if found:
        raise ValueError(f"leaky features detected{' in ' + context if context else ''}: {found}")
    return df


def all_features(df: DataFrame, include_identity: bool = False, master: DataFrame | None = None,
                 roles: K.PartnerRoles = K.DEFAULT_ROLES) -> DataFrame:
    """Bureau, qi/partner and history features, identity signals on request."""
    df = prior_history(qi_partner_features(bureau_features(df), roles))
    if include_identity:
        if "prove_phone_trust_score" not in df.columns and master is not None:
            from .enrich import enrich
            df = enrich(df, master)
        df = identity_features(df)
    return reject_leaky(df, "all_features output")


def compact_features(df: DataFrame, roles: K.PartnerRoles = K.DEFAULT_ROLES) -> DataFrame:
    df = df.withColumn("qi_encoded", fill(lookup(c("qi"), K.QI_ORDINAL), 4))
    return df.withColumns({
        "qi_missing": flag(c("qi") == "MISSING"),
        "partner_encoded": fill(lookup(c("partner"), roles.encoding), 1),
        "fico_qi_interaction": _interaction_bin(0.0) * 5 + c("qi_encoded"),
        "paid_ratio": _ratio(c("tl_paid"), c("tl_total")),
        "delin_rate": _ratio(c("tl_delin"), c("tl_total")),
        "delin_severity": c("d30") + c("d60") * 2,
        "payment_burden": zero(c("mopmt")) / _total_balance(),
        "credit_activity": c("inq6") / at_least(c("tl_total"), 1),
    })


def typed_numbers(df: DataFrame, cols=K.BUREAU_COLUMNS, default: float | None = None) -> DataFrame:
    """Numeric columns as doubles; absent ones are created, missing values get the default."""
    none = F.lit(default).cast("double")
    types = dict(df.dtypes)

    def one(k):
        if k not in types:
            return none
        v = number(c(k)) if types[k] == "string" else c(k).cast("double")
        return v if default is None else F.coalesce(v, none)

    return df.withColumns({k: one(k) for k in cols})


def scorecard_features(df: DataFrame, roles: K.PartnerRoles = K.DEFAULT_ROLES) -> DataFrame:
    df = typed_numbers(df)
    qi = c("qi") if "qi" in df.columns else F.lit(None).cast("string")
    partner = c("partner") if "partner" in df.columns else F.lit(None).cast("string")
    total = at_least(fill(c("tl_total"), 1.0), 1)
    df = df.withColumns({
        "qi_encoded": fill(lookup(qi, K.QI_ORDINAL), 4).cast("double"),
        "partner_encoded": fill(lookup(partner, roles.encoding), 1).cast("double"),
        "paid_ratio": clip(zero(c("tl_paid")) / total, 0, 1),
        "delin_rate": clip(zero(c("tl_delin")) / total, 0, 1),
        "delin_severity": zero(c("d30")) + zero(c("d60")) * 2,
        "cash_stress": (flag(fill(c("fico"), 700.0) < 580) * 2 + flag(c("pastdue") > 0)
                        + flag(c("revutil") > 80) + flag(c("d60") > 0)).cast("double"),
        "util_distance": F.abs(fill(c("revutil"), 50.0) - 50),
        "any_delin": flag((c("d30") > 0) | (c("d60") > 0)),
        **{k: (fill(c(k), 0) if k in df.columns else F.lit(0)).cast("int")
           for k in ("has_prior_bad", "is_repeat", "is_cross_entity", "prior_loans_ssn", "prior_shops_ssn")},
    })
    return prior_history(df.withColumns({
        "qi_missing": flag(c("qi_encoded") == 4),
        "fico_qi_interaction": _interaction_bin(2.0) * 5 + c("qi_encoded"),
        "bureau_health": (flag(zero(c("tl_delin")) == 0) * 0.4 + c("paid_ratio") * 0.3 + (1 - c("delin_rate")) * 0.3),
    }))


def survival_features(df: DataFrame) -> DataFrame:
    df = typed_numbers(df, default=0.0)
    qi = (F.upper("qi") if "qi" in df.columns else F.upper("shop_qi") if "shop_qi" in df.columns
          else F.lit(None).cast("string"))
    total = at_least(c("tl_total"), 1)
    df = df.withColumns({
        "qi_encoded": fill(lookup(qi, K.QI_ORDINAL), 4),
        "qi_missing": flag(qi.isNull() | qi.isin("MISSING", "NONE", "NAN")),
        "paid_ratio": clip(c("tl_paid") / total, 0, 1),
        "delin_rate": clip(c("tl_delin") / total, 0, 1),
        "delin_severity": c("d30") + c("d60") * 2,
        "payment_burden": c("mopmt") / _total_balance(),
        "credit_activity": c("inq6") / total,
        "cash_stress": flag(c("fico") < 580) * 2 + flag(c("pastdue") > 0) + flag(c("revutil") > 80),
    })
    return df.withColumns({
        "fico_qi_interaction": _interaction_bin(2.0) * 5 + c("qi_encoded"),
        "bureau_health": (flag(c("tl_delin") == 0) * 0.4 + (1 - clip(c("credit_activity"), 0, 1)) * 0.3
                          + c("paid_ratio") * 0.3),
    })


PROVIDERS = {"prove": "prove_phone_trust_score", "plaid": "plaid_balance",
             "taktile": "taktile_status", "giact": "giact_bankruptcy_count"}


def fraud_features(df: DataFrame) -> DataFrame:
    """Provider coverage, stress, contradiction and delinquency inputs of the points engine."""
    have = set(df.columns)
    gone = lambda k: missing_in(df, k) if k in have else F.lit(True)
    val = lambda k, d: number_in(df, k, d) if k in have else F.lit(float(d))
    df = df.withColumns({
        **{f"{p}_missing": gone(k) for p, k in PROVIDERS.items()},
        "fr_qi_missing": is_missing(upper_text(c("qi"))) if "qi" in have else F.lit(True),
        "fr_fico": val("fico", 500), "fr_pastdue": val("pastdue", 0), "fr_revutil": val("revutil", 0),
        "fr_d60": val("d60", 0), "fr_inq6": val("inq6", 0), "fr_tl_total": val("tl_total", 5),
        "fr_balance": val("plaid_balance", 0), "fr_nsf": val("plaid_recentNSFs", 0),
        "fr_negdays": val("negative_balance_days_90d", 0), "fr_bankrupt": val("giact_bankruptcy_count", 0),
        "fr_verified": val("prove_verified", 0),
        "fr_partner": upper_text(c("partner")) if "partner" in have else F.lit(None).cast("string"),
        "fr_delin": number_in(df, "tl_delin") if "tl_delin" in have else F.lit(None).cast("double"),
        "fr_total0": val("tl_total", 0),
    })
    return df.withColumns({
        "n_providers": 4 - sum((c(f"{p}_missing").cast("int") for p in PROVIDERS), F.lit(0)),
        "fr_cash_stress": (flag(c("fr_fico") < 580) * 2 + flag(c("fr_pastdue") > 0)
                           + flag(c("fr_revutil") > 80) + flag(c("fr_d60") > 0)),
        "contradiction_score": flag(~c("prove_missing") & (c("fr_verified") == 1)
                                    & ~c("plaid_missing") & (c("fr_balance") < 0)),
        "fr_delin_rate": F.when((c("fr_total0") > 0) & c("fr_delin").isNotNull(),
                                c("fr_delin") / F.greatest(c("fr_total0"), F.lit(1.0))).otherwise(0.0),
    })


def six_rule_features(df: DataFrame, roles: K.PartnerRoles = K.DEFAULT_ROLES) -> DataFrame:
    """Preparation of the short pipeline: zero-filled bureau columns, qi filled, all features."""
    filled = [k for k in K.BUREAU_COLUMNS if k != "fico" and k in df.columns]
    df = typed_numbers(df, filled, 0.0)
    if "qi" in df.columns:
        df = df.withColumn("qi", fill(c("qi"), "MISSING"))
    return prior_history(qi_partner_features(bureau_features(df), roles))


def history_length(df: DataFrame, oldest: str = "crhist_date", unit: str = "days", out: str = "crhist") -> DataFrame:
    """Days (or months) from the oldest tradeline to signing, never negative, 0 if unknown."""
    days = F.datediff(F.to_date("signing_date"), F.to_date(oldest))
    value = F.greatest(F.coalesce(days, F.lit(0)), F.lit(0)).cast("double")
    return df.withColumn(out, value if unit == "days" else value / K.DAYS_PER_MONTH)

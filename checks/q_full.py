"""Whole operators over all their fields: survival in the cascade, evaluations, range rules, aliases, feature sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.operators import conform, decisions, features, labels, models, survival
from creditloom.plans.scoring import ScoringConfig, score_cascade
from creditloom.sources import fixtures as fx

from . import frames as fr
from .base_sql import SPLIT, sql
from .q_reports import _rank_sql
from .registry import query

c = F.col

# --- survival in batch scoring, with a given model ------------------------------------
_MODEL = survival.CoxModel({"fico": -0.004, "inq6": 0.08, "qi_missing": 0.5}, {"fico": 650.0, "inq6": 4.0, "qi_missing": 0.2}, {"fico": 0.001, "inq6": 0.02, "qi_missing": 0.1},
                           [60, 180, 365, 548, 900], [0.01, 0.05, 0.12, 0.2, 0.9], (0.8, 1.3))
_HAZARD = """hz as (select application_id, is_bad, decision, exp(-0.004e0*(coalesce(fico,0)-650)+0.08e0*(coalesce(inq6,0)-4)+0.5e0*(case when qi is null or upper(qi) in ('MISSING','NONE','NAN') then 1 else 0 end-0.2e0)) as h from decided),
sv as (select *, 1-exp(-h*0.05e0) as p6, 1-exp(-h*0.12e0) as p12, 1-exp(-h*0.2e0) as p18, case when h>=1.3e0 then 'early_default' when h>=0.8e0 then 'late_default' else 'low_risk' end as tier,
 case when 0.01e0>=ln(2e0)/h then 60 when 0.05e0>=ln(2e0)/h then 180 when 0.12e0>=ln(2e0)/h then 365 when 0.2e0>=ln(2e0)/h then 548 when 0.9e0>=ln(2e0)/h then 900 end/30.44e0 as med from hz)"""


def _with_survival(spark, sf):
    df = fr.with_lookup(fx.identity(fr.feature_table(spark, sf)))
    return score_cascade(df, fr.predict_fixed, ScoringConfig(fr.SEVEN), _MODEL)


@query("cascade_survival", sql("select application_id, decision, round(p6,4) as survival_hazard_6mo, round(p12,4) as survival_hazard_12mo, round(p18,4) as survival_hazard_18mo, tier as survival_risk_tier, round(med,1) as survival_median_months, 1 as survival_available from sv", "decided", plus=_HAZARD))
def cascade_survival(spark, sf):
    """The cascade with survival columns on every row."""
    return _with_survival(spark, sf).select("application_id", "decision", *[f"survival_hazard_{m}mo" for m in K.HORIZON_MONTHS], "survival_risk_tier", "survival_median_months", "survival_available")


@query("tier_separation", sql("select tier, count(*) as n, cast(sum(is_bad) as bigint) as n_bad, round(avg(is_bad),6) as bad_rate, round(count(*)/(select count(*) from sv),6) as pct from sv group by tier", "decided", plus=_HAZARD))
def tier_separation(spark, sf):
    scored = _with_survival(spark, sf).select("survival_risk_tier", c("is_bad").alias("event"))
    return fr.rounded(survival.tier_separation(scored, "survival_risk_tier"))


# --- evaluations ------------------------------------------------------------------------
@query("scorecard_report", sql("select name, n_obs, n_bad, round(auc,6) as auc, round(2*auc-1,6) as gini, round(ks,6) as ks, round(average_precision,6) as average_precision, case when name='pd' then round((select avg(pow(pd-is_bad,2)) from decided),6) end as brier from rk",
                               "decided", plus=_rank_sql(("pd", "woe_pd", "rule_pd", "xgb_pd"))))
def scorecard_report(spark, sf):
    return fr.rounded(models.evaluate_scorecard(fr.scored_table(spark, sf)))


_FLAG = """fl as (select application_id, decision as decision_v1, (woe_pd*0.55e0+rule_pd*0.10e0+xgb_pd*0.35e0)*0.75e0+fraud_score/145e0*0.25e0 as s, case when coalesce(fico,650)<600 then 0.140 when coalesce(fico,650)<650 then 0.080 when coalesce(fico,650)<700 then 0.115 else 0.140 end as lim from decided)"""


@query("optimised_decision", sql("select application_id, decision_v1, case when s is null then decision_v1 when round(s,9)>=lim then 'Flag' else 'Approve' end as decision from fl", "decided", plus=_FLAG))
def optimised_decision(spark, sf):
    return decisions.optimised_decision(fr.scored_table(spark, sf)).select("application_id", "decision_v1", "decision")


@query("leaky_columns", "select count(*) as n, 1 as refused from orders where o_orderstatus is not null")
def leaky_columns(spark, sf):
    """The guard lets clean features through and refuses a table with a column known only afterwards."""
    o = fx.table(spark, sf, "orders").where("o_orderstatus is not null").select("o_orderkey")
    n = features.reject_leaky(o, "training").agg(F.count("*").alias("n"))
    try:
        features.reject_leaky(o.withColumn(sorted(K.LEAKY_COLUMNS)[0], F.lit(1)), "training")
        refused = 0
    except ValueError:
        refused = 1
    return n.withColumn("refused", F.lit(refused))


# --- inputs ---------------------------------------------------------------------------
def _limits(ranges: dict, alias: dict | None = None) -> str:
    parts = []
    for k, (low, high, required) in ranges.items():
        v = (alias or {}).get(k, k)
        parts += [f"case when {v} is null then '{k}_required' end"] if required else []
        parts += [f"case when {v}<{low} then '{k}_low' end"] if low is not None else []
        parts += [f"case when {v}>{high} then '{k}_high' end"] if high is not None else []
    return "concat_ws('|', " + ", ".join(parts) + ")"


_FIELDS = {"pastdue": (0, None, False), "d30": (0, None, False), "d60": (0, None, False), "delin_rate": (0, 1, False), "bal_to_limit": (0, None, False), "rev_avail_pct": (0, 1, False), "revbal": (0, None, False),
           "mopmt": (0, None, False), "revutil": (0, None, False), "instbal": (0, None, False), "tl_total": (0, None, False), "tl_paid": (0, None, False), "tl_delin": (0, None, False), "crhist": (0, None, False),
           "inq6": (0, None, False), "years_in_business": (0, None, False), "has_prior_bad": (0, 1, False), "is_repeat": (0, 1, False), "nsf_count": (0, None, False), "negative_balance_days_90d": (0, None, False)}
_SHIFTED = ("pastdue", "d30", "d60", "revbal", "mopmt", "revutil", "instbal", "tl_total", "tl_paid", "tl_delin", "crhist", "inq6")
_MADE = {"delin_rate": "tl_delin/tl_total*2", "bal_to_limit": "revutil-0.04", "rev_avail_pct": "d30-1", "years_in_business": "crhist-100", "has_prior_bad": "d60-1", "is_repeat": "d30-2", "nsf_count": "inq6-3", "negative_balance_days_90d": "d30-1"}


@query("request_ranges", sql("select application_id, " + _limits({"fico": (300, 850, True), **_FIELDS}) + " as errors from (select application_id, fico, " + ", ".join(f"{k}-2 as {k}" for k in _SHIFTED) + ", "
                             + ", ".join(f"{e} as {k}" for k, e in _MADE.items()) + " from loans) t", "loans"))
def request_ranges(spark, sf):
    """Every configured request field, shifted so that each rule is met by some rows."""
    df = fr.loans(spark, sf).select("application_id", "fico", *[(c(k) - 2).alias(k) for k in _SHIFTED], *[F.expr(e).alias(k) for k, e in _MADE.items()])
    return df.select("application_id", F.array_join(conform.range_errors(df), "|").alias("errors"))


_MONITOR = {"nsf_count": (0, None, False), "nsf_rate": (0, 1, False), "nsf_in_first_90d": (0, 1, False), "nsf_cluster_max": (0, None, False), "max_consecutive_nsf": (0, None, False),
            "has_recovery": (0, 1, False), "recovery_nsf_rate": (0, 1, False), "payment_cv": (0, None, False)}


@query("monitor_ranges", sql("select loan_id, " + _limits(_MONITOR) + " as errors from (select loan_id, nsf_count-1 as nsf_count, nsf_rate*2 as nsf_rate, nsf_in_first_90d*2-1 as nsf_in_first_90d, nsf_cluster_max-1 as nsf_cluster_max, max_consecutive_nsf-1 as max_consecutive_nsf, has_recovery*2 as has_recovery, recovery_nsf_rate-0.5e0 as recovery_nsf_rate, payment_cv-0.4e0 as payment_cv from payf join scope using (loan_id)) t", "payf", "scope"))
def monitor_ranges(spark, sf):
    df = fr.payment_table(spark, sf).select("loan_id", *[F.expr(e).alias(k) for k, e in {
        "nsf_count": "nsf_count-1", "nsf_rate": "nsf_rate*2", "nsf_in_first_90d": "nsf_in_first_90d*2-1", "nsf_cluster_max": "nsf_cluster_max-1", "max_consecutive_nsf": "max_consecutive_nsf-1",
        "has_recovery": "has_recovery*2", "recovery_nsf_rate": "recovery_nsf_rate-0.5d", "payment_cv": "payment_cv-0.4d"}.items()])
    return df.select("loan_id", F.array_join(conform.range_errors(df, K.MONITOR_RANGES), "|").alias("errors"))


_NAMES = ("fico", "d30", "d60", "inq6", "revutil", "pastdue", "instbal", "revbal", "tl_total", "tl_paid", "tl_delin", "mopmt", "crhist", "qi")


@query("alias_columns", sql("select application_id, " + ", ".join(_NAMES) + ", d30 as d90, strftime(signing_date,'%Y-%m-%d') as crhist_date from loans", "loans"))
def alias_columns(spark, sf):
    """All sixteen short names from their long forms."""
    df = fr.loans(spark, sf).withColumns({"d90": c("d30"), "crhist_date": F.date_format("signing_date", "yyyy-MM-dd")})
    long = df.withColumnsRenamed({k: K.COLUMN_ALIASES[k][-1] for k in K.COLUMN_ALIASES})
    return conform.apply_aliases(long).select("application_id", *_NAMES, "d90", "crhist_date")


_BUREAU = _NAMES[:-1]


@query("feature_sets", sql("select " + ", ".join(f"count({k}) as {k}" for k in _BUREAU) + " from scope", "scope"))
def feature_sets(spark, sf):
    df = fr.scope(spark, sf)
    names = conform.feature_columns(df, "bureau_core")
    return df.select(*names).agg(*[F.count(n).alias(n) for n in names])


# --- the whole scorecard: no SQL twin; its parts have one each --------------------------
@query("blended_scorecard_fit")
def blended_scorecard_fit(spark, sf):
    """Fit on the training period (sub-models, out-of-fold calibration, multiplier), predict and evaluate the test period, recalibrate on it."""
    train, test = labels.temporal_split(fr.feature_table(spark, sf), SPLIT)
    m = models.fit_scorecard(train, rounds=10, oof_folds=2)
    report = models.evaluate_scorecard(m.predict(test)).select(F.lit("test").alias("stage"), "name", "n_obs", "auc", "ks", "brier")
    _, stages = models.recalibrate(m, test)
    return report.unionByName(stages.select("stage", F.lit("pd").alias("name"), "n_obs", F.lit(None).cast("double").alias("auc"), F.lit(None).cast("double").alias("ks"), "brier"))

"""Fitted models, reasons, survival regression and streaming runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.operators import labels, models, survival
from creditloom.operators.features import six_rule_features, survival_features
from creditloom.operators.grading import fixed_grade
from creditloom.operators.models import LogitModel
from creditloom.plans.scoring import ScoringConfig, live_record, score_cascade, score_six_rules
from creditloom.session import cut_lineage, scratch_path
from creditloom.sources import fixtures as fx
from creditloom.streaming import incremental, live

from . import frames as fr
from .base_sql import AS_OF, SPLIT, sql
from .q_rules import _SIX, _rule_texts
from .registry import query

c = F.col


_TIER_OF = {"MISSING_QI_": 1, "INTERACTION_": 1, "Missing QI": 1, "Prior default by connected": 2, "Multiple connected entities": 2, "Cross-entity borrower": 2, "HIGH_PD_GRADE_E_DECLINE": 2,
            "AUTO_DECLINE_HIGH_PD_REVIEW": 2, "PARTNER_GRADE_E_AUTO_DECLINE": 2, "AUTO_APPROVE_LOW_PD_REVIEW": 6, "Negative bank balance": 3, "High NSFs": 3, "Extended negative balance": 3, "Bureau stress": 3,
            "PARTNER_B": 3, "High delinquency rate": 4, "High inquiries": 4, "GIACT bankruptcy": 4, "Below-average credit": 4, "High monthly payment": 4, "Elevated revolving": 4, "Zero/minimal tradelines": 4,
            "Severe delinquencies": 6, "High past due": 6, "Low FICO": 6, "FICO < 550": 6, "FICO 550-600": 6, "Plaid missing": 7, "Prove missing": 7, "All providers missing": 7,
            "Minimal provider coverage": 7, "Provider disagreement": 7}


# --- reasons and the full cascade -----------------------------------------------
def _reasons_sql() -> str:
    i = lambda e: f"cast(trunc({e}) as bigint)"
    money = lambda e: f"format('${{:,}}', cast(round_even({e},0) as bigint))"
    pct = "format('{:.1f}',pd*100)||'%'"
    tiers = _TIER_OF.items()
    tier = "case " + " ".join(f"when starts_with(v,'{p}') then {t}" for p, t in tiers) + " else 5 end"
    top = lambda e: f"list_transform(list_sort(list_transform({e}, lambda v, n: {{'t': {tier}, 'n': n, 'v': v}}))[1:8], lambda s: s.v)"
    return f"""
r0 as materialized (select *, list_transform(list_filter([{_rule_texts()}], lambda v: v is not null), lambda v: trim(split_part(v,'(+',1))) as fr_,
  case when coalesce(tl_delin,0)=0 then 0.4e0 else 0 end + least(coalesce(tl_paid,0)/greatest(coalesce(tl_total,1),1),1)*0.3e0 + (1-least(coalesce(tl_delin,0)/greatest(coalesce(tl_total,1),1),1))*0.3e0 as bh from decided),
r1 as materialized (select *, list_concat(fr_, list_filter([case when pd>=0.25 then 'High default risk (PD='||{pct}||')' when pd>=0.15 then 'Elevated default risk (PD='||{pct}||')' end,
  case when grade in ('E','F','G') then 'Poor credit grade ('||grade||')' end], lambda v: v is not null)) as r from r0),
r2 as materialized (select *, {top('''list_concat(r, list_filter([
  case when fico<600 and len(list_filter(r, lambda v: contains(v,'FICO')))=0 then 'Low FICO ('||''' + i('fico') + '''||')' end,
  case when partner='PARTNER_B' and fico<650 and len(list_filter(r, lambda v: contains(v,'PARTNER_B')))=0 then 'PARTNER_B partner (high-risk segment)' end,
  case when qi='MISSING' and len(list_filter(r, lambda v: contains(upper(v),'QI')))=0 then 'Missing QI' end,
  case when bh<0.35 then 'Below-average credit bureau profile' end,
  case when mopmt>3000 then 'High monthly payment obligations ('||''' + money('mopmt') + '''||')' end,
  case when revbal>50000 then 'Elevated revolving credit balances ('||''' + money('revbal') + '''||')' end], lambda v: v is not null))''')} as r8 from r1),
r3 as materialized (select *, case grade_e_action when 'PARTNER_GRADE_E_AUTO_DECLINE' then 'PARTNER_GRADE_E_AUTO_DECLINE (partner='||partner||')' when 'HIGH_PD_GRADE_E_DECLINE' then 'HIGH_PD_GRADE_E_DECLINE (PD='||{pct}||' > 40%)' end as late from r2)"""


def _cascade_plan(spark, sf):
    df = fr.with_lookup(fx.identity(fr.feature_table(spark, sf)))
    return score_cascade(df, fr.predict_fixed, ScoringConfig(fr.SEVEN))


@query("cascade_scores", sql("select application_id, decision, fraud_score, pd, grade, pricing_tier, default_score, grade_e_action, 0 as survival_available from decided", "decided"))
def cascade_scores(spark, sf):
    return _cascade_plan(spark, sf).select("application_id", "decision", "fraud_score", "pd", "grade", "pricing_tier", "default_score", "grade_e_action", "survival_available")


@query("cascade_reasons", sql("""select application_id, array_to_string(case when late is null then r8 else
 list_transform(list_sort(list_transform(list_concat(r8,[late]), lambda v, n: {'t': case """
       + " ".join(f"when starts_with(v,'{p}') then {t}" for p, t in _TIER_OF.items())
       + """ else 5 end, 'n': n, 'v': v}))[1:8], lambda s: s.v) end, '|') as reasons from r3""", "decided", plus=_reasons_sql()))
def cascade_reasons(spark, sf):
    return _cascade_plan(spark, sf).select("application_id", F.array_join("reasons", "|").alias("reasons"))


# --- fitted models (rows only) ------------------------------------------------------
@query("woe_logistic_model")
def woe_logistic_model(spark, sf):
    """Fit the WoE model on the training period, grade everything, report by grade."""
    feat = six_rule_features(fr.feature_table(spark, sf).select("application_id", "signing_date", "is_bad", "qi", "partner", "has_prior_bad", "is_repeat", *K.BUREAU_COLUMNS))
    train, _ = labels.temporal_split(feat, SPLIT)
    m = models.fit_woe_pd(train.cache())
    train.unpersist()
    scored = fixed_grade(m.predict(feat))
    return scored.groupBy("grade").agg(F.count("*").alias("n"), F.avg("pd").alias("mean_pd"), F.avg(c("is_bad").cast("double")).alias("bad_rate"))


def _survival_frame(spark, sf):
    df = labels.with_duration(fr.feature_table(spark, sf).select("application_id", "signing_date", "loan_state", "qi", *K.BUREAU_COLUMNS), AS_OF)
    return survival_features(labels.survival_eligible(df, ["tl_total"]))


@query("cox_horizons")
def cox_horizons(spark, sf):
    """Cox model on the training period; Brier and calibration gap at each horizon on the rest."""
    train, test = labels.temporal_split(_survival_frame(spark, sf), SPLIT)
    m = survival.fit_hazard_tiers(survival.fit_cox(train), train)
    return survival.horizon_checks(m.predict(test))


@query("cox_profiles")
def cox_profiles(spark, sf):
    """The five borrowers scored with a model fitted on the portfolio."""
    train, _ = labels.temporal_split(_survival_frame(spark, sf), SPLIT)
    m = survival.fit_hazard_tiers(survival.fit_cox(train), train)
    return m.predict(survival_features(survival.profiles(spark))).select("profile", "pd_6mo", "pd_12mo", "pd_18mo", "hazard_ratio", "median_survival_months", "risk_tier")


@query("concordance", sql(f"""select round(sum(case when a.s>b.s then 1e0 when a.s=b.s then 0.5e0 else 0 end)/count(*),6) as c_index from v a join v b on a.e=1 and (b.t>a.t or (b.t=a.t and b.e=0))""", "pts",
       plus=f"v as (select fraud_score as s, is_bad as e, date_diff('day',cast(signing_date as date),date '{AS_OF}') as t from pts)"))
def concordance(spark, sf):
    df = labels.with_duration(fr.scored_table(spark, sf), AS_OF)
    return fr.rounded(survival.concordance(df, "fraud_score"))


# --- streaming ------------------------------------------------------------------------
def six_rules(df):
    df = df.withColumn("lu_connected_loans", c("prior_loans_ssn"))
    scored = score_six_rules(df, lambda d: d.withColumn("pd", F.round(LogitModel(*fx.WOE_STATE).column(), 6)))
    return live_record(scored, "stream")


def arrivals(spark, path, n):
    """The files below a path as a stream of n micro-batches: one holds as many files as Spark wrote for an arrival, however many tasks wrote them."""
    written = spark.read.option("recursiveFileLookup", True).parquet(path)
    each = -(-len(written.inputFiles()) // n)
    return spark.readStream.schema(written.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", each).parquet(path)


@query("incremental_scoring", sql("select application_id, pd, grade, upper(substr(decision,1,1))||substr(decision,2) as decision, fraud_decision from sixpd", "six", plus=_SIX))
def incremental_scoring(spark, sf):
    """Applications arrive in three overlapping files; the stream scores each of them once."""
    root = scratch_path(spark, "stream")
    apps = fr.scope(spark, sf)
    part = c("application_id") % 3
    for i in range(3):  # each file repeats a third of the applications seen before
        apps.where((part == i) | (part == (i + 2) % 3) & F.lit(i > 0)).write.mode("append").parquet(root + f"/in/f{i}")
    tables = incremental.LiveTables(root + "/scored", root + "/log")
    q = incremental.start(arrivals(spark, root + "/in", 3), tables, six_rules, root + "/ckpt", entity=cut_lineage(fr.history(spark, sf)), every=None)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return tables.read(spark).select("application_id", "pd", "grade", "decision", "fraud_decision")


@query("nsf_windows", """select user_id as account, w as window_start, count(*) as nsf_count from (select user_id, date_trunc('day', ts)::timestamp - to_days(cast(k as integer)) as w from events, (select unnest(range(30)) as k) g where event_type='error') t group by 1,2 having count(*)>=2""")
def nsf_windows(spark, sf):
    e = fx.transactions(spark, sf)
    return live.nsf_windows(e).select("account", c("window_start").cast("timestamp_ntz").alias("window_start"), "nsf_count")


@query("activity_sessions", """select user_id as account, min(ts) as session_start, count(*) as n_events, round(sum(value),4) as amount from (select *, sum(new) over (partition by user_id order by ts, event_id) as s from (select *, case when ts > lag(ts) over (partition by user_id order by ts, event_id) + interval 12 hour then 1 else 0 end as new from events) t) t group by user_id, s""")
def activity_sessions(spark, sf):
    e = fx.transactions(spark, sf)
    return fr.rounded(live.activity_sessions(e, gap="12 hours").select("account", c("session_start").cast("timestamp_ntz").alias("session_start"), "n_events", "amount"), 4)

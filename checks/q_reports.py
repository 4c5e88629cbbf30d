"""Metrics, summaries, drift, review queue, survival tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.operators import baseline, drift, labels, metrics, review, summary, survival
from creditloom.operators.enrich import compare_production
from creditloom.plans import monitoring, portfolio
from creditloom.plans.scoring import live_record
from creditloom.session import scratch_path
from creditloom.sources import fixtures as fx
from creditloom.sources.appendlog import AppendLog

from . import frames as fr
from .base_sql import AS_OF, BAD, SPLIT, sql
from .registry import query, r6

c = F.col
_DISPLAY = "upper(substr(decision,1,1))||substr(decision,2)"


def _test(spark, sf):
    return labels.temporal_split(fr.scored_table(spark, sf), SPLIT)[1]


# --- ranking ------------------------------------------------------------------
def _rank_sql(names, where="true", by="'all'"):
    longs = " union all ".join(f"select {by} as g, '{n}' as name, cast({n} as double) as s, is_bad as y from decided where {where}" for n in names)
    return f"""sv as ({longs}),
h as (select g, name, s, sum(y) as pos, sum(1-y) as neg from sv group by all),
cm as (select *, sum(pos) over w as cpos, sum(neg) over w as cneg, sum(pos) over (partition by g,name) as np, sum(neg) over (partition by g,name) as nn from h window w as (partition by g, name order by s)),
rk as (select g, name, cast(max(np+nn) as bigint) as n_obs, cast(max(np) as bigint) as n_bad, sum(pos*(cneg-neg)+0.5e0*pos*neg)/(max(np)*max(nn)) as auc,
  greatest(max((np-cpos+pos)/np-(nn-cneg+neg)/nn),0) as ks, sum(pos/np*((np-cpos+pos)/((np-cpos+pos)+(nn-cneg+neg)))) as average_precision from cm group by g, name)"""


_SCORES = ("fraud_score", "pd", "woe_pd", "rule_pd", "xgb_pd", "pricing_tier")


@query("ranking_metrics", sql("select name, n_obs, n_bad, round(auc,6) as auc, round(2*auc-1,6) as gini, round(ks,6) as ks, round(average_precision,6) as average_precision from rk", "decided", plus=_rank_sql(_SCORES)))
def ranking_metrics(spark, sf):
    return fr.rounded(metrics.ranking(fr.scored_table(spark, sf), _SCORES))


@query("model_comparison", sql("select name, round(auc,6) as auc from rk order by auc desc", "decided", plus=_rank_sql(_SCORES, f"signing_date >= timestamp '{SPLIT}'")))
def model_comparison(spark, sf):
    return fr.rounded(summary.model_table(metrics.ranking(_test(spark, sf), _SCORES)).select("name", "auc"))


@query("raw_score_auc", sql("""select name, round(sum(pos*(cneg-neg)+0.5e0*pos*neg)/(max(np)*max(nn)),6) as auc from (
 select *, sum(neg) over (partition by name order by s) as cneg, sum(pos) over (partition by name) as np, sum(neg) over (partition by name) as nn from (
 select name, s, sum(is_bad) as pos, sum(1-is_bad) as neg from (select 'fico' as name, -fico as s, is_bad from scope where fico is not null union all select 'principal', principal, is_bad from scope) t group by all) t) t group by name""", "scope"))
def raw_score_auc(spark, sf):
    """Scores with as many distinct values as rows."""
    df = fr.scope(spark, sf).select("is_bad", (-c("fico")).alias("fico"), "principal")
    return fr.rounded(metrics.ranking(df, ["fico", "principal"]).select("name", "auc"))


@query("calibration_ratios", sql("select count(*) as n_obs, round(avg(pd),6) as pred_mean, round(avg(is_bad),6) as actual_mean, round(avg(pow(pd-is_bad,2)),6) as brier, round(avg(pd)/greatest(avg(is_bad),0.001),6) as pred_over_act, round(avg(is_bad)/avg(pd),6) as act_over_pred from decided", "decided"))
def calibration_ratios(spark, sf):
    return fr.rounded(metrics.calibration(fr.scored_table(spark, sf), "pd"))


_DEC = """dt as (select *, cast((pd>e[2])::int+(pd>e[3])::int+(pd>e[4])::int+(pd>e[5])::int+(pd>e[6])::int+(pd>e[7])::int+(pd>e[8])::int+(pd>e[9])::int+(pd>e[10])::int as integer) as decile
 from decided, (select list_sort(list_distinct(quantile_cont(pd,[0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1]))) as e from decided) q),
dc as (select decile, avg(pd) as p, avg(is_bad) as a, count(*) as n, cast(sum(is_bad) as bigint) as n_bad from dt group by decile)"""


@query("decile_table", sql("select decile, round(p,6) as predicted_mean, round(a,6) as actual_rate, n, n_bad from dc", "decided", plus=_DEC))
def decile_table(spark, sf):
    return fr.rounded(metrics.decile_table(fr.scored_table(spark, sf), "pd"))


@query("decile_lift", sql("select round(arg_max(a,decile),6) as top_rate, round(arg_min(a,decile),6) as bottom_rate, round(sum(n_bad)/sum(n),6) as base_rate, round(arg_max(a,decile)/(sum(n_bad)/sum(n)),6) as lift_top from dc", "decided", plus=_DEC))
def decile_lift(spark, sf):
    return fr.rounded(metrics.decile_lift(fr.scored_table(spark, sf), "pd"))


@query("confusion_metrics", sql("""select tp, fp, fn, tn, round(tp/(tp+fp),6) as precision, round(tp/(tp+fn),6) as recall, round(5*tp/(5*tp+4*fn+fp),6) as f2,
 round((tp::double*tn-fp::double*fn)/sqrt((tp+fp)::double*(tp+fn)*(tn+fp)*(tn+fn)),6) as mcc, round(((tp+tn)/n-pe)/(1-pe),6) as kappa from (
 select *, (((tp+fp)::double*(tp+fn))+((tn+fn)::double*(tn+fp)))/(n::double*n) as pe from (select count(*) as n, count(case when decision<>'approve' and is_bad=1 then 1 end) as tp, count(case when decision<>'approve' and is_bad=0 then 1 end) as fp,
 count(case when decision='approve' and is_bad=1 then 1 end) as fn, count(case when decision='approve' and is_bad=0 then 1 end) as tn from decided) t) t""", "decided"))
def confusion_metrics(spark, sf):
    return fr.rounded(metrics.confusion(fr.scored_table(spark, sf), c("decision") != "approve"))


@query("reject_precision", sql("select count(case when fraud_score>=70 and is_bad=1 then 1 end) as tp, round(coalesce(count(case when fraud_score>=70 and is_bad=1 then 1 end)/nullif(count(case when fraud_score>=70 then 1 end),0),0),6) as precision, round(count(case when fraud_score>=70 and is_bad=1 then 1 end)/sum(is_bad),6) as recall from pts", "pts"))
def reject_precision(spark, sf):
    return fr.rounded(metrics.confusion(fr.scored_table(spark, sf), c("fraud_score") >= 70).select("tp", "precision", "recall"))


@query("grade_agreement", sql("""select n as n_compared, round(po,6) as agreement, round((po-pe)/(1-pe),6) as kappa from (select n, po, s/(n::double*n) as pe from
 (select count(*) as n, avg(case when grade=production_grade_letter then 1e0 else 0 end) as po from dec_all where production_grade_letter is not null) x,
 (select sum(a.k::double*b.k) as s from (select grade as g, count(*) as k from dec_all where production_grade_letter is not null group by 1) a join (select production_grade_letter as g, count(*) as k from dec_all where production_grade_letter is not null group by 1) b using (g)) y) t""", "dec_all"))
def grade_agreement(spark, sf):
    df = portfolio.scored_table(fr.scored_table(spark, sf))
    return fr.rounded(metrics.label_agreement(df, "production_grade_letter", "grade"))


@query("calibration_error", sql("select round(sum(n*abs(y-p))/(select count(*) from decided),6) as ece, (select count(*) from decided) as n_obs from (select floor(pd*10+1e-12) as b, count(*) as n, avg(is_bad) as y, avg(pd) as p from decided where pd<1 group by 1) t", "decided"))
def calibration_error(spark, sf):
    return fr.rounded(metrics.expected_calibration_error(fr.scored_table(spark, sf), "pd"))


@query("acceptance", sql("""select round(auc,6) as auc, mono as monotonic, case when auc>=0.64 then 1 else 0 end as auc_pass, case when auc>=0.64 and mono=1 then 1 else 0 end as accepted from rk,
 (select case when bool_and(r >= coalesce(m,0)) then 1 else 0 end as mono from (select grade, round(avg(is_bad),4) as r, max(round(avg(is_bad),4)) over (order by grade rows between unbounded preceding and 1 preceding) as m from decided group by grade) t) g""", "decided", plus=_rank_sql(("pd",))))
def acceptance(spark, sf):
    return fr.rounded(summary.acceptance(fr.scored_table(spark, sf), "pd", fr.LETTERS))


# --- summaries ------------------------------------------------------------------
_RATES = " union all ".join(f"select '{d}' as dim, {d} as value, count(*) as n, cast(sum(is_bad) as bigint) as n_bad, round(avg(is_bad),6) as bad_rate, round(avg(pd),6) as mean_pd, round(count(*)/(select count(*) from decided),6) as pct from decided group by {d}"
                            for d in ("decision", "grade", "fraud_decision"))


@query("group_rates", sql(_RATES, "decided"))
def group_rates(spark, sf):
    return fr.rounded(summary.group_rates(fr.scored_table(spark, sf), ["decision", "grade", "fraud_decision"]))


@query("grade_stats", sql("""select grade_order, g.grade, coalesce(n,0) as n, coalesce(n_bad,0) as n_bad, bad_rate, round(mean_pd,6) as mean_pd,
 (select case when bool_and(r >= coalesce(m,0)) then 1 else 0 end from (select round(avg(is_bad),4) as r, max(round(avg(is_bad),4)) over (order by grade rows between unbounded preceding and 1 preceding) as m from decided group by grade) t) as monotonic
 from (values (0,'A'),(1,'B'),(2,'C'),(3,'D'),(4,'E'),(5,'F'),(6,'G'),(7,'H')) g(grade_order,grade) left join (select grade, count(*) as n, cast(sum(is_bad) as bigint) as n_bad, round(avg(is_bad),4) as bad_rate, avg(pd) as mean_pd from decided group by grade) s on g.grade=s.grade""", "decided"))
def grade_stats(spark, sf):
    return fr.rounded(summary.grade_stats(fr.scored_table(spark, sf), (*fr.LETTERS, "H")))


@query("payment_flag_stats", sql(" union all ".join(
    f"select '{f}' as flag, count(case when {f}=1 then 1 end) as n_flagged, round(avg({f}),6) as flagged_pct, round(coalesce(avg(case when {f}=1 then is_bad end),0),6) as flagged_rate, round(coalesce(avg(case when {f}=0 then is_bad end),0),6) as unflagged_rate, round(avg(is_bad),6) as base_rate, round(coalesce(avg(case when {f}=1 then is_bad end),0)/avg(is_bad),6) as lift from payr"
    for f in K.PAYMENT_FLAGS), "payr"))
def payment_flag_stats(spark, sf):
    return fr.rounded(summary.flag_stats(fr.payment_table(spark, sf), tuple(K.PAYMENT_FLAGS)))


@query("payment_tier_stats", sql("select risk_tier as tier, count(*) as n, cast(sum(is_bad) as bigint) as n_bad, round(avg(is_bad),6) as bad_rate, round(avg(default_probability),6) as avg_pd, round(count(*)/(select count(*) from paypd),6) as pct from paypd group by risk_tier", "paypd"))
def payment_tier_stats(spark, sf):
    return fr.rounded(summary.tier_stats(_payment_pd(spark, sf)))


def _payment_pd(spark, sf):
    from creditloom.operators.payments import fit_payment_pd, payment_pd
    df = fr.payment_table(spark, sf)
    return payment_pd(df, fit_payment_pd(df))


@query("flag_histogram", sql("select flag_count as score, count(*) as n from payr group by flag_count", "payr"))
def flag_histogram(spark, sf):
    return summary.score_histogram(fr.payment_table(spark, sf), "flag_count")


@query("payment_trends", sql("select date_trunc('month',signing_date)::timestamp as month, count(*) as n_loans, round(avg(flag_count),6) as avg_flags, round(avg(default_probability),6) as avg_pd, round(avg(case when risk_tier='red' then 1e0 else 0 end),6) as pct_red, round(avg(case when risk_tier in ('orange','red') then 1e0 else 0 end),6) as pct_orange_plus from paypd group by 1", "paypd"))
def payment_trends(spark, sf):
    return fr.rounded(summary.monthly_trends(_payment_pd(spark, sf))).withColumn("month", c("month").cast("timestamp_ntz"))


@query("points_summary", sql("select round(avg(fraud_score),6) as mean, round(stddev_pop(fraud_score),6) as std, min(fraud_score)::double as min, max(fraud_score)::double as max, round(quantile_cont(fraud_score,0.25),6) as p25, round(median(fraud_score),6) as median, round(quantile_cont(fraud_score,0.75),6) as p75, round(quantile_cont(fraud_score,0.9),6) as p90, round(quantile_cont(fraud_score,0.95),6) as p95, round(quantile_cont(fraud_score,0.99),6) as p99 from pts", "pts"))
def points_summary(spark, sf):
    return fr.rounded(summary.score_summary(fr.scored_table(spark, sf), "fraud_score"))


@query("points_percentiles", sql(f"select cast(floor(q) as bigint) as score, cast(max(p) as integer) as percentile from (select unnest({list(range(0, 101, 5))}) as p, unnest(quantile_cont(fraud_score,{[p / 100 for p in range(0, 101, 5)]})) as q from pts) t group by 1", "pts"))
def points_percentiles(spark, sf):
    return summary.percentile_map(fr.scored_table(spark, sf), "fraud_score")


@query("score_description", sql("select count(*) as count, round(avg(default_score),6) as mean, round(stddev_samp(default_score),6) as std, min(default_score)::double as min, max(default_score)::double as max, round(quantile_cont(default_score,0.25),6) as p25, round(quantile_cont(default_score,0.5),6) as p50, round(quantile_cont(default_score,0.75),6) as p75 from sc", "sc"))
def score_description(spark, sf):
    return fr.rounded(summary.describe_score(fr.scored_table(spark, sf), "default_score"))


@query("grade_migration", sql("select production_grade_letter as production, " + ", ".join(f"count(case when grade='{g}' then 1 end) as ours_{g.lower()}" for g in "ABCDEFG") + " from dec_all where production_grade_letter is not null group by 1", "dec_all"))
def grade_migration(spark, sf):
    return summary.grade_migration(portfolio.scored_table(fr.scored_table(spark, sf)))


@query("payment_portfolio", sql("select unnest(['total_loans','avg_risk_score','avg_flag_count','avg_default_probability'," + ",".join(f"'prevalence_{f}'" for f in K.PAYMENT_FLAGS) + "]) as \"key\", round(unnest([count(*)::double,avg(risk_score),avg(flag_count),avg(default_probability)," + ",".join(f"avg({f})" for f in K.PAYMENT_FLAGS) + "]),6) as value from paypd", "paypd"))
def payment_portfolio(spark, sf):
    return fr.rounded(summary.portfolio_summary(_payment_pd(spark, sf)))


@query("production_comparison", sql("select round(avg(case when production_grade_letter is not null then case when grade=production_grade_letter then 1e0 else 0 end end),6) as grade_agreement_rate, count(production_grade_letter) as n_compared, count(case when decision='decline' then 1 end) as would_decline, count(case when decision='decline' and is_bad=1 then 1 end) as would_catch_defaults, round(count(case when decision='decline' and is_bad=1 then 1 end)/sum(is_bad),6) as default_capture_rate from dec_all", "dec_all"))
def production_comparison(spark, sf):
    return fr.rounded(portfolio.production_comparison(portfolio.scored_table(fr.scored_table(spark, sf))))


@query("score_comparison", sql(f"select application_id, {_DISPLAY} as decision, case when grade=production_grade_letter then 1 else 0 end as agrees_with_production, case when decision='decline' then 1 else 0 end as would_have_declined, case when decision='decline' and is_bad=1 then 1 else 0 end as would_have_caught from dec_all", "dec_all"))
def score_comparison(spark, sf):
    df = portfolio.scored_table(fr.scored_table(spark, sf))
    return compare_production(df, c("grade"), c("production_grade_letter")).select("application_id", "decision", "agrees_with_production", "would_have_declined", "would_have_caught")


@query("live_records", sql(f"select application_id, {_DISPLAY} as decision, pd, grade, production_grade_letter, 'r1' as run_id from dec_all", "dec_all"))
def live_records(spark, sf):
    return live_record(fr.scored_table(spark, sf), "r1").select("application_id", "decision", "pd", "grade", "production_grade_letter", "run_id")


@query("portfolio_report", sql(f"""select 'rates' as section, 'decision|'||decision as "key", 'bad_rate' as sub_key, round(avg(is_bad),6) as value from decided group by decision
 union all select 'model_performance', name, 'auc', round(auc,6) from rk union all select 'calibration','all','pred_over_act', round(avg(pd)/greatest(avg(is_bad),0.001),6) from decided where signing_date >= timestamp '{SPLIT}'
 union all select 'data','all','test_loans', count(*)::double from decided where signing_date >= timestamp '{SPLIT}'""", "decided", plus=_rank_sql(_SCORES, f"signing_date >= timestamp '{SPLIT}'")))
def portfolio_report(spark, sf):
    r = portfolio.portfolio_report(portfolio.scored_table(fr.scored_table(spark, sf)), SPLIT)
    keep = ((c("section") == "rates") & c("key").startswith("decision|") & (c("sub_key") == "bad_rate")) | \
           ((c("section") == "model_performance") & (c("sub_key") == "auc")) | \
           ((c("section") == "calibration") & (c("sub_key") == "pred_over_act")) | ((c("section") == "data") & (c("sub_key") == "test_loans"))
    return fr.rounded(r.where(keep)).withColumn("key", F.when(c("section") == "rates", F.concat(F.lit("decision|"), F.lower(F.substring_index("key", "|", -1)))).otherwise(c("key")))


_VIN = f"""vin as (select d.grade, d.pd, case when curst in {BAD} then 1 else 0 end as bad, case when curst<>d.loan_state then 1 else 0 end as ch, date_diff('day',cast(signing_date as date),date '{AS_OF}') as age_days,
 case when loan_id%3=0 then loan_id%45 else 0 end as dwop, case when curst in {BAD} and loan_id%200<=90 then 1 else 0 end as d90, case when curst in {BAD} and loan_id%200<=30 then 1 else 0 end as fpd
 from (select *, case when loan_id%50=1 and loan_state='NORMAL' then 'WORKOUT' else loan_state end as curst from decided) d)"""


@query("vintage_tracking", sql("""select grade, count(*) as n_loans, cast(sum(bad) as bigint) as n_bad_now, round(avg(bad),4) as bad_rate_now, cast(sum(ch) as bigint) as n_state_changed, cast(sum(d90) as bigint) as n_early_default_90d, cast(sum(fpd) as bigint) as n_first_payment_default,
 round(avg(dwop),1) as avg_dwop, cast(max(dwop) as integer) as max_dwop, round(avg(age_days),0) as avg_age_days, round(avg(pd),4) as avg_pd,
 (select case when bool_and(r>=coalesce(m,0)) then 1 else 0 end from (select round(avg(bad),4) as r, max(round(avg(bad),4)) over (order by grade rows between unbounded preceding and 1 preceding) as m from vin where grade in ('A','B','C','D') group by grade) t) as monotonic
 from vin group by grade""", "decided", plus=_VIN))
def vintage_tracking(spark, sf):
    df = fr.scored_table(spark, sf)
    rows = summary.vintage_rows(df.select("application_id", "loan_state", "grade", "pd"), fx.current_state(df), fx.days_without_payment(df), AS_OF)
    return summary.vintage_tracking(rows)


@query("run_log", sql("select count(*) as new_scored, cast(sum(is_bad) as bigint) as new_bads, round(avg(is_bad),4) as new_bad_rate, count(case when decision='approve' then 1 end) as decisions_approve, count(case when decision='review' then 1 end) as decisions_review, count(case when decision='decline' then 1 end) as decisions_decline, (select count(*) from loans) as total_in_db, 'OK' as status from decided", "decided"))
def run_log(spark, sf):
    df = fr.scored_table(spark, sf)
    total = fr.loans(spark, sf).agg(F.count("*")).scalar()
    return summary.run_log(df, "r1", total, total, "v1").select("new_scored", "new_bads", "new_bad_rate", "decisions_approve", "decisions_review", "decisions_decline", "total_in_db", "status")


@query("training_summary", sql(f"select count(*) as n, round(avg(is_bad),6) as bad_rate, round(avg(pd),6) as mean_pd, round(median(pd),6) as median_pd from decided where signing_date < timestamp '{SPLIT}'", "decided"))
def training_summary(spark, sf):
    return fr.rounded(summary.training_summary(labels.temporal_split(fr.scored_table(spark, sf), SPLIT)[0]))


@query("payment_coverage", sql("select count(*) as n_loans, count(nsf_count) as n_with_payments, count(case when coalesce(cust_payments,0)=0 then 1 end) as zero_customer_payments, round(avg(case when coalesce(cust_payments,0)=0 then 1e0 else 0 end),6) as pct_zero_customer_payments from scope left join payf using (loan_id)", "scope", "payf"))
def payment_coverage(spark, sf):
    from creditloom.operators.payments import payment_features
    f = payment_features(fx.payments(spark, sf), fx.PAYMENT_ORDER)
    return fr.rounded(summary.payment_coverage(fr.scope(spark, sf).select("loan_id").join(f, "loan_id", "left")))


# --- drift ------------------------------------------------------------------------
def _psi_cont(names, src="decided"):
    longs = " union all ".join(f"select '{n}' as name, cast({n} as double) as v, signing_date < timestamp '{SPLIT}' as ref from {src} where {n} is not null" for n in names)
    return f"""pv as ({longs}),
ed as (select name, lo-m as lo, hi+m as hi from (select name, min(v) as lo, max(v) as hi, case when max(v)>min(v) then (max(v)-min(v))*0.01e0 else 0.01e0 end as m from pv where ref group by name) t),
bb as (select pv.name, ref, case when v>=lo and v<=hi then {'+'.join(f'(v>=lo+(hi-lo)*({i}/10e0))::int' for i in range(1, 10))} end as b from pv join ed using (name)),
tt as (select name, sum(ref::int) as nr, sum((not ref)::int) as nc, count(case when not ref and b is null then 1 end) as n_out from bb group by name),
gg as (select t.name, n_out, nr, nc, g.b, coalesce(r,0)/nr+1e-6 as r, coalesce(q,0)/nc+1e-6 as q from tt t, (select unnest(range(10)) as b) g left join (select name, b, sum(ref::int) as r, sum((not ref)::int) as q from bb where b is not null group by name, b) x on x.name=t.name and x.b=g.b),
ps as (select name, max(nr)::bigint as n_reference, max(nc)::bigint as n_current, max(n_out)::bigint as n_out_of_range, sum((q/sq-r/sr)*ln((q/sq)/(r/sr))) as psi from (select *, sum(r) over (partition by name) as sr, sum(q) over (partition by name) as sq from gg) t group by name)"""


def _split(spark, sf, cols=None):
    return labels.temporal_split(fr.scored_table(spark, sf), SPLIT)


@query("psi_scores", sql("select name, round(psi,6) as psi, n_reference, n_current, n_out_of_range from ps", "decided", plus=_psi_cont(("fraud_score", "pd", "fico", "d30", "revutil"))))
def psi_scores(spark, sf):
    ref, cur = _split(spark, sf)
    cols = ("fraud_score", "pd", "fico", "d30", "revutil")
    return fr.rounded(drift.psi_continuous(drift.psi_baseline(ref, cols), cur, cols))


def _psi_cat(names):
    longs = " union all ".join(f"select '{n}' as name, coalesce({n},'MISSING') as k, signing_date < timestamp '{SPLIT}' as ref from decided" for n in names)
    return f"""cv as ({longs}),
cp as (select name, k, sum(ref::int)/max(tr)+1e-6 as r, sum((not ref)::int)/max(tc)+1e-6 as q from (select *, sum(ref::int) over (partition by name) as tr, sum((not ref)::int) over (partition by name) as tc from cv) t group by name, k),
pc as (select name, sum((q-r)*ln(q/r)) as psi from cp group by name)"""


@query("psi_categories", sql("select name, round(psi,6) as psi from pc", "decided", plus=_psi_cat(("grade", "qi", "partner"))))
def psi_categories(spark, sf):
    ref, cur = _split(spark, sf)
    cols = ("grade", "qi", "partner")
    return fr.rounded(drift.psi_categorical(drift.category_baseline(ref, cols), cur, cols).select("name", "psi"))


_LEVEL = "case when psi>0.25 then 'CRITICAL' when psi>0.10 then 'WARNING' else 'STABLE' end as level"


@query("feature_psi", sql(f"select name, round(psi,6) as psi, {_LEVEL} from (select name, psi from ps union all select name, psi from pc) t", "decided", plus=_psi_cont(("fico", "d30", "revutil")) + ",\n" + _psi_cat(("qi", "partner"))))
def feature_psi(spark, sf):
    return fr.rounded(drift.feature_psi(*_split(spark, sf)))


_PERIOD = f"case when signing_date < timestamp '{SPLIT}' then 'reference' else 'current' end"


@query("auc_decay", sql("""select name, round(ra,6) as reference_auc, round(ca,6) as current_auc, round(ca-ra,6) as delta, case when ra-ca>=0.05 then 'CRITICAL' when ra-ca>=0.02 then 'WARNING' else 'STABLE' end as level
 from (select name, max(case when g='reference' then auc end) as ra, max(case when g='current' then auc end) as ca from rk group by name) t""", "decided", plus=_rank_sql(("pd", "fraud_score", "woe_pd", "rule_pd", "xgb_pd"), by=_PERIOD)))
def auc_decay(spark, sf):
    both = drift.with_period(fr.scored_table(spark, sf), SPLIT)
    return fr.rounded(drift.auc_decay(both, ["pd", "fraud_score", "woe_pd", "rule_pd", "xgb_pd"]))


_GRADES = "(values ('A'),('B'),('C'),('D'),('E'),('F'),('G')) g(grade)"
_GC = f"gc as (select g.grade, count(case when signing_date < timestamp '{SPLIT}' then 1 end) as nr, count(case when signing_date >= timestamp '{SPLIT}' then 1 end) as nc, avg(case when signing_date < timestamp '{SPLIT}' then is_bad end) as rr, avg(case when signing_date >= timestamp '{SPLIT}' then is_bad end) as rc from {_GRADES} left join decided d on d.grade=g.grade group by g.grade)"


@query("grade_shift", sql("select grade, nr as n_ref, round(nr/(select sum(nr) from gc),4) as share_ref, round(rr,4) as rate_ref, nc as n_cur, round(nc/(select sum(nc) from gc),4) as share_cur, round(rc,4) as rate_cur, case when nc>0 then round(round(rc,4)/greatest(coalesce(round(rr,4),0),0.001),4) end as ratio from gc", "decided", plus=_GC))
def grade_shift(spark, sf):
    return drift.grade_shift(*_split(spark, sf), fr.LETTERS)


@query("grade_chi2", sql("""select chi2, dof, n_current, round(p,4) as p_value, case when p<0.01 then 'RED' when p<0.05 then 'WARNING' else 'STABLE' end as level from (select *, exp(-v/2)*(1+v/2+v*v/8) as p from (select sum(pow(nc-x,2)/x) as v, round(sum(pow(nc-x,2)/x),4) as chi2, 6 as dof, sum(nc)::bigint as n_current from (select nc, e*sum(nc) over ()/sum(e) over () as x from (select nc, greatest(round(nr/(select sum(nr) from gc),4)*(select sum(nc) from gc),1) as e from gc) t) t) t) t""", "decided", plus=_GC))
def grade_chi2(spark, sf):
    return fr.rounded(drift.grade_chi2(*_split(spark, sf), fr.LETTERS), 4)


_RUN_SQL = """select 'score_psi' as part, name, round(psi,6) as value from ps where name in ('fraud_score','pd') union all select 'score_psi', name, round(psi,6) from pc where name='grade'
 union all select 'feature_psi', name, round(psi,6) from ps where name not in ('fraud_score','pd') union all select 'feature_psi', name, round(psi,6) from pc where name<>'grade'
 union all select 'auc', name, round(max(case when g='current' then auc end)-max(case when g='reference' then auc end),6) from rk group by name
 union all select 'grade_shift', grade, case when nc>0 then round(round(rc,4)/greatest(coalesce(round(rr,4),0),0.001),4) end from gc
 union all select 'grade_chi2', 'chi2', round(sum(pow(nc-x,2)/x),4) from (select nc, e*sum(nc) over ()/sum(e) over () as x from (select nc, greatest(round(nr/(select sum(nr) from gc),4)*(select sum(nc) from gc),1) as e from gc) t) t"""
_RUN_PLUS = ",\n".join((_psi_cont(("fraud_score", "pd", "fico", "d30", "revutil")), _psi_cat(("grade", "qi", "partner")), _rank_sql(("pd", "fraud_score", "woe_pd", "rule_pd", "xgb_pd"), by=_PERIOD), _GC))


def _run_values(parts):
    part = lambda k, name, value, digits: parts[k].select(F.lit(k).alias("part"), name.alias("name"), F.round(value, digits).alias("value"))
    return (part("score_psi", c("name"), c("psi"), 6).unionByName(part("feature_psi", c("name"), c("psi"), 6)).unionByName(part("auc", c("name"), c("delta"), 6))
            .unionByName(part("grade_shift", c("grade"), c("ratio"), 4)).unionByName(part("grade_chi2", F.lit("chi2"), c("chi2"), 4)))


@query("stored_baseline", sql(_RUN_SQL, "decided", plus=_RUN_PLUS))
def stored_baseline(spark, sf):
    """The reference is captured in three periods, appended and summed; the run reads these counts and the current rows only."""
    ref, cur = _split(spark, sf)
    root = scratch_path(spark, "baseline")
    log = AppendLog(spark, root)
    year = F.year("signing_date")
    for i, part in enumerate((ref.where(year < 1995), ref.where((year >= 1995) & (year < 1998)), ref.where(year >= 1998))):
        log.append(baseline.capture(part), f"{root}/counts", i)
    return _run_values(baseline.drift_from_baseline(baseline.together(log.read(f"{root}/counts")), cur, fr.LETTERS))


@query("drift_run", sql(_RUN_SQL, "decided", plus=_RUN_PLUS))
def drift_run(spark, sf):
    ref, cur = _split(spark, sf)
    return _run_values(monitoring.drift_run(ref, cur, SPLIT, fr.LETTERS))


@query("calibration_drift", sql("""select decile, p as predicted_mean, a as actual_rate, n, n_bad, r as act_over_pred, case when r<0.6 or r>1.5 then 'CRITICAL' when r<0.8 or r>1.2 then 'WARNING' else 'STABLE' end as level from (
 select decile, round(p,4) as p, round(a,4) as a, n, n_bad, round(case when round(p,4)>0.001 then round(a,4)/round(p,4) when a>0 then 'inf'::double else 1 end,4) as r from dc) t""", "decided", plus=_DEC))
def calibration_drift(spark, sf):
    return drift.calibration_drift(fr.scored_table(spark, sf))


@query("calibration_worst", sql("""select decile as worst_decile, r as worst_ratio, round((select avg(r) from cr),6) as mean_ratio, (select count(*) from cr where not (r<0.6 or r>1.5) and (r<0.8 or r>1.2)) as n_warning, (select count(*) from cr where r<0.6 or r>1.5) as n_critical
 from cr order by abs(r-1) desc, decile limit 1""", "decided", plus=_DEC + ", cr as (select decile, round(round(a,4)/round(p,4),4) as r from dc)"))
def calibration_worst(spark, sf):
    return fr.rounded(drift.calibration_summary(drift.calibration_drift(fr.scored_table(spark, sf))))


_OPS = f"""ops as (select avg(case when decision='approve' then 1e0 else 0 end) as approve_rate, avg(case when decision='review' then 1e0 else 0 end) as review_rate, avg(case when decision='decline' then 1e0 else 0 end) as decline_rate, avg(pd) as mean_pd from decided where signing_date >= timestamp '{SPLIT}'),
brk as (select metric, round(v,4) as value, case when v<coalesce(fl,-1) or v<cl or v>ch then 'CRITICAL' when v<wl or v>wh then 'WARNING' else 'OK' end as level,
 case when v<coalesce(fl,-1) then 'below floor' when v<cl or v>ch then 'outside critical range' when v<wl or v>wh then 'outside warning range' else '' end as note
 from (select m.*, case m.metric when 'approve_rate' then approve_rate when 'review_rate' then review_rate when 'decline_rate' then decline_rate else mean_pd end as v from ops,
 (values ('approve_rate',0.35,0.75,0.10,0.85,0.10),('review_rate',0.20,0.65,0.10,0.80,null),('decline_rate',0.01,0.15,0.0,0.25,null),('mean_pd',0.03,0.20,0.01,0.30,null)) m(metric,wl,wh,cl,ch,fl)) t)"""


@query("operational_breakers", sql("select metric, value, level, note from brk", "decided", plus=_OPS))
def operational_breakers(spark, sf):
    return drift.breakers(drift.operational_metrics(_split(spark, sf)[1]))


_AL = _psi_cont(("fraud_score", "pd")) + ",\n" + _psi_cat(("grade",)) + ",\n" + _rank_sql(("pd", "fraud_score"), by=_PERIOD) + ",\n" + _OPS + f""",
cal as (select round(round(avg(pd)/greatest(avg(is_bad),0.001),4),4) as r from decided where signing_date >= timestamp '{SPLIT}'),
al as (select 'psi' as "check", name as "key", {_LEVEL} from (select name, psi from ps union all select name, psi from pc) t
 union all select 'auc', name, case when ra-ca>=0.05 then 'CRITICAL' when ra-ca>=0.02 then 'WARNING' else 'STABLE' end from (select name, max(case when g='reference' then auc end) as ra, max(case when g='current' then auc end) as ca from rk group by name) t
 union all select 'calibration','all', case when r<0.6 or r>1.5 then 'CRITICAL' when r<0.8 or r>1.2 then 'WARNING' else 'STABLE' end from cal
 union all select 'operations', metric, level from brk)"""


@query("drift_alerts", sql("select * from al where level in ('WARNING','CRITICAL')", "decided", plus=_AL))
def drift_alerts(spark, sf):
    return drift.score_table_drift(fr.scored_table(spark, sf), SPLIT)["alerts"]


@query("drift_status", sql("select cast(max(case level when 'CRITICAL' then 2 when 'WARNING' then 1 else 0 end) as integer) as exit_status, count(case when level in ('WARNING','CRITICAL') then 1 end) as n_alerts, case max(case level when 'CRITICAL' then 2 when 'WARNING' then 1 else 0 end) when 2 then 'CRITICAL' when 1 then 'WARNING' else 'GREEN' end as status from al", "decided", plus=_AL))
def drift_status(spark, sf):
    return drift.score_table_drift(fr.scored_table(spark, sf), SPLIT)["status"]


@query("monthly_grade_calibration", sql("select grade, round(avg(pd),4) as predicted, round(avg(is_bad),4) as actual, count(*) as n from decided where strftime(signing_date,'%Y-%m')='2000-05' group by grade", "decided"))
def monthly_grade_calibration(spark, sf):
    return drift.score_table_drift(fr.scored_table(spark, sf), SPLIT, "2000-05")["calibration_by_grade"]


_PH = """ph as (select count(*) as n_loans, count(case when risk_tier='red' then 1 end) as high_risk_alerts, count(case when risk_tier='yellow' then 1 end) as early_warning, round(avg(case when risk_tier='red' then 1e0 else 0 end),4) as red_pct, avg(case when risk_tier in ('orange','red') then 1e0 else 0 end) as orange_red_pct, round(avg(flag_count),2) as avg_flag_count, round(avg(default_probability),4) as avg_default_probability from paypd)"""


@query("payment_health", sql("""select n_loans, high_risk_alerts, early_warning, red_pct, round(orange_red_pct,6) as orange_red_pct, avg_flag_count, avg_default_probability, case when red_pct>0.10 then 'CRITICAL' when red_pct>0.05 then 'WARNING' else 'OK' end as red_level,
 case when orange_red_pct>0.15 then 'WARNING' else 'OK' end as orange_level, case when red_pct>0.10 then 'CRITICAL' when red_pct>0.05 or orange_red_pct>0.15 then 'WARNING' else 'GREEN' end as status from ph""", "paypd", plus=_PH))
def payment_health(spark, sf):
    return fr.rounded(drift.payment_health(_payment_pd(spark, sf)))


@query("combined_status", sql("select cast(max(s) as integer) as exit_status, count(case when s>0 then 1 end) as n_alerts, case max(s) when 2 then 'CRITICAL' when 1 then 'WARNING' else 'GREEN' end as status from (select case level when 'CRITICAL' then 2 when 'WARNING' then 1 else 0 end as s from al union all select case when red_pct>0.10 then 2 when red_pct>0.05 then 1 else 0 end from ph union all select case when orange_red_pct>0.15 then 1 else 0 end from ph) t", "decided", "paypd", plus=_AL + ",\n" + _PH))
def combined_status(spark, sf):
    return monitoring.combined_status(fr.scored_table(spark, sf), _payment_pd(spark, sf), SPLIT)


# --- review queue ---------------------------------------------------------------------
_RQ = """q0 as (select *, case when grade='E' or pd>=0.20 or fraud_score>=80 then 'urgent' when grade='D' or pd>=0.15 or fraud_score>=60 then 'high' when grade='C' or pd>=0.10 then 'medium' else 'low' end as review_tier,
 round(0.60e0*least(pd,1)+0.20e0*fraud_normalized+0.15e0*(case grade when 'A' then 0.1e0 when 'B' then 0.3e0 when 'C' then 0.5e0 when 'D' then 0.7e0 when 'E' then 0.9e0 when 'F' then 0.95e0 else 1.0e0 end)+0.05e0*(case when qi='MISSING' then 1e0 else 0 end),6) as composite_risk_score from decided where decision='review'),
q1 as (select *, case review_tier when 'urgent' then 0 when 'high' then 1 when 'medium' then 2 else 3 end as tord, case review_tier when 'urgent' then 10 when 'medium' then 20 else 15 end as estimated_review_time from q0),
q2 as (select *, row_number() over (order by tord, composite_risk_score desc, application_id) as review_priority from q1),
tot as (select (select count(*) from q2) as n, (select sum(is_bad) from q2) as qb, (select sum(is_bad) from decided) as pb)"""


_QUEUE = ("application_id", "decision", "is_bad", "grade", "pd", "fraud_score", "fraud_normalized", "fraud_decision", "qi", "fico", "partner")


def _queue(spark, sf, reasons=False):
    return review.prioritise(fr.scored_table(spark, sf).select(*_QUEUE), with_reasons=reasons)


def _unranked(spark, sf):
    return review.queued(fr.scored_table(spark, sf), with_reasons=False)


@query("review_priority", sql("select application_id, review_tier, composite_risk_score, estimated_review_time, review_priority from q2", "decided", plus=_RQ))
def review_priority(spark, sf):
    return _queue(spark, sf).select("application_id", "review_tier", "composite_risk_score", "estimated_review_time", "review_priority")


def _review_reason_sql() -> str:
    pct = "format('{:.1f}',pd*100)||'%)'"
    i = lambda e: f"cast(trunc({e}) as bigint)||')'"
    items = [
        f"case when pd>=0.25 then '1|Very high default probability ('||{pct} when pd>=0.15 then '2|High default probability ('||{pct} when pd>=0.10 then '4|Elevated default probability ('||{pct} end",
        "case when grade='E' then '1|Worst credit grade (E)' when grade='D' then '3|Poor credit grade (D)' when grade in ('F','G') then '2|Review-trigger grade ('||grade||')' end",
        f"case when fraud_score>=80 then '1|High fraud risk score ('||{i('fraud_score')} when fraud_score>=60 then '3|Elevated fraud risk score ('||{i('fraud_score')} when fraud_score>=40 then '5|Moderate fraud risk score ('||{i('fraud_score')} end",
        "case when qi='MISSING' then '2|Missing QI (industry classification unavailable)' end",
        f"case when fico<550 then '2|Very low FICO score ('||{i('fico')} when fico<600 then '4|Low FICO score ('||{i('fico')} when fico<650 then '6|Below-average FICO score ('||{i('fico')} end",
        "case when partner='PARTNER_B' then '5|PARTNER_B partner (higher historical risk)' end", "case when fraud_decision='review' then '3|Fraud gate flagged for review' end"]
    keyed = ", ".join(f"case when x{n} is not null then left(x{n},1)||'{n}'||substr(x{n},2) end" for n in range(len(items)))
    cols = ", ".join(f"{e} as x{n}" for n, e in enumerate(items))
    return f"""select application_id, coalesce(nullif(array_to_string(list_transform(list_sort(list_filter([{keyed}], lambda v: v is not null))[1:3], lambda v: substr(v,4)),';'),''),'Flagged by pipeline review rules') as reasons from (select application_id, {cols} from q2) t"""


@query("review_reasons", sql(_review_reason_sql(), "decided", plus=_RQ))
def review_reasons(spark, sf):
    return _queue(spark, sf, True).select("application_id", F.array_join("review_reasons", ";").alias("reasons"))


@query("review_tiers", sql("""select v.tord as tier_order, v.review_tier, coalesce(n,0) as n, coalesce(bads,0) as bads, round(coalesce(n,0)*100e0/(select n from tot),1) as pct, round(coalesce(bads*100e0/n,0),1) as bad_rate, round(coalesce(p,0),4) as avg_pd, round(coalesce(f,0),1) as avg_fraud_score, coalesce(m,0) as minutes, round(coalesce(m,0)/60e0,1) as hours
 from (values (0,'urgent'),(1,'high'),(2,'medium'),(3,'low')) v(tord,review_tier) left join (select review_tier, count(*) as n, cast(sum(is_bad) as bigint) as bads, avg(pd) as p, avg(fraud_score) as f, cast(sum(estimated_review_time) as bigint) as m from q2 group by 1) t on t.review_tier=v.review_tier""", "decided", plus=_RQ))
def review_tiers(spark, sf):
    return review.tier_breakdown(_unranked(spark, sf))


@query("review_grades", sql("select grade, count(*) as n, cast(sum(is_bad) as bigint) as bads, round(avg(is_bad)*100,1) as bad_rate from q2 group by grade", "decided", plus=_RQ))
def review_grades(spark, sf):
    return review.grade_breakdown(_unranked(spark, sf))


@query("capture_curve", sql("""select review_pct, loans_reviewed, defaults_captured, round(defaults_captured*100e0/qb,1) as capture_pct_of_review_bads, round(defaults_captured*100e0/pb,1) as capture_pct_of_all_bads from (
 select p as review_pct, cast(floor(n*p/100) as bigint) as loans_reviewed, (select count(*) from q2 where is_bad=1 and review_priority<=floor(n*p/100)) as defaults_captured, qb, pb from tot, (select cast(unnest(range(10,101,10)) as integer) as p) g) t""", "decided", plus=_RQ))
def capture_curve(spark, sf):
    return review.capture_curve(_unranked(spark, sf), fr.scored_table(spark, sf))


@query("review_cutoffs", sql("""select k as top_n, round(k*100e0/n,1) as pct_of_queue, b as bads_caught, round(b*100e0/qb,1) as capture_rate_review, round(b*100e0/pb,1) as capture_rate_all, round(b*100e0/k,1) as precision, round((k-b)*100e0/k,1) as false_positive_rate, cast(ceil(k/20e0) as bigint) as days_at_capacity from (
 select k, (select count(*) from q2 where is_bad=1 and review_priority<=k) as b, n, qb, pb from tot, (select distinct least(unnest([10,25,50,100,200,500,1000,2000,3000,1000000000]), (select n from tot)) as k) g) t""", "decided", plus=_RQ))
def review_cutoffs(spark, sf):
    return review.cutoff_table(_unranked(spark, sf), fr.scored_table(spark, sf))


_TP = """tp0 as (select review_tier as tier, tord, count(*) as loans, cast(sum(is_bad) as bigint) as defaults, round(avg(is_bad)*100,1) as bad_rate, cast(ceil(count(*)/20e0) as bigint) as days_needed from q2 group by 1,2),
tp1 as (select *, cast(sum(loans) over w as bigint) as cumulative_loans, cast(sum(defaults) over w as bigint) as cumulative_defaults, cast(sum(days_needed) over w as bigint) as cumulative_days from tp0 window w as (order by tord)),
tp2 as (select *, case when (tier in ('urgent','high') or bad_rate/100>=0.092) and cumulative_days<=90 then 1 else 0 end as r from tp1),
tp3 as (select *, case when (select sum(r) from tp2)=0 and tord=(select min(tord) from tp2) then 1 else r end as recommended from tp2)"""


@query("tier_plan", sql("select tier, loans, defaults, bad_rate, days_needed, cumulative_loans, cumulative_defaults, cumulative_days, round(cumulative_defaults*100e0/qb,1) as cumulative_capture_of_review_bads, round(cumulative_defaults*100e0/pb,1) as cumulative_capture_of_all_bads, recommended from tp3, tot", "decided", plus=_RQ + ",\n" + _TP))
def tier_plan(spark, sf):
    return review.tier_plan(_unranked(spark, sf), fr.scored_table(spark, sf))


@query("capacity_plan", sql("""select t as recommended_tiers, l as loans_to_review, d as expected_defaults_caught, n as total_in_queue, cast(ceil(l/20e0) as bigint) as days_to_clear_queue, cast(ceil(n/20e0) as bigint) as days_to_clear_full_queue,
 round(d*100e0/qb,1) as expected_default_capture_rate, round(d*100e0/pb,1) as expected_all_bads_capture_rate, round((l-d)*100e0/l,1) as expected_false_positive_rate, round(d*100e0/l,1) as expected_precision from tot,
 (select string_agg(tier,'|' order by tord) as t, max(cumulative_loans) as l, max(cumulative_defaults) as d from tp3 where recommended=1) x""", "decided", plus=_RQ + ",\n" + _TP))
def capacity_plan(spark, sf):
    return review.capacity_plan(_queue(spark, sf), fr.scored_table(spark, sf))


# --- survival tables ------------------------------------------------------------------
_KM = f"""sv as (select date_diff('day',cast(signing_date as date),date '{AS_OF}') as t, is_bad as e, case when pd<=q[1] then 'low_risk' when pd<=q[2] then 'medium_risk' else 'high_risk' end as tier
  from decided, (select quantile_cont(pd,[0.33,0.66]) as q from decided) z where date_diff('day',cast(signing_date as date),date '{AS_OF}')>0),
kd as (select tier, t, count(*) as n, sum(e) as d, sum(count(*)) over (partition by tier order by t desc) as r from sv group by tier, t),
ks as (select *, case when max(case when d=r then 1 else 0 end) over w = 1 then 0e0 else exp(sum(coalesce(ln(nullif(1-d/r,0)),0)) over w) end as s from kd window w as (partition by tier order by t))"""


def _survival(spark, sf):
    df = labels.with_duration(fr.scored_table(spark, sf), AS_OF)
    return survival.tier_by_percentile(df, "pd", 0.33, 0.66, ("low_risk", "medium_risk", "high_risk"), True, "tier").where("duration_days > 0")


@query("kaplan_meier", sql("select tier, t::bigint as duration, n, d::bigint as events, r::bigint as at_risk, round(s,6) as survival from ks", "decided", plus=_KM))
def kaplan_meier(spark, sf):
    t = survival.life_table(_survival(spark, sf), ["tier"])
    return fr.rounded(t.select("tier", c("duration").cast("bigint").alias("duration"), "n", "events", "at_risk", "survival"))


@query("survival_by_tier", sql("select tier, sum(n)::bigint as n, sum(d)::bigint as events, " + ", ".join(f"round(coalesce(arg_max(case when t<={d} then s end, case when t<={d} then t end),1),6) as survival_{m}mo" for m, d in zip(K.HORIZON_MONTHS, K.HORIZON_DAYS)) + " from ks group by tier", "decided", plus=_KM))
def survival_by_tier(spark, sf):
    t = survival.life_table(_survival(spark, sf), ["tier"])
    return fr.rounded(survival.survival_at(t, by=["tier"]))

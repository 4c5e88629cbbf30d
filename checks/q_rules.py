"""Rule engines, grading, decisions, reasons, WoE."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.operators import decisions, grading, models, rules, woe
from creditloom.operators.metrics import with_quantile_bin
from creditloom.operators.models import LogitModel
from creditloom.plans.scoring import score_six_rules
from creditloom.sources import fixtures as fx

from . import frames as fr
from .base_sql import SPLIT, sql
from .registry import query, r6

c = F.col


@query("points_engine", sql("select application_id, c1 as pts_business, c3 as pts_financial, c4 as pts_bureau, c5 as pts_coverage, c6 as pts_interaction, c7 as pts_entity, fraud_score, fraud_normalized, fraud_decision from pts", "pts"))
def points_engine(spark, sf):
    df = rules.points_engine(fr.with_lookup(fx.identity(fr.with_history(spark, sf))), with_reasons=False)
    return df.select("application_id", *[f"pts_{k}" for k in K.POINT_CAPS if k != "identity"], "fraud_score", "fraud_normalized", "fraud_decision")


@query("points_profiles", sql("""select p as profile, case when base_score>=hi then 'decline' when base_score>=lo then 'review' else 'pass' end as decision, count(*) as n
 from pts, (values ('conservative',20,55),('moderate',25,70),('aggressive',35,80)) v(p,lo,hi) group by all""", "pts"))
def points_profiles(spark, sf):
    scored = rules.points_engine(fx.identity(fr.scope(spark, sf)), with_reasons=False).groupBy("fraud_score").agg(F.count("*").alias("n"))
    out = None
    for p in K.POINT_PROFILES:
        lo, hi = rules.point_thresholds(p)
        t = scored.groupBy(F.lit(p).alias("profile"), F.when(c("fraud_score") >= hi, "decline").when(c("fraud_score") >= lo, "review").otherwise("pass").alias("decision")).agg(F.sum("n").alias("n"))
        out = t if out is None else out.unionByName(t)
    return out


def _rule_texts() -> str:
    """The reason list in SQL: running caps written out rule by rule."""
    def block(cap, items):
        out, before = [], "0"
        for flag, pts, text in items:
            after = f"{before}+{pts}"
            out.append(f"case when {flag}>0 and least({cap},{after})-least({cap},{before})>0 then {text}||' (+'||(least({cap},{after})-least({cap},{before}))||')' end")
            before = after
        return out
    i = lambda e: f"cast(trunc({e}) as bigint)"
    money = lambda e: f"format('${{:,}}', cast(round_even({e},0) as bigint))"
    qi_text = ("case when pp='PARTNER_A' then 'MISSING_QI_PARTNER_A: Missing QI + PARTNER_A partner' when ff<600 then 'MISSING_QI_LOW_FICO: Missing QI + FICO<600' "
               "when ff<700 then 'MISSING_QI_MID_FICO: Missing QI + FICO 600-699' else 'MISSING_QI_HIGH_FICO: Missing QI + FICO 700+' end")
    parts = block(30, [("a1", "a1", qi_text), ("a2", "a2", f"'GIACT bankruptcy count='||{i('giact_bankruptcy_count')}")])
    parts += block(35, [
        ("b1", "b1", f"case when ff<550 then 'FICO < 550 ('||{i('ff')}||')' else 'FICO 550-600 ('||{i('ff')}||')' end"),
        ("b2", "b2", f"'Negative bank balance='||{money('plaid_balance')}"), ("b3", "b3", f"'High NSFs='||{i('plaid_recentNSFs')}"),
        ("b4", "b4", f"'High past due='||{money('fpd')}"), ("b5", "b5", f"'Extended negative balance history ('||{i('negative_balance_days_90d')}||' days in 90d)'")])
    parts += block(25, [
        ("d1", "d1", f"'Severe delinquencies (60d+)='||{i('fd60')}"), ("d2", "d2", f"'High inquiries (6mo)='||{i('finq')}"),
        ("d3", "d3", f"'Zero/minimal tradelines='||{i('ftl')}"), ("d4", "d4", "'High delinquency rate='||format('{:.1f}',fdr*100)||'%'")])
    parts += ["case when np=0 then 'All providers missing (+15)' when np=1 then 'Minimal provider coverage (1/4) (+8)' end",
              "case when np>1 and plm then 'Plaid missing (+3)' end", "case when np>1 and prm then 'Prove missing (+3)' end"]
    parts += block(20, [
        ("e1", "e1", f"'INTERACTION_QI_LOW_FICO: Missing QI + FICO<600 ('||{i('ff')}||')'"),
        ("e2", "e2", f"'INTERACTION_PARTNER_A_QI: PARTNER_A + Missing QI + low FICO ('||{i('ff')}||')'"),
        ("e3", "e3", f"'PARTNER_B + Low FICO ('||{i('ff')}||')'"), ("e4", "e4", "'Bureau stress ('||cs||')'"),
        ("e5", "e5", "'Provider disagreement ('||contra||' contradictions)'")])
    parts += block(40, [("g1", "g1", "'Prior default by connected entity'"), ("g2", "g2", "'Multiple connected entities ('||lu_conn||')'"),
                        ("g3", "g3", "'Cross-entity borrower'")])
    return ", ".join(parts)


@query("point_reasons", sql(f"select application_id, concat_ws('|', {_rule_texts()}) as reasons from pts", "pts"))
def point_reasons(spark, sf):
    df = rules.points_engine(fr.with_lookup(fx.identity(fr.with_history(spark, sf))))
    return df.select("application_id", F.array_join("fraud_reasons", "|").alias("reasons"))


@query("hard_rules", sql("select application_id, fraud_decision, fraud_rules_triggered from six", "six"))
def hard_rules(spark, sf):
    df = fr.with_history(spark, sf).withColumn("lu_connected_loans", c("prior_loans_ssn"))
    return rules.hard_rules(df).select("application_id", "fraud_decision", "fraud_rules_triggered")


@query("rule_grades", sql("select application_id, s_fico as fico_score, s_d30 as d30_score, s_d60 as d60_score, s_inq as inq6_score, s_rev as revutil_score, s_tl as tl_total_score, s_cr as crhist_score, s_mo as mopmt_score from rulec", "rulec"))
def rule_grades(spark, sf):
    df = rules.rule_grades(fr.scope(spark, sf))
    return df.select("application_id", *[f"{k}_score" for k in ("fico", "d30", "d60", "inq6", "revutil", "tl_total", "crhist", "mopmt")])


@query("rule_composite", sql(f"select application_id, {r6('rule_score')} from rulec", "rulec"))
def rule_composite(spark, sf):
    return fr.rounded(rules.rule_composite(fr.with_history(spark, sf)).select("application_id", "rule_score"))


@query("blended_pd", sql("select application_id, woe_pd, rule_pd, xgb_pd, pd0 as pd_before_segment, pd, default_score from sc", "sc"))
def blended_pd(spark, sf):
    return fr.pd_scored(spark, sf).select("application_id", "woe_pd", "rule_pd", "xgb_pd", "pd_before_segment", "pd", "default_score")


@query("quantile_bins", sql("""select application_id, cast((fico>e[2])::int+(fico>e[3])::int+(fico>e[4])::int as double) as fico_bin from scope, (select quantile_cont(fico,[0,0.25,0.5,0.75,1]) as e from scope) q""", "scope"))
def quantile_bins(spark, sf):
    return with_quantile_bin(fr.scope(spark, sf), "fico", 4, "fico_bin").select("application_id", c("fico_bin").cast("double").alias("fico_bin"))


_QC = ("fico", "revutil", "mopmt", "tl_total")


@query("exact_quantiles", sql(" union all ".join(
    f"select '{k}' as name, {', '.join(f'round(quantile_cont({k},{i}/6),6) as q{i}' for i in range(7))} from scope" for k in _QC), "scope"))
def exact_quantiles(spark, sf):
    from creditloom.operators.prefix import quantiles
    q = quantiles(fr.scope(spark, sf), _QC, [i / 6 for i in range(7)])
    return fr.rounded(q.select("name", *[c("q")[i].alias(f"q{i}") for i in range(7)]))


_WOE_FEATURES = ("fico", "d30", "d60", "inq6", "revutil", "pastdue", "instbal", "revbal", "tl_total", "tl_paid", "tl_delin", "mopmt", "crhist", "qi_encoded", "fico_qi_interaction",
                 "paid_ratio", "delin_rate", "bureau_health", "cash_stress", "is_repeat", "has_prior_bad")


def _woe_sql(tail: str) -> str:
    longs = " union all ".join(f"select application_id, is_bad, '{f}' as name, cast({f} as double) as value from sfeat where signing_date < timestamp '{SPLIT}'" for f in _WOE_FEATURES)
    edges = "[0,570,600,620,650,670,700,740,800,900]"
    return sql(tail, "sfeat", plus=f"""lv as ({longs}),
sp as (select name, case when name='fico' then 'expert' when count(distinct value)<=10 then 'category' else 'quantile' end as kind,
  case when name='fico' then {edges} else list_sort(list_distinct(quantile_cont(value,[0,1/6,2/6,3/6,4/6,5/6,1]))) end as edges from lv where value is not null group by name),
bn as (select application_id, is_bad, lv.name, kind, value, case when value is null then 'null' when kind='category' then 'v'||cast(value as varchar)
   else 'b'||len(list_filter(edges[2:len(edges)-1], lambda e: e < value)) end as bin from lv join sp on lv.name=sp.name),
ct as (select name, kind, bin, cast(sum(1-is_bad) as bigint) as n_good, cast(sum(is_bad) as bigint) as n_bad from bn group by name, kind, bin),
tb as (select *, ln(pg/pb) as woe, (pg-pb)*ln(pg/pb) as iv from (select *, greatest(cast(n_good as double),0.5)/sum(n_good) over (partition by name) as pg, greatest(cast(n_bad as double),0.5)/sum(n_bad) over (partition by name) as pb from ct) t)""")


def _train(spark, sf):
    from creditloom.operators.labels import temporal_split
    return temporal_split(fr.feature_table(spark, sf), SPLIT)[0]


@query("woe_table", _woe_sql(f"select name, kind, bin, n_good, n_bad, {r6('woe', 'iv')} from tb"))
def woe_table(spark, sf):
    counts = woe.value_counts(_train(spark, sf), _WOE_FEATURES)
    return fr.rounded(woe.woe_table(counts, woe.bin_spec(counts)))


@query("woe_selection", _woe_sql("select name, round(iv,6) as iv, cast(row_number() over (order by iv desc, name) as integer) as rank from (select name, sum(iv) as iv from tb group by name) t where iv>=0.02 order by iv desc limit 15"))
def woe_selection(spark, sf):
    counts = woe.value_counts(_train(spark, sf), _WOE_FEATURES)
    iv = woe.information_values(woe.woe_table(counts, woe.bin_spec(counts)))
    return fr.rounded(woe.select_features(iv))


@query("woe_transform", _woe_sql("select application_id, name, round(woe,6) as woe from bn join tb using (name, kind, bin) where name in (select name from (select name, sum(iv) as iv from tb group by name) t where iv>=0.02 order by iv desc, name limit 15)"))
def woe_transform(spark, sf):
    """The selected features of every training row as weights of evidence, a row for each feature."""
    df = _train(spark, sf)
    m = woe.fit_woe(df)
    t = m.transform(df)
    return fr.rounded(t.select("application_id", F.inline(F.array(*[F.struct(F.lit(f).alias("name"), c(f + "_woe").alias("woe")) for f in m.features]))))


# --- grading ---------------------------------------------------------------------
@query("grade_schemes", sql(" union all ".join(
    f"select '{n}' as scheme, unnest({[q / 100 for q in K.GRADE_SCHEMES[n][2]]}) as q, round(unnest(quantile_cont(pd,{[q / 100 for q in K.GRADE_SCHEMES[n][2]]})),6) as boundary from sc" for n in ("5grade", "6grade")), "sc"))
def grade_schemes(spark, sf):
    df = fr.scored_table(spark, sf)
    rows = []
    for n in ("5grade", "6grade"):
        s = grading.fit_scheme(df, scheme=n)
        rows += [(n, q / 100, b) for q, b in zip(K.GRADE_SCHEMES[n][2], s.boundaries)]
    return fr.rounded(spark.createDataFrame(rows, "scheme string, q double, boundary double"))


@query("grade_assignment", sql("select application_id, grade, round(case grade_index when 0 then 0 when 1 then 0.04 when 2 then 0.08 when 3 then 0.12 when 4 then 0.18 when 5 then 0.25 else 0.35 end,6)::double as pd_range_low, (case grade_index when 0 then 0.04 when 1 then 0.08 when 2 then 0.12 when 3 then 0.18 when 4 then 0.25 when 5 then 0.35 else 1.0 end)::double as pd_range_high, pricing_tier, grade_index from graded", "graded"))
def grade_assignment(spark, sf):
    return grading.grade(fr.pd_scored(spark, sf), fr.SEVEN).select("application_id", "grade", "pd_range_low", "pd_range_high", "pricing_tier", "grade_index")


@query("boundary_iv", sql("""select round(sum((g-b)*ln(g/b)),6) as iv from (select greatest(cast(sum(1-is_bad) as double),0.5)/(select sum(1-is_bad) from sc) as g, greatest(cast(sum(is_bad) as double),0.5)/(select sum(is_bad) from sc) as b
 from sc group by case when pd>=0.2 then 3 when pd>=0.12 then 2 when pd>=0.06 then 1 else 0 end) t""", "sc"))
def boundary_iv(spark, sf):
    return fr.rounded(grading.boundary_iv(fr.scored_table(spark, sf), (0.06, 0.12, 0.20)))


_IV_PART = "(greatest({g},0.5)/tg - greatest({b},0.5)/tb)*ln((greatest({g},0.5)/tg)/(greatest({b},0.5)/tb))"
_BEST_IV = f"""tot as (select cast(sum(1-is_bad) as double) as tg, cast(sum(is_bad) as double) as tb, min(pd) as lowest from sc),
cuts as (select v, row_number() over (order by v) as i from (select distinct unnest(quantile_cont(pd,{[i / 100 for i in range(1, 100)]})) as v from sc) q where v > (select lowest from tot)),
cum as (select i, v, cast(sum(1-is_bad) as double) as g, cast(sum(is_bad) as double) as b from cuts join sc on pd < v group by i, v),
head as (select i, v, {_IV_PART.format(g='g', b='b')} as p from cum, tot),
tail as (select i, {_IV_PART.format(g='tg-g', b='tb-b')} as p from cum, tot),
mid as (select x.i as i, y.i as j, {_IV_PART.format(g='y.g-x.g', b='y.b-x.b')} as p from cum x join cum y on y.i > x.i, tot),
best as (select h.i as a, m.j as b, n.j as c, o.j as d, h.p+m.p+n.p+o.p+t.p as iv from head h join mid m on m.i=h.i join mid n on n.i=m.j join mid o on o.i=n.j join tail t on t.i=o.j order by round(iv,12) desc, a, b, c, d limit 1),
bounds as (select iv, (select list(v order by i) from cum where i in (best.a,best.b,best.c,best.d)) as vs from best)"""


@query("optimal_iv_grades", sql("select chr(cast(65+len(list_filter(vs, lambda e: e <= pd)) as integer)) as grade, count(*) as n, round(avg(cast(is_bad as double)),6) as bad_rate, round(any_value(iv),6) as iv from sc, bounds group by 1", "sc", plus=_BEST_IV))
def optimal_iv_grades(spark, sf):
    df = fr.scored_table(spark, sf).select("pd", "is_bad")
    s = grading.fit_scheme(df, scheme="optimal_iv")
    return fr.rounded(grading.grade(df, s, partner=None).groupBy("grade").agg(F.count("*").alias("n"), F.avg(c("is_bad").cast("double")).alias("bad_rate"), F.lit(s.iv).alias("iv")))


@query("boundary_grades", sql("select application_id, case when fico is null then 'worst' when fico>=700 then 'worst' when fico>=600 then 'mid' else 'low' end as label from scope", "scope"))
def boundary_grades(spark, sf):
    return grading.boundary_grade(fr.scope(spark, sf), "fico", [700, 600], ["low", "mid", "worst"], "label").select("application_id", "label")


@query("fixed_grades", sql("select application_id, case when pd<0.06 then 'A' when pd<0.12 then 'B' when pd<0.20 then 'C' else 'D' end as grade from sc", "sc"))
def fixed_grades(spark, sf):
    return grading.fixed_grade(fr.pd_scored(spark, sf)).select("application_id", "grade")


# --- decisions ---------------------------------------------------------------------
@query("decision_cascade", sql("select application_id, d0 as decision from (select *, case when fraud_decision='decline' then 'decline' when fraud_decision='review' then 'review' when pd>=0.25 then 'decline' when pd>=0.15 then 'review' when grade in ('E','F','G') then 'review' else 'approve' end as d0 from graded) t", "graded"))
def decision_cascade(spark, sf):
    return decisions.cascade(fr.scored_table(spark, sf)).select("application_id", "decision")


@query("grade_e_treatment", sql("select application_id, decision, grade_e_action, case when grade_e_action='GRADE_E_REPRICING' then 1.55::double end as grade_e_repricing from decided", "decided"))
def grade_e_treatment(spark, sf):
    return fr.scored_table(spark, sf).select("application_id", "decision", "grade_e_action", "grade_e_repricing")


@query("review_optimisation", sql("select application_id, case when decision<>'review' then 'not_applicable' when pd>0.36 then 'auto_declined' when pd<0.06 then 'auto_approved' else 'unchanged' end as review_optimization, case when decision='review' and pd>0.36 then 'decline' when decision='review' and pd<0.06 then 'approve' else decision end as decision from decided", "decided"))
def review_optimisation(spark, sf):
    return decisions.review_optimisation(fr.scored_table(spark, sf)).select("application_id", "review_optimization", "decision")


def _combined(blend, w, limits):
    return f"""select application_id, round(s,6) as combined_score, b as fico_bucket, case when s >= case b when 'lt_600' then {limits[0]} when '600_650' then {limits[1]} when '650_700' then {limits[2]} else {limits[3]} end then 1 else 0 end as flagged
 from (select application_id, (woe_pd*{blend[0]}e0+rule_pd*{blend[1]}e0+xgb_pd*{blend[2]}e0)*{w[0]}e0+fraud_score/{w[2]}e0*{w[1]}e0 as s,
 case when coalesce(fico,650)<600 then 'lt_600' when coalesce(fico,650)<650 then '600_650' when coalesce(fico,650)<700 then '650_700' else 'gte_700' end as b from sc) t"""


@query("combined_score_first", sql(_combined((0.55, 0.10, 0.35), (0.75, 0.25, 145.0), (0.140, 0.080, 0.115, 0.140)), "sc"))
def combined_score_first(spark, sf):
    return fr.rounded(decisions.combined_flag(fr.scored_table(spark, sf), "first").select("application_id", "combined_score", "fico_bucket", "flagged"))


@query("combined_score_second", sql(_combined((0.45, 0.12, 0.43), (0.52, 0.48, 111.0), (0.300, 0.230, 0.200, 999)), "sc"))
def combined_score_second(spark, sf):
    return fr.rounded(decisions.combined_flag(fr.scored_table(spark, sf), "second").select("application_id", "combined_score", "fico_bucket", "flagged"))


# --- the short pipeline, end to end --------------------------------------------------
_SIX = """sixpd as (select *, round(1/(1+exp(-(-2.6e0+0.9e0*qi_missing+0.5e0*missing_qi_low_fico+0.25e0*has_severe_delin+0.4e0*coalesce(tl_delin/greatest(tl_total,1),0)))),6) as pd,
 case when pd<0.06 then 'A' when pd<0.12 then 'B' when pd<0.20 then 'C' else 'D' end as grade,
 case when fraud_decision='decline' then 'decline' when pd>0.25 then 'decline' when pd>0.15 then 'review' when grade='D' then 'review' when fraud_decision='review' then 'review' else 'approve' end as decision from six)"""


def _six_scored(spark, sf):
    df = fr.with_history(spark, sf).withColumn("lu_connected_loans", c("prior_loans_ssn"))
    return score_six_rules(df, lambda d: d.withColumn("pd", F.round(LogitModel(*fx.WOE_STATE).column(), 6)))


@query("six_rule_scores", sql("select application_id, pd, grade, decision, fraud_decision, fraud_rules_triggered from sixpd", "six", plus=_SIX))
def six_rule_scores(spark, sf):
    return _six_scored(spark, sf).select("application_id", "pd", "grade", "decision", "fraud_decision", "fraud_rules_triggered")


@query("six_rule_rates", sql("""select 'grade' as dim, grade as value, count(*) as n, cast(sum(is_bad) as bigint) as n_bad, round(avg(is_bad),6) as bad_rate, round(avg(pd),6) as mean_pd, round(count(*)/(select count(*) from sixpd),6) as pct from sixpd group by grade
 union all select 'decision', decision, count(*), cast(sum(is_bad) as bigint), round(avg(is_bad),6), round(avg(pd),6), round(count(*)/(select count(*) from sixpd),6) from sixpd group by decision""", "six", plus=_SIX))
def six_rule_rates(spark, sf):
    from creditloom.operators.summary import group_rates
    return fr.rounded(group_rates(_six_scored(spark, sf), ["grade", "decision"]))


@query("segment_multiplier", sql("""select n, round(act,6) as actual, round(pred,6) as predicted, round(raw,6) as raw_multiplier, round(k,6) as shrinkage, round(case when n<20 then 1 else least(greatest(1+k*(raw-1),1),3) end,6) as multiplier
 from (select *, act/greatest(pred,0.01) as raw, n/(n+60e0) as k from (select count(*) as n, avg(is_bad) as act, avg(pd0) as pred from sc where partner='PARTNER_B') t) t""", "sc"))
def segment_multiplier(spark, sf):
    df = fr.scored_table(spark, sf)
    t = models.segment_multiplier(df, c("partner") == "PARTNER_B", "pd_before_segment")
    return fr.rounded(t.select("n", "actual", "predicted", "raw_multiplier", "shrinkage", "multiplier"))


@query("segment_quintiles", sql("""select q as quintile, n_segment, n_other, round(rs,6) as rate_segment, round(ro,6) as rate_other, round(rs/greatest(ro,0.001),6) as ratio from (
 select cast((pd0>e[2])::int+(pd0>e[3])::int+(pd0>e[4])::int+(pd0>e[5])::int as integer) as q, count(case when partner='PARTNER_B' then 1 end) as n_segment, count(case when coalesce(partner,'')<>'PARTNER_B' then 1 end) as n_other,
 avg(case when partner='PARTNER_B' then is_bad end) as rs, coalesce(avg(case when coalesce(partner,'')<>'PARTNER_B' then is_bad end),0) as ro
 from sc, (select list_sort(list_distinct(quantile_cont(pd0,[0,0.2,0.4,0.6,0.8,1]))) as e from sc) q group by 1) t where n_segment>=3""", "sc"))
def segment_quintiles(spark, sf):
    return fr.rounded(models.segment_quintiles(fr.scored_table(spark, sf), c("partner") == "PARTNER_B", "pd_before_segment"))


@query("score_mapping", sql("select application_id, pd, default_score from sc", "sc"))
def score_mapping(spark, sf):
    df = fr.scored_table(spark, sf).drop("default_score")
    return df.withColumn("default_score", models.pd_to_score(c("pd"))).select("application_id", "pd", "default_score")



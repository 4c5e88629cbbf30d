"""Fitted models against the same fits written as SQL: Newton steps unrolled as common table expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import boosting, isotonic, labels, models, survival
from creditloom.operators.rules import rule_composite

from . import frames as fr
from .base_sql import AS_OF, SPLIT, sql
from .q_models import _survival_frame
from .registry import query

c = F.col
_SURVIVAL = f"""sv as (select cast(signing_date as date) as sd, cast(date_diff('day',cast(signing_date as date),date '{AS_OF}') as bigint) as t, is_bad as e, fico as f1, coalesce(inq6,0) as f2 from scope
 where signing_date < timestamp '{SPLIT}' and date_diff('day',cast(signing_date as date),date '{AS_OF}')>0 and fico is not null and tl_total is not null)"""


def _cox_newton(steps: int) -> str:
    """Cox coefficients of two features: Efron ties, ridge 0.1 a loan on standardised features."""
    parts = ["""mo as materialized (select count(*) as n, avg(f1) as m1, avg(f2) as m2, stddev_samp(f1) as s1, stddev_samp(f2) as s2 from sv)""",
             """z as materialized (select t, e, (f1-m1)/s1 as x1, (f2-m2)/s2 as x2 from sv, mo)""", """b0 as materialized (select 0e0 as b1, 0e0 as b2)"""]
    for k in range(steps):
        parts += [
            f"w{k} as (select t, e, x1, x2, exp(b1*x1+b2*x2) as w from z, b{k})",
            f"""d{k} as (select t, sum(e) as d, sum(e*x1) as g1, sum(e*x2) as g2, sum(w) as o, sum(w*x1) as o1, sum(w*x2) as o2, sum(w*x1*x1) as o11, sum(w*x1*x2) as o12, sum(w*x2*x2) as o22,
 sum(e*w) as e0, sum(e*w*x1) as e1, sum(e*w*x2) as e2, sum(e*w*x1*x1) as e11, sum(e*w*x1*x2) as e12, sum(e*w*x2*x2) as e22 from w{k} group by t)""",
            f"""r{k} as (select *, sum(o) over v as s, sum(o1) over v as s1, sum(o2) over v as s2, sum(o11) over v as s11, sum(o12) over v as s12, sum(o22) over v as s22 from d{k} window v as (order by t desc))""",
            f"""k{k} as (select *, j/cast(d as double) as f, s - f*e0 as den, (s1-f*e1)/den as a1, (s2-f*e2)/den as a2 from (select *, unnest(range(cast(d as bigint))) as j from r{k} where d>0) q)""",
            f"""n{k} as (select sum(a1) as a1, sum(a2) as a2, sum((s11-f*e11)/den-a1*a1) as h11, sum((s12-f*e12)/den-a1*a2) as h12, sum((s22-f*e22)/den-a2*a2) as h22 from k{k})""",
            f"""l{k} as (select (select sum(g1) from r{k})-a1-0.1e0*n*b1 as u1, (select sum(g2) from r{k})-a2-0.1e0*n*b2 as u2, h11+0.1e0*n as i11, h12 as i12, h22+0.1e0*n as i22, b1, b2 from n{k}, mo, b{k})""",
            f"b{k + 1} as materialized (select b1+(i22*u1-i12*u2)/(i11*i22-i12*i12) as b1, b2+(i11*u2-i12*u1)/(i11*i22-i12*i12) as b2 from l{k})"]
    return ",\n".join(parts)


@query("cox_coefficients", sql("""select 'fico' as feature, round(b1/s1,6) as coef from b7, mo union all select 'inq6', round(b2/s2,6) from b7, mo""", "scope", plus=_SURVIVAL + ",\n" + _cox_newton(7)))
def cox_coefficients(spark, sf):
    train, _ = labels.temporal_split(_survival_frame(spark, sf), SPLIT)
    m = survival.fit_cox(train, ["fico", "inq6"])
    return m.coefficients(spark).select("feature", F.round("coef", 6).alias("coef"))


@query("cox_score_equations", sql("""select feature, (select count(*) from sv) as n, 0e0 as residual from (values ('fico'),('d30'),('d60'),('inq6'),('revutil'),('pastdue'),('instbal'),('revbal'),('tl_total'),('tl_paid'),('tl_delin'),('mopmt'),('crhist'),
 ('qi_encoded'),('qi_missing'),('fico_qi_interaction'),('paid_ratio'),('delin_rate'),('delin_severity'),('bureau_health'),('cash_stress')) t(feature)""", "scope", plus=_SURVIVAL))
def cox_score_equations(spark, sf):
    """First-order conditions of the model that cox_horizons and cox_profiles use: the penalised score of every feature is 0."""
    train, _ = labels.temporal_split(_survival_frame(spark, sf), SPLIT)
    m = survival.fit_cox(train)
    n = train.agg(F.count("*")).scalar()
    return survival.score_equations(m, train).select("feature", n.alias("n"), (F.round("residual", 6) + 0.0).alias("residual"))


# --- logistic fits -------------------------------------------------------------------
def _logit_newton(steps: int, features: int) -> str:
    """Coefficients of models `m` (id, fold left out or -1, inverse penalty or 0) over cells `ce` (fold, x1, x2, n, bad), from 0."""
    parts = ["be0 as materialized (select id, 0e0 as b0, 0e0 as b1, 0e0 as b2 from m)"]
    two = features == 2
    for k in range(steps):
        parts += [
            f"""mu{k} as (select id, c, n, bad, x1, x2, b0, b1, b2, 1/(1+exp(-(b0+b1*x1+b2*x2))) as p from be{k} join m using (id) join ce on ce.fold<>m.fold)""",
            f"""su{k} as (select id, any_value(b0) as b0, any_value(b1) as b1, any_value(b2) as b2, any_value(case when c>0 then 1/c else 0 end) as r, sum(bad-n*p) as g0, sum((bad-n*p)*x1) as g1, sum((bad-n*p)*x2) as g2,
 sum(n*p*(1-p)) as h00, sum(n*p*(1-p)*x1) as h01, sum(n*p*(1-p)*x2) as h02, sum(n*p*(1-p)*x1*x1) as h11, sum(n*p*(1-p)*x1*x2) as h12, sum(n*p*(1-p)*x2*x2) as h22 from mu{k} group by id)""",
            f"""so{k} as (select id, b0, b1, b2, g0, g1-r*b1 as g1, g2-r*b2 as g2, h00, h01, {'h02' if two else '0e0'} as h02, h11+r as h11, {'h12' if two else '0e0'} as h12, {'h22+r' if two else '1e0'} as h22 from su{k})""",
            f"""co{k} as (select *, h11*h22-h12*h12 as c00, h02*h12-h01*h22 as c01, h01*h12-h02*h11 as c02, h00*h22-h02*h02 as c11, h01*h02-h00*h12 as c12, h00*h11-h01*h01 as c22, h00*c00+h01*c01+h02*c02 as det from so{k})""",
            f"""be{k + 1} as materialized (select id, b0+(c00*g0+c01*g1+c02*g2)/det as b0, b1+(c01*g0+c11*g1+c12*g2)/det as b1, b2+(c02*g0+c12*g1+c22*g2)/det as b2 from co{k})"""]
    return ",\n".join(parts)


_PENALTIES = "(0.001),(0.01),(0.1),(1.0),(10.0)"


@query("logit_grid", sql("""select c as c_value, round((select avg(auc) from au where au.c=m.c),6) as mean_auc, round(b0,6) as b0, round(b1,6) as b1, round(b2,6) as b2 from be12 join m using (id) where fold=-1""", "sc", plus=f"""
ce as materialized (select cast(application_id % 3 as integer) as fold, cast(qi_missing as double) as x1, coalesce(fico,650)/100 as x2, cast(count(*) as double) as n, cast(sum(is_bad) as double) as bad from sc group by 1,2,3),
m as materialized (select cast(row_number() over () as integer) as id, fold, c from (values (-1),(0),(1),(2)) f(fold), (values {_PENALTIES}) p(c)),
{_logit_newton(12, 2)},
he as (select m.c, ce.fold, b0+b1*x1+b2*x2 as s, sum(bad) as pos, sum(n-bad) as neg from be12 join m using (id) join ce on ce.fold=m.fold group by 1,2,3),
cu as (select *, sum(neg) over (partition by c, fold order by s) as cneg, sum(pos) over (partition by c, fold) as np, sum(neg) over (partition by c, fold) as nn from he),
au as (select c, fold, sum(pos*(cneg-neg)+0.5e0*pos*neg)/(max(np)*max(nn)) as auc from cu group by 1,2)"""))
def logit_grid(spark, sf):
    """All penalties and folds of a cross-validated logistic fit on two features."""
    df = fr.scored_table(spark, sf).select("is_bad", "qi_missing", (c("application_id") % 3).cast("int").alias("fold"), (F.coalesce("fico", F.lit(650.0)) / 100).alias("fico"))
    rows = [(v, auc, m.intercept, *m.coef.values()) for auc, v, m in models.logit_grid(df, ["qi_missing", "fico"], fold="fold")]
    return fr.rounded(spark.createDataFrame(rows, "c_value double, mean_auc double, b0 double, b1 double, b2 double"))


@query("rule_logit", sql("select round(b0,6) as intercept, round(b1,6) as slope from be14", "sc", plus=f"""
ce as materialized (select -2 as fold, rule_score as x1, 0e0 as x2, cast(count(*) as double) as n, cast(sum(is_bad) as double) as bad from sc where signing_date < timestamp '{SPLIT}' group by 2),
m as materialized (select 1 as id, -1 as fold, 1e0 as c),
{_logit_newton(14, 1)}"""))
def rule_logit(spark, sf):
    """Rule composite to PD, fitted on the training period."""
    train, _ = labels.temporal_split(rule_composite(fr.feature_table(spark, sf)), SPLIT)
    m = models.fit_rule_pd(train)
    return fr.rounded(spark.createDataFrame([(m.intercept, m.coef["rule_score"])], "intercept double, slope double"))


@query("isotonic_calibration", sql("""select s as score, round(y,6) as calibrated from (select i, s, max(low) as y from (select a.i as j, b.i as i, b.s, min((b.cp-a.cp+a.p)/(b.cn-a.cn+a.n)) over (partition by a.i order by b.i desc) as low from cu a join cu b on b.i>=a.i) t group by i, s) t""", "decided", plus=f"""
h as (select round(pd,3) as s, cast(sum(is_bad) as double) as p, cast(count(*) as double) as n from decided group by 1),
cu as materialized (select s, p, n, row_number() over w as i, sum(p) over w as cp, sum(n) over w as cn from h window w as (order by s))"""))
def isotonic_calibration(spark, sf):
    """Isotonic fit of the label on the PD, at every distinct score, against the max-min formula."""
    df = fr.scored_table(spark, sf).select("is_bad", F.round("pd", 3).alias("score"))
    m = isotonic.fit_isotonic(df, "score", n_slices=16)
    return m.apply(df.select("score").distinct(), "score", "y").select("score", F.round("y", 6).alias("calibrated"))


# --- boosted trees ---------------------------------------------------------------------
def _boosting(rounds: int, step: float, bins: int) -> str:
    """Two-level trees with signs on three features, from cells `bc` (b0, b1, b2, n, bad) and the first score in `ba`."""
    probs = [i / bins for i in range(1, bins)]
    names = ("x0", "x1", "x2")
    parts = [f"ed as materialized (select {', '.join(f'list_sort(list_distinct(quantile_cont({x},{probs}))) as q{i}, max({x}) as m{i}' for i, x in enumerate(names))} from bx)",
             "bb as materialized (select id, y, " + ", ".join(f"len(list_filter(q{i}, lambda e: e < m{i} and x{i} > e)) as b{i}" for i in range(3)) + " from bx, ed)",
             "ba as materialized (select ln(avg(y)/(1-avg(y))) as f0 from bb)",
             "f_0 as materialized (select b0, b1, b2, cast(count(*) as double) as n, cast(sum(y) as double) as bad, any_value(f0) as f from bb, ba group by 1,2,3)"]
    sign = "case j when 0 then -1 else 1 end"
    for r in range(rounds):
        def candidates(name, source, low, high):
            longs = " union all ".join(f"select node, {j} as j, b{j} as b, n, bad-n/(1+exp(-f)) as g, n*(1/(1+exp(-f)))*(1-1/(1+exp(-f))) as h from {source}" for j in range(3))
            return [f"hi_{name} as (select node, j, b, sum(n) as n, sum(g) as g, sum(h) as h from ({longs}) t group by 1,2,3)",
                    f"cu_{name} as (select node, j, b, sum(n) over w as nl, sum(g) over w as gl, sum(h) over w as hl, sum(n) over a as n, sum(g) over a as g, sum(h) over a as h from hi_{name} window w as (partition by node, j order by b), a as (partition by node, j))",
                    f"""ca_{name} as (select node, j, b, least(greatest(gl/(hl+1),{low}),{high}) as l, least(greatest((g-gl)/(h-hl+1),{low}),{high}) as r, gl*gl/(hl+1)+(g-gl)*(g-gl)/(h-hl+1)-g*g/(h+1) as gain, {sign} as s from cu_{name} where nl>=50 and n-nl>=50)""",
                    f"sp_{name} as materialized (select * from (select *, row_number() over (partition by node order by gain desc, j, b) as k from ca_{name} where gain>1e-12 and s*(r-l)>=0) t where k=1)"]
        lo = f"(case when node=1 then (select case when s<0 then (l+r)/2 else -1e300 end from sp_{r}a) else (select case when s>0 then (l+r)/2 else -1e300 end from sp_{r}a) end)"
        hi = f"(case when node=1 then (select case when s>0 then (l+r)/2 else 1e300 end from sp_{r}a) else (select case when s<0 then (l+r)/2 else 1e300 end from sp_{r}a) end)"
        goes = "case j when 0 then b0 when 1 then b1 else b2 end"
        parts += [f"n_{r}a as (select *, 0 as node from f_{r})", *candidates(f"{r}a", f"n_{r}a", "-1e300", "1e300"),
                  f"n_{r}b as materialized (select c.*, case when {goes} <= t.b then 1 else 2 end as node, case when {goes} <= t.b then t.l else t.r end as v from f_{r} c, sp_{r}a t)",
                  *candidates(f"{r}b", f"n_{r}b", lo, hi),
                  f"f_{r + 1} as materialized (select b0, b1, b2, n, bad, f+{step}*(case when t.node is null then v when {goes} <= t.b then t.l else t.r end) as f from n_{r}b c left join sp_{r}b t using (node))"]
    return ",\n".join(parts)


@query("monotone_trees", sql("select id as application_id, round(1/(1+exp(-f)),6) as pd from bb join f_3 using (b0, b1, b2)", "sc", plus=f"""
bx as materialized (select application_id as id, is_bad as y, coalesce(fico,650e0) as x0, coalesce(inq6,0e0) as x1, coalesce(revutil,50e0) as x2 from sc),
{_boosting(3, 0.3, 8)}"""))
def monotone_trees(spark, sf):
    """Three trees of two levels with signs on every feature."""
    df = fr.feature_table(spark, sf)
    m = boosting.fit(df, ("fico", "inq6", "revutil"), {"fico": 650.0, "inq6": 0.0, "revutil": 50.0}, rounds=3, depth=2, step=0.3, bins=8, signs={"fico": -1, "inq6": 1, "revutil": 1})
    return df.select("application_id", F.round(m.column(), 6).alias("pd"))

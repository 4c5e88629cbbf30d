"""Common table expressions of the oracle SQL (DuckDB dialect), written from the
definitions and not from the Spark code."""

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def sql(body: str, *needs: str, plus: str = "") -> str:
    """``body`` preceded by the CTEs it needs, in dependency order, and ``plus`` after them."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in CTES[n][0]:
            add(d)
        if n not in order:
            order.append(n)

    for n in needs:
        add(n)
    head = ",\n".join([f"{n} as materialized ({CTES[n][1]})" for n in order] + ([plus] if plus else []))
    return f"with {head}\n{body}" if order else body


BAD = "('CHARGE_OFF','DEFAULT','WORKOUT','PRE_DEFAULT','TECHNICAL_DEFAULT')"
GOOD = "('PAID_CLOSED','PAID','OVER_PAID')"
AS_OF, SPLIT, BANK_AS_OF = "2001-08-02", "2000-01-01", "2024-01-16"

cte("bureau", (), """
 select l_orderkey as loan_id, cast(count(*) as double) as n_lines,
  cast(sum(case when l_returnflag='R' then 1 else 0 end) as double) as d30,
  cast(sum(case when l_returnflag='R' and l_linestatus='F' then 1 else 0 end) as double) as d60,
  cast(sum(case when l_quantity>=40 then 1 else 0 end)*2 as double) as inq6,
  cast((cast(sum(cast(round(l_discount*100) as bigint)) as bigint)*2000+count(*))//(2*count(*)) as double)/100 as revutil,
  cast(sum(case when l_returnflag='R' and l_tax>=0.06 then l_quantity*25 else 0 end) as double) as pastdue,
  cast((cast(sum(cast(round(l_extendedprice*100) as bigint)) as bigint)+5)//10 as double)/100 as instbal,
  cast((cast(sum(case when l_linestatus='O' then cast(round(l_extendedprice*100) as bigint) else 0 end) as bigint)+5)//10 as double)/100 as revbal,
  cast(count(*)*3 as double) as tl_total, cast(sum(case when l_linestatus='F' then 3 else 0 end) as double) as tl_paid,
  cast(sum(case when l_returnflag='R' then 1 else 0 end) as double) as tl_delin,
  cast((cast(sum(cast(round(l_extendedprice*100) as bigint)*cast(round(l_tax*100) as bigint)) as bigint)+500)//1000 as double)/100 as mopmt, cast(sum(l_partkey)%6000 as double) as crhist
 from lineitem group by l_orderkey""")

cte("loans", ("bureau",), f"""
 select o_orderkey as loan_id, o_orderkey as application_id, o_custkey as shop_id,
  cast(floor(o_orderkey/3) as bigint) as ident_key, o_orderdate as signing_date, o_totalprice as principal,
  fico, qi, partner, c_acctbal as acct_balance, date_diff('day', cast(o_orderdate as date), date '{AS_OF}') as age, o_custkey % 1000 as revision_id,
  case when o_orderstatus='F' and (o_orderkey*7919)%100 < (850-coalesce(fico,600))/10 + case when qi='MISSING' then 12 else 0 end
         then case when o_orderkey%2=0 then 'CHARGE_OFF' else 'DEFAULT' end
       when o_orderstatus='F' then 'PAID_CLOSED'
       when o_orderstatus='P' and o_orderkey%7=0 then 'REJECTED'
       when o_orderstatus='P' then 'PAID' else 'NORMAL' end as loan_state,
  n_lines, d30, d60, inq6, revutil, pastdue, instbal, revbal, tl_total, tl_paid, tl_delin, mopmt, crhist
 from (select o.*, c.c_mktsegment, c.c_acctbal, b.*,
   case when o_orderkey%97=0 then null else cast(450+(o_custkey*37+o_orderkey*11)%400 as double) end as fico,
   case o_orderpriority when '1-URGENT' then 'HFHT' when '2-HIGH' then 'HFLT' when '3-MEDIUM' then 'LFHT'
        when '4-NOT SPECIFIED' then 'LFLT' else 'MISSING' end as qi,
   case c_mktsegment when 'AUTOMOBILE' then 'PARTNER_A' when 'BUILDING' then 'PARTNER_B' when 'FURNITURE' then 'PARTNER_C'
        when 'MACHINERY' then 'other' else null end as partner
   from orders o join customer c on o_custkey=c_custkey left join bureau b on o_orderkey=b.loan_id) t""")

cte("scope", ("loans",), f"""
 select *, case when loan_state in {BAD} then 1 else 0 end as is_bad from loans
 where loan_state not in ('REJECTED','CANCELED','PENDING_FUNDING','APPROVED')""")

cte("bfeat", ("scope",), """
 select *, case when zero_current_delin=1 and (coalesce(d30,0)>0 or coalesce(d60,0)>0) then 1 else 0 end as credit_recovery,
  coalesce(revbal,0)/total_balance as rev_share, coalesce(mopmt,0)/total_balance as payment_burden,
  zero_current_delin*0.4e0 + (1 - case when credit_activity>1 then 1 when credit_activity<0 then 0 else credit_activity end)*0.3e0 + paid_ratio*0.3e0 as bureau_health
 from (select *,
  case when tl_total is null then null else tl_paid/case when tl_total<1 then 1 else tl_total end end as pr0,
  least(greatest(pr0,0),1) * case when pr0 is null then null else 1 end as paid_ratio,
  case when tl_total is null then null else tl_delin/case when tl_total<1 then 1 else tl_total end end as dr0,
  least(greatest(dr0,0),1) * case when dr0 is null then null else 1 end as delin_rate,
  coalesce(d30,0)+2*coalesce(d60,0) as delin_severity,
  case when d60>0 then 1 else 0 end as has_severe_delin,
  case when coalesce(d30,0)+coalesce(d60,0)>0 then 1 else 0 end as any_delin,
  case when tl_delin=0 then 1 else 0 end as zero_current_delin,
  case when d60>0 then 2e0 when d30>0 then 1e0 else 0e0 end as delin_recency,
  pow((coalesce(revutil,50)-37.5e0)/37.5e0,2) as util_distance,
  case when revutil>80 then 1 else 0 end as high_util, case when revutil=0 then 1 else 0 end as zero_util,
  greatest(coalesce(instbal,0)+coalesce(revbal,0),1) as total_balance,
  case when inq6>=6 then 1 else 0 end as high_inq,
  case when tl_total is null then null else coalesce(inq6,0)/greatest(tl_total,1) end as credit_activity,
  case when crhist is null then null else coalesce(inq6,0)/greatest(crhist,1)*12 end as inq_intensity,
  (case when fico<580 then 2 else 0 end)+(case when pastdue>0 then 1 else 0 end)+(case when revutil>80 then 1 else 0 end) as cash_stress,
  case when fico<=0 or fico>900 or fico is null then 5e0 when fico<=500 then 1e0 when fico<=550 then 2e0 when fico<=580 then 3e0
   when fico<=600 then 4e0 when fico<=620 then 5e0 when fico<=650 then 6e0 when fico<=700 then 7e0 when fico<=750 then 8e0 else 9e0 end as fico_band
  from scope) t""")

cte("qfeat", ("bfeat",), """
 select *, fbin*5+qi_encoded as fico_qi_interaction,
  case when qi_missing=1 and fico<600 then 1 else 0 end as missing_qi_low_fico,
  fico*(1+partner_encoded*0.1e0) as fico_partner_risk,
  qi_encoded+(case when fico<600 then 3 else 0 end)+any_delin*2 as triple_risk
 from (select *,
  case qi when 'HFHT' then 0 when 'HFLT' then 1 when 'LFHT' then 2 when 'LFLT' then 3 else 4 end as qi_encoded,
  case when qi is null or qi='MISSING' then 1 else 0 end as qi_missing,
  case qi when 'HFHT' then 10 when 'LFHT' then 7 when 'HFLT' then 6 when 'LFLT' then 4 else 1 end as qi_quality,
  case upper(partner) when 'PARTNER_A' then 0 when 'PARTNER_C' then 1 when 'PARTNER_B' then 2 else 1 end as partner_encoded,
  case when qi='HFHT' and fico>=650 then 1 else 0 end as hfht_high_fico,
  case when fico is null or fico<=0 or fico>900 then 2e0 when fico<=550 then 0e0 when fico<=600 then 1e0 when fico<=650 then 2e0 when fico<=700 then 3e0 else 4e0 end as fbin
  from bfeat) t""")

# strictly earlier loans of the same identity, as a self join
cte("hist", ("scope",), f"""
 select *, case when prior_bad_ssn>0 then 1 else 0 end as has_prior_bad, case when prior_paid_ssn>0 then 1 else 0 end as has_prior_paid,
  case when prior_loans_ssn>0 then 1 else 0 end as is_repeat, case when prior_shops_ssn>1 then 1 else 0 end as is_cross_entity
 from (select a.application_id, a.signing_date, a.shop_id, a.ident_key, count(distinct b.loan_id) as prior_loans_ssn,
   cast(count(case when b.loan_state in {BAD} then 1 end) as bigint) as prior_bad_ssn,
   cast(count(case when b.loan_state in {GOOD} then 1 end) as bigint) as prior_paid_ssn,
   count(distinct b.shop_id) as prior_shops_ssn
  from scope a left join scope b on a.ident_key=b.ident_key and b.signing_date<a.signing_date and b.loan_id<>a.loan_id
  group by all) t""")

cte("ent", ("qfeat", "hist"), """
 select q.*, h.has_prior_bad, h.is_repeat, h.is_cross_entity, h.prior_loans_ssn, h.prior_shops_ssn, h.prior_bad_ssn, h.prior_paid_ssn,
  case when h.has_prior_bad=1 then 'prior_BAD' when h.is_repeat=1 then 'prior_PAID' else 'none' end as prior_history
 from qfeat q join hist h using (application_id)""")

cte("ident", ("scope",), """
 select *, case when loan_id%3<>0 then acct_balance end as plaid_balance,
  case when shop_id%4<>0 then cast((shop_id*13)%1000 as double) end as prove_phone_trust_score,
  case when shop_id%4<>0 then cast((shop_id*7)%100 as double) end as prove_name_score,
  case when shop_id%6<>0 then cast(shop_id%2 as double) end as prove_ssn_match,
  case when shop_id%5<>0 then cast(loan_id%2 as double) end as prove_verified,
  cast(loan_id%6 as double) as plaid_recentNSFs,
  case when shop_id%20=0 then 1e0 when shop_id%20<>10 then 0e0 end as giact_bankruptcy_count,
  case when loan_id%7<>0 then 'success' end as taktile_status,
  case loan_id%5 when 0 then 'High-Risk pattern' when 1 then 'Identity match: VERIFIED' when 2 then 'manual' when 3 then 'rejected by rule' end as taktile_output,
  case when loan_id%4<>0 then cast(loan_id%11 as double) end as negative_balance_days_90d
 from scope""")

# points engine
cte("fr", ("ident", "hist"), """
 select i.*, h.has_prior_bad as lu_bad, h.prior_shops_ssn as lu_conn, h.is_cross_entity as lu_cross,
  (qi is null or qi='MISSING') as qm, coalesce(fico,500) as ff, upper(partner) as pp,
  coalesce(pastdue,0) as fpd, coalesce(revutil,0) as fru, coalesce(d60,0) as fd60, coalesce(inq6,0) as finq, coalesce(tl_total,5) as ftl,
  (plaid_balance is null) as plm, (prove_phone_trust_score is null) as prm, (giact_bankruptcy_count is null) as gim,
  4 - (case when plm then 1 else 0 end) - (case when prm then 1 else 0 end) - (case when gim then 1 else 0 end) - (case when taktile_status is null then 1 else 0 end) as np,
  (case when ff<580 then 2 else 0 end)+(case when fpd>0 then 1 else 0 end)+(case when fru>80 then 1 else 0 end)+(case when fd60>0 then 1 else 0 end) as cs,
  case when not prm and coalesce(prove_verified,0)=1 and not plm and plaid_balance<0 then 1 else 0 end as contra,
  case when coalesce(tl_total,0)>0 and tl_delin is not null then tl_delin/greatest(tl_total,1) else 0 end as fdr
 from ident i join hist h using (application_id)""")

cte("pts", ("fr",), """
 select *, c1+c3+c4+c5+c6 as base_score, c1+c3+c4+c5+c6+c7 as fraud_score,
  case when fraud_score>=70 then 'decline' when fraud_score>=25 then 'review' else 'pass' end as fraud_decision,
  round(fraud_score/185e0,4) as fraud_normalized
 from (select *,
  case when qm and pp='PARTNER_A' then 30 when qm and ff<600 then 30 when qm and ff<700 then 20 when qm then 10 else 0 end as a1,
  case when giact_bankruptcy_count>0 then 15 else 0 end as a2, least(30,a1+a2) as c1,
  case when ff<550 then 15 when ff<600 then 8 else 0 end as b1, case when plaid_balance<0 then 15 else 0 end as b2,
  case when not plm and plaid_recentNSFs>=3 then 10 else 0 end as b3, case when fpd>500 then 8 else 0 end as b4,
  case when negative_balance_days_90d>5 then 8 else 0 end as b5, least(35,b1+b2+b3+b4+b5) as c3,
  case when fd60>0 then 10 else 0 end as d1, case when finq>=6 then 8 else 0 end as d2, case when ftl<=1 then 12 else 0 end as d3,
  case when fdr>0.5 then 10 else 0 end as d4, least(25,d1+d2+d3+d4) as c4,
  case when np=0 then 15 when np=1 then 8 else (case when plm then 3 else 0 end)+(case when prm then 3 else 0 end) end as c5,
  case when qm and ff<600 then 20 else 0 end as e1, case when qm and pp='PARTNER_A' and ff<650 then 8 else 0 end as e2,
  case when pp='PARTNER_B' and ff<600 then 12 else 0 end as e3, case when cs>=3 then 10 else 0 end as e4, case when contra>0 then 8 else 0 end as e5,
  least(20,e1+e2+e3+e4+e5) as c6,
  case when lu_bad=1 then 25 else 0 end as g1, case when lu_conn>=3 then 10 else 0 end as g2, case when lu_cross=1 then 5 else 0 end as g3,
  least(40,g1+g2+g3) as c7 from fr) t""")

# scorecard features, rule composite and the given-parameter PDs
cte("sfeat", ("ent",), """
 select e.* exclude (paid_ratio, delin_rate, bureau_health, cash_stress, qi_encoded, qi_missing, util_distance, any_delin, delin_severity, fico_qi_interaction),
  cast(qi_encoded as double) as qi_encoded, qi_missing, fico_qi_interaction,
  coalesce(d30,0)+2*coalesce(d60,0) as delin_severity,
  least(greatest(coalesce(tl_paid,0)/greatest(coalesce(tl_total,1),1),0),1) as paid_ratio,
  least(greatest(coalesce(tl_delin,0)/greatest(coalesce(tl_total,1),1),0),1) as delin_rate,
  (case when coalesce(tl_delin,0)=0 then 0.4e0 else 0e0 end) + least(greatest(coalesce(tl_paid,0)/greatest(coalesce(tl_total,1),1),0),1)*0.3e0
   + (1-least(greatest(coalesce(tl_delin,0)/greatest(coalesce(tl_total,1),1),0),1))*0.3e0 as bureau_health,
  cast((case when coalesce(fico,700)<580 then 2 else 0 end)+(case when pastdue>0 then 1 else 0 end)+(case when revutil>80 then 1 else 0 end)+(case when d60>0 then 1 else 0 end) as double) as cash_stress,
  abs(coalesce(revutil,50)-50) as util_distance, case when d30>0 or d60>0 then 1 else 0 end as any_delin
 from ent e""")

cte("rulec", ("sfeat",), """
 select *, 0.40e0*(0.4e0*s_fico+0.3e0*(0.6e0*s_d30+0.4e0*s_d60)+0.3e0*(0.5e0*s_tl+0.5e0*s_cr)) + 0.25e0*(0.65e0*s_qi+0.35e0*s_inq)
   + 0.25e0*(0.25e0*(s_rev+s_mo+s_tl+s_cr)) + 0.10e0*(0.5e0*s_rep+0.5e0*s_bad) as rule_score
 from (select *,
  case when fico is null then 7 when fico>=800 then 1 when fico>=770 then 2 when fico>=740 then 3 when fico>=700 then 4 when fico>=670 then 5 when fico>=650 then 6 when fico>=620 then 7 when fico>=600 then 8 when fico>=570 then 9 else 10 end as s_fico,
  case when d30 is null then 5 when d30>=12 then 6 when d30>=8 then 5 when d30>=4 then 4 when d30>=2 then 3 when d30>=1 then 2 else 1 end as s_d30,
  case when d60 is null then 5 when d60>=8 then 5 when d60>=4 then 4 when d60>=2 then 3 when d60>=1 then 2 else 1 end as s_d60,
  case when inq6 is null then 3 when inq6>=12 then 6 when inq6>=8 then 5 when inq6>=5 then 4 when inq6>=3 then 3 when inq6>=1 then 2 else 1 end as s_inq,
  case when revutil is null then 5 when revutil>=90 then 5 when revutil>=75 then 4 when revutil>=50 then 3 when revutil>=25 then 2 else 1 end as s_rev,
  case when tl_total is null then 8 when tl_total>=40 then 1 when tl_total>=25 then 2 when tl_total>=15 then 3 when tl_total>=8 then 4 when tl_total>=3 then 5 else 6 end as s_tl,
  case when crhist is null then 7 when crhist>=7300 then 1 when crhist>=5475 then 2 when crhist>=3650 then 3 when crhist>=1825 then 4 when crhist>=1095 then 5 when crhist>=365 then 6 else 7 end as s_cr,
  case when mopmt is null then 5 when mopmt>=2000 then 6 when mopmt>=1000 then 5 when mopmt>=500 then 4 when mopmt>=300 then 3 when mopmt>=100 then 2 else 1 end as s_mo,
  case when is_repeat>=1 then 1 else 2 end as s_rep,
  case when has_prior_bad=1 then 10 else 1 end as s_bad,
  case qi when 'HFHT' then 1 when 'HFLT' then 3 when 'LFHT' then 3 when 'LFLT' then 4 else 10 end as s_qi
  from sfeat) t""")

cte("sc", ("rulec", "pts"), """
 select *, cast(trunc(least(greatest(300+(1-pd)*550,300),850)) as integer) as default_score
 from (select * exclude (w, u, v, x, p0), round(w,6) as woe_pd, round(u,6) as rule_pd, round(v,6) as xgb_pd, round(p0,6) as pd0, round(case when upper(partner)='PARTNER_B' then least(greatest(p0*1.25e0,0.001),0.95) else least(greatest(p0,0.001),0.95) end,6) as pd
 from (select *, least(greatest(case when x<=0 then 0e0 when x<=0.03 then 0e0+(x-0e0)*((0.02e0-0e0)/(0.03e0-0e0)) when x<=0.06 then 0.02e0+(x-0.03e0)*((0.05e0-0.02e0)/(0.06e0-0.03e0))
   when x<=0.1 then 0.05e0+(x-0.06e0)*((0.12e0-0.05e0)/(0.1e0-0.06e0)) when x<=0.2 then 0.12e0+(x-0.1e0)*((0.22e0-0.12e0)/(0.2e0-0.1e0))
   when x<=0.4 then 0.22e0+(x-0.2e0)*((0.45e0-0.22e0)/(0.4e0-0.2e0)) when x<=0.8 then 0.45e0+(x-0.4e0)*((0.9e0-0.45e0)/(0.8e0-0.4e0)) else 0.9e0 end,0.001),0.999) as p0
 from (select *, w*0.25e0+u*0.25e0+v*0.5e0 as x
 from (select r.*, p.fraud_score, p.fraud_decision, p.fraud_normalized, p.c1, p.c3, p.c4, p.c5, p.c6, p.c7,
  p.qm, p.ff, p.pp, p.np, p.plm, p.prm, p.cs, p.contra, p.fdr, p.fpd, p.fd60, p.finq, p.ftl, p.plaid_balance, p.plaid_recentNSFs, p.negative_balance_days_90d, p.giact_bankruptcy_count, p.lu_bad, p.lu_conn, p.lu_cross,
  p.a1,p.a2,p.b1,p.b2,p.b3,p.b4,p.b5,p.d1,p.d2,p.d3,p.d4,p.e1,p.e2,p.e3,p.e4,p.e5,p.g1,p.g2,p.g3,
  1/(1+exp(-(-2.6e0+0.9e0*qi_missing+0.5e0*missing_qi_low_fico+0.25e0*has_severe_delin+0.4e0*delin_rate))) as w,
  1/(1+exp(-(-5.0e0+0.55e0*rule_score))) as u,
  1/(1+exp(-(2.2e0-0.007e0*coalesce(fico,650)+0.15e0*high_inq+0.1e0*cash_stress))) as v
  from rulec r join (select * exclude (fico, qi, partner, loan_id, shop_id, ident_key, signing_date, principal, acct_balance, age, revision_id, loan_state, n_lines, d30, d60, inq6, revutil, pastdue, instbal, revbal, tl_total, tl_paid, tl_delin, mopmt, crhist, is_bad) from pts) p using (application_id)) t) t) t) t""")

cte("graded", ("sc",), """
 select *, case grade_index when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D' when 4 then 'E' when 5 then 'F' else 'G' end as grade,
  grade_index+1 as pricing_tier
 from (select *, case when upper(partner)='PARTNER_B' then least(gi+1,6) else gi end as grade_index
  from (select *, case when pd>=0.35 then 6 when pd>=0.25 then 5 when pd>=0.18 then 4 when pd>=0.12 then 3 when pd>=0.08 then 2 when pd>=0.04 then 1 else 0 end as gi from sc) t) t""")

cte("decided", ("graded",), """
 select * exclude (d0), case when grade='E' and partner='PARTNER_A' then 'PARTNER_GRADE_E_AUTO_DECLINE' when grade='E' and pd>0.40 then 'HIGH_PD_GRADE_E_DECLINE'
   when grade='E' then 'GRADE_E_REPRICING' else '' end as grade_e_action,
  case when grade='E' and (partner='PARTNER_A' or pd>0.40) then 'decline' else d0 end as decision
 from (select *, case when fraud_decision='decline' then 'decline' when fraud_decision='review' then 'review' when pd>=0.25 then 'decline'
   when pd>=0.15 then 'review' when grade in ('E','F','G') then 'review' else 'approve' end as d0 from graded) t""")

cte("six", ("ent",), """
 select *, case when dec<>'' then 'decline' when rev<>'' then 'review' else 'approve' end as fraud_decision,
  case when dec<>'' then dec else rev end as fraud_rules_triggered
 from (select *,
  concat_ws('|', case when has_prior_bad=1 then 'prior_bad_auto_decline' end, case when qi='MISSING' and coalesce(fico,650)<600 then 'missing_qi_low_fico' end,
   case when qi='MISSING' and partner='PARTNER_A' then 'missing_qi_partner_a' end) as dec,
  concat_ws('|', case when coalesce(fico,650)<550 then 'extreme_subprime' end, case when coalesce(d60,0)>=4 and coalesce(fico,650)<620 then 'bureau_stress' end,
   case when prior_loans_ssn>=3 then 'entity_cluster' end) as rev
  from ent) t""")

cte("pay", (), """
 select l_orderkey as loan_id, l_partkey%360 as day_no, l_linenumber as o1, l_suppkey as o2, l_partkey as o3, l_extendedprice as o4,
  cast((cast(round(l_extendedprice*100) as bigint)+50)//100 as double)/100 as amount, case when l_returnflag='R' then 1 else 0 end as r, case when l_linenumber>=6 then 'RECOVERY' else 'CUSTOMER' end as ptype,
  row_number() over (partition by l_orderkey order by l_partkey%360, l_linenumber, l_suppkey, l_partkey, l_extendedprice, case when l_returnflag='R' then 1 else 0 end) as pno
 from lineitem""")

cte("payf", ("pay",), """
 select b.loan_id, n_payments, nsf_count, nsf_rate, nsf_in_first_90d, has_recovery, recovery_nsf_rate, cust_payments, payment_cv,
  coalesce(cl.m,0) as nsf_cluster_max, coalesce(st.m,0) as max_consecutive_nsf, tr.p as payment_decline_pct
 from (select loan_id, count(*) as n_payments, cast(sum(r) as double) as nsf_count, avg(r) as nsf_rate,
   cast(max(case when r=1 and day_no<=90 then 1 else 0 end) as double) as nsf_in_first_90d,
   cast(max(case when ptype='RECOVERY' then 1 else 0 end) as double) as has_recovery,
   avg(case when ptype='RECOVERY' then r end) as recovery_nsf_rate, count(case when ptype='CUSTOMER' then 1 end) as cust_payments,
   stddev_samp(case when ptype='CUSTOMER' then amount end)/nullif(avg(case when ptype='CUSTOMER' then amount end),0) as payment_cv
   from pay group by loan_id) b
 left join (select a.loan_id, cast(max(n) as double) as m from (select a.loan_id, a.pno, count(*) as n from pay a join pay b on a.loan_id=b.loan_id and b.r=1 and b.day_no between a.day_no-29 and a.day_no
   where a.r=1 group by a.loan_id, a.pno) a group by a.loan_id) cl on b.loan_id=cl.loan_id
 left join (select loan_id, cast(max(n) as double) as m from (select loan_id, g, count(*) as n from (select *, pno - row_number() over (partition by loan_id, r order by pno) as g from pay) t where r=1 group by loan_id, g) t group by loan_id) st on b.loan_id=st.loan_id
 left join (select loan_id, (avg(case when k>n-3 then amount end)-avg(case when k<=3 then amount end))/avg(case when k<=3 then amount end) as p
   from (select *, row_number() over (partition by loan_id order by pno) as k, count(*) over (partition by loan_id) as n from pay where ptype='CUSTOMER') t where n>=6 group by loan_id) tr on b.loan_id=tr.loan_id""")

cte("payr", ("payf", "scope"), """
 select *, case when flag_count=0 then 'green' when flag_count=1 then 'yellow' when flag_count=2 then 'orange' else 'red' end as risk_tier,
  round(flag_count*100e0/9,1) as risk_score
 from (select *, flag_any_nsf+flag_nsf_rate_high+flag_early_nsf+flag_nsf_cluster+flag_consec_nsf+flag_has_recovery+flag_recovery_nsf+flag_high_cv+flag_declining as flag_count
 from (select p.*, s.is_bad, s.signing_date,
  case when nsf_count>0 then 1 else 0 end as flag_any_nsf, case when nsf_rate>0.15 then 1 else 0 end as flag_nsf_rate_high,
  case when nsf_in_first_90d>0 then 1 else 0 end as flag_early_nsf, case when nsf_cluster_max>=2 then 1 else 0 end as flag_nsf_cluster,
  case when max_consecutive_nsf>=2 then 1 else 0 end as flag_consec_nsf, case when has_recovery>0 then 1 else 0 end as flag_has_recovery,
  case when recovery_nsf_rate>0.5 then 1 else 0 end as flag_recovery_nsf, case when payment_cv>1.0 then 1 else 0 end as flag_high_cv,
  case when payment_decline_pct<-0.20 then 1 else 0 end as flag_declining
  from payf p join scope s using (loan_id)) t) t""")

# isotonic fit of flag_count -> P(bad) by the min-max formula over the few counts
cte("paypd", ("payr",), """
 select r.*, round(least(greatest(i.p,0.001),0.999),4) as default_probability
 from payr r join (
  select k, max(lo) as p from (select a.flag_count as k, i.flag_count as i0, min(s.avg_y) as lo
   from (select distinct flag_count from payr) a join (select distinct flag_count from payr) i on i.flag_count<=a.flag_count
   join (select x.flag_count as i0, y.flag_count as j0, sum(z.b)/sum(z.n) as avg_y
     from (select distinct flag_count from payr) x join (select distinct flag_count from payr) y on y.flag_count>=x.flag_count
     join (select flag_count, cast(sum(is_bad) as double) as b, count(*) as n from payr group by flag_count) z on z.flag_count between x.flag_count and y.flag_count
     group by x.flag_count, y.flag_count) s on s.i0=i.flag_count and s.j0>=a.flag_count
   group by a.flag_count, i.flag_count) t group by k) i on r.flag_count=i.k""")

cte("dec_all", ("decided",), """
 select *, case loan_id%5 when 0 then 'A1' when 1 then 'B2' when 2 then 'C3' when 3 then 'D' else '' end as production_grade,
  case loan_id%5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D' end as production_grade_letter from decided""")

"""Feature derivation, joins, history, banking, payments."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.operators import banking, enrich, entity, features, payments
from creditloom.sources import fixtures as fx

from . import frames as fr
from .base_sql import BAD, BANK_AS_OF, GOOD, sql
from .registry import query, r6

c = F.col

_BUREAU = ("paid_ratio", "delin_rate", "delin_severity", "util_distance", "total_balance", "rev_share", "payment_burden",
           "credit_activity", "inq_intensity", "bureau_health", "fico_band", "delin_recency")
_BUREAU_INT = ("has_severe_delin", "any_delin", "zero_current_delin", "credit_recovery", "high_util", "zero_util", "high_inq", "cash_stress")


@query("bureau_features", sql(f"select application_id, {r6(*_BUREAU)}, {', '.join(_BUREAU_INT)} from bfeat", "bfeat"))
def bureau_features(spark, sf):
    return fr.rounded(features.bureau_features(fr.scope(spark, sf)).select("application_id", *_BUREAU, *_BUREAU_INT))


_QI = ("qi_encoded", "qi_missing", "qi_quality", "partner_encoded", "missing_qi_low_fico", "hfht_high_fico", "triple_risk")


@query("qi_partner_features", sql(f"select application_id, {', '.join(_QI)}, {r6('fico_qi_interaction', 'fico_partner_risk')} from qfeat", "qfeat"))
def qi_partner_features(spark, sf):
    df = features.qi_partner_features(features.bureau_features(fr.scope(spark, sf)))
    return fr.rounded(df.select("application_id", *_QI, "fico_qi_interaction", "fico_partner_risk"))


@query("identity_features", sql("""select application_id,
 (case when prove_phone_trust_score is not null then 1 else 0 end)+(case when plaid_balance is not null then 1 else 0 end)+(case when giact_bankruptcy_count is not null then 1 else 0 end)+(case when taktile_status='success' then 1 else 0 end) as n_identity_sources,
 round(coalesce(prove_phone_trust_score,0)/1000,6) as prove_trust_norm, case when coalesce(prove_phone_trust_score,0)<500 then 1 else 0 end as prove_trust_low,
 case when coalesce(prove_name_score,0)<50 then 1 else 0 end as prove_name_match_weak, case when prove_ssn_match=0 then 1 else 0 end as prove_ssn_fail,
 round(ln(1+greatest(coalesce(plaid_balance,0),0)),6) as plaid_balance_log, case when coalesce(plaid_balance,0)<500 then 1 else 0 end as plaid_low_balance,
 case when plaid_balance<0 then 1 else 0 end as plaid_negative_balance, case when plaid_recentNSFs>0 then 1 else 0 end as plaid_has_nsf, case when plaid_recentNSFs>=3 then 1 else 0 end as plaid_high_nsf,
 case when giact_bankruptcy_count>0 then 1 else 0 end as giact_has_bankruptcy, case when giact_bankruptcy_count>1 then 1 else 0 end as giact_multiple_bankruptcy,
 case when taktile_output is not null then 1 else 0 end as taktile_has_output,
 case when regexp_matches(coalesce(taktile_output,''),'(?i)fraud|suspicious|high.?risk|reject') then 1 else 0 end as taktile_fraud_flag,
 case when regexp_matches(coalesce(taktile_output,''),'(?i)identity.?match|verified|confirm') then 1 else 0 end as taktile_identity_match from ident""", "ident"))
def identity_features(spark, sf):
    df = features.identity_features(fx.identity(fr.scope(spark, sf)))
    return fr.rounded(df.select("application_id", *K.FEATURE_SETS["identity_signals"], "taktile_has_output"))


@query("history_levels", sql("select application_id, has_prior_bad, is_repeat, prior_history from ent", "ent"))
def history_levels(spark, sf):
    return features.prior_history(fr.with_history(spark, sf)).select("application_id", "has_prior_bad", "is_repeat", "prior_history")


@query("all_features", sql(f"select application_id, {r6('bureau_health', 'fico_qi_interaction', 'util_distance')}, triple_risk, prior_history, case when plaid_recentNSFs>=3 then 1 else 0 end as plaid_high_nsf from ent join (select application_id, plaid_recentNSFs from ident) i using (application_id)", "ent", "ident"))
def all_features(spark, sf):
    df = fr.with_history(spark, sf)
    master = fx.identity(fr.loans(spark, sf).select("loan_id", "shop_id", "acct_balance"))
    df = features.all_features(df, include_identity=True, master=master)
    return fr.rounded(df.select("application_id", "bureau_health", "fico_qi_interaction", "util_distance", "triple_risk", "prior_history", "plaid_high_nsf"))


@query("compact_features", sql("""select application_id, qi_encoded, case when qi='MISSING' then 1 else 0 end as qi_missing, partner_encoded,
 round((case when fico is null then 0 else fbin end)*5+qi_encoded,6) as fico_qi_interaction, round(paid_ratio,6) as paid_ratio, round(delin_rate,6) as delin_rate, round(d30+2*d60,6) as delin_severity,
 round(payment_burden,6) as payment_burden, round(inq6/greatest(tl_total,1)*case when tl_total is null then null else 1 end,6) as credit_activity from qfeat""", "qfeat"))
def compact_features(spark, sf):
    cols = ("qi_encoded", "qi_missing", "partner_encoded", "fico_qi_interaction", "paid_ratio", "delin_rate", "delin_severity", "payment_burden", "credit_activity")
    return fr.rounded(features.compact_features(fr.scope(spark, sf)).select("application_id", *cols))


@query("scorecard_features", sql(f"select application_id, {r6('qi_encoded', 'fico_qi_interaction', 'paid_ratio', 'delin_rate', 'delin_severity', 'bureau_health', 'cash_stress', 'util_distance')}, qi_missing, any_delin, prior_history from sfeat", "sfeat"))
def scorecard_features(spark, sf):
    df = features.scorecard_features(fr.with_history(spark, sf))
    return fr.rounded(df.select("application_id", "qi_encoded", "fico_qi_interaction", "paid_ratio", "delin_rate", "delin_severity", "bureau_health",
                                "cash_stress", "util_distance", "qi_missing", "any_delin", "prior_history"))


@query("survival_features", sql("""select application_id, qi_encoded, qi_missing, round(fbin*5+qi_encoded,6) as fico_qi_interaction,
 round(coalesce(least(greatest(tl_paid/greatest(tl_total,1),0),1),0),6) as paid_ratio, round(coalesce(inq6,0)/greatest(coalesce(tl_total,0),1),6) as credit_activity,
 round((case when coalesce(tl_delin,0)=0 then 0.4e0 else 0 end)+(1-least(coalesce(inq6,0)/greatest(coalesce(tl_total,0),1),1))*0.3e0+coalesce(least(greatest(tl_paid/greatest(tl_total,1),0),1),0)*0.3e0,6) as bureau_health,
 (case when coalesce(fico,0)<580 then 2 else 0 end)+(case when pastdue>0 then 1 else 0 end)+(case when revutil>80 then 1 else 0 end) as cash_stress from qfeat""", "qfeat"))
def survival_features(spark, sf):
    return fr.rounded(features.survival_features(fr.scope(spark, sf)).select(
        "application_id", "qi_encoded", "qi_missing", "fico_qi_interaction", "paid_ratio", "credit_activity", "bureau_health", "cash_stress"))


@query("fraud_features", sql("select application_id, np as n_providers, cs as cash_stress, contra as contradiction_score, round(fdr,6) as delin_rate, case when prm then 1 else 0 end as prove_missing, case when plm then 1 else 0 end as plaid_missing from fr", "fr"))
def fraud_features(spark, sf):
    df = features.fraud_features(fx.identity(fr.scope(spark, sf)))
    return fr.rounded(df.select("application_id", "n_providers", c("fr_cash_stress").alias("cash_stress"), "contradiction_score", c("fr_delin_rate").alias("delin_rate"),
                                c("prove_missing").cast("int").alias("prove_missing"), c("plaid_missing").cast("int").alias("plaid_missing")))


@query("six_rule_features", sql("""select application_id, round(coalesce(tl_paid,0)/greatest(coalesce(tl_total,0),1),6) as paid_ratio, round(fbin*5+qi_encoded,6) as fico_qi_interaction, prior_history,
 case when coalesce(tl_delin,0)=0 then 1 else 0 end as zero_current_delin from ent""", "ent"))
def six_rule_features(spark, sf):
    return fr.rounded(features.six_rule_features(fr.with_history(spark, sf)).select("application_id", "paid_ratio", "fico_qi_interaction", "prior_history", "zero_current_delin"))


# --- joins ---------------------------------------------------------------------
@query("enrich_join", sql("select application_id, plaid_balance, taktile_output from ident", "ident"))
def enrich_join(spark, sf):
    master = fx.identity(fr.loans(spark, sf))
    doubled = master.unionByName(master)   # duplicate master rows are dropped per loan
    return enrich.enrich(fr.scope(spark, sf), doubled, cols=("plaid_balance", "taktile_output"), order=["plaid_balance"]).select(
        "application_id", "plaid_balance", "taktile_output")


@query("attach_history", sql("select application_id, has_prior_bad, is_repeat, is_cross_entity, cast(prior_loans_ssn as integer) as prior_loans_ssn, cast(prior_bad_ssn as integer) as prior_bad_ssn from hist", "hist"))
def attach_history(spark, sf):
    return enrich.attach_entity(fr.scope(spark, sf), fr.history(spark, sf)).select("application_id", "has_prior_bad", "is_repeat", "is_cross_entity", "prior_loans_ssn", "prior_bad_ssn")


_BANK = f"""
with acc as (select distinct user_id as revision_id, user_id as account from events where user_id%5<>0),
bal as (select revision_id, avg(case when d>=date '{BANK_AS_OF}'-30 then cur end) as avg_balance_30d, avg(case when d between date '{BANK_AS_OF}'-90 and date '{BANK_AS_OF}'-60 then cur end) as avg_balance_60_90d,
  min(case when d>=date '{BANK_AS_OF}'-30 then cur end) as min_balance_30d, max(case when d>=date '{BANK_AS_OF}'-30 then cur end) as max_balance_30d,
  cast(sum(case when cur<0 and d>=date '{BANK_AS_OF}'-90 then 1 else 0 end) as bigint) as negative_balance_days_90d
  from acc join (select user_id as account, cast(ts as date) as d, value-60 as cur from events) b using (account) where d<=date '{BANK_AS_OF}' group by revision_id),
txn as (select revision_id, count(*) as txn_count_total, count(case when dir='CREDIT' and d>=date '{BANK_AS_OF}'-90 then 1 end) as credit_txn_count_90d,
  sum(case when dir='CREDIT' and d>=date '{BANK_AS_OF}'-90 then value else 0 end) as credit_sum_90d, count(case when dir='DEBIT' and d>=date '{BANK_AS_OF}'-90 then 1 end) as debit_txn_count_90d,
  sum(case when dir='DEBIT' and d>=date '{BANK_AS_OF}'-90 then value else 0 end) as debit_sum_90d, count(case when et='error' and d>=date '{BANK_AS_OF}'-90 then 1 end) as nsf_count_90d
  from acc join (select user_id as account, cast(ts as date) as d, value, event_type as et, case when event_type in ('purchase','view') then 'DEBIT' else 'CREDIT' end as dir from events) t using (account) where d<=date '{BANK_AS_OF}' group by revision_id),
bank as (select * from bal left join txn using (revision_id))"""
_BANK_COLS = ("avg_balance_30d", "avg_balance_60_90d", "min_balance_30d", "max_balance_30d", "credit_sum_90d", "debit_sum_90d")
_BANK_INTS = ("negative_balance_days_90d", "txn_count_total", "credit_txn_count_90d", "debit_txn_count_90d", "nsf_count_90d")


def _bank(spark, sf):
    return banking.banking_velocity(fx.accounts(spark, sf), fx.balances(spark, sf), fx.transactions(spark, sf), fx.BANK_AS_OF)


@query("banking_velocity", f"{_BANK} select revision_id, {r6(*_BANK_COLS, digits=4)}, {', '.join(_BANK_INTS)} from bank")
def banking_velocity(spark, sf):
    return fr.rounded(_bank(spark, sf).select("revision_id", *_BANK_COLS, *_BANK_INTS), 4)


@query("banking_coverage", _BANK + """, o as (select o_custkey%1000 as revision_id from orders where not (o_orderstatus='P' and o_orderkey%7=0))
 select count(*) as n_rows, count(nsf_count_90d) as n_matched, round(count(nsf_count_90d)/count(*),6) as coverage from o left join bank using (revision_id)""")
def banking_coverage(spark, sf):
    return fr.rounded(enrich.coverage(enrich.attach_banking(fr.scope(spark, sf), _bank(spark, sf)), "nsf_count_90d"))


@query("default_model_assembly", sql("""select loan_id, fico, qi, dwop, tl_total from (
 select l.loan_id, case when l.loan_id%4<>0 then s.score end as fico, coalesce(q.qi,'MISSING') as qi, case when l.loan_id%3=0 then cast(l.loan_id%45 as integer) else 0 end as dwop, case when l.loan_id%4<>0 then l.tl_total end as tl_total
 from loans l left join (select loan_id, fico + 2 as score from loans) s using (loan_id)
 left join (select o_custkey as shop_id, case o_orderpriority when '1-URGENT' then 'HFHT' when '2-HIGH' then 'HFLT' when '3-MEDIUM' then 'LFHT' when '4-NOT SPECIFIED' then 'LFLT' else 'MISSING' end as qi,
  row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) q on l.shop_id=q.shop_id and q.rn=1) t where fico is not null""", "loans"))
def default_model_assembly(spark, sf):
    """Three bureau reports per application of which the newest counts; a quarter has none."""
    base = fr.loans(spark, sf)
    k = c("loan_id")
    slim = base.select("loan_id", "application_id", "loan_state")
    offers = base.select("application_id", "shop_id", "partner", F.lit("flex_loan").alias("product_name"))
    have = base.where(k % 4 != 0)
    reports = have.select(F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("i"), "application_id", "signing_date").select(
        (c("application_id") * 10 + c("i")).alias("id"), c("application_id").alias("target_application_id"), F.lit("CREDIT").alias("provider_type"),
        F.date_add(F.to_date("signing_date"), c("i")).alias("fetched_at"))
    risk = have.select(F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("i"), "application_id", "fico").select(
        (c("application_id") * 10 + c("i")).alias("report_id"), F.lit("V8").alias("model_type"), (c("fico") + c("i")).alias("score"))
    stats = have.select((c("application_id") * 10 + 2).alias("report_id"), "tl_total")
    dwop = fx.days_without_payment(base).withColumnRenamed("application_id", "loan_id")
    out = enrich.assemble_loans(slim, offers, reports, risk, stats, dwop, fx.qi_history(spark, sf), "CREDIT", "V8", ["flex_loan"])
    return out.select("loan_id", "fico", "qi", "dwop", "tl_total")


@query("latest_qi", """select o_custkey as shop_id, qi, updated_at from (select o_custkey, o_orderdate as updated_at, case o_orderpriority when '1-URGENT' then 'HFHT' when '2-HIGH' then 'HFLT' when '3-MEDIUM' then 'LFHT' when '4-NOT SPECIFIED' then 'LFLT' else 'MISSING' end as qi,
 row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) t where rn=1""")
def latest_qi(spark, sf):
    return enrich.latest(fx.qi_history(spark, sf), ["shop_id"], ["updated_at", "tie"], ["qi", "updated_at"])


@query("prior_history", sql("select application_id, prior_loans_ssn, prior_bad_ssn, prior_paid_ssn, prior_shops_ssn, has_prior_bad, has_prior_paid, is_repeat, is_cross_entity from hist", "hist"))
def prior_history(spark, sf):
    return fr.history(spark, sf).select("application_id", "prior_loans_ssn", "prior_bad_ssn", "prior_paid_ssn", "prior_shops_ssn",
                                        "has_prior_bad", "has_prior_paid", "is_repeat", "is_cross_entity")


@query("owner_history", sql(f"""select a.application_id, count(distinct b.loan_id) as prior_loans_ssn, count(distinct case when b.loan_state in {BAD} then b.loan_id end) as prior_bad_ssn
 from scope a left join scope b on a.shop_id%50=b.shop_id%50 and b.signing_date<a.signing_date group by a.application_id""", "scope"))
def owner_history(spark, sf):
    """Fifty identities own the whole portfolio: every key holds many rows."""
    df = fr.scope(spark, sf)
    owners = df.select("application_id", (c("shop_id") % 50).alias("owner")).unionByName(df.select("application_id", (c("shop_id") % 50).alias("owner")))
    linked = entity.identity_loans(df.select("application_id", "loan_id", "shop_id", "signing_date", "loan_state"), owners, "owner")
    return entity.prior_history(linked, "owner").select("application_id", "prior_loans_ssn", "prior_bad_ssn")


@query("shop_lookup", sql(f"""select cast(shop_id as varchar) as "key", case when b>0 then 1 else 0 end as has_prior_bad, n as connected_count from (
 select s.shop_id, count(case when s.loan_state in {BAD} then 1 end) as b, count(*) as n from scope s join (select shop_id, max(signing_date) as m from scope group by shop_id) l on s.shop_id=l.shop_id and s.signing_date<l.m
 where s.loan_state in {BAD} or s.loan_state in {GOOD} group by s.shop_id) t""", "scope"))
def shop_lookup(spark, sf):
    return entity.shop_lookup(fr.scope(spark, sf))


@query("lookup_fallback", sql("""select s.application_id, coalesce(l.has_prior_bad,0) as has_prior_bad, coalesce(l.prior_shops_ssn,0) as connected_count
 from scope s left join hist l on l.application_id = case when s.application_id%3<>0 then s.application_id else s.shop_id end""", "scope", "hist"))
def lookup_fallback(spark, sf):
    df = fr.scope(spark, sf).select("application_id", "shop_id").withColumn("lookup_id", F.when(c("application_id") % 3 != 0, c("application_id")))
    out = entity.attach_lookup(df, entity.lookup_from_history(fr.history(spark, sf)), "lookup_id", "shop_id")
    return out.select("application_id", F.coalesce("lu_has_prior_bad", F.lit(0)).alias("has_prior_bad"), F.coalesce("lu_connected_count", F.lit(0)).alias("connected_count"))


@query("connected_shops", """with recursive m as (select distinct o_custkey as shop, 'p'||(o_custkey%97) as id from orders where o_custkey%3=0 union select distinct o_custkey, 'e'||(o_custkey//40) from orders where o_custkey%2=0),
 r as (select distinct o_custkey as shop, o_custkey as label from orders union select b.shop, r.label from r join m a on r.shop=a.shop join m b on a.id=b.id)
 select shop as shop_id, min(label) as component from r group by shop""")
def connected_shops(spark, sf):
    o = fx.table(spark, sf, "orders").select(c("o_custkey").alias("shop_id"))
    ids = F.array_compact(F.array(F.when(c("shop_id") % 3 == 0, F.concat(F.lit("p"), (c("shop_id") % 97).cast("string"))),
                                  F.when(c("shop_id") % 2 == 0, F.concat(F.lit("e"), F.floor(c("shop_id") / 40).cast("string")))))
    return entity.components(o.select("shop_id", F.explode_outer(ids).alias("identifier")))


@query("not_yet_scored", sql("select application_id from scope where application_id%4<>0", "scope"))
def not_yet_scored(spark, sf):
    df = fr.scope(spark, sf)
    done = df.where("application_id % 4 = 0").select("application_id")
    return enrich.not_scored(df, done.unionByName(done)).select("application_id")


@query("train_test_union", sql("select count(*) as n, count(distinct application_id) as n_ids, count(extra) as n_extra from (select application_id, case when signing_date < timestamp '2000-01-01' then 1 end as extra from scope) t", "scope"))
def train_test_union(spark, sf):
    from creditloom.operators.labels import temporal_split
    a, b = temporal_split(fr.scope(spark, sf), fx.SPLIT)
    u = a.withColumn("extra", F.lit(1)).unionByName(b, allowMissingColumns=True)
    return u.agg(F.count("*").alias("n"), F.count_distinct("application_id").alias("n_ids"), F.count("extra").alias("n_extra"))


@query("category_domain", sql("select distinct coalesce(partner,'MISSING') as category from scope", "scope"))
def category_domain(spark, sf):
    from creditloom.operators.labels import temporal_split
    a, b = temporal_split(fr.scope(spark, sf), fx.SPLIT)
    cat = F.coalesce("partner", F.lit("MISSING")).alias("category")
    return a.select(cat).union(b.select(cat)).distinct()


# --- payments --------------------------------------------------------------------
_PAYF = ("nsf_count", "nsf_rate", "nsf_in_first_90d", "nsf_cluster_max", "max_consecutive_nsf", "has_recovery", "recovery_nsf_rate", "payment_cv", "payment_decline_pct")


@query("payment_features", sql(f"select loan_id, n_payments, cust_payments, {r6(*_PAYF)} from payf", "payf"))
def payment_features(spark, sf):
    return fr.rounded(payments.payment_features(fx.payments(spark, sf), fx.PAYMENT_ORDER).select("loan_id", "n_payments", "cust_payments", *_PAYF))


@query("payment_risk", sql(f"select loan_id, {', '.join(K.PAYMENT_FLAGS)}, flag_count, risk_tier, risk_score from payr", "payr"))
def payment_risk(spark, sf):
    return fr.payment_frame(spark, sf).select("loan_id", *K.PAYMENT_FLAGS, "flag_count", "risk_tier", "risk_score")


@query("payment_probability", sql("select loan_id, flag_count, default_probability from paypd", "paypd"))
def payment_probability(spark, sf):
    df = fr.payment_frame(spark, sf)
    return payments.payment_pd(df, payments.fit_payment_pd(df)).select("loan_id", "flag_count", "default_probability")


@query("payment_monitor", sql("select cast(loan_id as varchar) as loan_id, upper(substr(risk_tier,1,1))||substr(risk_tier,2) as payment_tier, default_probability as payment_pd, flag_count from paypd", "paypd"))
def payment_monitor(spark, sf):
    df = fr.payment_frame(spark, sf)
    return payments.monitor(df, payments.fit_payment_pd(df)).select("loan_id", "payment_tier", "payment_pd", "flag_count")



"""The loan domain derived from the driver's star-schema tables (see FIXTURES.md)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import half_up, lookup

AS_OF, SPLIT = "2001-08-02", "2000-01-01"
BANK_AS_OF = "2024-01-16"
QI_OF_PRIORITY = {"1-URGENT": "HFHT", "2-HIGH": "HFLT", "3-MEDIUM": "LFHT", "4-NOT SPECIFIED": "LFLT"}
PARTNER_OF_SEGMENT = {"AUTOMOBILE": "PARTNER_A", "BUILDING": "PARTNER_B", "FURNITURE": "PARTNER_C", "MACHINERY": "other"}
c = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _d(x) -> F.Column:
    return x.cast("double")


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bureau columns per loan, aggregated from its lines."""
    li = table(spark, sf_dir, "lineitem")
    n = lambda cond: _d(F.count_if(cond))
    # money is summed in whole cents: sums of doubles depend on the order of rows
    cents = lambda k: half_up(c(k) * 100).cast("bigint")
    halved = lambda total, by: _d(F.floor((total + by // 2) / by)) / 100
    returned, final = c("l_returnflag") == "R", c("l_linestatus") == "F"
    return li.groupBy(c("l_orderkey").alias("loan_id")).agg(
        _d(F.count("*")).alias("n_lines"), n(returned).alias("d30"), n(returned & final).alias("d60"),
        _d(F.count_if(c("l_quantity") >= 40) * 2).alias("inq6"), (_d(F.call_function("div", F.sum(cents("l_discount")) * 2000 + F.count("*"), 2 * F.count("*"))) / 100).alias("revutil"),
        F.sum(F.when(returned & (c("l_tax") >= 0.06), c("l_quantity") * 25).otherwise(0.0)).alias("pastdue"),
        halved(F.sum(cents("l_extendedprice")), 10).alias("instbal"),
        halved(F.sum(F.when(c("l_linestatus") == "O", cents("l_extendedprice")).otherwise(0)), 10).alias("revbal"),
        _d(F.count("*") * 3).alias("tl_total"), _d(F.count_if(final) * 3).alias("tl_paid"), n(returned).alias("tl_delin"),
        halved(F.sum(cents("l_extendedprice") * cents("l_tax")), 1000).alias("mopmt"),
        _d(F.sum("l_partkey") % 6000).alias("crhist"))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per application with state, qi, partner and bureau columns."""
    o = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    key, status = c("o_orderkey"), c("o_orderstatus")
    fico = F.when(key % 97 != 0, _d(450 + (c("o_custkey") * 37 + key * 11) % 400))
    qi = lookup(c("o_orderpriority"), QI_OF_PRIORITY, "MISSING")
    base = o.join(cust, c("o_custkey") == c("c_custkey")).select(
        key.alias("loan_id"), key.alias("application_id"), c("o_custkey").alias("shop_id"),
        F.floor(key / 3).alias("ident_key"), c("o_custkey").alias("owner_id"), c("o_orderdate").alias("signing_date"),
        c("o_totalprice").alias("principal"), fico.alias("fico"), qi.alias("qi"),
        lookup(c("c_mktsegment"), PARTNER_OF_SEGMENT).alias("partner"), status.alias("_status"), c("c_acctbal").alias("acct_balance"))
    odds = (850 - F.coalesce(c("fico"), F.lit(600.0))) / 10 + F.when(c("qi") == "MISSING", 12).otherwise(0)
    hit = (c("loan_id") * 7919) % 100 < odds
    state = (F.when((c("_status") == "F") & hit, F.when(c("loan_id") % 2 == 0, "CHARGE_OFF").otherwise("DEFAULT"))
             .when(c("_status") == "F", "PAID_CLOSED")
             .when((c("_status") == "P") & (c("loan_id") % 7 == 0), "REJECTED")
             .when(c("_status") == "P", "PAID").otherwise("NORMAL"))
    base = base.withColumn("loan_state", state).drop("_status")
    return base.join(bureau(spark, sf_dir), "loan_id", "left").withColumns({
        "age": F.datediff(F.lit(AS_OF).cast("date"), F.to_date("signing_date")),
        "revision_id": c("shop_id") % 1000})


def identity(df: DataFrame) -> DataFrame:
    """Identity, bank and bankruptcy signals on top of the loans."""
    k, s = c("loan_id"), c("shop_id")
    score = F.when(s % 4 != 0, _d((s * 13) % 1000))
    return df.withColumns({
        "plaid_balance": F.when(k % 3 != 0, c("acct_balance")), "prove_phone_trust_score": score,
        "prove_name_score": F.when(s % 4 != 0, _d((s * 7) % 100)), "prove_ssn_match": F.when(s % 6 != 0, _d(s % 2)),
        "prove_verified": F.when(s % 5 != 0, _d(k % 2)),
        "plaid_recentNSFs": _d(k % 6),
        "giact_bankruptcy_count": F.when(s % 20 == 0, 1.0).when(s % 20 != 10, 0.0),
        "taktile_status": F.when(k % 7 != 0, "success"),
        "taktile_output": F.when(k % 5 == 0, "High-Risk pattern").when(k % 5 == 1, "Identity match: VERIFIED")
        .when(k % 5 == 2, "manual").when(k % 5 == 3, "rejected by rule"),
        "negative_balance_days_90d": F.when(k % 4 != 0, _d(k % 11))})


def production_grade(df: DataFrame) -> DataFrame:
    k = c("loan_id") % 5
    return df.withColumn("production_grade", F.when(k == 0, "A1").when(k == 1, "B2").when(k == 2, "C3").when(k == 3, "D").otherwise(""))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw payments; (day_no, line, supplier, part, price) orders a loan's payments."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        c("l_orderkey").alias("loan_id"), (c("l_partkey") % 360).alias("day_no"), c("l_linenumber").alias("o1"),
        c("l_suppkey").alias("o2"), c("l_partkey").alias("o3"), c("l_extendedprice").alias("o4"),
        (_d(F.floor((half_up(c("l_extendedprice") * 100).cast("bigint") + 50) / 100)) / 100).alias("amount"), (c("l_returnflag") == "R").cast("int").alias("is_returned"),
        F.when(c("l_linenumber") >= 6, "RECOVERY").otherwise("CUSTOMER").alias("payment_type"))


PAYMENT_ORDER = ("day_no", "o1", "o2", "o3", "o4")


def balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(c("user_id").alias("account"), c("ts").alias("date"), (c("value") - 60).alias("current"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(c("user_id").alias("account"), c("ts").alias("date"),
                    F.when(c("event_type").isin("purchase", "view"), "DEBIT").otherwise("CREDIT").alias("direction"),
                    F.when(c("event_type") == "error", "NSF_OVERDRAFT").otherwise("OTHER").alias("category_primary"),
                    c("value").alias("amount"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("user_id % 5 <> 0")
    return e.select(c("user_id").alias("revision_id"), c("user_id").alias("account"))


def qi_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(c("o_custkey").alias("shop_id"), lookup(c("o_orderpriority"), QI_OF_PRIORITY, "MISSING").alias("qi"),
                    c("o_orderdate").alias("updated_at"), c("o_orderkey").alias("tie"))


def current_state(df: DataFrame) -> DataFrame:
    """State of the scored loans some time later, with an update date."""
    k = c("loan_id")
    changed = (k % 50 == 1) & (c("loan_state") == "NORMAL")
    return df.select("application_id", "signing_date", F.when(changed, "WORKOUT").otherwise(c("loan_state")).alias("loan_state"),
                     F.date_add(F.to_date("signing_date"), (k % 200).cast("int")).alias("updated_at"))


def days_without_payment(df: DataFrame) -> DataFrame:
    return df.where("loan_id % 3 = 0").select("application_id", (c("loan_id") % 45).cast("int").alias("dwop"))


# Given model state for the oracle-checked scoring queries: coefficients, not fits.
WOE_STATE = (-2.6, {"qi_missing": 0.9, "missing_qi_low_fico": 0.5, "has_severe_delin": 0.25, "delin_rate": 0.4}, {})
FICO_STATE = (2.2, {"fico": -0.007, "high_inq": 0.15, "cash_stress": 0.1}, {"fico": 650.0})
RULE_STATE = (-5.0, {"rule_score": 0.55}, {})
ISOTONIC_STATE = ((0.0, 0.03, 0.06, 0.1, 0.2, 0.4, 0.8), (0.0, 0.02, 0.05, 0.12, 0.22, 0.45, 0.9))
SEGMENT_MULTIPLIER = 1.25

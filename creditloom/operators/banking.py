"""Bank balance and transaction velocity per application revision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _known(rows: DataFrame, as_of: str) -> DataFrame:
    """Rows dated up to as_of. The bound compares the column itself, so the scan takes it."""
    after = F.date_add(F.lit(as_of).cast("date"), 1)
    return rows.where(F.col("date") < after.cast(rows.schema["date"].dataType))


def _since(days: int, as_of: str):
    return F.to_date("date") >= F.date_sub(F.lit(as_of).cast("date"), days)


def balance_windows(balances: DataFrame, as_of: str) -> DataFrame:
    """Per account: sums, counts and extremes of the balance windows (partial, additive)."""
    cur = F.col("current").cast("double")
    in30 = F.when(_since(30, as_of), cur)
    mid = F.to_date("date").between(F.date_sub(F.lit(as_of).cast("date"), 90), F.date_sub(F.lit(as_of).cast("date"), 60))
    in60 = F.when(mid, cur)
    return _known(balances, as_of).groupBy("account").agg(
        F.sum(in30).alias("s30"), F.count(in30).alias("n30"), F.min(in30).alias("lo30"), F.max(in30).alias("hi30"),
        F.sum(in60).alias("s60"), F.count(in60).alias("n60"),
        F.count_if((cur < 0) & _since(90, as_of)).alias("neg"))


def transaction_windows(transactions: DataFrame, as_of: str) -> DataFrame:
    recent = _since(90, as_of)
    amount = F.col("amount").cast("double")
    is_dir = lambda d: recent & (F.col("direction") == d)
    return _known(transactions, as_of).groupBy("account").agg(
        F.count("*").alias("total"),
        F.count_if(is_dir("CREDIT")).alias("cn"), F.sum(F.when(is_dir("CREDIT"), amount).otherwise(0.0)).alias("cs"),
        F.count_if(is_dir("DEBIT")).alias("dn"), F.sum(F.when(is_dir("DEBIT"), amount).otherwise(0.0)).alias("ds"),
        F.count_if(recent & (F.col("category_primary") == "NSF_OVERDRAFT")).alias("nsf"))


def banking_velocity(accounts: DataFrame, balances: DataFrame, transactions: DataFrame, as_of: str) -> DataFrame:
    """Balance and transaction windows per revision.

    Rows are reduced per account before the account link is joined, so the joins
    carry one row per account whatever the history length. ``as_of`` replaces the
    wall clock: nothing dated later is seen, and a rerun gives the same features."""
    link = accounts.where(F.col("account").isNotNull()).select("revision_id", "account").distinct()
    bal = link.join(balance_windows(balances, as_of), "account").groupBy("revision_id").agg(
        F.try_divide(F.sum("s30"), F.sum("n30")).alias("avg_balance_30d"),
        F.try_divide(F.sum("s60"), F.sum("n60")).alias("avg_balance_60_90d"),
        F.min("lo30").alias("min_balance_30d"), F.max("hi30").alias("max_balance_30d"),
        F.sum("neg").alias("negative_balance_days_90d"))
    txn = link.join(transaction_windows(transactions, as_of), "account").groupBy("revision_id").agg(
        F.sum("total").alias("txn_count_total"), F.sum("cn").alias("credit_txn_count_90d"),
        F.sum("cs").alias("credit_sum_90d"), F.sum("dn").alias("debit_txn_count_90d"),
        F.sum("ds").alias("debit_sum_90d"), F.sum("nsf").alias("nsf_count_90d"))
    return bal.join(txn, "revision_id", "left")

"""Payment behaviour: features from raw payments, the nine flags, tiers and their calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from ..functions.binning import lerp
from ..functions.clean import display, flag, lookup
from .prefix import running_sums, split_hot


def payment_features(payments: DataFrame, order: tuple = ("day_no", "payment_no"), key: str = "loan_id") -> DataFrame:
    """Features of the monitor from raw payments (key, order.., day_no, amount, is_returned 0/1, payment_type).

    ``amount`` must be constant within one full ``order`` key. The payments are shuffled once, by loan, and read in
    order there. A loan may hold any share of the rows: those with more than HOT_ROWS payments are cut into slices.
    """
    few, many = split_hot(payments, key)
    out = _in_order(few, order, key)
    return out if many is None else out.unionByName(_in_slices(many, order, key))


def _in_order(payments: DataFrame, order: tuple, key: str) -> DataFrame:
    """The features by windows over each loan's payments."""
    rows = payments.select(
        key, *dict.fromkeys((*order, "day_no")), "amount", F.col("is_returned").cast("bigint").alias("r"),
        (F.col("payment_type") == "CUSTOMER").cast("bigint").alias("c"), (F.col("payment_type") == "RECOVERY").cast("bigint").alias("rec"))
    so_far = W.partitionBy(key).orderBy(*order, "amount", "r").rowsBetween(W.unboundedPreceding, 0)
    # the total in the order of the running sums, so that one pass over the loan gives all three
    total = so_far.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = rows.withColumns({"_ret": F.sum("r").over(so_far), "_cust": F.sum("c").over(so_far), "_all": F.sum("c").over(total)})
    rows = rows.withColumn("_run", F.col("_ret") - F.coalesce(F.max(F.when(F.col("r") == 0, F.col("_ret"))).over(so_far), F.lit(0)))
    rows = rows.withColumn("_n30", F.sum("r").over(W.partitionBy(key).orderBy("day_no").rangeBetween(-29, 0)))
    r, cust, amount = F.col("r"), F.col("c") == 1, F.col("amount")
    out = rows.groupBy(key).agg(
        F.count("*").alias("n_payments"), F.sum(r).cast("double").alias("nsf_count"), F.avg(r).alias("nsf_rate"),
        F.max((r == 1) & (F.col("day_no") <= 90)).cast("double").alias("nsf_in_first_90d"),
        F.max("rec").cast("double").alias("has_recovery"), F.avg(F.when(F.col("rec") == 1, r)).alias("recovery_nsf_rate"),
        F.sum("c").alias("cust_payments"),
        F.try_divide(F.stddev_samp(F.when(cust, amount)), F.avg(F.when(cust, amount))).alias("payment_cv"),
        F.max(F.when(r == 1, F.col("_n30"))).cast("double").alias("nsf_cluster_max"),
        F.max("_run").cast("double").alias("max_consecutive_nsf"),
        (F.sum(F.when(cust & (F.col("_cust") <= 3), amount)) / 3).alias("f3"),
        (F.sum(F.when(cust & (F.col("_cust") > F.col("_all") - 3), amount)) / 3).alias("l3"))
    decline = F.when(F.col("cust_payments") >= 6, F.try_divide(F.col("l3") - F.col("f3"), F.col("f3"))).alias("payment_decline_pct")
    return out.select(*[n for n in out.columns if n not in ("f3", "l3")], decline).fillna(0.0, ["nsf_cluster_max", "max_consecutive_nsf"])


def _in_slices(payments: DataFrame, order: tuple, key: str) -> DataFrame:
    """The features of loans too large for one task: streaks are islands of a sliced running count, the 30-day cluster
    is a window over loan-days, first/last payments come from running counts."""
    days_key = "day_no"
    ret = F.col("is_returned").cast("bigint")
    cust = (F.col("payment_type") == "CUSTOMER").cast("bigint")
    rec = (F.col("payment_type") == "RECOVERY").cast("bigint")

    base = payments.groupBy(key).agg(
        F.count("*").alias("n_payments"), F.sum(ret).cast("double").alias("nsf_count"),
        F.avg(ret).alias("nsf_rate"),
        F.max((ret == 1) & (F.col(days_key) <= 90)).cast("double").alias("nsf_in_first_90d"),
        F.max(rec).cast("double").alias("has_recovery"),
        F.avg(F.when(rec == 1, ret)).alias("recovery_nsf_rate"),
        F.sum(cust).alias("cust_payments"),
        F.try_divide(F.stddev_samp(F.when(cust == 1, F.col("amount"))),
                     F.avg(F.when(cust == 1, F.col("amount")))).alias("payment_cv"))

    # any 30-day window: returned counts per loan-day, at most one row per calendar day
    daily = payments.where(ret == 1).groupBy(key, days_key).agg(F.count("*").alias("n"))
    month = W.partitionBy(key).orderBy(days_key).rangeBetween(-29, 0)
    cluster = (daily.withColumn("n30", F.sum("n").over(month)).groupBy(key)
               .agg(F.max("n30").cast("double").alias("nsf_cluster_max")))

    steps = payments.select(key, *order, "amount", cust.alias("c"), ret.alias("r"), (1 - ret).alias("ok"))
    steps = steps.groupBy(key, *order, "amount", "r").agg(
        F.sum("c").alias("c"), F.sum("ok").alias("ok"), F.count("*").alias("n"))
    cum = running_sums(steps, [*order, "amount", "r"], ["c", "ok", "n"], keys=[key], merge=False,
                       slice_width=30.0 if order[0] == days_key else None)
    # one pass: islands of returned payments (equal running count of good ones) and the
    # amounts of the first and last three customer payments, from 6 payments on. The number of a loan's customer payments
    # comes by (loan, part of its days), and islands are dealt out anew, so no task gets a loan whole
    part = F.floor(F.col(order[0]) / 30)
    parts = steps.select(key, part.alias("_part")).distinct().join(base.select(key, "cust_payments"), key)
    cum = cum.withColumn("_part", part).join(parts, [key, "_part"])
    took = lambda lo, hi: F.greatest(F.lit(0), F.least(F.col("c_before") + F.col("c"), hi) - F.greatest(F.col("c_before"), lo))
    first, last = took(F.lit(0), F.lit(3)), took(F.col("cust_payments") - 3, F.col("cust_payments"))
    islands = cum.groupBy(key, "cust_payments", "ok_before").agg(
        F.sum(F.when(F.col("r") == 1, F.col("n")).otherwise(0)).alias("len"),
        F.sum(first * F.col("amount")).alias("f"), F.sum(last * F.col("amount")).alias("l"))
    runs = islands.groupBy(key, "cust_payments").agg(
        F.max("len").cast("double").alias("max_consecutive_nsf"), (F.sum("f") / 3).alias("f3"), (F.sum("l") / 3).alias("l3"))
    runs = runs.select(key, "max_consecutive_nsf", F.when(
        F.col("cust_payments") >= 6, F.try_divide(F.col("l3") - F.col("f3"), F.col("f3"))).alias("payment_decline_pct"))

    out = base.join(cluster, key, "left").join(runs, key, "left")
    return out.fillna(0.0, ["nsf_cluster_max", "max_consecutive_nsf"])


_TESTS = {"gt": lambda v, t: v > t, "gte": lambda v, t: v >= t, "lt": lambda v, t: v < t, "lte": lambda v, t: v <= t}


def payment_flags(df: DataFrame, flags: dict = K.PAYMENT_FLAGS) -> DataFrame:
    """One 0/1 column per configured flag; missing values and absent columns do not trigger."""
    return df.withColumns({
        name: flag(_TESTS[how](F.col(feature), t)) if feature in df.columns else F.lit(0)
        for name, (feature, how, t, _w, _d) in flags.items()})


def with_weights(weights: dict, flags: dict = K.PAYMENT_FLAGS) -> dict:
    """A new flag table with other weights; the shared one is never changed."""
    unknown = sorted(set(weights) - set(flags))
    if unknown:
        raise ValueError(f"unknown flags {unknown}")
    return {k: (*v[:3], weights.get(k, v[3]), v[4]) for k, v in flags.items()}


def tier_of(count: Column, tiers=K.PAYMENT_TIERS) -> Column:
    expr = None
    for name, low, high in tiers:
        cond = (count >= low) & (count <= high)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("red")


def payment_risk(df: DataFrame, flags: dict = K.PAYMENT_FLAGS, tiers=K.PAYMENT_TIERS) -> DataFrame:
    """Weighted flag count, tier, 0-100 risk score, advice and descriptions of the set flags."""
    total = sum(v[3] for v in flags.values())
    count = sum((F.col(k) * v[3] for k, v in flags.items()), F.lit(0)).cast("int")
    df = payment_flags(df, flags).withColumn("flag_count", count)
    df = df.withColumns({
        "risk_tier": tier_of(F.col("flag_count"), tiers),
        "risk_score": F.round(F.col("flag_count") * 100.0 / total, 1) if total else F.lit(0.0),
        "flags": F.array_compact(F.array(*[F.when(F.col(k) == 1, v[4]) for k, v in flags.items()])),
    })
    return df.withColumn("recommendation", lookup(F.col("risk_tier"), K.TIER_ADVICE, "Unknown tier"))


def fit_payment_pd(df: DataFrame, label: str = "is_bad") -> dict:
    """Isotonic steps of flag_count -> P(bad), tier rates and base rate.

    The data is first counted per flag_count; only those few counts leave the cluster."""
    from .models import isotonic_steps
    counts = df.groupBy("flag_count").agg(F.sum(F.col(label).cast("double")).alias("bad"), F.count("*").alias("n"))
    rows = sorted((float(r.flag_count), float(r.bad), float(r.n)) for r in counts.collect())
    tiers = {}
    for name, low, high in K.PAYMENT_TIERS:
        inside = [r for r in rows if low <= r[0] <= high]
        n = sum(r[2] for r in inside)
        tiers[name] = sum(r[1] for r in inside) / n if n else 0.0
    xs, ys = isotonic_steps([r[0] for r in rows], [r[1] / r[2] for r in rows], [r[2] for r in rows])
    n = sum(r[2] for r in rows)
    return {"xs": xs, "ys": ys, "tier_rates": tiers, "base_rate": sum(r[1] for r in rows) / n if n else 0.0}


def payment_pd(df: DataFrame, model: dict | None) -> DataFrame:
    """default_probability by isotonic steps, else tier rates, else the base rate."""
    if model and model.get("xs"):
        p = lerp(F.col("flag_count").cast("double"), model["xs"], model["ys"])
        p = F.least(F.greatest(p, F.lit(0.001)), F.lit(0.999))
    elif model and model.get("tier_rates"):
        p = F.coalesce(lookup(F.col("risk_tier"), model["tier_rates"]), F.lit(K.PAYMENT_BASE_RATE))
    else:
        p = F.lit(K.PAYMENT_BASE_RATE)
    return df.withColumn("default_probability", F.round(p, 4))


def monitor(df: DataFrame, model: dict | None = None) -> DataFrame:
    """Monitor output: display tier, PD, flag count, flags, loan id as text."""
    scored = payment_pd(payment_risk(df), model)
    return scored.select(
        F.coalesce(F.col("loan_id").cast("string"), F.lit("unknown")).alias("loan_id"),
        display(F.col("risk_tier")).alias("payment_tier"), F.col("default_probability").alias("payment_pd"),
        "flag_count", "flags", *K.PAYMENT_FLAGS)

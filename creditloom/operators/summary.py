"""Portfolio summaries. One scan per report: grouping sets or conditional aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from .metrics import ranking
from .prefix import quantiles

c = F.col


def _n(x: str) -> Column:
    return F.sum(c(x).cast("bigint"))


def group_rates(df: DataFrame, dims: Sequence[str], label: str = "is_bad", pd_col: str = "pd") -> DataFrame:
    """Count, share, bads, bad rate and mean pd of every value of every dimension.

    GROUPING SETS reads the scored table once for all dimensions."""
    whole = df.select(*[c(d).cast("string").alias(d) for d in dims], label, pd_col)
    sets = whole.groupingSets([[c(d)] for d in dims], *dims).agg(
        F.grouping_id(*dims).alias("_gid"), F.count("*").alias("n"), _n(label).alias("n_bad"),
        F.avg(c(label).cast("double")).alias("bad_rate"), F.avg(pd_col).alias("mean_pd"))
    k = len(dims)
    dim = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for i, d in enumerate(dims):
        mine = c("_gid") == (2 ** k - 1 - 2 ** (k - 1 - i))
        dim, value = F.when(mine, d).otherwise(dim), F.when(mine, c(d)).otherwise(value)
    out = sets.select(dim.alias("dim"), value.alias("value"), "n", "n_bad", "bad_rate", "mean_pd")
    total = F.sum("n").over(W.partitionBy("dim"))  # a handful of values per dimension
    return out.withColumn("pct", c("n") / total)


def dataset_summary(df: DataFrame, label: str = "is_bad") -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.min("signing_date").alias("first_date"),
                  F.max("signing_date").alias("last_date"), F.avg(c(label).cast("double")).alias("bad_rate"))


def grade_stats(df: DataFrame, grades: Sequence[str], grade: str = "grade", label: str = "is_bad",
                pd_col: str = "pd") -> DataFrame:
    """Stats of every grade of the scheme, empty grades included, plus whether bad rates are
    non-decreasing over the non-empty grades."""
    domain = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(g) for g in grades])).alias("grade_order", "grade"))
    stats = df.groupBy(c(grade).alias("grade")).agg(
        F.count("*").alias("n"), _n(label).alias("n_bad"), F.round(F.avg(c(label).cast("double")), 4).alias("bad_rate"),
        F.avg(pd_col).alias("mean_pd"))
    out = domain.join(stats, "grade", "left").fillna(0, ["n", "n_bad"])
    every = W.orderBy("grade_order").rowsBetween(W.unboundedPreceding, -1)  # one row per grade
    worst = F.max("bad_rate").over(every)
    out = out.withColumn("_ok", c("bad_rate").isNull() | worst.isNull() | (c("bad_rate") >= worst))
    return out.withColumn("monotonic", F.bool_and("_ok").over(W.partitionBy(F.lit(1))).cast("int")).drop("_ok")


def flag_stats(df: DataFrame, flags: Sequence[str], label: str = "is_bad") -> DataFrame:
    """Per flag: flagged count and share, flagged and unflagged bad rates, lift."""
    pairs = F.array(*[F.struct(F.lit(f).alias("flag"), c(f).alias("on")) for f in flags])
    long = df.select(c(label).cast("double").alias("y"), F.inline(pairs))
    t = long.groupBy("flag").agg(
        F.count_if(c("on") == 1).alias("n_flagged"), F.avg((c("on") == 1).cast("double")).alias("flagged_pct"),
        F.avg(F.when(c("on") == 1, c("y"))).alias("flagged_rate"), F.avg(F.when(c("on") == 0, c("y"))).alias("unflagged_rate"),
        F.avg("y").alias("base_rate"))
    t = t.fillna(0.0, ["flagged_rate", "unflagged_rate"])
    return t.withColumn("lift", F.when(c("base_rate") > 0, c("flagged_rate") / c("base_rate")).otherwise(0.0))


def tier_stats(df: DataFrame, tier: str = "risk_tier", label: str = "is_bad", pd_col: str = "default_probability",
               tiers: Sequence[str] = tuple(t[0] for t in K.PAYMENT_TIERS)) -> DataFrame:
    domain = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in tiers])).alias("tier"))
    t = df.groupBy(c(tier).alias("tier")).agg(
        F.count("*").alias("n"), _n(label).alias("n_bad"), F.avg(c(label).cast("double")).alias("bad_rate"),
        F.avg(pd_col).alias("avg_pd"))
    out = domain.join(t, "tier", "left").fillna(0)
    return out.withColumn("pct", c("n") / F.sum("n").over(W.partitionBy(F.lit(1))))


def score_histogram(df: DataFrame, score: str) -> DataFrame:
    return df.groupBy(c(score).alias("score")).agg(F.count("*").alias("n"))


def monthly_trends(df: DataFrame, date: str = "signing_date") -> DataFrame:
    """Per signing month: loans, mean flags, mean pd, red and orange-or-worse share."""
    return df.groupBy(F.date_trunc("month", date).alias("month")).agg(
        F.count("flag_count").alias("n_loans"), F.avg("flag_count").alias("avg_flags"),
        F.avg("default_probability").alias("avg_pd"),
        F.avg((c("risk_tier") == "red").cast("double")).alias("pct_red"),
        F.avg(c("risk_tier").isin("orange", "red").cast("double")).alias("pct_orange_plus"))


def score_summary(df: DataFrame, score: str) -> DataFrame:
    """Mean, population std, extremes and p25..p99."""
    q = quantiles(df, [score], [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]).select("q").scalar()
    s = c(score).cast("double")
    out = df.agg(F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"))
    return out.withColumn("_q", q).select(
        "mean", "std", "min", "max", *[c("_q")[i].alias(n) for i, n in enumerate(("p25", "median", "p75", "p90", "p95", "p99"))])


def percentile_map(df: DataFrame, score: str, step: int = 5) -> DataFrame:
    """Truncated score -> highest percentile reaching it, in 5% steps."""
    q = quantiles(df, [score], [p / 100 for p in range(0, 101, step)])
    return q.select(F.posexplode("q").alias("i", "v")).groupBy(c("v").cast("bigint").alias("score")).agg(
        F.max(c("i") * step).cast("int").alias("percentile"))


def describe_score(df: DataFrame, score: str) -> DataFrame:
    """count, mean, sample std, min, quartiles, max."""
    q = quantiles(df, [score], [0.25, 0.5, 0.75]).select("q").scalar()
    s = c(score).cast("double")
    out = df.agg(F.count(s).alias("count"), F.avg(s).alias("mean"), F.stddev_samp(s).alias("std"),
                 F.min(s).alias("min"), F.max(s).alias("max"))
    return out.withColumn("_q", q).select("count", "mean", "std", "min", "max", *[
        c("_q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))])


def grade_migration(df: DataFrame, production: str = "production_grade_letter", ours: str = "grade",
                    grades: Sequence[str] = ("A", "B", "C", "D", "E", "F", "G")) -> DataFrame:
    """Production x our grade counts, zero-filled."""
    return (df.where(c(production).isin(*grades)).groupBy(c(production).alias("production"))
            .pivot(ours, list(grades)).agg(F.count(F.lit(1))).fillna(0)
            .withColumnsRenamed({g: f"ours_{g.lower()}" for g in grades}))


def portfolio_summary(df: DataFrame) -> DataFrame:
    """Payment portfolio: totals, averages and flag prevalence as (key, value)."""
    named = {"total_loans": F.count("*"), "avg_risk_score": F.avg("risk_score"), "avg_flag_count": F.avg("flag_count"),
             "avg_default_probability": F.avg("default_probability"),
             **{f"prevalence_{k}": F.avg(c(k).cast("double")) for k in K.PAYMENT_FLAGS}}
    one = df.agg(*[v.cast("double").alias(k) for k, v in named.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), c(k).alias("value")) for k in named])))


def vintage_rows(scored: DataFrame, current: DataFrame, dwop: DataFrame, as_of: str) -> DataFrame:
    """Scored loans with their current state, days without payment and derived flags."""
    from .labels import bad_state
    cur = current.select("application_id", c("loan_state").alias("current_state"), "updated_at", c("signing_date").alias("signed"))
    j = scored.join(cur, "application_id").join(dwop, "application_id", "left")
    bad = bad_state(c("current_state"))
    days = F.datediff(F.to_date("updated_at"), F.to_date("signed"))
    return j.withColumns({
        "is_bad_now": bad, "state_changed": (c("current_state") != c("loan_state")).cast("int"),
        "age_days": F.datediff(F.lit(as_of).cast("date"), F.to_date("signed")),
        "dwop": F.coalesce(c("dwop"), F.lit(0)),
        "early_default_90d": F.coalesce((bad == 1) & (days <= 90), F.lit(False)).cast("int"),
        "first_payment_default": F.coalesce((bad == 1) & (days <= 30), F.lit(False)).cast("int")})


def vintage_stats(rows: DataFrame, grade: str = "grade", pd_col: str = "pd") -> DataFrame:
    return rows.where(c(grade).isNotNull()).groupBy(c(grade).alias("grade")).agg(
        F.count("*").alias("n_loans"), _n("is_bad_now").alias("n_bad_now"),
        F.round(F.avg(c("is_bad_now").cast("double")), 4).alias("bad_rate_now"),
        _n("state_changed").alias("n_state_changed"), _n("early_default_90d").alias("n_early_default_90d"),
        _n("first_payment_default").alias("n_first_payment_default"), F.round(F.avg("dwop"), 1).alias("avg_dwop"),
        F.max("dwop").alias("max_dwop"), F.round(F.avg("age_days"), 0).alias("avg_age_days"),
        F.round(F.avg(pd_col), 4).alias("avg_pd"))


def vintage_tracking(rows: DataFrame, order: Sequence[str] = ("A", "B", "C", "D")) -> DataFrame:
    """Vintage stats plus whether current bad rates rise with the grade."""
    t = vintage_stats(rows)
    seen = W.orderBy("grade").rowsBetween(W.unboundedPreceding, -1)  # one row per grade
    inside = c("grade").isin(*order)
    worst = F.max(F.when(inside, c("bad_rate_now"))).over(seen)
    ok = ~inside | worst.isNull() | (c("bad_rate_now") >= worst)
    return t.withColumn("_ok", ok).withColumn("monotonic", F.bool_and("_ok").over(W.partitionBy(F.lit(1))).cast("int")).drop("_ok")


def run_log(batch: DataFrame, run_id: str, total: Column, cumulative: Column, version: str) -> DataFrame:
    """Counts of one scoring run as a single row."""
    d = F.lower("decision")
    return batch.agg(
        F.count("*").alias("new_scored"), F.coalesce(_n("is_bad"), F.lit(0)).alias("new_bads"),
        F.round(F.coalesce(F.avg(c("is_bad").cast("double")), F.lit(0.0)), 4).alias("new_bad_rate"),
        F.count_if(d == "approve").alias("decisions_approve"), F.count_if(d == "review").alias("decisions_review"),
        F.count_if(d == "decline").alias("decisions_decline")).withColumns({
            "run_id": F.lit(run_id), "pipeline_version": F.lit(version),
            "total_in_db": total, "cumulative_scored": cumulative,
            "status": F.when(c("new_scored") == 0, "NO_NEW_DATA").otherwise("OK")})


def training_summary(df: DataFrame, pd_col: str = "pd", label: str = "is_bad") -> DataFrame:
    med = quantiles(df, [pd_col], [0.5]).select(c("q")[0]).scalar()
    return df.agg(F.count("*").alias("n"), F.avg(c(label).cast("double")).alias("bad_rate"),
                  F.avg(pd_col).alias("mean_pd")).withColumn("median_pd", med)


def payment_coverage(df: DataFrame) -> DataFrame:
    zero = F.coalesce(c("cust_payments"), F.lit(0)) == 0
    return df.agg(F.count("*").alias("n_loans"), F.count("nsf_count").alias("n_with_payments"),
                  F.count_if(zero).alias("zero_customer_payments"), F.avg(zero.cast("double")).alias("pct_zero_customer_payments"))


def model_table(metrics: DataFrame) -> DataFrame:
    """Metric rows of several models, best AUC first."""
    return metrics.orderBy(F.desc("auc"), "name")


def acceptance(df: DataFrame, score: str, grades: Sequence[str], label: str = "is_bad", min_auc: float = K.ACCEPT_AUC) -> DataFrame:
    """AUC gate and grade monotonicity as one verdict row."""
    auc = ranking(df, [score], label).select("auc").scalar()
    mono = grade_stats(df, grades, label=label, pd_col=score).agg(F.min("monotonic")).scalar()
    one = df.sparkSession.range(1).select(auc.alias("auc"), mono.alias("monotonic"))
    return one.withColumns({"auc_pass": (c("auc") >= min_auc).cast("int"),
                            "accepted": ((c("auc") >= min_auc) & (c("monotonic") == 1)).cast("int")})


def long_metrics(df: DataFrame, section: str, keys: Sequence[str] = ()) -> DataFrame:
    """Any wide metric frame as (section, key, sub_key, value): key is the joined key columns."""
    rest = [f for f in df.columns if f not in keys]
    key = F.concat_ws("|", *[c(k).cast("string") for k in keys]) if keys else F.lit("all")
    cells = F.array(*[F.struct(F.lit(r).alias("sub_key"), c(r).cast("double").alias("value")) for r in rest])
    return df.select(F.lit(section).alias("section"), key.alias("key"), F.inline(cells))

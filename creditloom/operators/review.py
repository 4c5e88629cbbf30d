"""Review queue: tiers, composite score, global rank, capture and capacity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from ..functions.clean import fill, lookup, percent, upper_text, whole
from ..session import cut_lineage
from .labels import in_review
from .prefix import ranked, running_sums

c = F.col


def _grade(df: DataFrame) -> Column:
    return fill(upper_text(c("grade")), "C")


def review_tier(df: DataFrame, out: str = "review_tier") -> DataFrame:
    """First tier with any matching condition."""
    g, p, f = _grade(df), fill(c("pd"), 0.0), fill(c("fraud_score"), 0)
    return df.withColumn(out, (
        F.when((g == "E") | (p >= 0.20) | (f >= 80), "urgent")
        .when((g == "D") | (p >= 0.15) | (f >= 60), "high")
        .when((g == "C") | (p >= 0.10), "medium").otherwise("low")))


def normalised_weights(weights: dict) -> dict:
    total = sum(weights.values())
    return dict(weights) if abs(total - 1.0) <= 0.01 else {k: v / total for k, v in weights.items()}


def composite_score(df: DataFrame, weights: dict = K.REVIEW_WEIGHTS, out: str = "composite_risk_score") -> DataFrame:
    w = normalised_weights(weights)
    raw = F.least(fill(c("fraud_score"), 0) / K.REVIEW_FRAUD_MAX, F.lit(1.0))
    fraud = F.coalesce(c("fraud_normalized"), raw) if "fraud_normalized" in df.columns else raw
    grade = lookup(_grade(df), K.REVIEW_GRADE_RISK, 0.5)
    qi = F.when(upper_text(c("qi")) == "MISSING", 1.0).otherwise(0.0)
    total = (F.least(fill(c("pd"), 0.0), F.lit(1.0)) * w["pd"] + fraud * w["fraud"] + grade * w["grade"] + qi * w["qi"])
    return df.withColumn(out, F.round(total, 6))


def review_reasons(df: DataFrame, roles: K.PartnerRoles = K.DEFAULT_ROLES, out: str = "review_reasons") -> DataFrame:
    """Top three (priority, text) pairs in order of priority, then of the list below."""
    p, f, g, fico = fill(c("pd"), 0.0), fill(c("fraud_score"), 0), _grade(df), c("fico")
    wrap = lambda text, v: F.concat(F.lit(text + " ("), v, F.lit(")"))
    pair = lambda prio, text: F.struct(F.lit(prio).alias("prio"), text.alias("text"))
    pairs = F.array(
        F.when(p >= 0.25, pair(1, wrap("Very high default probability", percent(p))))
        .when(p >= 0.15, pair(2, wrap("High default probability", percent(p))))
        .when(p >= 0.10, pair(4, wrap("Elevated default probability", percent(p)))),
        F.when(g == "E", pair(1, F.lit("Worst credit grade (E)")))
        .when(g == "D", pair(3, F.lit("Poor credit grade (D)")))
        .when(g.isin("F", "G"), pair(2, wrap("Review-trigger grade", g))),
        F.when(f >= 80, pair(1, wrap("High fraud risk score", whole(f))))
        .when(f >= 60, pair(3, wrap("Elevated fraud risk score", whole(f))))
        .when(f >= 40, pair(5, wrap("Moderate fraud risk score", whole(f)))),
        F.when(upper_text(c("qi")) == "MISSING", pair(2, F.lit("Missing QI (industry classification unavailable)"))),
        F.when(fico < 550, pair(2, wrap("Very low FICO score", whole(fico))))
        .when(fico < 600, pair(4, wrap("Low FICO score", whole(fico))))
        .when(fico < 650, pair(6, wrap("Below-average FICO score", whole(fico)))),
        F.when(upper_text(c("partner")) == roles.risky, pair(5, F.lit(f"{roles.risky} partner (higher historical risk)"))),
        F.when(c("fraud_decision") == "review", pair(3, F.lit("Fraud gate flagged for review"))),
    )
    keyed = F.transform(F.array_compact(pairs), lambda s, i: F.struct(s["prio"].alias("prio"), i.alias("pos"), s["text"].alias("text")))
    best = F.transform(F.slice(F.array_sort(keyed), 1, K.REVIEW_MAX_REASONS), lambda s: s["text"])
    return df.withColumn(out, F.when(F.size(best) > 0, best).otherwise(F.array(F.lit("Flagged by pipeline review rules"))))


TIER_ORDER = {t: i for i, t in enumerate(K.REVIEW_TIERS)}


def queued(scored: DataFrame, weights: dict = K.REVIEW_WEIGHTS, with_reasons: bool = True) -> DataFrame:
    """Review rows with tier, composite score and minutes, in no order."""
    q = composite_score(review_tier(in_review(scored)), weights)
    if with_reasons:
        q = review_reasons(q)
    return q.withColumn("estimated_review_time", lookup(c("review_tier"), K.REVIEW_MINUTES, 15))


def prioritise(scored: DataFrame, id_col: str = "application_id", weights: dict = K.REVIEW_WEIGHTS,
               with_reasons: bool = True) -> DataFrame:
    """Review rows ranked by (tier, -score, id): review_priority is 1 for the riskiest. The queue is written once: slices, totals and ranks read it."""
    q = queued(scored, weights, with_reasons)
    return ranked(cut_lineage(_in_order(q, id_col)), "_key", "_tie", "review_priority").drop("_key", "_tie")


def _in_order(queue: DataFrame, id_col: str) -> DataFrame:
    """The queue with its place as (_key, _tie)."""
    numeric = dict(queue.dtypes)[id_col] in ("bigint", "int")
    return queue.withColumns({
        # scores lie in [0, 1.x]: two units per tier keep the tiers apart
        "_key": lookup(c("review_tier"), TIER_ORDER, 9) * 4.0 - c("composite_risk_score"),
        "_tie": c(id_col).cast("bigint") if numeric else F.xxhash64(id_col),
    })


def tier_breakdown(queue: DataFrame) -> DataFrame:
    """Counts, bads, mean pd and fraud score and hours per tier (0 rows for empty tiers)."""
    tiers = F.array(*[F.struct(F.lit(i).alias("tier_order"), F.lit(t).alias("review_tier")) for t, i in TIER_ORDER.items()])
    domain = queue.sparkSession.range(1).select(F.inline(tiers))
    t = queue.groupBy("review_tier").agg(
        F.count("*").alias("n"), F.sum(c("is_bad").cast("bigint")).alias("bads"),
        F.avg("pd").alias("avg_pd"), F.avg("fraud_score").alias("avg_fraud_score"),
        F.sum(c("estimated_review_time").cast("bigint")).alias("minutes"))
    out = domain.join(t, "review_tier", "left").fillna(0)
    return out.withColumns({
        "pct": F.round(F.coalesce(F.try_divide(c("n") * 100.0, F.sum("n").over(W.partitionBy(F.lit(1)))), F.lit(0.0)), 1),
        "bad_rate": F.round(F.coalesce(F.try_divide(c("bads") * 100.0, c("n")), F.lit(0.0)), 1),
        "avg_pd": F.round("avg_pd", 4), "avg_fraud_score": F.round("avg_fraud_score", 1),
        "hours": F.round(c("minutes") / 60.0, 1)})


def grade_breakdown(queue: DataFrame) -> DataFrame:
    return queue.groupBy(fill(upper_text(c("grade")), "?").alias("grade")).agg(
        F.count("*").alias("n"), F.sum(c("is_bad").cast("bigint")).alias("bads"),
        F.round(F.avg(c("is_bad").cast("double")) * 100, 1).alias("bad_rate"))


def _cutoffs(queue: DataFrame, scored: DataFrame, cuts: Column, id_col: str) -> DataFrame:
    """Bads among the first N of the queue for each N of a short array. The queue need not be ranked: loans are counted by key, and only keys that a
    cutoff divides are read in order."""
    rows = _in_order(queue, id_col).select("_key", "_tie", F.lit(1).cast("bigint").alias("n"), F.coalesce(c("is_bad") == 1, F.lit(False)).cast("bigint").alias("bads"))
    by_key = cut_lineage(rows.groupBy("_key").agg(F.sum("n").alias("n"), F.sum("bads").alias("bads")))
    totals = by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_queue"), F.sum("bads").alias("queue_bads"))
    portfolio = scored.agg(F.sum(c("is_bad").cast("bigint"))).scalar()
    points = totals.select("n_queue", "queue_bads", portfolio.alias("portfolio_bads"), F.explode(cuts).alias("cut"))
    points = points.withColumn("top_n", c("cut.top_n"))
    ns = points.agg(F.sort_array(F.collect_set("top_n"))).scalar()  # a dozen numbers
    keys = running_sums(by_key, ["_key"], ["n", "bads"], merge=False).withColumn("_ns", ns)
    keys = keys.withColumn("_ns", F.filter("_ns", lambda k: (k > c("n_before")) & (k <= c("n_before") + c("n")))).where(F.size("_ns") > 0)
    keys = cut_lineage(keys)  # at most a row for each cutoff
    whole_keys = keys.select(F.explode("_ns").alias("top_n"), "n", "n_before", (c("bads_before") + c("bads")).alias("bads_caught")).where(c("top_n") == c("n_before") + c("n"))
    parted = keys.select("_key", c("n_before").alias("_n"), c("bads_before").alias("_bads"), F.filter("_ns", lambda k: k < c("n_before") + c("n")).alias("_ns")).where(F.size("_ns") > 0)
    inside = cut_lineage(rows.join(F.broadcast(parted), "_key"))
    inside = running_sums(inside.select("_key", "_tie", "n", "bads"), ["_tie"], ["n", "bads"], keys=["_key"], merge=False).join(F.broadcast(parted), "_key")
    at = inside.where(F.array_contains("_ns", c("_n") + c("n_before") + 1)).select(
        (c("_n") + c("n_before") + 1).alias("top_n"), (c("_bads") + c("bads_before") + c("bads")).alias("bads_caught"))
    caught = whole_keys.select("top_n", "bads_caught").unionByName(at)
    return points.join(F.broadcast(caught), "top_n", "left").fillna(0, ["bads_caught"])


def capture_curve(queue: DataFrame, scored: DataFrame, id_col: str = "application_id") -> DataFrame:
    """Share of bads found when reviewing 10%..100% of the queue."""
    cuts = F.transform(F.sequence(F.lit(10), F.lit(100), F.lit(10)), lambda p: F.struct(
        p.alias("review_pct"), F.floor(c("n_queue") * p / 100).alias("top_n")))
    t = _cutoffs(queue, scored, cuts, id_col)
    return t.select(
        c("cut.review_pct").alias("review_pct"), c("top_n").alias("loans_reviewed"),
        c("bads_caught").alias("defaults_captured"),
        F.round(F.coalesce(F.try_divide(c("bads_caught") * 100.0, c("queue_bads")), F.lit(0.0)), 1).alias("capture_pct_of_review_bads"),
        F.round(F.coalesce(F.try_divide(c("bads_caught") * 100.0, c("portfolio_bads")), F.lit(0.0)), 1).alias("capture_pct_of_all_bads"))


def cutoff_table(queue: DataFrame, scored: DataFrame, daily_reviews: int = 20, id_col: str = "application_id") -> DataFrame:
    """Efficiency of reviewing the top N, N in a fixed list and the whole queue, without repeats."""
    fixed = F.array(*[F.lit(n).cast("bigint") for n in K.REVIEW_CUTOFFS])
    ns = F.array_distinct(F.concat(F.transform(fixed, lambda n: F.least(n, c("n_queue"))), F.array("n_queue")))
    t = _cutoffs(queue, scored, F.transform(ns, lambda n: F.struct(n.alias("top_n"))), id_col)
    share = lambda a, b: F.round(F.coalesce(F.try_divide(a * 100.0, b), F.lit(0.0)), 1)
    return t.select(
        "top_n", share(c("top_n"), c("n_queue")).alias("pct_of_queue"), "bads_caught",
        share(c("bads_caught"), c("queue_bads")).alias("capture_rate_review"),
        share(c("bads_caught"), c("portfolio_bads")).alias("capture_rate_all"),
        share(c("bads_caught"), c("top_n")).alias("precision"),
        share(c("top_n") - c("bads_caught"), c("top_n")).alias("false_positive_rate"),
        F.ceil(c("top_n") / daily_reviews).cast("bigint").alias("days_at_capacity"))


def tier_plan(queue: DataFrame, scored: DataFrame, daily_reviews: int = 20) -> DataFrame:
    """Per-tier and cumulative work and capture, with the recommended tiers marked.

    Urgent and high are always wanted, others from the portfolio bad rate on, as long
    as the cumulative days stay within a quarter; if none fits, the first tier is taken."""
    portfolio = scored.agg(F.sum(c("is_bad").cast("bigint"))).scalar()
    t = tier_breakdown(queue).where("n > 0").select("tier_order", c("review_tier").alias("tier"), "n", "bads")
    run = W.orderBy("tier_order").rowsBetween(W.unboundedPreceding, 0)   # at most four rows
    every = W.partitionBy(F.lit(1))
    t = t.withColumns({
        "bad_rate": F.round(c("bads") * 100.0 / c("n"), 1),
        "days_needed": F.ceil(c("n") / daily_reviews).cast("bigint"), "portfolio_bads": portfolio})
    t = t.withColumns({
        "cumulative_loans": F.sum("n").over(run), "cumulative_defaults": F.sum("bads").over(run),
        "cumulative_days": F.sum("days_needed").over(run), "queue_bads": F.sum("bads").over(every)})
    wanted = (c("tier").isin("urgent", "high") | (c("bad_rate") / 100 >= K.PORTFOLIO_BAD_RATE)) & (c("cumulative_days") <= K.MAX_CLEAR_DAYS)
    t = t.withColumn("recommended", wanted.cast("int"))
    none = (F.sum("recommended").over(every) == 0) & (F.row_number().over(W.orderBy("tier_order")) == 1)
    share = lambda a, b: F.round(F.coalesce(F.try_divide(a * 100.0, b), F.lit(0.0)), 1)
    return t.select(
        "tier", c("n").alias("loans"), c("bads").alias("defaults"), "bad_rate", "days_needed", "cumulative_loans",
        "cumulative_defaults", "cumulative_days",
        share(c("cumulative_defaults"), c("queue_bads")).alias("cumulative_capture_of_review_bads"),
        share(c("cumulative_defaults"), c("portfolio_bads")).alias("cumulative_capture_of_all_bads"),
        F.when(none, 1).otherwise(c("recommended")).alias("recommended"))


def capacity_plan(queue: DataFrame, scored: DataFrame, daily_reviews: int = 20) -> DataFrame:
    """One row: recommended tiers and cutoff with the expected catch, precision and days. The ranked queue is written once for its readers."""
    queue = cut_lineage(queue.drop("review_reasons"))
    totals = queue.agg(F.struct(F.count("*").alias("n"), F.sum(c("is_bad").cast("bigint")).alias("bads"))).scalar()
    portfolio = scored.agg(F.sum(c("is_bad").cast("bigint"))).scalar()
    p = tier_plan(queue, scored, daily_reviews)
    # the recommended tiers lie in queue order; the deepest one sets the cutoff
    r = p.where("recommended = 1").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cumulative_loans", "tier"))), lambda s: s["tier"]), "|").alias("recommended_tiers"),
        F.max("cumulative_loans").alias("loans_to_review"),
        F.max("cumulative_defaults").alias("expected_defaults_caught"))
    r = r.withColumns({"t": totals, "portfolio_bads": portfolio})
    n, bads = c("loans_to_review"), c("expected_defaults_caught")
    share = lambda a, b: F.round(F.coalesce(F.try_divide(a * 100.0, b), F.lit(0.0)), 1)
    return r.select(
        "recommended_tiers", "loans_to_review", "expected_defaults_caught", c("t.n").alias("total_in_queue"),
        F.ceil(n / daily_reviews).cast("bigint").alias("days_to_clear_queue"),
        F.ceil(c("t.n") / daily_reviews).cast("bigint").alias("days_to_clear_full_queue"),
        share(bads, c("t.bads")).alias("expected_default_capture_rate"),
        share(bads, c("portfolio_bads")).alias("expected_all_bads_capture_rate"),
        share(n - bads, n).alias("expected_false_positive_rate"), share(bads, n).alias("expected_precision"))

"""Portfolio run: score everything once, then report from the written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import display, grade_letter
from ..operators import summary
from ..operators.enrich import compare_production
from ..operators.labels import moment
from ..operators.metrics import calibration, decile_lift, ranking
from ..session import compiled

SCORES = ("fraud_score", "pd", "woe_pd", "rule_pd", "xgb_pd", "pricing_tier")


def write_scored(scored: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Materialise a scored frame and return its path.

    A score is a deep expression. Filtering on it lazily would copy that expression
    into the pushed predicate many times over, so the reports read a written table."""
    w = scored.write.mode("overwrite")
    with compiled(scored.sparkSession):
        (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return path


def scored_table(scored: DataFrame) -> DataFrame:
    """Scores with context, production reference and comparison flags."""
    df = scored.withColumns({"decision": display(F.col("decision")),
                             "production_grade_letter": grade_letter(F.col("production_grade"))})
    df = compare_production(df, F.col("grade"), F.col("production_grade_letter"))
    entity = [k for k in ("has_prior_bad", "is_repeat", "is_cross_entity", "prior_bad_ssn") if k in df.columns]
    return df.select("application_id", "signing_date", "loan_state", "is_bad", "decision", "fraud_score", "fraud_normalized",
                     "fraud_decision", "pd", "default_score", "woe_pd", "rule_pd", "xgb_pd", "grade", "pricing_tier", "fico",
                     "qi", "partner", "production_grade", "production_grade_letter", "agrees_with_production",
                     "would_have_declined", "would_have_caught", *entity)


def production_comparison(scored: DataFrame) -> DataFrame:
    """Agreement with the production grade and what our declines would have caught."""
    known = F.col("production_grade_letter").isNotNull()
    return scored.agg(
        F.avg(F.when(known, F.col("agrees_with_production").cast("double"))).alias("grade_agreement_rate"),
        F.count_if(known).alias("n_compared"), F.sum(F.col("would_have_declined").cast("bigint")).alias("would_decline"),
        F.sum(F.col("would_have_caught").cast("bigint")).alias("would_catch_defaults"),
        F.try_divide(F.sum("would_have_caught").cast("double"), F.sum("is_bad")).alias("default_capture_rate"))


def portfolio_report(scored: DataFrame, split_date: str) -> DataFrame:
    """The run report as long metrics. ``scored`` should be a written table: several
    aggregates read it."""
    at = moment(scored, split_date)
    test = scored.where(F.col("signing_date") >= at)
    data = scored.agg(F.count("*").alias("total_loans"), F.count_if(F.col("signing_date") < at).alias("train_loans"),
                      F.count_if(F.col("signing_date") >= at).alias("test_loans"), F.sum("is_bad").alias("total_bads"),
                      F.avg(F.col("is_bad").cast("double")).alias("bad_rate"))
    rates = summary.group_rates(scored, ["decision", "grade", "fraud_decision"])
    parts = [
        summary.long_metrics(data, "data"),
        summary.long_metrics(rates, "rates", ["dim", "value"]),
        summary.long_metrics(ranking(test, SCORES), "model_performance", ["name"]),
        summary.long_metrics(calibration(test, "pd"), "calibration"),
        summary.long_metrics(decile_lift(test, "pd"), "lift"),
        summary.long_metrics(production_comparison(scored), "production_comparison"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""Sinks: parquet with manifest, scored CSV, JSON reports, model state (appends: appendlog)."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.boosting import BoostedTrees
from ..operators.grading import GradeScheme
from ..operators.isotonic import IsotonicSteps
from ..operators.models import LogitModel, ScorecardModel, WoePdModel
from ..operators.woe import WoeModel


def save_with_manifest(df: DataFrame, path: str, name: str, statement: str = "") -> DataFrame:
    """Write parquet and return its manifest row: rows, columns, bytes, statement hash."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    size = spark.read.format("binaryFile").load(path + "/*.parquet").agg(F.sum("length")).scalar()
    rows = spark.read.parquet(path).agg(F.count("*").alias("row_count"))
    manifest = rows.select(F.lit(name).alias("dataset"), "row_count", F.lit(len(df.columns)).alias("column_count"),
                           size.alias("file_size_bytes"), F.substring(F.md5(F.lit(statement)), 1, 8).alias("query_hash"))
    return manifest.withColumn("saved_at", F.current_timestamp())


def write_scores(df: DataFrame, path: str, fmt: str = "csv", partition_by: str | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path)


def write_report(metrics: DataFrame, folder: str, run_date: str) -> None:
    """Long metrics (section, key, sub_key, value) as JSON lines, dated and as latest.

    NaN has no JSON form and is written as null."""
    clean = metrics.withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    lines = clean.select(F.to_json(F.struct("section", "key", "sub_key", "value"), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.mode("overwrite").text(f"{folder}/report_{run_date}")
    # the plan runs once; the second copy is made from the first
    df = metrics.sparkSession.read.text(f"{folder}/report_{run_date}")
    df.write.mode("overwrite").text(f"{folder}/report_latest")


def write_lookup_json(lookup: DataFrame, path: str) -> None:
    lookup.write.mode("overwrite").json(path)


# --- model state ----------------------------------------------------------------
def _put(spark: SparkSession, path: str, state: dict) -> None:
    spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode("overwrite").parquet(path)


def _get(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.parquet(path).first()["state"])


def save_scheme(spark: SparkSession, scheme: GradeScheme, path: str) -> None:
    _put(spark, path, asdict(scheme))


def load_scheme(spark: SparkSession, path: str) -> GradeScheme:
    s = _get(spark, path)
    return GradeScheme(s["name"], tuple(s["boundaries"]), tuple(s["grades"]), s["iv"])


def save_scorecard(spark: SparkSession, model: ScorecardModel, path: str) -> None:
    """All parameters, the trees included, as one small table."""
    _put(spark, f"{path}/params", {
        "woe": asdict(model.woe), "woe_logit": asdict(model.woe_logit), "rule_logit": asdict(model.rule_logit), "boosted": asdict(model.boosted),
        "multiplier": model.multiplier, "weights": list(model.weights), "roles": asdict(model.roles), "isotonic": asdict(model.isotonic)})


def load_scorecard(spark: SparkSession, path: str) -> ScorecardModel:
    from ..constants import PartnerRoles
    s = _get(spark, f"{path}/params")
    roles = PartnerRoles(s["roles"]["missing_qi"], s["roles"]["risky"], tuple(s["roles"]["grade_e_decline"]), s["roles"]["encoding"])
    return ScorecardModel(
        WoeModel(**s["woe"]), LogitModel(**s["woe_logit"]), LogitModel(**s["rule_logit"]), BoostedTrees(**s["boosted"]),
        IsotonicSteps(**s["isotonic"]), s["multiplier"], tuple(s["weights"]), roles)


def save_woe_pd(spark: SparkSession, model: WoePdModel, path: str) -> None:
    _put(spark, f"{path}/params", {"woe": asdict(model.woe), "logit": asdict(model.logit), "c_value": model.c_value, "isotonic": asdict(model.isotonic)})


def load_woe_pd(spark: SparkSession, path: str) -> WoePdModel:
    s = _get(spark, f"{path}/params")
    return WoePdModel(WoeModel(**s["woe"]), LogitModel(**s["logit"]), IsotonicSteps(**s["isotonic"]), s["c_value"])

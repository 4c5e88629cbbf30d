"""Equi-joins that widen the loan table, and latest-row lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K

IDENTITY_COLUMNS = (
    "prove_phone_trust_score", "prove_name_score", "prove_verified", "prove_first_name_score",
    "prove_last_name_score", "prove_address_score", "prove_dob_match", "prove_ssn_match",
    "plaid_balance", "plaid_recentNSFs", "plaid_name_match_score", "plaid_len_history",
    "taktile_status", "taktile_output", "giact_bankruptcy_count",
    "mcc_code", "mcc_sector", "shop_credit_score", "shop_qi",
)


def latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per key: ``cols`` of the row with the greatest ``newest`` tuple.

    An aggregate instead of row_number: it combines map-side, so a key with a
    third of all rows is reduced before the shuffle. NULLs in ``newest`` sort last.
    """
    pick = F.max_by(F.struct(*cols), F.struct(*newest))
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, *[F.col(f"_r.{k}").alias(k) for k in cols])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Drop duplicates on keys, keeping the row with the smallest ``order`` (deterministic)."""
    rest = [k for k in df.columns if k not in keys]
    pick = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, *[F.col(f"_r.{k}").alias(k) for k in rest])


def enrich(df: DataFrame, master: DataFrame, key: str = "loan_id", cols: Sequence[str] = IDENTITY_COLUMNS,
           order: Sequence[str] | None = None) -> DataFrame:
    """Left join the master columns that exist and are not already in df; one master row per key."""
    keep = [k for k in cols if k in master.columns and k not in df.columns]
    extra = master.select(key, *keep, *[o for o in (order or ()) if o not in keep and o != key])
    extra = first_per_key(extra, [key], order or keep).select(key, *keep)
    return df.join(extra, key, "left")


def attach_entity(df: DataFrame, entity: DataFrame, key: str = "application_id") -> DataFrame:
    """Left join entity history, unknown history is 0."""
    if "has_prior_bad" in df.columns:
        return df
    cols = [k for k in K.ENTITY_COLUMNS if k in entity.columns]
    joined = df.join(entity.select(key, *cols), key, "left")
    return joined.withColumns({k: F.coalesce(F.col(k), F.lit(0)).cast("int") for k in cols})


def attach_banking(df: DataFrame, banking: DataFrame, key: str = "revision_id") -> DataFrame:
    return df.join(banking, key, "left")


def coverage(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.count(col).alias("n_matched"),
                  (F.count(col) / F.count("*")).alias("coverage"))


def assemble_loans(loans: DataFrame, offers: DataFrame, reports: DataFrame, risk: DataFrame, stats: DataFrame,
                   dwop: DataFrame, qi_history: DataFrame, provider: str, model: str,
                   products: Sequence[str]) -> DataFrame:
    """The default-model table: loans left joined to offers, the latest bureau report with its
    score and summary, days without payment and the latest qi of the shop."""
    offer = offers.where(F.col("product_name").isin(*products)).drop("product_name")
    report = latest(reports.where(F.col("provider_type") == provider), ["target_application_id"],
                    ["fetched_at", "id"], ["id"]).select(
        F.col("target_application_id").alias("application_id"), F.col("id").alias("report_id"))
    score = risk.where(F.col("model_type") == model).select("report_id", F.col("score").cast("double").alias("fico"))
    qi = latest(qi_history, ["shop_id"], ["updated_at", "tie"], ["qi"])
    out = (loans.join(offer, "application_id", "left").join(report, "application_id", "left")
           .join(score, "report_id", "left").join(stats, "report_id", "left")
           .join(dwop, "loan_id", "left").join(qi, "shop_id", "left"))
    return out.where(F.col("fico").isNotNull()).withColumns({
        "qi": F.coalesce("qi", F.lit("MISSING")), "dwop": F.coalesce("dwop", F.lit(0))})


def not_scored(df: DataFrame, scored: DataFrame, key: str = "application_id") -> DataFrame:
    """Applications without a score yet. Ids stay on the cluster.

    They grow with the portfolio and take far more memory than the files they are read from, by which a broadcast would be chosen: they are shuffled at every size."""
    return df.join(scored.select(key).hint("merge"), key, "left_anti")


def compare_production(df: DataFrame, ours: Column, production: Column) -> DataFrame:
    """Agreement and what-if flags against the production grade."""
    declined = F.lower("decision") == "decline"
    return df.withColumns({
        "agrees_with_production": F.coalesce(ours == production, F.lit(False)).cast("int"),
        "would_have_declined": declined.cast("int"),
        "would_have_caught": (declined & (F.col("is_bad") == 1)).cast("int"),
    })

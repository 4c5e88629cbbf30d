"""Labels, censoring, splits and eligibility filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.clean import finite, flag

CENSORING = ("normal_as_good", "exclude_recent", "resolved_only", "include_all")


def in_scope(df: DataFrame, states: Sequence[str] = K.EXCLUDE_STATES) -> DataFrame:
    """Drop applications that never became loans."""
    return df.where(~F.col("loan_state").isin(*states))


def bad_state(c: Column) -> Column:
    return flag(c.isin(*K.BAD_STATES))


def with_label(df: DataFrame) -> DataFrame:
    """Add is_bad unless it is already there."""
    return df if "is_bad" in df.columns else df.withColumn("is_bad", bad_state(F.col("loan_state")))


def censor(df: DataFrame, mode: str = "normal_as_good", seasoning_days: int = 90) -> DataFrame:
    """Right-censoring policy for loans that have not resolved yet."""
    if mode not in CENSORING:
        raise ValueError(f"unknown censoring mode {mode!r}, expected one of {CENSORING}")
    resolved = F.col("loan_state").isin(*K.BAD_STATES, *K.GOOD_STATES)
    if mode == "exclude_recent":
        return df.where(resolved | (F.col("age") >= seasoning_days))
    if mode == "resolved_only":
        return df.where(resolved)
    return df


def moment(df: DataFrame, text: str, col: str = "signing_date") -> Column:
    """Literal of the column's own type: a cast on the column would block pushdown."""
    return F.lit(text).cast(df.schema[col].dataType)


def temporal_split(df: DataFrame, split_date: str = K.SPLIT_DATE) -> tuple[DataFrame, DataFrame]:
    at = moment(df, split_date)
    return df.where(F.col("signing_date") < at), df.where(F.col("signing_date") >= at)


def in_month(df: DataFrame, month: str) -> DataFrame:
    """Rows signed in YYYY-MM, as a half-open range so that parquet can prune."""
    year, mon = map(int, month.split("-"))
    start = moment(df, f"{month}-01")
    end = moment(df, f"{year + mon // 12}-{mon % 12 + 1:02d}-01")
    return df.where((F.col("signing_date") >= start) & (F.col("signing_date") < end))


def originated(df: DataFrame, product_col: str, products: Sequence[str], since: str) -> DataFrame:
    """Product, type and date predicates of the extract."""
    return df.where(F.col(product_col).isin(*products) & (F.col("signing_date") >= moment(df, since)))


def with_duration(df: DataFrame, as_of: str) -> DataFrame:
    """Survival duration in days and months, and the event flag.

    An ``event_date`` column, when present, ends the duration of bad loans."""
    end = F.to_date(F.lit(as_of))
    if "event_date" in df.columns:
        end = F.when(bad_state(F.col("loan_state")) == 1, F.coalesce(F.to_date("event_date"), end)).otherwise(end)
    days = F.datediff(end, F.to_date("signing_date"))
    return df.withColumns({"duration_days": days, "duration_months": days / K.DAYS_PER_MONTH,
                           "event": bad_state(F.col("loan_state"))})


def survival_eligible(df: DataFrame, features: Sequence[str] = ()) -> DataFrame:
    """Valid date, positive duration, known fico and complete features."""
    cond = (F.col("duration_days") > 0) & F.col("fico").isNotNull()
    return df.where(cond).dropna(subset=list(features)) if features else df.where(cond)


def horizon_counts(df: DataFrame, min_n: int = 20) -> DataFrame:
    """Loans observed at least as long as each horizon; NULL below the minimum sample."""
    aggs = []
    for m, d in zip(K.HORIZON_MONTHS, K.HORIZON_DAYS):
        seen = F.col("duration_days") >= d
        n = F.count_if(seen)
        aggs += [n.alias(f"n_{m}mo"),
                 F.when(n >= min_n, F.avg(F.when(seen, 1.0 - F.col("event")))).alias(f"actual_survival_{m}mo")]
    return df.agg(*aggs)


def in_review(df: DataFrame, col: str = "decision") -> DataFrame:
    return df.where(F.lower(col) == "review")


def finite_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & finite(F.col(c))
    return df.where(cond)

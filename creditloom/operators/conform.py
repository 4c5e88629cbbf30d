"""Schema conformance: aliases, casts, defaults, validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.clean import nan_to_null, none_text, number, text_or_null, upper_text

D, S, I, L, TS = T.DoubleType(), T.StringType(), T.IntegerType(), T.LongType(), T.TimestampType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


LOAN = _schema(("loan_id", S), ("application_id", S), ("shop_id", S), ("revision_id", S), ("signing_date", TS),
               ("loan_state", S), ("principal", D), ("partner", S), ("qi", S), ("grade", S), ("age", I),
               *[(k, D) for k in K.BUREAU_COLUMNS], ("d90", D), ("dwop", I))
ENTITY = _schema(("application_id", S), ("has_prior_bad", I), ("has_prior_paid", I), ("is_repeat", I),
                 ("is_cross_entity", I), ("prior_loans_ssn", L), ("prior_bad_ssn", L),
                 ("prior_paid_ssn", L), ("prior_shops_ssn", L))
BANKING = _schema(("revision_id", S), ("avg_balance_30d", D), ("avg_balance_60_90d", D), ("min_balance_30d", D),
                  ("max_balance_30d", D), ("negative_balance_days_90d", L), ("txn_count_total", L),
                  ("credit_txn_count_90d", L), ("credit_sum_90d", D), ("debit_txn_count_90d", L),
                  ("debit_sum_90d", D), ("nsf_count_90d", L))
PAYMENT = _schema(("loan_id", S), *[(f[0], D) for f in K.PAYMENT_FLAGS.values()], ("is_bad", I), ("signing_date", TS))
SCORED = _schema(("application_id", S), ("run_id", S), ("signing_date", TS), ("loan_state", S), ("is_bad", I),
                 ("decision", S), ("fraud_score", I), ("fraud_normalized", D), ("fraud_decision", S), ("pd", D),
                 ("default_score", I), ("woe_pd", D), ("rule_pd", D), ("xgb_pd", D), ("grade", S),
                 ("pricing_tier", I), ("fico", D), ("qi", S), ("partner", S), ("production_grade", S),
                 ("production_grade_letter", S))


def apply_aliases(df: DataFrame, aliases: dict = K.COLUMN_ALIASES) -> DataFrame:
    """Rename the first present long name to its short name, only if the short one is absent."""
    have = set(df.columns)
    renames = {}
    for short, longs in aliases.items():
        if short not in have:
            found = next((n for n in longs if n in have), None)
            if found:
                renames[found] = short
    return df.withColumnsRenamed(renames)


def cast_to(df: DataFrame, schema: T.StructType, fill_absent: bool = False) -> DataFrame:
    """Cast by declared schema: unparsable values become NULL instead of failing the job."""
    types = dict(df.dtypes)
    out = {}
    for f in schema.fields:
        if f.name not in types:
            if fill_absent:
                out[f.name] = F.lit(None).cast(f.dataType)
            continue
        col = F.col(f.name)
        if types[f.name] == "string" and f.dataType == TS:
            out[f.name] = F.try_to_timestamp(text_or_null(col))
        elif types[f.name] == "string" and f.dataType != S:
            v = number(col)
            out[f.name] = v if f.dataType == D else v.try_cast(f.dataType)
        else:
            out[f.name] = col.cast(f.dataType)
    return df.withColumns(out) if out else df


def conform(df: DataFrame, schema: T.StructType = LOAN, fill_absent: bool = False) -> DataFrame:
    """Aliases, casts, NaN to NULL, upper-case categoricals."""
    df = nan_to_null(cast_to(apply_aliases(df), schema, fill_absent))
    return df.withColumns({k: upper_text(F.col(k)) for k in ("qi", "partner") if k in df.columns})


def require_columns(df: DataFrame) -> DataFrame:
    """Batch precondition: rows and at least one fico column. Raises ValueError."""
    if not set(K.FICO_ALIASES) & set(df.columns):
        raise ValueError(f"need one of {sorted(K.FICO_ALIASES)}, got {sorted(df.columns)}")
    if df.isEmpty():
        raise ValueError("empty input")
    return df


def missing_optional(df: DataFrame) -> list[str]:
    return sorted({"qi", "shop_qi", "partner"} - set(df.columns))


def validation_errors(df: DataFrame) -> Column:
    """Array of error codes per row; empty means valid."""
    types = dict(df.dtypes)
    present = [k for k in K.FICO_ALIASES if k in types]
    errors = []
    if present:
        raw = F.coalesce(*[none_text(F.col(k).cast("string")) for k in present])
        value = raw.try_cast("double")
        known = raw.isNotNull() & ~F.coalesce(F.isnan(value), F.lit(False))
        errors.append(F.when(known & value.isNull(), "fico_not_numeric"))
        errors.append(F.when(known & ((value < K.FICO_MIN) | (value > K.FICO_MAX)), "fico_out_of_range"))
    qi_cols = [k for k in ("qi", "shop_qi") if k in types]
    if qi_cols:
        qi = F.coalesce(*[none_text(F.col(k)) for k in qi_cols])
        errors.append(F.when(~upper_text(qi).isin(*K.QI_VALUES), "qi_unknown"))
    if "partner" in types and types["partner"] != "string":
        errors.append(F.when(F.col("partner").isNotNull(), "partner_not_text"))
    fico_names = set(K.FICO_ALIASES)
    names = [n for k in K.NUMERIC_FIELDS for n in (k, *K.COLUMN_ALIASES.get(k, ()))]
    for k in dict.fromkeys(names):
        if types.get(k) == "string" and k not in fico_names:
            v = none_text(F.col(k))
            errors.append(F.when(v.isNotNull() & v.try_cast("double").isNull(), f"{k}_not_numeric"))
    return F.array_compact(F.array(*errors))


def validate(df: DataFrame) -> DataFrame:
    """Add ``errors`` and ``valid``."""
    return df.withColumn("errors", validation_errors(df)).withColumn("valid", F.size("errors") == 0)


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = validate(df)
    return checked.where("valid").drop("errors", "valid"), checked.where(~F.col("valid"))


def range_errors(df: DataFrame, ranges: dict = K.REQUEST_RANGES) -> Column:
    """Declarative request constraints as an array of ``<field>_<low|high|required>``."""
    errors = []
    for k, (low, high, required) in ranges.items():
        if k not in df.columns:
            if required:
                errors.append(F.lit(f"{k}_required"))
            continue
        v = number(F.col(k))
        if required:
            errors.append(F.when(v.isNull(), f"{k}_required"))
        if low is not None:
            errors.append(F.when(v < low, f"{k}_low"))
        if high is not None:
            errors.append(F.when(v > high, f"{k}_high"))
    return F.array_compact(F.array(*errors))


def feature_columns(df: DataFrame, feature_set: str = "full_default") -> list[str]:
    """Names of a set that the frame really has; leaky names are refused."""
    names = K.FEATURE_SETS.get(feature_set, K.FEATURE_SETS["bureau_core"])
    leaky = sorted(set(names) & set(K.LEAKY_COLUMNS))
    if leaky:
        raise ValueError(f"feature set {feature_set!r} contains leaky features: {leaky}")
    return [n for n in names if n in df.columns]


def fill_defaults(df: DataFrame, numeric: float | None = 0.0, entity: bool = True) -> DataFrame:
    """Default fill: bureau columns (created if absent), entity columns 0."""
    from .features import typed_numbers
    df = typed_numbers(df, default=numeric)
    if entity:
        df = df.withColumns({k: (F.coalesce(F.col(k), F.lit(0)) if k in df.columns else F.lit(0)).cast("int")
                             for k in K.ENTITY_COLUMNS})
    return df


def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, median) learned on a training frame."""
    from .prefix import quantiles
    return quantiles(df, cols, [0.5]).select("name", F.col("q")[0].alias("median"))


def impute_medians(df: DataFrame, train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs with the training medians (one map with len(cols) entries)."""
    m = medians(train, cols).agg(F.map_from_entries(F.collect_list(F.struct("name", "median"))).alias("m"))
    df = df.withColumn("_m", m.scalar())
    return df.withColumns({k: F.coalesce(F.col(k).cast("double"), F.element_at("_m", F.lit(k))) for k in cols}).drop("_m")


def warehouse_units(df: DataFrame) -> DataFrame:
    """Units and types of the extract: cents to dollars, MISSING qi, days without payment."""
    out = {"principal": (F.col("principal") / 100).cast("double")}
    if "qi" in df.columns:
        out["qi"] = F.coalesce("qi", F.lit("MISSING"))
    if "dwop" in df.columns:
        out["dwop"] = F.coalesce("dwop", F.lit(0))
    return df.withColumns(out)


def resolve_loan_id(df: DataFrame, *names: str, out: str = "loan_id") -> DataFrame:
    """First usable identifier as text, else 'unknown'."""
    usable = [text_or_null(F.col(n)) for n in names if n in df.columns]
    return df.withColumn(out, F.coalesce(*usable, F.lit("unknown")))



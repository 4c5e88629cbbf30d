"""Readers with declared schemas; absent optional inputs degrade to empty frames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import LOAN, SCORED, cast_to
from ..operators.labels import bad_state


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The dataset if it exists, else an empty frame of the declared schema."""
    try:
        return cast_to(spark.read.parquet(path), schema, fill_absent=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def read_scored_csv(spark: SparkSession, path: str, prefix: str = "our_", schema: T.StructType = SCORED) -> DataFrame:
    """Scored CSV: declared types by header name, prefix stripped, is_bad derived if absent."""
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    df = raw.withColumnsRenamed({k: k[len(prefix):] for k in raw.columns if k.startswith(prefix)})
    df = cast_to(df, schema)
    if "is_bad" not in df.columns and "loan_state" in df.columns:
        df = df.withColumn("is_bad", bad_state(F.col("loan_state")))
    return df


def latest_file(spark: SparkSession, glob: str, fmt: str = "csv") -> str | None:
    """Path of the newest file that matches (by modification time, then name); listing only."""
    files = spark.read.format("binaryFile").load(glob).select("path", "modificationTime")
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    return row["p"] if row else None


def latest_partition(df: DataFrame, col: str = "run_date") -> DataFrame:
    """Rows of the greatest partition value; the scalar becomes a pruned partition filter."""
    return df.where(F.col(col) == df.agg(F.max(col)).scalar())


def run_sql(spark: SparkSession, statement: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run a warehouse statement in-process; ``{name}`` placeholders take frames."""
    return spark.sql(statement, **(tables or {}))


def read_lookup_json(spark: SparkSession, path: str) -> DataFrame:
    """Keyed entity lookup from JSON lines {key, has_prior_bad, connected_count, ...}."""
    schema = "key string, has_prior_bad int, connected_count bigint, connected_loans bigint, is_repeat int, is_cross_entity int"
    return spark.read.schema(schema).json(path)


def load_loans(spark: SparkSession, path: str) -> DataFrame:
    from ..operators.conform import conform
    return conform(spark.read.parquet(path), LOAN)

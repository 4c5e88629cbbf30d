"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query, with its DuckDB twin where SQL can express it."""
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: lineage ends here and any executor can reread it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stash_path = path
    return out


def unstash(df: DataFrame | None) -> None:
    """Delete what stash() wrote, once nothing reads it any more."""
    path = getattr(df, "_stash_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def with_column_batches(df: DataFrame, fn: Callable[[list], list], source: str, into: str, kind: T.DataType) -> DataFrame:
    """df with column `into`, made by fn from lists of the values of `source` inside tasks.

    All other columns pass through untouched; an input column named like `into` is replaced.
    """
    keep = [c for c in df.columns if c != into]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(into, kind, True)])
    arrow_kind = arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            made = pa.array(fn(batch.column(names.index(source)).to_pylist()), type=arrow_kind)
            yield pa.RecordBatch.from_arrays([batch.column(names.index(c)) for c in keep] + [made], names=keep + [into])

    return df.mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)

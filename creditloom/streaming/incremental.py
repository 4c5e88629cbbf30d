"""Incremental scoring: new applications only, exactly one scored row per application.

Each micro-batch stages its scores, its run log and its running totals and publishes
them with one marker of the append log, so a batch that fails half way leaves nothing
and a replayed one changes nothing. The anti join against
the scored table reads one narrow column, the ids of every batch: an application
may come back with another signing date, or with none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.enrich import attach_entity, not_scored
from ..operators.metrics import confusion, decile_lift, expected_calibration_error, label_agreement, ranking
from ..operators.summary import run_log
from ..sources.appendlog import AppendLog
from .totals import add_totals, batch_totals, cumulative_metrics

MIN_METRIC_ROWS = 50


@dataclass(frozen=True)
class LiveTables:
    """Folders of the scored table and the run log; the append log of both and of the running totals is kept beside the scores."""

    scored: str
    log: str

    @property
    def totals(self) -> str:
        return f"{self.scored}_totals"

    def commits(self, spark: SparkSession) -> AppendLog:
        return AppendLog(spark, f"{self.scored}_commits")

    def read(self, spark: SparkSession, which: str = "scored", before: int | None = None, only: str | None = None) -> DataFrame | None:
        """The committed rows of a table, or None on the first run."""
        return self.commits(spark).read(getattr(self, which), which, before, only)


def _month(col: str = "signing_date"):
    return F.date_format(col, "yyyy-MM")


def latest(batch: DataFrame, key: str = "application_id") -> DataFrame:
    """One row per application: the one signed last; among those, the first by a hash of all its columns, then by the columns.

    The row is shuffled once, as the last part of what orders it."""
    texts = F.struct(*[F.col(k).cast("string").alias(k) for k in sorted(batch.columns)])
    signed = F.coalesce(F.col("signing_date").cast("timestamp"), F.lit("0001-01-01").cast("timestamp"))
    last = F.max(F.struct(signed, F.xxhash64(texts), F.struct(*batch.columns).alias("row")))
    return batch.groupBy(key).agg(last.alias("_last")).select("_last.row.*")


def only_new(batch: DataFrame, scored: DataFrame | None, batch_id: int, key: str = "application_id") -> DataFrame:
    """One row per application of the batch that no earlier batch has scored."""
    batch = latest(batch, key)
    if scored is None:
        return batch
    return not_scored(batch, scored.where(F.col("batch_id") != batch_id), key)


def batch_metrics(batch: DataFrame, min_rows: int = MIN_METRIC_ROWS) -> DataFrame:
    """Metrics of one batch as one row; NULL unless it has enough rows and both classes.

    Flagged means not approved."""
    r = ranking(batch, ["pd"]).select("n_obs", "n_bad", "auc", "average_precision")
    flagged = F.lower("decision") != "approve"
    m = confusion(batch, flagged).select("mcc", "kappa", "f2")
    ece = expected_calibration_error(batch, "pd").select("ece").scalar()
    lift = decile_lift(batch, "pd").select("lift_top").scalar()
    one = r.withColumns({"m": m.select(F.struct("mcc", "kappa", "f2")).scalar(), "ece": ece, "lift": lift})
    if "production_grade_letter" in batch.columns:
        k = label_agreement(batch, "production_grade_letter", "grade")
        one = one.withColumn("k", k.select(F.when(F.col("n_compared") > min_rows, F.col("kappa"))).scalar())
    else:
        one = one.withColumn("k", F.lit(None).cast("double"))
    ok = (F.col("n_obs") > min_rows) & (F.col("n_bad") > 0) & (F.col("n_bad") < F.col("n_obs"))
    named = {"auc_this_batch": "auc", "avg_precision_this_batch": "average_precision", "mcc_this_batch": "m.mcc",
             "kappa_decision_vs_default": "m.kappa", "f2_this_batch": "m.f2", "ece_this_batch": "ece",
             "lift_top_decile": "lift", "kappa_shadow_vs_prod_grade": "k"}
    return one.select(*[F.when(ok, F.round(v, 2 if k == "lift_top_decile" else 4)).alias(k) for k, v in named.items()])


def score_batch(batch: DataFrame, batch_id: int, tables: LiveTables, score: Callable[[DataFrame], DataFrame],
                entity: DataFrame | None = None, version: str = "six-rules") -> None:
    """One micro-batch: anti join, score, stage, log, commit. Safe to run twice for the same batch id."""
    spark = batch.sparkSession
    sink = tables.commits(spark)
    if sink.has(batch_id):
        return
    scored = tables.read(spark)
    new = only_new(batch, scored, batch_id)
    if entity is not None:
        new = attach_entity(new, entity)
    out = score(new).withColumn("signing_month", _month())
    path = sink.stage(out, tables.scored, batch_id, "signing_month")
    schema = out.schema
    try:
        written = spark.read.schema(schema).parquet(path)
        n_new = written.count()
    except AnalysisException:
        written, n_new = spark.createDataFrame([], schema), 0
    total = F.lit(batch.count()).cast("bigint")
    before = scored.count() if scored is not None else 0
    log = run_log(written, str(batch_id), total, F.lit(before + n_new).cast("bigint"), version)
    if n_new:
        log = log.withColumn("_m", batch_metrics(written).select(F.struct("*")).scalar()).select("*", "_m.*").drop("_m")
    folders = {"scored": path}
    if "is_bad" in schema.names:
        # the last committed totals hold all batches before this one
        last = max((int(t) for t in sink.commits()), default=-1)
        seen = tables.read(spark, "totals", only=str(last)) if last >= 0 else None
        folders["totals"] = sink.stage(add_totals(seen, batch_totals(written)), tables.totals, batch_id)
        sums = cumulative_metrics(spark.read.parquet(folders["totals"]))
        log = log.withColumn("_c", sums.select(F.struct("*")).scalar()).select("*", "_c.*").drop("_c")
    folders["log"] = sink.stage(log.withColumn("run_timestamp", F.current_timestamp()), tables.log, batch_id)
    sink.commit(batch_id, folders)


def start(stream: DataFrame, tables: LiveTables, score: Callable[[DataFrame], DataFrame], checkpoint: str,
          entity: DataFrame | None = None, every: str | None = "15 minutes"):
    """Start the query; ``every=None`` processes what is available and stops."""
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, i: score_batch(df, i, tables, score, entity)))
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    return w.start()


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)

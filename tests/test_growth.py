"""Steps whose cost at size was a finding: what is carried, how often an input is read, and the same results."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from checks import frames as fr
from creditloom.functions.clean import half_up
from creditloom.operators import metrics, payments, review, survival
from creditloom.session import compiled
from creditloom.sources import fixtures as fx
from creditloom.sources.appendlog import AppendLog
from creditloom.streaming import incremental


def test_scored_table_leaves_model_inputs_out(spark, sf):
    t = fr.scored_table(spark, sf)
    assert t.columns == list(fr.SCORED)
    assert t.count() == fr.feature_table(spark, sf).count()


def test_cutoffs_divide_ties_by_id(spark):
    rng = np.random.default_rng(3)
    n = 400
    pdf = pd.DataFrame({"application_id": rng.permutation(n) + 7, "review_tier": rng.choice(["urgent", "high", "low"], n),
                        "composite_risk_score": rng.choice([0.1, 0.5, 0.9], n), "is_bad": rng.integers(0, 2, n)})
    tier = pdf.review_tier.map(review.TIER_ORDER)
    order = pdf.assign(k=tier * 4.0 - pdf.composite_risk_score).sort_values(["k", "application_id"])
    bads = order.is_bad.cumsum().to_numpy()
    queue = spark.createDataFrame(pdf)
    got = {r.review_pct: (r.loans_reviewed, r.defaults_captured) for r in review.capture_curve(queue, queue).collect()}
    assert got == {p: (n * p // 100, int(bads[n * p // 100 - 1])) for p in range(10, 101, 10)}
    cut = {r.top_n: r.bads_caught for r in review.cutoff_table(queue, queue).collect()}
    assert set(cut) == {10, 25, 50, 100, 200, 400} and all(v == bads[k - 1] for k, v in cut.items())
    small = {r.review_pct: r.defaults_captured for r in review.capture_curve(queue.where("application_id < 12"), queue).collect()}
    assert small[10] == 0 and len(small) == 10


def test_cox_fit_computes_its_rows_once(spark):
    rng = np.random.default_rng(4)
    n = 300
    df = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=n), "duration_days": rng.integers(1, 90, n), "event": rng.integers(0, 2, n)}))
    seen = spark.sparkContext.accumulator(0)

    def look(v):
        seen.add(1)
        return v

    train = df.withColumn("x", F.udf(look, "double")("x"))
    m = survival.fit_cox(train, ["x"])
    assert seen.value == n
    survival.fit_hazard_tiers(m, train)
    assert seen.value == 2 * n


def test_half_up_is_round(spark):
    rng = np.random.default_rng(5)
    odd = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 0.5, -0.5, 2.5, -2.5, 0.49999999999999994, 4503599627370497.5, 1e300, 0.0000005, 0.1234565, 1.005, 2.675]
    values = odd + rng.uniform(-1, 1, 5000).tolist() + rng.uniform(-1e12, 1e12, 5000).tolist() + (rng.integers(0, 10**9, 5000) / 2).tolist() + rng.uniform(0, 1, 5000).round(7).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 4, 6):
        assert df.where(~F.round("v", digits).eqNullSafe(half_up(F.col("v"), digits))).isEmpty()


def test_scores_alone_write_no_features(spark, sf):
    other = f"{sf}/"  # the same tables under a path that no test has read from
    t = fr.scored_table(spark, other)
    assert (spark.sparkContext.applicationId, other, "features") not in fr._TABLES
    fr.feature_table(spark, sf)
    written = fr.scored(spark, sf).select(*fr.SCORED)  # from the written features
    assert t.exceptAll(written).isEmpty() and written.exceptAll(t).isEmpty()


def test_payment_table_leaves_texts_out(spark, sf):
    assert fr.payment_table(spark, sf).columns == list(fr.PAID)


def test_payments_are_summed_in_their_order(spark, sf):
    """Three passes over a loan's payments, then sums without a table of the loans."""
    with compiled(spark):
        plan = payments.payment_features(fx.payments(spark, sf), fx.PAYMENT_ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 3 and plan.count("SortAggregate") == 1 and "HashAggregate" not in plan


def test_ranking_reads_its_rows_once(spark):
    rng = np.random.default_rng(6)
    n = 500
    df = spark.createDataFrame(pd.DataFrame({"s": rng.integers(0, 50, n).astype(float), "is_bad": rng.integers(0, 2, n)}))
    seen = spark.sparkContext.accumulator(0)

    def look(v):
        seen.add(1)
        return v

    metrics.ranking(df.withColumn("s", F.udf(look, "double")("s")), ["s"]).collect()
    assert seen.value == n


def test_ids_of_scored_applications_are_not_broadcast(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("application_id"), F.lit(0).alias("batch_id")).write.parquet(str(tmp_path / "s"))
    batch = spark.range(50, 150).select(F.col("id").alias("application_id"), F.lit("2024-01-01").cast("date").alias("signing_date"))
    new = incremental.only_new(batch, spark.read.parquet(str(tmp_path / "s")), 1)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(r.application_id for r in new.collect()) == list(range(100, 150))


def test_staged_rows_of_a_month_are_one_file(spark, tmp_path):
    """Not one for each task that holds some of them: every reader lists the files on the driver."""
    rows = spark.range(0, 1000, 1, 8).withColumn("month", F.col("id") % 10)
    path = AppendLog(spark, str(tmp_path / "log")).stage(rows, str(tmp_path / "t"), 0, "month")
    got = spark.read.parquet(path)
    assert len(got.inputFiles()) == 10
    assert got.exceptAll(rows.withColumn("month", F.col("month").cast("int"))).isEmpty() and got.count() == 1000


def test_an_arrival_is_one_batch_however_many_files(spark, sf, monkeypatch):
    from __spark_entry__ import queries
    seen = []

    def note(batch, i, tables, score, entity):
        seen.append(batch.select(F.input_file_name()).distinct().count())
        sink = tables.commits(batch.sparkSession)
        sink.commit(i, {"scored": sink.stage(batch.select("application_id", *[F.lit(0).alias(k) for k in ("pd", "grade", "decision", "fraud_decision")]), tables.scored, i)})

    monkeypatch.setattr(incremental, "score_batch", note)
    many = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in many}
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        queries()["incremental_scoring"](spark, sf)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(seen) == 3 and sum(seen) > 24


def test_latest_row_is_shuffled_once(spark):
    rng = np.random.default_rng(7)
    n = 600
    rows = spark.createDataFrame(pd.DataFrame({"application_id": rng.integers(0, 60, n), "day": rng.integers(0, 4, n), "fico": rng.integers(400, 900, n).astype(float), "qi": rng.choice(["HFHT", "LFLT"], n)}))
    rows = rows.select("application_id", "fico", "qi", F.when(F.col("day") > 0, F.date_add(F.lit("2024-01-01").cast("date"), F.col("day").cast("int"))).alias("signing_date"))
    one = incremental.latest(rows)
    plan = one._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("max") == 1 and "max_by" not in plan.toString()
    texts = F.struct(*[F.col(k).cast("string").alias(k) for k in sorted(rows.columns)])
    order = F.struct(F.coalesce(F.col("signing_date").cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), F.xxhash64(texts), texts)
    want = rows.groupBy("application_id").agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
    assert one.columns == rows.columns and one.count() == 60
    assert one.exceptAll(want).isEmpty() and want.exceptAll(one).isEmpty()

"""Incremental scoring: once per application, safe to replay, first run, empty runs."""

from pyspark.sql import functions as F

from creditloom.streaming import incremental


def _score(df):
    return df.withColumns({"pd": F.col("application_id") / 1000.0, "grade": F.lit("A"), "decision": F.when(F.col("application_id") % 5 == 0, "Decline").otherwise("Approve")})


def _apps(spark, lo, hi):
    return spark.range(lo, hi).select(F.col("id").alias("application_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 86400).alias("signing_date"),
                                      (F.col("id") % 7 == 0).cast("int").alias("is_bad"))


def test_batches_replay_and_log(spark, tmp_path):
    t = incremental.LiveTables(str(tmp_path / "s"), str(tmp_path / "l"))
    assert t.read(spark) is None
    incremental.score_batch(_apps(spark, 0, 120), 0, t, _score)
    incremental.score_batch(_apps(spark, 60, 180).unionByName(_apps(spark, 170, 180)), 1, t, _score)
    incremental.score_batch(_apps(spark, 60, 180), 1, t, _score)      # replay of the same batch
    incremental.score_batch(_apps(spark, 0, 50), 2, t, _score)        # nothing new
    got = t.read(spark)
    assert got.count() == 180 and got.select("application_id").distinct().count() == 180
    log = {r.batch_id: r for r in t.read(spark, "log").collect()}
    assert [log[i].new_scored for i in range(3)] == [120, 60, 0]
    assert [log[i].status for i in range(3)] == ["OK", "OK", "NO_NEW_DATA"]
    assert [log[i].cumulative_scored for i in range(3)] == [120, 180, 180]
    assert log[0].auc_this_batch is not None


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    _apps(spark, 0, 300).repartition(3).write.parquet(src)
    t = incremental.LiveTables(str(tmp_path / "s"), str(tmp_path / "l"))
    stream = incremental.read_stream(spark, src, spark.read.parquet(src).schema)
    q = incremental.start(stream, t, _score, str(tmp_path / "c"), every=None)
    q.awaitTermination()
    want = _score(_apps(spark, 0, 300)).select("application_id", "pd", "decision")
    assert t.read(spark).select("application_id", "pd", "decision").exceptAll(want).isEmpty()
    assert t.read(spark).count() == 300


def test_append_log_survives_failed_and_replayed_writes(spark, tmp_path):
    import pytest

    from creditloom.sources.appendlog import AppendLog
    log, table = AppendLog(spark, str(tmp_path / "log")), str(tmp_path / "rows")
    rows = spark.range(100).repartition(4)
    assert log.read(table) is None and log.append(rows.where("id < 10"), table, 0)
    broken = rows.where("id >= 10").withColumn("id", F.when(F.col("id") == 97, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception):
        log.append(broken, table, 1)                     # half of it may be written
    log.stage(rows.where("id >= 10"), table, 1)          # all written, the writer dies before the marker
    assert log.read(table).count() == 10 and not log.has(1)
    assert log.append(rows.where("id >= 10"), table, 1)  # replay
    assert not log.append(rows.where("id >= 10"), table, 1) and not log.commit(1, {})
    assert sorted(r.id for r in log.read(table).collect()) == list(range(100))
    assert log.read(table, before=1).count() == 10
    assert log.vacuum(table, 2**60) >= 1 and log.read(table).count() == 100


def test_cumulative_metrics_equal_those_of_the_union(spark, tmp_path):
    from creditloom.operators.metrics import confusion, expected_calibration_error, ranking
    from creditloom.streaming.totals import add_totals, batch_totals, cumulative_metrics
    rows = _score(_apps(spark, 0, 300)).withColumn("is_bad", F.when(F.col("application_id") < 290, F.col("is_bad")))
    seen = None
    for i in range(3):
        seen = add_totals(seen, batch_totals(rows.where(F.col("application_id") % 3 == i)))
    got, known = cumulative_metrics(seen).first(), rows.where("is_bad is not null")
    want, four = ranking(known, ["pd"]).first(), confusion(known, F.lower("decision") != "approve").first()
    assert got.n_cumulative == 290 and abs(got.auc_cumulative - want.auc) < 1e-12 and abs(got.avg_precision_cumulative - want.average_precision) < 1e-12
    assert abs(got.mcc_cumulative - four.mcc) < 1e-12 and abs(got.ece_cumulative - expected_calibration_error(known, "pd").first().ece) < 1e-12


_START = 1_700_006_400  # a day's first second


def _replayed(spark, rows, schema, time, tmp_path):
    """One file for each list of rows, read one after another."""
    for i, part in enumerate(rows):
        df = spark.createDataFrame(part, schema)
        df.withColumn(time, F.timestamp_seconds(time)).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i:03}"))
    schema = spark.read.parquet(str(tmp_path / "in" / "000")).schema
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_streaks_and_sessions_free_their_state(spark, tmp_path):
    from checks.q_streams import drain
    from creditloom.streaming.stateful import account_activity
    d = 86400
    at = lambda day, sec=0: _START + day * d + sec
    batches = [
        [(1, at(0, 50), 2, 1, 5.0), (1, at(0, 10), 1, 0, 1.0), (2, at(0, 5), 3, 1, 1.0), (1, at(1, 20), 4, 1, 1.0)],
        # out of order but in time: the streak of account 1 is joined from three files
        [(1, at(0, 80), 5, 1, 2.0), (1, at(1, 90), 6, 0, 1.0), (2, at(1, 5), 7, 1, 1.0)],
        [(1, at(2, 5), 8, 1, 1.0), (2, at(2, 5), 9, 1, 1.0)],
        [(None, at(100), 10, 0, 0.0)],
        [(None, at(101), 13, 0, 0.0)],
        [(1, at(1), 11, 1, 9.0)],  # all slices up to it are given out: dropped
        [(None, at(300), 12, 0, 0.0)],
    ]
    stream = _replayed(spark, batches, "account long, date long, event_id long, returned int, amount double", "date", tmp_path)
    out, progress = drain(account_activity(stream, gap_days=1.5, idle_days=3, late="1 day"), str(tmp_path / "run"))
    got = {(r.account, r.kind, r.start_us // 10**6 - _START, r.end_us // 10**6 - _START, r.n) for r in out.where("account is not null").collect()}
    assert got == {(1, "streak", 50, d + 20, 3), (2, "streak", 5, 2 * d + 5, 3), (1, "session", 10, 2 * d + 5, 6), (2, "session", 5, 2 * d + 5, 3)}
    assert sum(o.numRowsDroppedByWatermark for p in progress for o in p.stateOperators) == 1
    # the last silence of the flushing rows is all that is left
    assert max(o.numRowsTotal for o in progress[-1].stateOperators) <= 3


def test_breakers_count_late_rows_and_free_their_state(spark, tmp_path):
    from checks.q_streams import drain
    from creditloom.streaming.stateful import breakers_of_totals, late_rows, window_totals
    d = 86400
    row = lambda day, decision="approve", pd=0.1: (_START + day * d + 60, decision, pd)
    batches = [[row(0), row(0, "Review", 0.3)], [row(1), row(0, "decline", 0.2), row(0, None, None)], [row(5)], [row(0), row(0, "decline"), row(5)], [row(50)]]
    stream = _replayed(spark, batches, "scored_at long, decision string, pd double", "scored_at", tmp_path)
    totals, progress = drain(window_totals(stream, width="1 day", late="1 hour"), str(tmp_path / "run"))
    found = {(r.window_start.timestamp() // d, r.metric): r.value for r in breakers_of_totals(totals).collect()}
    day = _START // d
    assert {k[0] - day for k in found} == {0, 1, 5} and found[day, "approve_rate"] == 0.25 and found[day, "mean_pd"] == 0.2
    assert [(r.n_final, r.n_late) for r in late_rows(totals).collect()] == [(4, 2)]
    assert {(r.window_start.timestamp() // d - day): r.value for r in breakers_of_totals(totals, with_late=True).where("metric = 'decline_rate'").collect()}[0] == round(2 / 6, 4)
    states = [o.numRowsTotal for p in progress for o in p.stateOperators]
    assert max(states) <= 12 and states[-1] <= 4


def test_activity_is_kept_by_shard_and_read_by_many_tasks(spark, tmp_path):
    from checks.q_streams import drain, replay
    from creditloom.streaming.stateful import account_activity
    events = spark.range(0, 240, 1, 3).select((F.col("id") % 40 + 2**53).alias("account"), F.timestamp_seconds(F.lit(_START) + F.floor(F.col("id") / 80) * 86400 + F.col("id")).alias("date"),
                                              F.col("id").alias("event_id"), F.lit(1).alias("returned"), F.lit(0.5).alias("amount"))
    day = F.floor((F.unix_seconds("date") - _START) / 86400).cast("int")
    stream = replay(events, "date", day, 4, str(tmp_path / "r"))  # the fourth group has no rows
    assert {len(list(p.glob("*.parquet"))) for p in (tmp_path / "r" / "in").iterdir()} == {3}
    out, progress = drain(account_activity(stream, gap_days=1.5, idle_days=3, shards=2), str(tmp_path / "r"))
    got = {(r.account, r.kind, r.n, r.amount) for r in out.where("account is not null").collect()}
    assert got == {(2**53 + i, kind, 6, amount) for i in range(40) for kind, amount in (("streak", 0.0), ("session", 3.0))}
    kept = [o.numRowsTotal for p in progress for o in p.stateOperators if o.operatorName.startswith("transformWithState")]
    assert kept and max(kept) <= 2 * 3

"""Event-time monitors with own state: streaks and sessions of accounts, breakers per window with late rows counted.

All run in append mode. What is final is given out once the watermark has passed it, and its state is removed then; nothing is
kept for accounts and windows that are over. They need the RocksDB state store (`needs_rocksdb`).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.drift import breakers
from ..session import shuffle_width

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DAY = 86_400_000_000
#: Parts into which the accounts of an activity stream are hashed.
SHARDS = 256
ACTIVITY = "kind string, start_us long, end_us long, n long, amount double"
TOTALS = ["n", "approve", "review", "decline", "pd_sum", "pd_n"]


@contextmanager
def needs_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


# --- streaks and sessions ------------------------------------------------------------
def day_summaries(events: DataFrame, key: str, time: str, tie: str, gap_us: int, width: str = "1 day", late: str | None = "1 day") -> DataFrame:
    """(key, slice_time, runs, sessions, opens, closes): each slice of an account reduced to what its neighbours need to know.

    events holds key, time, tie, returned (0/1) and amount. An account is spread over its slices here, so one
    that has a third of all rows is no single task; a slice's events are ordered by (time, tie) inside one row.
    """
    if late and events.isStreaming:
        events = events.withWatermark(time, late)
    one = F.struct(F.unix_micros(time).alias("t"), F.col(tie).alias("id"), F.col("returned").cast("int").alias("r"), F.col("amount").cast("double").alias("a"))
    per = events.groupBy(key, F.window(time, width).alias("w")).agg(F.array_sort(F.collect_list(one)).alias("ev"))
    ev, at = F.col("ev"), lambda i: F.get(F.col("ev"), i)
    places, last = F.sequence(F.lit(0), F.size(ev) - 1), F.size(ev) - 1
    gap = lambda i: at(i)["t"] - at(i - 1)["t"] > gap_us
    run_from = F.filter(places, lambda i: (at(i)["r"] == 1) & ((i == 0) | (at(i - 1)["r"] == 0)))
    run_to = F.filter(places, lambda i: (at(i)["r"] == 1) & ((i == last) | (at(i + 1)["r"] == 0)))
    from_ = F.filter(places, lambda i: (i == 0) | gap(i))
    to = F.filter(places, lambda i: (i == last) | gap(i + 1))
    span = lambda i, j: [at(i)["t"].alias("start"), at(j)["t"].alias("end"), (j - i + 1).cast("long").alias("n")]
    return per.select(
        key, F.window_time("w").alias("slice_time"),
        F.zip_with(run_from, run_to, lambda i, j: F.struct(*span(i, j))).alias("runs"),
        F.zip_with(from_, to, lambda i, j: F.struct(*span(i, j), F.aggregate(F.slice(ev, i + 1, j - i + 1), F.lit(0.0), lambda s, x: s + x["a"]).alias("amount"))).alias("sessions"),
        (at(F.lit(0))["r"] == 1).alias("opens"), (at(last)["r"] == 1).alias("closes"))


def spans_of(days: DataFrame, key: str, shards: int) -> DataFrame:
    """(shard, account, slice_time, kind, pos, start, end, n, amount, fresh, over): a row for each session and streak of a slice.

    fresh: nothing before the slice may join it; over: nothing after it. A slice without returned events has an empty streak that is both, which
    ends the streak before it. Accounts travel as text, the missing one as ''."""
    def one(kind, s, i, amount, fresh, over):
        return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("pos"), s["start"].alias("start"), s["end"].alias("end"), s["n"].alias("n"), amount.alias("amount"),
                        F.coalesce(fresh, F.lit(True)).alias("fresh"), F.coalesce(over, F.lit(True)).alias("over"))
    sessions = F.transform("sessions", lambda s, i: one("session", s, i, s["amount"], F.lit(False), F.lit(False)))
    last = F.size("runs") - 1
    runs = F.transform("runs", lambda s, i: one("streak", s, i, F.lit(0.0), (i > 0) | ~F.col("opens"), (i < last) | ~F.col("closes")))
    at = F.get("sessions", F.lit(0))["start"]
    none = F.array(one("streak", {"start": at, "end": at, "n": F.lit(0).cast("long")}, F.lit(0), F.lit(0.0), F.lit(True), F.lit(True)))
    return days.select(F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard"), F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("account"),
                       "slice_time", F.inline(F.concat(sessions, F.when(last < 0, none).otherwise(runs))))


def joined(spans: pd.DataFrame, gap_us: int, idle_us: int) -> tuple[pd.DataFrame, pd.Series]:
    """Spans of any number of accounts with neighbours joined, and which of them may still grow: the last session of an account, and its last streak
    if nothing has ended that."""
    spans = spans.assign(code=pd.factorize(spans["account"])[0]).sort_values(["code", "kind", "start", "pos"], kind="stable")
    code, kind, start, end = (spans[k].to_numpy() for k in ("code", "kind", "start", "end"))
    fresh, over = spans["fresh"].to_numpy(bool), spans["over"].to_numpy(bool)
    new = np.ones(len(spans), bool)
    alone = (code[1:] != code[:-1]) | (kind[1:] != kind[:-1])
    new[1:] = alone | fresh[1:] | over[:-1] | (start[1:] - end[:-1] > np.where(kind[1:] == "session", gap_us, idle_us))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(spans)) - 1
    out = spans.iloc[first][["account", "kind", "start"]].assign(
        end=end[last], n=np.add.reduceat(spans["n"].to_numpy(np.int64), first), amount=np.add.reduceat(spans["amount"].to_numpy(float), first))
    ends = np.append(alone, True)
    return out, pd.Series(ends[last] & ~over[last], out.index)


class ActivityState(StatefulProcessor):
    """Joins the slices of a shard of accounts, in order: their open streaks and sessions are all that is kept, as one Arrow table, and one timer
    wakes the shard when the first of them is over."""

    FIELDS = ["account", "kind", "start", "end", "n", "amount"]

    def __init__(self, key: str, gap_us: int, idle_us: int, width_us: int, at_least: int):
        self.key, self.gap, self.idle, self.width, self.at_least = key, gap_us, idle_us, width_us, at_least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "spans binary, timer long")

    def _kept(self) -> tuple[pd.DataFrame | None, int | None]:
        if not self.open.exists():
            return None, None
        spans, timer = self.open.get()
        return pa.ipc.open_stream(bytes(spans)).read_pandas(), timer

    def _due_ms(self, spans: pd.DataFrame) -> np.ndarray:
        """End of the slice in which a span's silence is over; by then every slice up to it has come."""
        over = spans["end"].to_numpy() + np.where(spans["kind"] == "session", self.gap, self.idle)
        return (over // self.width + 1) * self.width // 1000

    def _keep(self, spans: pd.DataFrame, timer: int | None) -> None:
        due = int(self._due_ms(spans).min()) if len(spans) else None
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is None:
            self.open.clear()
            return
        if timer != due:
            self.handle.registerTimer(due)
        table = pa.Table.from_pandas(spans[self.FIELDS], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.open.update((sink.getvalue().to_pybytes(), due))

    def _rows(self, spans: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = spans[(spans["kind"] == "session") | (spans["n"] >= max(self.at_least, 1))]
        if len(rows):
            yield rows[self.FIELDS].set_axis([self.key, "kind", "start_us", "end_us", "n", "amount"], axis=1).reset_index(drop=True)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept, timer = self._kept()
        parts = list(rows) if kept is None else [kept.assign(pos=-1, fresh=False, over=False), *rows]
        found, growing = joined(pd.concat(parts, ignore_index=True), self.gap, self.idle)
        self._keep(found[growing], timer)
        yield from self._rows(found[~growing])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()  # it may have passed the ends of many at once
        kept, _ = self._kept()
        if kept is not None:
            over = self._due_ms(kept) <= now
            self._keep(kept[~over], None)
            yield from self._rows(kept[over])

    def close(self) -> None:
        pass


def account_activity(events: DataFrame, key: str = "account", time: str = "date", tie: str = "event_id", gap_days: float = 2, idle_days: float = 60,
                     at_least: int = 2, late: str = "1 day", shards: int = SHARDS) -> DataFrame:
    """Final streaks of returned payments and sessions of a stream: (key, kind, start_us, end_us, n, amount).

    A streak is a run of consecutive returned payments, ordered by (time, tie), that no silence of more than idle_days
    interrupts; a session ends with a silence of more than gap_days. Both come out when an event or the watermark has closed them.
    State is held by shard, a hash of the account: a call into Python serves all accounts of a shard. The number of shards is fixed for a checkpoint.
    """
    if min(gap_days, idle_days) <= 0 or idle_days < 1:
        raise ValueError("gap_days must be positive and idle_days at least one slice")
    gap_us, idle_us = round(gap_days * DAY), round(idle_days * DAY)
    days = day_summaries(events, key, time, tie, gap_us, "1 day", late)
    out = spans_of(days, key, shards).groupBy("shard").transformWithStateInPandas(ActivityState(key, gap_us, idle_us, DAY, at_least), f"{key} string, {ACTIVITY}", "Append", "eventTime")
    account = F.when(F.col(key) != "", F.substring(key, 2, 2**31 - 1)).cast(events.schema[key].dataType)
    return out.withColumn(key, account)


# --- breakers per window ---------------------------------------------------------------
def window_parts(scored: DataFrame, time: str = "scored_at", width: str = "1 day", slide: str | None = None) -> DataFrame:
    """(start_us, end_us, shard, totals): sums per window of what one task reads at a time, before anything is shuffled."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    d = F.lower("decision")
    rows = scored.select(w.alias("w"), *[F.coalesce((d == v).cast("long"), F.lit(0)).alias(v) for v in ("approve", "review", "decline")], F.col("pd").cast("double").alias("pd"))
    rows = rows.select(F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "approve", "review", "decline", "pd")
    shards = shuffle_width(scored.sparkSession)
    names = ["start_us", "end_us", "shard", *TOTALS]

    def run(batches):
        shard = TaskContext.get().partitionId() % shards
        for batch in batches:
            if batch.num_rows:
                t = pa.Table.from_batches([batch]).group_by(["start_us", "end_us"]).aggregate(
                    [([], "count_all"), ("approve", "sum"), ("review", "sum"), ("decline", "sum"), ("pd", "sum"), ("pd", "count")])
                sums = [t.column(c) for c in ("count_all", "approve_sum", "review_sum", "decline_sum")] + [t.column("pd_sum").fill_null(0.0), t.column("pd_count")]
                yield from pa.table([t.column("start_us"), t.column("end_us"), pa.array([shard] * t.num_rows, pa.int32())] + sums, names=names).to_batches()

    return rows.mapInArrow(run, "start_us long, end_us long, shard int, n long, approve long, review long, decline long, pd_sum double, pd_n long")


class WindowState(StatefulProcessor):
    """Totals of one window and shard until the watermark passes its end; what comes later is given out as late at once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", "n long, approve long, review long, decline long, pd_sum double, pd_n long")

    def _row(self, key, kind, totals) -> pd.DataFrame:
        return pd.DataFrame([(key[0], key[1], key[2], kind, *totals)], columns=["start_us", "end_us", "shard", "kind", *TOTALS])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))[TOTALS].sum()
        new = [float(new[c]) if c == "pd_sum" else int(new[c]) for c in TOTALS]
        end_ms = key[1] // 1000
        if end_ms <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, "late", new)
            return
        if self.totals.exists():
            new = [a + b for a, b in zip(self.totals.get(), new)]
        else:
            self.handle.registerTimer(end_ms)
        self.totals.update(tuple(new))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.totals.exists():
            row = self._row(key, "final", self.totals.get())
            self.totals.clear()
            yield row

    def close(self) -> None:
        pass


def window_totals(scored: DataFrame, time: str = "scored_at", width: str = "1 day", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Totals of each (window, shard) of a stream, kind `final` once the watermark has passed, and `late` for rows that came after that.

    Only the sums of a window are kept, split over as many shards as the shuffle has partitions. The parts carry no event-time column on
    purpose: Spark would drop late rows unseen.
    """
    parts = window_parts(scored.withWatermark(time, late), time, width, slide)
    schema = "start_us long, end_us long, shard int, kind string, n long, approve long, review long, decline long, pd_sum double, pd_n long"
    return parts.groupBy("start_us", "end_us", "shard").transformWithStateInPandas(WindowState(), schema, "Append", "eventTime")


def breakers_of_totals(totals: DataFrame, with_late: bool = False) -> DataFrame:
    """Breakers per window from the written totals: (window_start, window_end, metric, value, level, note); with_late adds the late rows."""
    rows = totals if with_late else totals.where("kind = 'final'")
    keys = ["window_start", "window_end"]
    per = rows.groupBy(F.timestamp_micros("start_us").alias(keys[0]), F.timestamp_micros("end_us").alias(keys[1])).agg(*[F.sum(c).alias(c) for c in TOTALS])
    rate = {f"{v}_rate": F.col(v) / F.col("n") for v in ("approve", "review", "decline")}
    return breakers(per.select(*keys, *[e.alias(k) for k, e in rate.items()], F.try_divide("pd_sum", "pd_n").alias("mean_pd")), keys)


def late_rows(totals: DataFrame) -> DataFrame:
    """(window_start, n_final, n_late) for every window that had late rows."""
    n = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    per = totals.groupBy(F.timestamp_micros("start_us").alias("window_start")).agg(n("final").alias("n_final"), n("late").alias("n_late"))
    return per.where("n_late > 0")

"""Streams replayed from files in event order with some disorder: streaks, sessions, breakers, late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.session import cut_lineage, scratch_path
from creditloom.sources import fixtures as fx
from creditloom.sources.appendlog import AppendLog
from creditloom.streaming import incremental, stateful

from . import frames as fr
from .base_sql import sql
from .q_models import arrivals, six_rules
from .q_rules import _SIX
from .registry import query

c = F.col
FLUSH_DAYS = 400


def utc(col):
    """A zoneless timestamp as the moment it names in UTC, whatever the session zone."""
    since = col.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros((since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("long"))


def zoneless(us):
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(us / F.lit(1_000_000)).cast("decimal(18,6)"))


def replay(df: DataFrame, time: str, file_no, n: int, root: str, last: DataFrame | None = None) -> DataFrame:
    """df as a stream of n groups of files that are read one after another; at the end come the rows `last` and one far in the future, which closes everything.

    A group is as many files as df has partitions, so no task writes or reads a group whole; empty files fill it up, for a trigger takes that many."""
    spark = df.sparkSession
    parts = df.withColumn("_no", file_no)
    far = df.agg(F.max(time).alias("_t")).select(*[(c("_t") + F.make_dt_interval(days=F.lit(FLUSH_DAYS))).alias(time) if f.name == time else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    size = parts.rdd.getNumPartitions()
    groups = [parts.where(c("_no") == i).drop("_no") for i in range(n)] + [x.coalesce(size) for x in (far, last) if x is not None]
    none = spark.createDataFrame([], df.schema)
    for i, group in enumerate(groups):
        folder = f"{root}/in/{i:03}"
        group.write.parquet(folder)
        for _ in range(size - len(spark.read.schema(df.schema).parquet(folder).inputFiles())):
            none.write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", size).parquet(f"{root}/in")


def drain(out: DataFrame, root: str) -> tuple[DataFrame, list]:
    """What the stream appends to a table until its input is used up, and the progress of its batches."""
    spark = out.sparkSession
    with stateful.needs_rocksdb(spark):
        q = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/ckpt").option("path", f"{root}/out").trigger(availableNow=True).start())
        q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(out.schema).parquet(f"{root}/out"), q.recentProgress


def bank_events(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events")
    return e.select("event_id", c("user_id").alias("account"), utc(c("ts")).alias("date"), (c("event_type") == "error").cast("int").alias("returned"), c("value").alias("amount"))


def in_disorder(time: str, tie: str, days: int = 6):
    """File of a row: its time, put off by up to 12 hours."""
    first = 1_704_067_200_000_000  # 2024-01-01
    return F.floor((F.unix_micros(time) - first + (c(tie) * 7919 % 1000) * 43_200_000) / (days * 86_400_000_000)).cast("int")


@query("activity_stream", """
with o as (select user_id as account, event_id, ts, value, case when event_type='error' then 1 else 0 end as r, lag(ts) over w as pts, lag(case when event_type='error' then 1 else 0 end) over w as pr
  from events window w as (partition by user_id order by ts, event_id)),
m as (select *, case when r=1 and (pr is null or pr=0 or ts-pts > interval 5 day) then 1 else 0 end as new_run, case when pts is null or ts-pts > interval 12 hour then 1 else 0 end as new_session from o),
g as (select *, sum(new_run) over w as run_no, sum(new_session) over w as session_no from m window w as (partition by account order by ts, event_id rows unbounded preceding))
select account, 'streak' as kind, min(ts) as start_at, max(ts) as end_at, count(*) as n, 0e0 as amount from g where r=1 group by account, run_no having count(*)>=2
union all select account, 'session', min(ts), max(ts), count(*), round(sum(value),4) from g group by account, session_no""")
def activity_stream(spark, sf):
    """Streaks of returned payments and sessions, found on the stream; rows come up to 12 hours out of order."""
    root = scratch_path(spark, "activity")
    stream = replay(bank_events(spark, sf), "date", in_disorder("date", "event_id"), 6, root)
    out, _ = drain(stateful.account_activity(stream, gap_days=0.5, idle_days=5, late="1 day"), root)
    return out.where("account is not null").select("account", "kind", zoneless(c("start_us")).alias("start_at"), zoneless(c("end_us")).alias("end_at"), "n", F.round("amount", 4).alias("amount"))


_BREAKER_SQL = """select window_start, metric, value, case when v<coalesce(fl,-1) or v<cl or v>ch then 'CRITICAL' when v<wl or v>wh then 'WARNING' else 'OK' end as level from (
 select m.*, w as window_start, case m.metric when 'approve_rate' then a when 'review_rate' then r when 'decline_rate' then d else p end as v, round(v,4) as value from (
 select make_timestamp(cast(floor(epoch(signing_date)/(30*86400)) as bigint)*30*86400*1000000) as w, avg(case when decision='approve' then 1e0 else 0 end) as a, avg(case when decision='review' then 1e0 else 0 end) as r, avg(case when decision='decline' then 1e0 else 0 end) as d, avg(pd) as p from decided group by 1) x,
 (values ('approve_rate',0.35,0.75,0.10,0.85,0.10),('review_rate',0.20,0.65,0.10,0.80,null),('decline_rate',0.01,0.15,0.0,0.25,null),('mean_pd',0.03,0.20,0.01,0.30,null)) m(metric,wl,wh,cl,ch,fl)) t"""


def _scores(spark, sf):
    return fr.scored_table(spark, sf).select("application_id", utc(c("signing_date")).alias("scored_at"), "decision", "pd")


def _file_of_year(n: int):
    """Files follow the signing dates from 1992 on."""
    return F.least(F.greatest(F.floor((F.year("scored_at") - 1992) / 2), F.lit(0)), F.lit(n - 1)).cast("int")


@query("streaming_breakers", sql(_BREAKER_SQL, "decided"))
def streaming_breakers(spark, sf):
    """The scored table replayed as a stream into 30-day event-time windows, given out once each when the watermark has passed them."""
    root = scratch_path(spark, "breakers")
    stream = replay(_scores(spark, sf), "scored_at", _file_of_year(4), 4, root)
    out, _ = drain(stateful.window_totals(stream, width="30 days", late="1 day"), root)
    found = stateful.breakers_of_totals(out)
    return found.select(zoneless(F.unix_micros("window_start")).alias("window_start"), "metric", "value", "level")


@query("late_decisions", sql("""with w as (select application_id % 50 = 0 as late, make_timestamp(cast(floor(epoch(signing_date)/(30*86400)) as bigint)*30*86400*1000000) as window_start from decided)
select window_start, count(*) filter (where not late) as n_final, count(*) filter (where late) as n_late from w group by 1 having count(*) filter (where late) > 0""".replace("with w as", "select * from (with w as") + ") t", "decided"))
def late_decisions(spark, sf):
    """Every fiftieth decision comes when all windows are closed: these rows are counted per window instead of lost."""
    root = scratch_path(spark, "late")
    df = _scores(spark, sf)
    late = c("application_id") % 50 == 0
    stream = replay(df.where(~late), "scored_at", _file_of_year(4), 4, root, last=df.where(late))
    out, _ = drain(stateful.window_totals(stream, width="30 days", late="1 day"), root)
    return stateful.late_rows(out).select(zoneless(F.unix_micros("window_start")).alias("window_start"), "n_final", "n_late")


@query("append_log", "select o_orderkey as k, o_totalprice as price, cast(o_orderkey % 4 as bigint) as batch_id from orders")
def append_log(spark, sf):
    """Four appends: one dies between staging and commit and is replayed, one is replayed after its commit."""
    root = scratch_path(spark, "append")
    log, table = AppendLog(spark, root), f"{root}/rows"
    rows = fx.table(spark, sf, "orders").select(c("o_orderkey").alias("k"), c("o_totalprice").alias("price"))
    for i in (0, 1, 2, 3):
        part = rows.where(c("k") % 4 == i)
        if i == 1:
            log.stage(part, table, i)  # the writer died here
        log.append(part, table, i)
        if i == 2:
            log.append(part, table, i)
    return log.read(table).select("k", "price", c("batch_id").cast("bigint").alias("batch_id"))


@query("live_metrics", sql("""select n_obs as n_cumulative, n_bad as n_bad_cumulative, round(auc,6) as auc, round(average_precision,6) as average_precision, (select mcc from cf) as mcc, (select ece from ec) as ece from rk""", "six", plus=_SIX + """,
h as (select pd as s, sum(is_bad) as pos, sum(1-is_bad) as neg from sixpd group by 1),
cm as (select *, sum(pos) over w as cpos, sum(neg) over w as cneg, sum(pos) over () as np, sum(neg) over () as nn from h window w as (order by s)),
rk as (select cast(max(np+nn) as bigint) as n_obs, cast(max(np) as bigint) as n_bad, sum(pos*(cneg-neg)+0.5e0*pos*neg)/(max(np)*max(nn)) as auc, sum(pos/np*((np-cpos+pos)/((np-cpos+pos)+(nn-cneg+neg)))) as average_precision from cm),
f4 as (select count(*) filter (where decision<>'approve' and is_bad=1)::double as tp, count(*) filter (where decision<>'approve' and is_bad=0)::double as fp, count(*) filter (where decision='approve' and is_bad=1)::double as fn, count(*) filter (where decision='approve' and is_bad=0)::double as tn from sixpd),
cf as (select round(coalesce((tp*tn-fp*fn)/nullif(sqrt((tp+fp)*(tp+fn)*(tn+fp)*(tn+fn)),0),0),6) as mcc from f4),
ec as (select round(sum(n*abs(y-p))/(select count(*) from sixpd),6) as ece from (select floor(pd*10+1e-12) as b, count(*) as n, avg(is_bad) as y, avg(pd) as p from sixpd where pd<1 group by 1) t)"""))
def live_metrics(spark, sf):
    """Applications scored in several micro-batches; the last batch's cumulative metrics are those of all of them."""
    root = scratch_path(spark, "live")
    apps = fr.scope(spark, sf)
    for i in range(3):
        apps.where(c("application_id") % 3 == i).write.parquet(f"{root}/in/f{i}")
    tables = incremental.LiveTables(f"{root}/scored", f"{root}/log")
    entity = cut_lineage(fr.history(spark, sf))  # a written side table: each batch reads it
    q = incremental.start(arrivals(spark, f"{root}/in", 3), tables, six_rules, f"{root}/ckpt", entity=entity, every=None)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    last = tables.read(spark, "log").orderBy(F.desc(c("batch_id").cast("int"))).limit(1)
    return fr.rounded(last.select("n_cumulative", "n_bad_cumulative", c("auc_cumulative").alias("auc"), c("avg_precision_cumulative").alias("average_precision"),
                                  c("mcc_cumulative").alias("mcc"), c("ece_cumulative").alias("ece")))

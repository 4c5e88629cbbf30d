"""Sources, normalisation, validation, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom import constants as K
from creditloom.functions import clean
from creditloom.operators import conform, labels
from creditloom.session import scratch_path
from creditloom.sources import fixtures as fx
from creditloom.sources import readers, writers

from . import frames as fr
from .base_sql import AS_OF, BAD, GOOD, SPLIT, sql
from .registry import query, r6

c = F.col


@query("loans_labelled", sql(f"""
select application_id, loan_state, is_bad, case when signing_date >= timestamp '{SPLIT}' then 1 else 0 end as is_test, signing_date, fico, qi, partner from scope""", "scope"))
def loans_labelled(spark, sf):
    return fr.scope(spark, sf).select("application_id", "loan_state", "is_bad",
                                      (c("signing_date") >= F.lit(SPLIT).cast("timestamp")).cast("int").alias("is_test"),
                                      "signing_date", "fico", "qi", "partner")


@query("optional_source", sql("select count(*) as n_loans, cast(0 as bigint) as n_with_history, cast(0 as bigint) as prior_bad from scope", "scope"))
def optional_source(spark, sf):
    none = readers.read_optional(spark, sf + "/no_such_table.parquet", conform.ENTITY)
    from creditloom.operators.enrich import attach_entity
    ids = fr.scope(spark, sf).withColumn("application_id", c("application_id").cast("string"))
    return attach_entity(ids, none).agg(F.count("*").alias("n_loans"), F.sum((c("is_repeat") > 0).cast("bigint")).alias("n_with_history"),
                                        F.sum(c("prior_bad_ssn").cast("bigint")).alias("prior_bad"))


@query("scored_csv", sql("select cast(application_id as varchar) as application_id, signing_date, is_bad, decision, pd, grade from decided", "decided"))
def scored_csv(spark, sf):
    path = scratch_path(spark, "scored-csv")
    df = fr.scored_table(spark, sf).select("application_id", "signing_date", "loan_state", *[c(k).alias(f"our_{k}") for k in ("decision", "pd", "grade")])
    writers.write_scores(df, path + "/run1", "csv")
    newest = readers.latest_file(spark, path + "/*/*.csv")
    folder = newest.rsplit("/", 1)[0]
    return readers.read_scored_csv(spark, folder).select("application_id", "signing_date", "is_bad", "decision", "pd", "grade")


@query("latest_partition", sql("select count(*) as n, cast(sum(is_bad) as bigint) as n_bad from scope where signing_date >= (select date_trunc('year', max(signing_date)) from scope)", "scope"))
def latest_partition(spark, sf):
    path = scratch_path(spark, "by-year")
    df = fr.scope(spark, sf).select("application_id", "is_bad", F.year("signing_date").alias("run_date"))
    writers.write_scores(df, path, "parquet", "run_date")
    return readers.latest_partition(spark.read.parquet(path)).agg(F.count("*").alias("n"), F.sum(c("is_bad").cast("bigint")).alias("n_bad"))


@query("warehouse_sql", sql("select loan_state, count(*) as n, round(sum(principal)/100,2) as principal from loans group by loan_state", "loans"))
def warehouse_sql(spark, sf):
    return readers.run_sql(spark, "select loan_state, count(*) as n, round(sum(principal)/100, 2) as principal from {loans} group by loan_state",
                           {"loans": fr.loans(spark, sf)})


@query("coerce_types", sql("""
select application_id, case when application_id%11=0 then null else fico end as fico, case when application_id%13=0 then null else tl_total end as tl_total,
 case when application_id%17=0 then null else signing_date end as signing_date from loans""", "loans"))
def coerce_types(spark, sf):
    k = c("application_id")
    text = fr.loans(spark, sf).select(
        k, F.when(k % 11 == 0, "n/a").otherwise(c("fico").cast("string")).alias("fico"),
        F.when(k % 13 == 0, "MISSING").otherwise(c("tl_total").cast("string")).alias("tl_total"),
        F.when(k % 17 == 0, "not a date").otherwise(c("signing_date").cast("string")).alias("signing_date"))
    out = conform.cast_to(text, conform.LOAN)
    return out.select(c("application_id").cast("bigint").alias("application_id"), "fico", "tl_total", "signing_date")


@query("parquet_manifest", sql("select 'scope' as dataset, count(*) as row_count, cast(3 as integer) as column_count, substr(md5('select 1'),1,8) as query_hash, 1 as has_bytes from scope", "scope"))
def parquet_manifest(spark, sf):
    m = writers.save_with_manifest(fr.scope(spark, sf).select("application_id", "loan_state", "is_bad"), scratch_path(spark, "manifest"), "scope", "select 1")
    return m.select("dataset", "row_count", "column_count", "query_hash", (c("file_size_bytes") > 0).cast("int").alias("has_bytes"))


@query("json_report", sql("""
select 'rates' as section, 'loan_state|'||loan_state as "key", unnest(['n','n_bad','bad_rate']) as sub_key,
 round(unnest([cast(count(*) as double), cast(sum(is_bad) as double), avg(is_bad)]),6) as value from scope group by loan_state""", "scope"))
def json_report(spark, sf):
    from creditloom.operators.summary import group_rates, long_metrics
    rates = group_rates(fr.scope(spark, sf).withColumn("pd", F.lit(0.0)), ["loan_state"]).select("dim", "value", "n", "n_bad", "bad_rate")
    folder = scratch_path(spark, "report")
    writers.write_report(long_metrics(rates, "rates", ["dim", "value"]), folder, "2024-01-31")
    back = spark.read.schema("section string, key string, sub_key string, value double").json(f"{folder}/report_latest")
    return back.withColumn("value", F.round("value", 6))


@query("lookup_json", sql("select cast(application_id as varchar) as \"key\", has_prior_bad, prior_shops_ssn as connected_count, is_cross_entity from hist", "hist"))
def lookup_json(spark, sf):
    from creditloom.operators.entity import lookup_from_history
    path = scratch_path(spark, "lookup")
    writers.write_lookup_json(lookup_from_history(fr.history(spark, sf)), path)
    return readers.read_lookup_json(spark, path).select("key", "has_prior_bad", "connected_count", "is_cross_entity")


@query("dataset_summary", sql(f"select count(*) as n_rows, min(signing_date) as first_date, max(signing_date) as last_date, {r6('avg(is_bad) as bad_rate')} from scope", "scope"))
def dataset_summary(spark, sf):
    from creditloom.operators.summary import dataset_summary as f
    return fr.rounded(f(fr.scope(spark, sf)))


@query("model_state", sql(f"select application_id, {r6('woe_pd')} from sc", "sc"))
def model_state(spark, sf):
    """Parameters written as a table, read back and applied."""
    import json
    from dataclasses import asdict
    from creditloom.operators.models import LogitModel
    path = scratch_path(spark, "state")
    writers._put(spark, path, asdict(LogitModel(*fx.WOE_STATE)))
    state = spark.read.parquet(path).first()["state"]
    m = LogitModel(**json.loads(state))
    return fr.feature_table(spark, sf).select("application_id", F.round(m.column(), 6).alias("woe_pd"))


# --- normalisation ----------------------------------------------------------
@query("upper_categoricals", sql("select upper(trim(qi)) as qi, upper(trim(partner)) as partner, count(*) as n from loans group by all", "loans"))
def upper_categoricals(spark, sf):
    df = fr.loans(spark, sf).select(F.concat(F.lit(" "), F.lower("qi")).alias("qi"), F.lower("partner").alias("partner"))
    return df.select(clean.upper_text(c("qi")).alias("qi"), clean.upper_text(c("partner")).alias("partner")).groupBy("qi", "partner").agg(F.count("*").alias("n"))


_SENT = """select application_id, case application_id%6 when 0 then 'MISSING' when 1 then '' when 2 then ' ' when 3 then null when 4 then 'abc' else cast(cast(fico as bigint) as varchar) end as v from loans"""


def _sentinels(spark, sf):
    k = c("application_id") % 6
    v = (F.when(k == 0, "MISSING").when(k == 1, "").when(k == 2, " ").when(k == 3, F.lit(None)).when(k == 4, "abc")
         .otherwise(c("fico").cast("bigint").cast("string")))
    return fr.loans(spark, sf).select("application_id", v.alias("v"))


@query("sentinel_values", sql(f"""select application_id, case when v is null or trim(v) in ('','MISSING') then 1 else 0 end as is_missing,
 coalesce(try_cast(case when trim(v) in ('','MISSING') then null else v end as double), 650) as as_number,
 case when trim(v) in ('','MISSING') then null else v end as as_text from ({_SENT}) t""", "loans"))
def sentinel_values(spark, sf):
    return _sentinels(spark, sf).select("application_id", clean.flag(clean.is_missing(c("v"))).alias("is_missing"),
                                        clean.number(c("v"), 650).alias("as_number"), clean.text_or_null(c("v")).alias("as_text"))


@query("none_text", sql("""select application_id, case when application_id%4=3 then qi end as v from loans""", "loans"))
def none_text(spark, sf):
    k = c("application_id") % 4
    v = F.when(k == 0, "None").when(k == 1, " NaN").when(k == 2, "null").otherwise(c("qi"))
    return fr.loans(spark, sf).select("application_id", clean.none_text(v).alias("v"))


def _dirty(spark, sf):
    k = c("application_id")
    return fr.loans(spark, sf).select(
        k, F.when(k % 10 == 0, "abc").when(k % 10 == 1, "200").when(k % 10 == 2, "900").otherwise(c("fico").cast("string")).alias("fico"),
        F.when(k % 7 == 0, "XXXX").otherwise(F.lower("qi")).alias("qi"), "partner",
        F.when(k % 9 == 0, "many").otherwise(c("d30").cast("string")).alias("d30"))


@query("input_validation", sql("""
select application_id, concat_ws('|', case when application_id%10=0 then 'fico_not_numeric' end, case when application_id%10 in (1,2) then 'fico_out_of_range' end,
 case when application_id%7=0 then 'qi_unknown' end, case when application_id%9=0 then 'd30_not_numeric' end) as errors,
 case when application_id%10 not in (0,1,2) and application_id%7<>0 and application_id%9<>0 then 1 else 0 end as valid from loans""", "loans"))
def input_validation(spark, sf):
    v = conform.validate(_dirty(spark, sf))
    return v.select("application_id", F.array_join("errors", "|").alias("errors"), c("valid").cast("int").alias("valid"))


@query("quarantine_split", sql("""
select case when application_id%10 not in (0,1,2) and application_id%7<>0 and application_id%9<>0 then 'good' else 'bad' end as side, count(*) as n from loans group by 1""", "loans"))
def quarantine_split(spark, sf):
    good, bad = conform.quarantine(conform.require_columns(_dirty(spark, sf)))
    return good.select(F.lit("good").alias("side")).unionByName(bad.select(F.lit("bad").alias("side"))).groupBy("side").agg(F.count("*").alias("n"))


@query("default_fill", sql("select application_id, coalesce(fico,0) as fico, coalesce(tl_total,0) as tl_total, coalesce(mopmt,0) as mopmt, cast(0 as integer) as has_prior_bad from scope", "scope"))
def default_fill(spark, sf):
    return conform.fill_defaults(fr.scope(spark, sf)).select("application_id", "fico", "tl_total", "mopmt", "has_prior_bad")


@query("median_impute", sql(f"""
select application_id, round(coalesce(fico,(select median(fico) from scope where signing_date < timestamp '{SPLIT}')),6) as fico,
 round(coalesce(revutil,(select median(revutil) from scope where signing_date < timestamp '{SPLIT}')),6) as revutil from scope""", "scope"))
def median_impute(spark, sf):
    df = fr.scope(spark, sf)
    train, _ = labels.temporal_split(df, SPLIT)
    return fr.rounded(conform.impute_medians(df, train, ["fico", "revutil"]).select("application_id", "fico", "revutil"))


@query("warehouse_units", sql("select application_id, round(principal/100,6) as principal, coalesce(nullif(qi,'HFHT'),'MISSING') as qi, case when loan_id%3=0 then cast(loan_id%45 as integer) else 0 end as dwop from loans", "loans"))
def warehouse_units(spark, sf):
    df = fr.loans(spark, sf)
    df = df.join(fx.days_without_payment(df), "application_id", "left").withColumn("qi", F.nullif(c("qi"), F.lit("HFHT")))
    return fr.rounded(conform.warehouse_units(df).select("application_id", "principal", "qi", "dwop"))


@query("display_mapping", sql("""select application_id, case loan_id%5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D' end as letter,
 upper(substr(lower(loan_state),1,1))||substr(lower(loan_state),2) as shown from loans""", "loans"))
def display_mapping(spark, sf):
    df = fx.production_grade(fr.loans(spark, sf))
    return df.select("application_id", clean.grade_letter(c("production_grade")).alias("letter"), clean.display(F.lower("loan_state")).alias("shown"))


@query("history_length", sql("""select application_id, cast(greatest(coalesce(date_diff('day', d, cast(signing_date as date)),0),0) as double) as days,
 round(greatest(coalesce(date_diff('day', d, cast(signing_date as date)),0),0)/30.44e0,6) as months
 from (select *, case when loan_id%8<>0 then cast(signing_date as date) + cast(100 - loan_id%3000 as integer) end as d from loans) t""", "loans"))
def history_length(spark, sf):
    from creditloom.operators.features import history_length as f
    df = fr.loans(spark, sf).drop("crhist").withColumn("crhist_date", F.when(
        c("loan_id") % 8 != 0, F.date_add(F.to_date("signing_date"), (100 - c("loan_id") % 3000).cast("int"))))
    return fr.rounded(f(f(df, out="days"), unit="months", out="months").select("application_id", "days", "months"))


@query("loan_id_resolution", sql("""select application_id, case when loan_id%3<>0 then cast(loan_id as varchar) when loan_id%5<>0 then 'alt-'||loan_id else 'unknown' end as resolved from loans""", "loans"))
def loan_id_resolution(spark, sf):
    k = c("loan_id")
    df = fr.loans(spark, sf).select("application_id", F.when(k % 3 != 0, k.cast("string")).otherwise("").alias("loan_id"),
                                    F.when(k % 5 != 0, F.concat(F.lit("alt-"), k.cast("string"))).alias("alt_id"))
    return conform.resolve_loan_id(df, "loan_id", "alt_id", out="resolved").select("application_id", "resolved")


# --- filters -----------------------------------------------------------------
@query("censoring_modes", sql(f"""
select 'normal_as_good' as mode, count(*) as n, cast(sum(is_bad) as bigint) as n_bad from scope
union all select 'include_all', count(*), cast(sum(is_bad) as bigint) from scope
union all select 'resolved_only', count(*), cast(sum(is_bad) as bigint) from scope where loan_state in {BAD} or loan_state in {GOOD}
union all select 'exclude_recent', count(*), cast(sum(is_bad) as bigint) from scope where loan_state in {BAD} or loan_state in {GOOD} or age>=180""", "scope"))
def censoring_modes(spark, sf):
    out = None
    for mode in labels.CENSORING:
        t = labels.censor(fr.scope(spark, sf), mode, 180).agg(F.lit(mode).alias("mode"), F.count("*").alias("n"), F.sum(c("is_bad").cast("bigint")).alias("n_bad"))
        out = t if out is None else out.unionByName(t)
    return out


@query("temporal_split", sql(f"select case when signing_date < timestamp '{SPLIT}' then 'train' else 'test' end as part, count(*) as n, {r6('avg(is_bad) as bad_rate')} from scope group by 1", "scope"))
def temporal_split(spark, sf):
    train, test = labels.temporal_split(fr.scope(spark, sf), SPLIT)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")), allowMissingColumns=True)
    return fr.rounded(both.groupBy("part").agg(F.count("*").alias("n"), F.avg(c("is_bad").cast("double")).alias("bad_rate")))


@query("month_filter", sql("select application_id, signing_date from scope where strftime(signing_date,'%Y-%m')='1999-03'", "scope"))
def month_filter(spark, sf):
    return labels.in_month(fr.scope(spark, sf), "1999-03").select("application_id", "signing_date")


@query("survival_rows", sql(f"""select application_id, date_diff('day',cast(signing_date as date),date '{AS_OF}') as duration_days, round(date_diff('day',cast(signing_date as date),date '{AS_OF}')/30.44e0,6) as duration_months, is_bad as event
 from scope where date_diff('day',cast(signing_date as date),date '{AS_OF}')>0 and fico is not null and tl_total is not null""", "scope"))
def survival_rows(spark, sf):
    df = labels.survival_eligible(labels.with_duration(fr.scope(spark, sf), AS_OF), ["tl_total"])
    return fr.rounded(df.select("application_id", c("duration_days").cast("bigint").alias("duration_days"), "duration_months", "event"))


_DUR = f"(select date_diff('day',cast(signing_date as date),date '{AS_OF}') as d, is_bad from scope)"


@query("horizon_counts", sql("select " + ", ".join(
    f"count(case when d>={d} then 1 end) as n_{m}mo, round(case when count(case when d>={d} then 1 end)>=20 then avg(case when d>={d} then 1e0-is_bad end) end,6) as actual_survival_{m}mo"
    for m, d in zip(K.HORIZON_MONTHS, K.HORIZON_DAYS)) + f" from {_DUR} t", "scope"))
def horizon_counts(spark, sf):
    return fr.rounded(labels.horizon_counts(labels.with_duration(fr.scope(spark, sf), AS_OF)))


@query("product_filter", sql("select partner, count(*) as n from loans where partner in ('PARTNER_A','PARTNER_B') and signing_date >= timestamp '1998-01-01' group by partner", "loans"))
def product_filter(spark, sf):
    return labels.originated(fr.loans(spark, sf), "partner", ["PARTNER_A", "PARTNER_B"], "1998-01-01").groupBy("partner").agg(F.count("*").alias("n"))


@query("review_rows", sql("select application_id, pd, grade from decided where decision='review'", "decided"))
def review_rows(spark, sf):
    df = fr.scored_table(spark, sf).withColumn("decision", F.initcap("decision"))
    return labels.in_review(df).select("application_id", "pd", "grade")


@query("finite_rows", sql("select count(*) as n, round(sum(fico),4) as s from scope where fico is not null and application_id%10>=2", "scope"))
def finite_rows(spark, sf):
    k = c("application_id") % 10
    v = F.when(k == 0, float("nan")).when(k == 1, float("inf")).otherwise(c("fico"))
    return fr.rounded(labels.finite_rows(fr.scope(spark, sf).withColumn("v", v), ["v"]).agg(F.count("*").alias("n"), F.sum("v").alias("s")), 4)

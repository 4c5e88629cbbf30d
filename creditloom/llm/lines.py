"""Cross-site line dedup: HyperLogLog spread of each line over sites, exact counts near the threshold.

A site is the value of `source`. A line is what lies between newlines, trimmed of blanks; blank lines are never
boilerplate. Lines are compared by a 64-bit hash together with their length. A line on at least `min_sites` sites is
removed wherever it occurs.

Edge cases: a null text stays null and has no lines; a null source is no site, its lines still lose boilerplate; repeated
rows are one site; ties don't arise; an empty table gives an empty result; other columns pass through, and names that
start with `_line_` are reserved for this operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.common import query, stash, table

MIN_SITES = 10
SKETCH_LG_K = 12
#: Relative width of the band in which the sketch does not decide; six standard errors of a sketch of 2**12 registers.
BAND = 0.1


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _lines(docs: DataFrame) -> DataFrame:
    """A row for each distinct non-blank line of a document: (_line_doc, _line_site, _line_hash, _line_len)."""
    lines = F.array_distinct(F.transform(F.split("text", "\n", -1), trimmed))
    return (docs.select(_row_key(docs).alias("_line_doc"), F.col("source").alias("_line_site"), F.explode(lines).alias("_line"))
            .where(F.length("_line") > 0)
            .select("_line_doc", "_line_site", F.xxhash64("_line").alias("_line_hash"), F.length("_line").alias("_line_len")))


def _row_key(docs: DataFrame) -> Column:
    """What two rows with the same text share; lines of a text are the same whichever row holds it."""
    return F.xxhash64("text", F.length("text"))


def spread(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Lines on at least min_sites distinct sites: (_line_hash, _line_len). Sketches merge map-side, so a line may be on any share of the rows."""
    lines = _lines(docs)
    low, high = min_sites - max(1.0, BAND * min_sites), min_sites + max(1.0, BAND * min_sites)
    sketched = (lines.where("_line_site is not null").groupBy("_line_hash", "_line_len")
                .agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64("_line_site"), F.lit(SKETCH_LG_K))).alias("sites"))
                .where(F.col("sites") >= low))
    sketched = stash(sketched, "line-spread")
    near = sketched.where(F.col("sites") <= high).select("_line_hash", "_line_len")
    exact = (lines.where("_line_site is not null").join(near, ["_line_hash", "_line_len"], "left_semi")
             .select("_line_hash", "_line_len", "_line_site").distinct()
             .groupBy("_line_hash", "_line_len").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites))
    return sketched.where(F.col("sites") > high).select("_line_hash", "_line_len").unionByName(exact.select("_line_hash", "_line_len"))


def remove_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """docs without boilerplate lines in `text`, and with `_line_count` and `_line_removed` (non-blank lines before, and removed)."""
    common = stash(spread(docs, min_sites), "line-common")
    hits = (_lines(docs).select("_line_doc", "_line_hash", "_line_len").join(common, ["_line_hash", "_line_len"], "left_semi")
            .groupBy("_line_doc").agg(F.collect_set(F.struct("_line_hash", "_line_len")).alias("_line_hits")))  # at most a text's own lines
    hits = stash(hits, "line-hits")
    split = F.split("text", "\n", -1)
    # the texts with boilerplate grow with the input, so both sides are shuffled whatever their size
    marked = docs.withColumn("_line_doc", _row_key(docs)).join(hits.hint("merge"), "_line_doc", "left")
    known = F.coalesce("_line_hits", F.array().cast(hits.schema["_line_hits"].dataType))

    def stays(line: Column) -> Column:
        return ~F.array_contains(known, F.struct(F.xxhash64(trimmed(line)).alias("_line_hash"), F.length(trimmed(line)).alias("_line_len")))

    untouched = F.col("_line_hits").isNull()
    rest = F.filter(split, stays)
    full = F.size(F.filter(split, lambda x: F.length(trimmed(x)) > 0))
    return (marked.withColumn("_line_count", F.when(F.col("text").isNull(), 0).otherwise(full).cast("long"))
            .withColumn("_line_removed", F.when(untouched, 0).otherwise(F.size(split) - F.size(rest)).cast("long"))
            .withColumn("text", F.when(untouched, F.col("text")).otherwise(F.array_join(rest, "\n")))
            .drop("_line_doc", "_line_hits"))


OP2_SQL = f"""
with pieces as (
  select text, source, trim(l, ' ' || chr(9) || chr(13)) as line
  from (select text, source, unnest(string_split(text, chr(10))) as l from documents)
), common as (
  select line from pieces where line <> '' group by line having count(distinct source) >= {MIN_SITES}
), parts as (
  select doc_id, unnest(string_split(text, chr(10))) as l, unnest(range(len(string_split(text, chr(10))))) as pos from documents
), judged as (
  select doc_id, l, pos, trim(l, ' ' || chr(9) || chr(13)) as line, trim(l, ' ' || chr(9) || chr(13)) in (select line from common) as gone from parts
), cleaned as (
  select doc_id, count(*) filter (line <> '') as n_lines, count(*) filter (gone) as n_removed,
         coalesce(string_agg(l, chr(10) order by pos) filter (not gone), '') as clean_text
  from judged group by doc_id
)
select d.doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed,
       case when d.text is null then null else clean_text end as clean_text
from documents d left join cleaned c on c.doc_id = d.doc_id
"""


@query("op2_line_dedup", OP2_SQL)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return remove_lines(docs).select("doc_id", F.col("_line_count").alias("n_lines"), F.col("_line_removed").alias("n_removed"), F.col("text").alias("clean_text"))


def drop_boilerplate(docs: DataFrame) -> DataFrame:
    """The documents with cross-site boilerplate lines taken out of their text; no document goes."""
    columns = docs.columns
    out = remove_lines(docs)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)

"""Personal data: exact base kinds, and bootstrapped contextual extraction of identifiers the base rules miss.

Base kinds are regular expressions with checks. The bootstrap takes runs of words with digits or an @ as candidate instances.
Those that hold a base match are seeds. Patterns are the neighbouring words with the shape of the instance; pattern and instance
scores are computed in turn over the pattern-instance graph, and instances with a high score are added as spans of the seeds' kind.

Texts stand for themselves: equal texts are scanned and joined by a 96-bit hash of the text, so copies are worked on once.

Edge cases: a null text is an empty one; texts of any length are searched whole; a null id stays null; repeated rows each get the same answer; an empty table gives an empty
result; ties in a pattern's score need no order, and an instance with two kinds takes the better one, then the first listed; extra columns pass
through, and names that start with `_pii_` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.llm.common import query, stash, table, unstash

KINDS = ("email", "ip", "card", "phone")
#: A match can only begin where its first character run begins, or right after the last match; possessive runs never backtrack.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TRIGGERS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "candidate": "[0-9@]"}
WORD = "[^ 0-9@]*+[0-9@][^ ]*+"
CANDIDATE = f"(?<![^ ]){WORD}(?: {WORD})*+"
MIN_SUPPORT = 4.0
MIN_CONFIDENCE = 0.8
MIN_SCORE = 0.9
KEY = ["_pii_a", "_pii_b", "_pii_n"]


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias(KEY[0]), F.hash(text).alias(KEY[1]), F.length(text).alias(KEY[2])]


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Matches of one kind with their number, what lies before each since the last match, and the neighbouring words (candidates only)."""
    parts, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    words = kind == "candidate"

    # split and matches are made once for a text, not once for a match
    rows = F.arrays_zip(parts, F.slice(parts, 2, 2**31 - 1), hits)

    def one(x: Column, i: Column) -> Column:
        before, after, value = x["0"], x["1"], x["2"]
        near = [F.substring_index(F.rtrim(before), " ", -2), F.substring_index(F.ltrim(after), " ", 1)] if words else [F.lit(None).cast("string")] * 2
        return F.struct(F.lit(kind).alias("kind"), i.alias("pos"), F.length(before).cast("long").alias("lead"), value.alias("value"),
                        near[0].alias("before"), near[1].alias("after"))

    empty = F.array().cast("array<struct<kind:string,pos:int,lead:bigint,value:string,before:string,after:string>>")
    return F.when(F.rlike(text, F.lit(TRIGGERS[kind])), F.filter(F.transform(rows, one), lambda x: x["value"].isNotNull())).otherwise(empty)


def scan(docs: DataFrame) -> DataFrame:
    """(text key, kind, start, end, value, before, after) of every match of the base patterns and every candidate, unchecked."""
    text = F.coalesce("text", F.lit(""))
    flat = F.translate(text, "\t\n\r\x0b\x0c", "     ")
    found = F.concat(*[_found(text, k, p) for k, p in PATTERNS.items()], _found(flat, "candidate", CANDIDATE))
    rows = docs.where(F.rlike(text, F.lit("[0-9@]"))).select(*text_key(text), F.inline(found)).dropDuplicates([*KEY, "kind", "pos"])
    so_far = Window.partitionBy(*KEY, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("lead") + F.length("value")).over(so_far)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value")).drop("pos", "lead")


def _valid() -> Column:
    value = F.col("value")
    digits = F.regexp_replace(value, "[^0-9]", "")
    parts = F.split(value, r"\.")

    def at_most_255(x: Column) -> Column:
        x = F.regexp_replace(x, "^0+", "")
        return (F.length(x) <= 3) & (F.coalesce(x.try_cast("int"), F.lit(0)) <= 255)

    return (F.when(F.col("kind") == "ip", F.forall(parts, at_most_255))
            .when(F.col("kind") == "card", F.length(digits).between(12, 19) & F.call_function("luhn_check", digits))
            .when(F.col("kind") == "phone", F.length(digits).between(9, 15))
            .otherwise(F.col("kind") == "email"))


def instances(found: DataFrame, base: DataFrame) -> DataFrame:
    """Candidates with their place, normalised value, shape, neighbours, and the kind of the first base span that begins inside (seed)."""
    edge = r"^[^\p{L}0-9+(@]+"
    cand = found.where("kind = 'candidate'").withColumn("start", F.col("start") + F.length(F.regexp_extract("value", edge, 0)))
    cand = cand.withColumn("value", F.regexp_replace(F.regexp_replace("value", edge, ""), r"[^\p{L}0-9)]+$", "")).withColumn("end", F.col("start") + F.length("value"))
    cand = cand.where((F.length(F.regexp_replace("value", "[^0-9]", "")) >= 5) | F.contains("value", F.lit("@")))
    both = cand.select(*KEY, "kind", "start", "end", "value", "before", "after").unionByName(base.select(*KEY, "kind", "start", "end"), allowMissingColumns=True)
    place = Window.partitionBy(*KEY).orderBy("start", F.col("kind") == "candidate", "kind")
    is_base = F.col("kind") != "candidate"
    marked = (both.withColumn("reach", F.max(F.when(is_base, F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("next", F.min(F.when(is_base, F.struct("start", "kind"))).over(Window.partitionBy(*KEY).orderBy("start").rangeBetween(0, Window.unboundedFollowing))))
    seed = F.when(F.col("next.start") < F.col("end"), F.col("next.kind"))
    shape = F.regexp_replace(F.regexp_replace("value", "[0-9]+", "9"), r"\p{L}+", "a")
    # long shapes by a hash of the whole
    shape = F.when(F.length(shape) > 40, F.concat(F.left(shape, F.lit(24)), F.lit("#"), F.hex(F.xxhash64(shape)))).otherwise(shape)
    return (marked.where(~is_base).select(*KEY, "start", "end", "value", shape.alias("shape"), "before", "after", seed.alias("seed"),
                                          (seed.isNotNull() | (F.coalesce("reach", F.lit(0)) > F.col("start"))).alias("taken")))


def graph(inst: DataFrame) -> DataFrame:
    """Distinct edges (pattern, value, seed) between lexical patterns and instances; seed is the value's own kind, if any."""
    clean = lambda c: F.nullif(F.lower(F.regexp_replace(c, r"[^\p{L} ]+", "")), F.lit(""))
    two, right = clean(F.col("before")), clean(F.col("after"))
    one = F.nullif(F.substring_index(two, " ", -1), F.lit(""))
    named = [F.concat_ws("|", F.lit("l1"), one, "shape"), F.concat_ws("|", F.lit("l2"), two, "shape"), F.concat_ws("|", F.lit("r1"), right, "shape"),
             F.concat_ws("|", F.lit("lr"), one, right, "shape")]
    there = [one.isNotNull(), two.isNotNull() & F.contains(two, F.lit(" ")), right.isNotNull(), one.isNotNull() & right.isNotNull()]
    patterns = F.filter(F.array(*[F.when(t, p) for t, p in zip(there, named)]), lambda x: x.isNotNull())
    return (inst.select("value", "seed", F.explode(patterns).alias("pattern")).groupBy("pattern", "value").agg(F.min("seed").alias("seed")))


def bootstrap(inst: DataFrame) -> DataFrame:
    """(value, kind, score) of instances found by the patterns; seeds are not among them.

    A pattern's confidence for a kind is the score of its instances over one more than their number. An instance combines its
    confident patterns as independent evidence. Rounds go on until instances, kinds and scores (to four digits) stay as they are;
    should they ever return to an earlier state instead, that ends them too.
    """
    edges = stash(graph(inst), "pii-graph")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    seeds = edges.where("seed is not null").select("value", F.col("seed").alias("kind")).distinct().withColumn("score", F.lit(1.0))
    known, found, marks = seeds, None, set()
    while True:
        confident = (edges.join(known, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("support")).join(sizes, "pattern")
                     .withColumn("confidence", F.col("support") / (F.col("n") + 1)).where((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE)))
        confident = stash(confident.select("pattern", "kind", "confidence"), "pii-patterns")
        scored = (edges.join(confident, "pattern").groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"))
                  .where(F.col("score") >= MIN_CONFIDENCE).join(seeds.select("value").distinct(), "value", "left_anti"))
        order = F.struct("score", *[(F.col("kind") == k).alias(k) for k in KINDS])
        scored = scored.groupBy("value").agg(F.max_by("kind", order).alias("kind"), F.max("score").alias("score"))
        last, found = found, stash(scored, "pii-found")
        for used in (last, confident):
            unstash(used)
        mark = tuple(found.agg(F.count("*"), F.sum(F.xxhash64("value", "kind", F.round("score", 4)).cast("decimal(38,0)"))).first())
        if mark in marks:
            break
        marks.add(mark)
        known = seeds.unionByName(found)
    unstash(edges)
    return found.where(F.col("score") >= MIN_SCORE)


def spans(docs: DataFrame) -> DataFrame:
    """(text key, kind, start, end, base) of all spans in the texts of docs; equal texts once."""
    found = stash(scan(docs), "pii-scan")
    base = stash(found.where("kind <> 'candidate'").where(_valid()).select(*KEY, "kind", "start", "end"), "pii-base")
    inst = stash(instances(found, base), "pii-instances")
    more = inst.where("not taken").join(bootstrap(inst), "value").select(*KEY, "kind", "start", "end")
    return stash(base.withColumn("base", F.lit(True)).unionByName(more.withColumn("base", F.lit(False))), "pii-spans")


def _listed(only_base: bool) -> Column:
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    item = F.struct("start", order.alias("o"), "end", "kind")
    return F.array_sort(F.collect_list(F.when(F.col("base"), item) if only_base else item))  # at most a text's own spans


def find_pii(docs: DataFrame) -> DataFrame:
    """docs with counts of the base kinds, their digest, and all spans as text."""
    said = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}")
    of_text = stash(spans(docs).groupBy(*KEY).agg(*map(count, KINDS), F.sha2(said(_listed(True)), 256).alias("base_sha256"), said(_listed(False)).alias("spans")), "pii-texts")
    added = [*[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    text = F.coalesce("text", F.lit(""))
    keyed = docs.drop(*[c for c in added if c in docs.columns]).select("*", *text_key(text)).drop("text")
    empty = {f"n_{k}": F.coalesce(f"n_{k}", F.lit(0).cast("long")) for k in KINDS}
    empty |= {"base_sha256": F.coalesce("base_sha256", F.sha2(F.lit(""), 256)), "spans": F.coalesce("spans", F.lit(""))}
    return keyed.join(of_text, KEY, "left").withColumns(empty).drop(*KEY)


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of text replaced by its kind in brackets; overlapping spans become one, named for the first."""
    columns, text = docs.columns, F.coalesce("text", F.lit(""))
    before = Window.partitionBy(*KEY).orderBy("start", F.col("end").desc(), "kind").rowsBetween(Window.unboundedPreceding, -1)
    cut = spans(docs).withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0))).where("end > reach")
    cut = cut.withColumn("fresh", F.col("start") >= F.col("reach")).withColumn("start", F.greatest("start", "reach"))
    of_text = stash(cut.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "fresh"))).alias("_pii_cut")), "pii-cuts")
    # the texts with spans grow with the input, so both sides are shuffled whatever their size
    marked = docs.select("*", *text_key(text)).join(of_text.hint("merge"), KEY, "left")
    c = F.col("_pii_cut")

    def piece(s: Column, i: Column) -> Column:
        since = F.when(i == 0, F.lit(0)).otherwise(F.get(c, i - 1)["end"])
        name = F.when(s["fresh"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")
        return F.concat(F.substring(F.col("text"), (since + 1).cast("int"), (s["start"] - since).cast("int")), name)

    tail = F.substring(F.col("text"), (F.element_at(c, -1)["end"] + 1).cast("int"), F.length("text"))
    out = marked.withColumn("text", F.when(c.isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.transform(c, piece), ""), tail)))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)


@query("op10_pii")
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

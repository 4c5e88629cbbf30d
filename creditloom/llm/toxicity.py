"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Two models, toxic and ordinary, share their lower orders: an n-gram of up to ORDER letters keeps class counts at the top order only and
backs off to continuation counts gathered over both classes. Rare and unseen word forms are so scored by the stems they share with known ones.
Where the top order is unseen, the shared backoff cancels out of the ratio and only the two backoff weights remain, so scoring needs
two tables: log ratios of seen n-grams, and log ratios of backoff weights of seen contexts.

Log-likelihoods are compared per letter over the whole document, and per word for its most telling words; a monotone curve (small boosted
trees), fitted on labelled documents that the models have not seen, turns these ratios into a probability.

Counts come from every labelled training row, in Spark: while the curve is fitted its own rows are left out, then all are counted again. The tables
of ratios stay in Spark whole. The distinct words pass all of them, block by block of bounded size; the ratios of at most COMMON frequent words are broadcast,
which spares frequent words the join with the documents, and every other word takes the join.

Edge cases: a null or wordless text is scored as an empty one; a document without id is scored and is never a training row; repeated rows are scored each and
counted each; a text of any length is read whole; with only one class in training every score is that class's rate; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from creditloom.llm import trees
from creditloom.llm.common import query, stash, table, unstash, with_column_batches

ORDER = 6
DISCOUNT = 0.75  # of the shared lower orders; the class orders estimate theirs
#: Frequent training words whose ratios are broadcast at most; the others are joined.
COMMON = 200_000
#: Contexts and n-grams that are sent to the tasks at a time.
KEYS_AT_ONCE = 2_000_000
#: Labelled documents that fit the curve at most, about; the counts have no such bound.
MAX_CALIBRATION = 20_000
#: Ratio (nats) above which a word counts as telling.
TELLING = 2.5
BEST = (1, 2, 3, 5)
#: Direction in which the probability may move with each measure: mean ratio a letter, the k-th best words, telling excess in all and a word, length.
MEASURES = (1, *[1] * len(BEST), 1, 1, 0)
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+")
START, END = "\x02", "\x03"
HELD_OUT = "pmod(crc32(cast(doc_id as string)), 3) = 1"


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, toxic, ordinary): in how many texts of either class each word stands."""
    def run(batches):
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(set(WORD.findall((text or "").lower())))
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()), pa.array([counts[0][w] for w in words], pa.int64())],
                                             names=["word", "toxic", "ordinary"])

    found = docs.select("text", F.col("toxic").cast("int")).mapInArrow(run, "word string, toxic long, ordinary long")
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def letters(words: DataFrame, *keep: str) -> DataFrame:
    """(ctx, letter, *keep) for each letter, and the end, of each row of words."""
    padded = F.concat(F.lit(START), F.col("word"), F.lit(END))
    ends = F.sequence(F.lit(2), F.length("padded"))
    at = words.select(*keep, padded.alias("padded")).select(*keep, "padded", F.explode(ends).alias("i"))
    first = F.greatest(F.lit(1), F.col("i") - (ORDER - 1))
    return at.select(F.substring("padded", first, F.col("i") - first).alias("ctx"), F.substring("padded", F.col("i"), F.lit(1)).alias("letter"), *keep)


def top_grams(words: DataFrame) -> DataFrame:
    """(ctx, letter, toxic, ordinary): the letter after up to ORDER - 1 letters of the same word, with its class counts."""
    return letters(words, "toxic", "ordinary").groupBy("ctx", "letter").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def shared_backoff(top: DataFrame, written: list | None = None) -> DataFrame:
    """(ctx, letter, shared): probability of the letter in the next lower order, by continuation counts over both classes.

    In order k the count of an n-gram is the number of different letters seen before it in order k + 1.
    `written` gets the tables that were written on the way.
    """
    grams = top.select("ctx", "letter")
    levels = []
    for k in range(ORDER - 1, 0, -1):  # letters in the n-gram
        longer = grams.where(F.length("ctx") >= k)  # n-grams of k + 1 letters, or longer ones of the top
        cut = F.substring("ctx", F.length("ctx") - k + 1, F.lit(k))
        seen = longer.select(cut.alias("ctx"), "letter").distinct()  # with one letter before the n-gram of k letters
        counts = seen.select(F.substring("ctx", 2, k).alias("ctx"), "letter").groupBy("ctx", "letter").agg(F.count("*").alias("n"))
        levels.append(counts)
    unigram = levels.pop()
    total = unigram.agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    below = unigram.crossJoin(F.broadcast(total)).select("ctx", "letter", ((F.col("n") + 0.5) / (F.col("total") + 0.5 * F.col("kinds"))).alias("shared"))  # total is one row
    known = stash(below, "letters")
    parts = [known]
    for counts in reversed(levels):
        sums = counts.groupBy("ctx").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        lower = known.withColumnRenamed("ctx", "low")
        mixed = (counts.join(sums, "ctx").withColumn("low", F.expr("substring(ctx, 2)")).join(lower, ["low", "letter"])
                 .select("ctx", "letter", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("shared")) / F.col("total")).alias("shared")))
        known = stash(mixed, "letters")
        parts.append(known)
    if written is not None:
        written += parts
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # each n-gram of the top order, of whatever length, with the probability one order below
    return top.withColumn("low", F.expr("substring(ctx, 2)")).join(out.withColumnRenamed("ctx", "low"), ["low", "letter"], "left").select("ctx", "letter", F.coalesce("shared", F.lit(1e-6)).alias("shared"))


def discounts(top: DataFrame, c: str) -> list[float]:
    """Discounts of n-grams seen once, twice and more often, from the counts of counts (modified Kneser-Ney).

    Where these are too sparse for the estimate, or it doesn't rise with the count, all three are DISCOUNT."""
    n = top.agg(*[F.count(F.when(F.col(c) == k, 1)) for k in (1, 2, 3, 4)]).first()
    if not all(n):
        return [DISCOUNT] * 3
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return found if 0 < found[0] <= found[1] <= found[2] else [DISCOUNT] * 3


@dataclass
class Ratio:
    """Log likelihood ratios as Arrow tables: (gram, ratio) of seen context + letter, (ctx, backoff) of the backoff weights.

    The look-up dictionaries are built where they are used, once in a worker."""
    gram_table: pa.Table
    ctx_table: pa.Table

    @cached_property
    def grams(self) -> dict:
        return dict(zip(*(c.to_pylist() for c in self.gram_table.columns)))

    @cached_property
    def contexts(self) -> dict:
        return dict(zip(*(c.to_pylist() for c in self.ctx_table.columns)))

    def word(self, word: str) -> float:
        padded, total = START + word + END, 0.0
        for i in range(1, len(padded)):
            ctx = padded[max(0, i - ORDER + 1):i]
            hit = self.grams.get(ctx + padded[i])
            total += hit if hit is not None else self.contexts.get(ctx, 0.0)
        return total


def ratio_table(words: DataFrame) -> DataFrame:
    """(ctx, letter, n, ratio, backoff) of every n-gram seen in words (word, toxic, ordinary)."""
    top = stash(top_grams(words), "letter-grams")
    written = [top]
    shared = shared_backoff(top, written)
    w = Window.partitionBy("ctx")  # at most as many rows as there are letters
    table = top.join(shared, ["ctx", "letter"]).select("*", *[F.sum(c).over(w).alias(f"sum_{c}") for c in ("toxic", "ordinary")])

    cuts = {c: discounts(top, c) for c in ("toxic", "ordinary")}

    def cut(c: str):
        d = cuts[c]
        return F.when(F.col(c) == 0, 0.0).when(F.col(c) == 1, d[0]).when(F.col(c) == 2, d[1]).otherwise(d[2])

    def weight(c: str):
        return F.when(F.col(f"sum_{c}") > 0, F.sum(cut(c)).over(w) / F.col(f"sum_{c}")).otherwise(1.0)

    def prob(c: str):
        seen = F.when(F.col(f"sum_{c}") > 0, (F.col(c) - cut(c)) / F.col(f"sum_{c}")).otherwise(0.0)
        return seen + weight(c) * F.col("shared")

    out = stash(table.select("ctx", "letter", (F.col("toxic") + F.col("ordinary")).alias("n"), F.log(prob("toxic") / prob("ordinary")).cast("float").alias("ratio"),
                              F.log(weight("toxic") / weight("ordinary")).cast("float").alias("backoff")), "ratios")
    for x in written:
        unstash(x)
    return out


def _frequent(counted: DataFrame, most: int) -> DataFrame:
    """The rows of counted with n of at least 1, 2, 4 or the next power that leaves at most `most` of them."""
    least, size = 1, counted.count()
    while size > most:
        least *= 2
        size = counted.where(F.col("n") >= least).count()
    return counted.where(F.col("n") >= least)


def fit_ratio(docs: DataFrame) -> Ratio:
    """The ratio tables of models counted over a small sample of docs (text, toxic), gathered whole for look-up; score() joins with them instead."""
    kept = ratio_table(stash(word_counts(docs), "word-counts"))
    contexts = kept.groupBy("ctx").agg(F.first("backoff").alias("backoff"))
    return Ratio(kept.select(F.concat("ctx", "letter").alias("gram"), "ratio").toArrow(), contexts.toArrow())


def key_table(ratios: DataFrame) -> DataFrame:
    """(k, v): what each seen context, and each seen letter after it, adds to the ratio of a word; k is a hash of the kind and the letters.

    A context adds its backoff weight, a seen letter the rest of its ratio, so the parts of a word's ratio add up in any order."""
    contexts = ratios.groupBy("ctx").agg(F.first("backoff").cast("double").alias("v")).select(F.xxhash64(F.concat(F.lit("c"), "ctx")).alias("k"), "v")
    grams = ratios.select(F.xxhash64(F.concat(F.lit("g"), "ctx", "letter")).alias("k"), (F.col("ratio").cast("double") - F.col("backoff").cast("double")).alias("v"))
    return grams.unionByName(contexts)


def _keys(word: str) -> list[int]:
    """The hashes of key_table() that concern a word."""
    padded, out = START + word + END, []
    for i in range(1, len(padded)):
        ctx = padded[max(0, i - ORDER + 1):i]
        out.append(xxh64_intdigest(("c" + ctx).encode("utf-8", "surrogatepass"), 42))
        out.append(xxh64_intdigest(("g" + ctx + padded[i]).encode("utf-8", "surrogatepass"), 42))
    return out


def word_ratios(words: DataFrame, keyed: DataFrame, at_once: int | None = None) -> DataFrame:
    """(word, ratio) of each row of words, from the whole of keyed: it is dealt into blocks by key, and every word passes all blocks.

    A block of at most about `at_once` keys is sent to the tasks at a time; neither letters nor words are shuffled."""
    blocks = -(-keyed.count() // (at_once or KEYS_AT_ONCE)) or 1
    out = words.select("word", F.lit(0.0).alias("ratio"))
    for b in range(blocks):
        part = keyed.where(F.pmod("k", F.lit(blocks)) == b).toArrow()
        k = part.column("k").to_numpy()
        order = np.argsort(k)
        sent = words.sparkSession.sparkContext.broadcast((k[order], part.column("v").to_numpy()[order]))

        def run(batches, sent=sent):
            keys, values = sent.value
            for batch in batches:
                found = [_keys(w) for w in batch.column(0).to_pylist()]
                flat = np.array([x for f in found for x in f], np.uint64).astype(np.int64)
                at = np.minimum(np.searchsorted(keys, flat), max(len(keys) - 1, 0))
                v = np.where(keys[at] == flat, values[at], 0.0) if len(keys) else np.zeros(len(flat))
                ends = np.cumsum([0] + [len(f) for f in found])
                sums = np.append(0.0, np.cumsum(v))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(batch.column(1).to_numpy() + sums[ends[1:]] - sums[ends[:-1]])], names=["word", "ratio"])

        before, out = out, out.mapInArrow(run, "word string, ratio double")
        if blocks > 1:
            out = stash(out, "word-ratios-block")
            unstash(before)
    return out


@dataclass
class Known:
    """Ratios of frequent words as an Arrow table (word, ratio); the dictionary is built where it is used, once in a worker."""
    table: pa.Table

    @cached_property
    def words(self) -> dict:
        return dict(zip(*(c.to_pylist() for c in self.table.columns)))


PARTS = "n long, times long, letters long, total double, excess double, best array<double>, rest array<struct<word:string,times:long>>"


def _parts(text: str | None, known: dict) -> tuple:
    """PARTS of a text: its distinct words, words and letters; sums and best ratios of its known words; and the other words."""
    words = Counter(WORD.findall((text or "").lower()))
    r, rest, total, excess = [], [], 0.0, 0.0
    for w, times in words.items():
        hit = known.get(w)
        if hit is None:
            rest.append({"word": w, "times": times})
        else:
            r.append(hit)
            total += hit * times
            if hit > TELLING:
                excess += hit - TELLING
    return len(words), sum(words.values()), sum((len(w) + 1) * t for w, t in words.items()), total, excess, heapq.nlargest(max(BEST), r), rest


def measured(docs: DataFrame, words: DataFrame, ratios: DataFrame, common: int | None = None, scratch: list | None = None) -> DataFrame:
    """docs without text, with the MEASURES of the text as column x, normalised by letters or words.

    words are those counted for ratios; the most frequent of them are broadcast (COMMON at most), all others are joined.
    `scratch` gets the tables that the result reads.
    """
    counted = words.select("word", (F.col("toxic") + F.col("ordinary")).alias("n"))
    frequent = _frequent(counted, COMMON if common is None else common)
    keyed = stash(key_table(ratios), "gram-keys")
    known = docs.sparkSession.sparkContext.broadcast(Known(word_ratios(frequent, keyed).toArrow()))
    keep = [c for c in docs.columns if c != "text"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))]
    fields = [f.split()[0] for f in PARTS.split(", ")]

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            made = list(zip(*(_parts(t, known.value.words) for t in batch.column(names.index("text")).to_pylist()))) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in keep], *[pa.array(list(m), k) for m, k in zip(made, kinds)]], names=[*keep, *fields])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    # the number of a row is fixed once it is written
    parts = stash(docs.mapInArrow(run, f"{schema}, {PARTS}").withColumn("row", F.monotonically_increasing_id()), "text-parts")
    rest = parts.select("row", F.explode("rest").alias("at")).select("row", "at.word", "at.times")
    scored = stash(word_ratios(rest.select("word").distinct(), keyed), "word-ratios")
    unstash(keyed)
    if scratch is not None:
        scratch += [parts, scored]
    k = max(BEST)
    joined = (rest.join(scored.hint("merge"), "word").groupBy("row")
              .agg(F.sum(F.col("ratio") * F.col("times")).alias("more"), F.sum(F.greatest(F.col("ratio") - TELLING, F.lit(0.0))).alias("more_excess"), F.collect_list("ratio").alias("others")))
    both = parts.drop("rest").join(joined.hint("merge"), "row", "left")
    top = F.slice(F.sort_array(F.concat("best", F.coalesce("others", F.array().cast("array<double>"))), asc=False), 1, k)
    excess = F.col("excess") + F.coalesce("more_excess", F.lit(0.0))
    x = F.array((F.col("total") + F.coalesce("more", F.lit(0.0))) / F.greatest("letters", F.lit(1)), *[F.get("top", (F.least(F.lit(i), F.col("n")) - 1).cast("int")) for i in BEST],
                excess, excess / F.greatest("n", F.lit(1)), F.log1p(F.col("times").cast("double")))
    empty = F.array(*[F.lit(0.0)] * len(MEASURES))
    return both.withColumn("top", top).select(*keep, F.when(F.col("n") > 0, x).otherwise(empty).alias("x"))


def _probability(rows: DataFrame, curve: trees.Forest) -> DataFrame:
    """rows with the probability for the measures x as column score, instead of x."""
    return with_column_batches(rows, lambda x: curve.probability(np.array(x).reshape(-1, len(MEASURES))).tolist(), "x", "score", T.DoubleType()).drop("x")


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of docs (doc_id, text); rows that are held out are never learnt from.

    The curve is fitted on a quarter of the training rows, MAX_CALIBRATION at most, by models that have not counted them; the final models count all.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    train = docs.join(known.where(f"not ({HELD_OUT})"), "doc_id").withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(4)))
    train = stash(train, "labelled-texts")
    held = F.coalesce(F.expr(HELD_OUT), F.lit(False))
    classes = train.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()  # at most eight rows
    size = lambda fit, toxic: sum(r["n"] for r in classes if (r["fold"] == 0) == fit and r["toxic"] == toxic)
    if not all(size(fit, toxic) for fit in (False, True) for toxic in (0, 1)):
        n = sum(r["n"] for r in classes)
        rate = sum(r["n"] for r in classes if r["toxic"]) / n if n else 0.0
        return docs.select("doc_id", held.alias("held_out"), F.lit(rate).alias("score"), F.lit(int(rate >= THRESHOLD)).alias("predicted"))
    share = min(1.0, MAX_CALIBRATION / (size(True, 0) + size(True, 1)))
    chosen = (F.col("fold") == 0) & (F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    words = stash(word_counts(train.where(~chosen)), "word-counts")
    fit = train.where(chosen).select("doc_id", "text", "toxic")
    ratios, scratch = ratio_table(words), []
    rows = measured(fit, words, ratios, scratch=scratch).select("doc_id", "toxic", "x").toPandas().sort_values("doc_id")
    for x in [ratios, *scratch]:
        unstash(x)
    curve = trees.fit(np.array(rows["x"].tolist()), rows["toxic"].to_numpy(float), list(MEASURES), trees=40, depth=3)

    every = words.unionByName(word_counts(fit)).groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    before, words = words, stash(every, "word-counts")
    unstash(before)
    unstash(train)
    scored = _probability(measured(docs, words, ratio_table(words)), curve)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

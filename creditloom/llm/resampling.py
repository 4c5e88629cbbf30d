"""Importance resampling towards a target: documents are drawn by how much more likely the target's words make them.

Features are runs of 1 to 2 words in hashed buckets. Both tables are counted per bucket inside tasks and summed; the gain of every bucket is
a logarithm of the ratio of smoothed frequencies, and an array of all gains scores the documents. Gumbel noise from a hash of the id
makes the highest scores a draw in proportion to the weights.

The cutoff is selected exactly by weighted medians of medians: each Arrow batch of the candidates gives the median of its keys, each
partition the median of these weighted by their rows, and the driver the median of the partitions' medians (one row for each). At least an eighth of
the candidates lies on either side, so a round discards or accepts that many for certain; what is left is written and the
next round reads nothing else. Keys are unique (score, id, row), so any number of ties is split exactly. Only the winners are sorted.

Edge cases: a null or empty text has no features, weight 0 and, like all with fewer than `least` words, is never drawn; a null id sorts after all others; repeated
rows are scored and drawn each; empty tables give empty counts (gains of smoothing alone) and an empty result; texts of any length are counted
whole, run by run. Extra columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.common import query, stash, table, unstash
from creditloom.llm.words import raw_texts, word_runs
from creditloom.session import shuffle_width

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = (25, 100)
SEED = 7
#: Candidates that are few enough to be looked at in one place.
FEW = 10_000
KEY = ["k_score", "k_id", "k_row"]


def feature_buckets(raw: bytes | None, buckets: int = BUCKETS):
    """(words, buckets of their features) for each run of words of a text; runs are joined by the pair across them."""
    spaced: list[int] = []
    for words in word_runs(raw):
        before = spaced[-1:]
        single = list(map(crc32, words))
        spaced = list(map(crc32, repeat(b" "), single))
        pairs = map(crc32, words if before else words[1:], before + spaced)
        yield len(words), np.fromiter([*single, *pairs], np.int64) % buckets
        if not words:
            spaced = before


def count_buckets(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all features of texts (text); tasks sum up what they read first."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in raw_texts(batch.column(0)):
                for _, found in feature_buckets(raw, buckets):
                    total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket in thousandths; as many numbers as there are buckets reach the driver."""
    own, theirs = (stash(count_buckets(x, buckets), "bucket-counts") for x in (docs, target))
    s_all, t_all = (x.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for x in (own, theirs))
    both = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(own.withColumnRenamed("n", "s"), "bucket", "left").join(theirs.withColumnRenamed("n", "t"), "bucket", "left")
    ratio = (F.coalesce("t", F.lit(0)) + 1.0) * float(s_all + buckets) / ((F.coalesce("s", F.lit(0)) + 1.0) * float(t_all + buckets))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["gain"]
    unstash(own)
    unstash(theirs)
    return out


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """docs with n_words, n_features and weight, the floored mean of the gains of their features."""
    results = ["n_words", "n_features", "weight"]
    keep = [c for c in docs.columns if c not in results]
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            made = []
            for raw in raw_texts(column["text"]):
                words = n = total = 0
                for more, found in feature_buckets(raw, buckets):
                    words += more
                    n += len(found)
                    total += int(gain[found].sum())
                made.append((words, n, total // n if n else 0))
            yield pa.RecordBatch.from_arrays([column[c] for c in keep] + [pa.array([m[i] for m in made], pa.int64()) for i in range(3)], names=keep + results)

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in results]))


def gumbel_score(seed: int = SEED, weight: str = "weight", doc_id: str = "doc_id"):
    """weight plus Gumbel noise in thousandths, drawn by a hash of the id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.col(weight) + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _after(bound: tuple):
    """Whether a row's key comes after bound."""
    score, doc, row = (F.col(c) for c in KEY)
    return (score > bound[0]) | ((score == bound[0]) & ((doc > bound[1]) | ((doc == bound[1]) & (row > bound[2]))))


def _weighted_median(medians: list[tuple]) -> tuple:
    """The first key at which half of the weight is reached; medians holds (key, weight)."""
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def partition_medians(keys: DataFrame) -> list[tuple]:
    """(key, rows) for each partition: the median of its batches' medians, weighted by their rows."""
    def run(batches):
        medians = []
        for batch in batches:
            if batch.num_rows:
                a, b, c = (batch.column(i).to_numpy() for i in range(3))
                mid = np.lexsort((c, b, a))[(batch.num_rows - 1) // 2]
                medians.append(((int(a[mid]), int(b[mid]), int(c[mid])), batch.num_rows))
        if medians:
            key = _weighted_median(medians)
            yield pa.RecordBatch.from_pylist([dict(zip([*KEY, "n"], [*key, sum(n for _, n in medians)]))])

    found = keys.select(*KEY).mapInArrow(run, ", ".join(f"{c} long" for c in [*KEY, "n"])).collect()  # one row for each partition
    return [(tuple(r[c] for c in KEY), r["n"]) for r in found]


def cutoff(keys: DataFrame, k: int, few: int = FEW) -> tuple | None:
    """The k-th smallest key; None if k < 1. keys has unique KEY columns and at least k rows."""
    if k < 1:
        return None
    now, left, n = keys.select(*KEY), k, None
    own = None
    while True:
        medians = partition_medians(now)
        n = sum(m for _, m in medians)
        if n <= few:
            break
        middle = _weighted_median(medians)
        upto = now.where(~_after(middle)).count()
        if upto == left:
            unstash(own)
            return middle
        before = own
        own = stash(now.where(_after(middle) if upto < left else ~_after(middle)), "candidates")
        unstash(before)
        left -= upto if upto < left else 0
        now = own
    rows = sorted(tuple(r) for r in now.collect())  # at most few
    unstash(own)
    return rows[left - 1]


def _ranked(winners: DataFrame) -> DataFrame:
    """winners with their rank by KEY: sorted in ranges, counted on from one range to the next."""
    spark = winners.sparkSession
    ordered = winners.repartitionByRange(shuffle_width(spark), *KEY).sortWithinPartitions(*KEY)
    placed = stash(ordered.withColumn("_place", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("_place", 33)
    counts = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one row for each range
    offsets, seen = [], 0
    for p, n in counts:
        offsets.append((p, seen))
        seen += n
    first = spark.createDataFrame(offsets, "_part long, _first long")
    return (placed.withColumn("_part", part).join(F.broadcast(first), "_part")
            .withColumn("rank", F.col("_first") + F.col("_place").bitwiseAND((1 << 33) - 1) + 1).drop("_part", "_first", "_place"))


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, least: int = LEAST_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, few: int = FEW, without: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text, ...) with n_words, n_features, weight, score and rank; rank is null for those not drawn.

    Of the documents with at least `least` words the share (numerator, denominator), rounded down, is drawn. Columns named in `without`
    are left out of the result, and of all that is written and sorted on the way to it.
    """
    scored = weigh(docs.drop("score", "rank"), gains(docs, target, buckets)).drop(*without).withColumn("score", gumbel_score(seed))
    keyed = stash(scored.withColumns({"k_score": -F.col("score"), "k_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)), "k_row": F.monotonically_increasing_id()}), "scored")
    able = F.col("n_words") >= least
    n = keyed.where(able).count()
    last = cutoff(keyed.where(able), share[0] * n // share[1], few)
    out = keyed.withColumn("rank", F.lit(None).cast("long"))
    if last is not None:
        won = able & ~_after(last)
        out = out.where(~won).unionByName(_ranked(keyed.where(won)))
    return out.drop(*KEY)


def _oracle() -> str:
    """CRC-32 is taken over half bytes with the table that follows from its polynomial."""
    half_bytes = []
    for c in range(16):
        for _ in range(4):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        half_bytes.append(c)
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT {words} AS w FROM benchmark),
df AS (SELECT doc_id, unnest(w) AS f FROM d UNION ALL SELECT doc_id, w[i] || ' ' || w[i + 1] FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)),
bf AS (SELECT unnest(w) AS f FROM b UNION ALL SELECT w[i] || ' ' || w[i + 1] FROM (SELECT w, unnest(range(1, len(w))) AS i FROM b)),
names AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
digits AS (SELECT f, list_transform(range(1, len(h) + 1), lambda i: instr('0123456789ABCDEF', h[i + CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END]) - 1) AS v FROM names),
coded AS (SELECT f, xor(list_reduce(v, lambda c, x: xor(c >> 4, ({half_bytes}::BIGINT[])[(xor(c, x) & 15) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM digits),
s AS (SELECT bucket, count(*) AS s FROM df JOIN coded USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN coded USING (f) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM df) + 10000)::DOUBLE
                / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bf) + 10000)::DOUBLE)))::BIGINT AS g
         FROM (SELECT bucket FROM s UNION SELECT bucket FROM t) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
sums AS (SELECT doc_id, count(*) AS n, sum(g) AS g FROM df JOIN coded USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
weighed AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce((g - ((g % n) + n) % n) // n, 0) AS weight FROM d LEFT JOIN sums USING (doc_id)),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
       CASE WHEN r <= (25 * (SELECT count(*) FROM placed)) // 100 THEN r END::BIGINT AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


@query("op13_resample", _oracle())
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample(docs, table(spark, sf_dir, "benchmark"), without=("text",))
    return drawn.select(*(F.col(c).cast("long").alias(c) for c in ("doc_id", "n_features", "weight", "score", "rank")))

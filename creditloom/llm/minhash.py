"""MinHash near-dedup: universal hash minima with banding, signature verification, exact confirmation, components.

A text is lower-cased (A-Z), cut into words at ASCII blanks, and stands for its distinct five-word shingles (with fewer
words, the whole sequence). Two documents are linked if the shared shingles are at least 75 % of the union; links are
confirmed on the full sets.

Documents with equal sets are merged first, so copies never meet each other. Each band bucket then compares its members with one
pivot (the smallest id); in buckets that still hold several components after that, what is outside the largest component is compared
with all other members in blocks of bounded size, by signatures and then exactly. A pair at similarity 0.75 shares no band with probability 5e-6.

Edge cases: a null or blank text has no shingles and is linked with nothing; a row without id can be a copy but not a representative, and is never
kept if its group has an id; repeated rows share one component; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.common import query, stash, table, unstash
from creditloom.llm.components import components

WORDS = 5
BANDS, ROWS = 32, 4
#: All minima count for the estimate, which errs by 0.027 (one sigma) at 0.75; pairs 4.5 sigma below the threshold still go on to the exact check.
MINIMA = 256
LEAST_ESTIMATE = 0.63
#: Mixed buckets with at most DIRECT pairs are joined directly, larger ones in blocks of BLOCK by BLOCK members that are compared inside
#: tasks; beyond HUGE pairs the blocks have eight times the members a side, so that members are copied to an eighth of the blocks.
DIRECT, BLOCK, HUGE = 256, 512, 1 << 30

_RNG = np.random.default_rng(20_240_229)
_A = (_RNG.integers(0, 2**63, MINIMA, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _RNG.integers(0, 2**63, MINIMA, dtype=np.uint64)
_WORD_MUL = _RNG.integers(0, 2**63, WORDS, dtype=np.uint64) | np.uint64(1)
_BAND_MUL = _RNG.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND_ADD = _RNG.integers(0, 2**63, BANDS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted 64-bit codes of a text's distinct shingles. Word codes are cached; the cache is emptied when it is full."""

    def __init__(self, cached: int = 1_000_000):
        self.codes: dict[bytes, int] = {}
        self.cached = cached

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        codes = self.codes
        if len(codes) > self.cached:
            codes.clear()
        for w in set(words):
            if w not in codes:
                codes[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
        k = min(WORDS, len(h))
        n = len(h) - k + 1
        key = np.full(n, k, np.uint64)
        for i in range(k):
            key += h[i:i + n] * _WORD_MUL[i]
        return np.unique(_mix(key))


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minima of all universal (multiply, add, shift) functions over the set."""
    x = (shingles >> np.uint64(32))[None, :]
    best = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, x.shape[1], 1024):
        part = _A[:, None] * x[:, i:i + 1024]
        part += _B[:, None]
        np.minimum(best, part.min(axis=1), out=best)
    return best >> np.uint64(32)


def band_keys(mins: np.ndarray) -> np.ndarray:
    return _mix((mins[:BANDS * ROWS].reshape(BANDS, ROWS) * _BAND_MUL).sum(axis=1, dtype=np.uint64) + _BAND_ADD).view(np.int64)


def profiles(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, sig) of every row; the set key is a 128-bit digest of the whole set."""
    def run(batches):
        shingler = Shingler()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            counts, keys, bands, sigs = [], [], [], []
            for t in texts:
                s = shingler(t.as_py())
                counts.append(len(s))
                if len(s):
                    mins = minima(s)
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(mins))
                    sigs.append((mins & np.uint64(255)).astype(np.uint8).tobytes())
                else:
                    keys.append(None), bands.append(None), sigs.append(None)
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                                              pa.array(sigs, pa.binary())], names=["doc_id", "n_shingles", "set_key", "bands", "sig"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return kept.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, bands array<long>, sig binary")


def _estimated(pairs: DataFrame) -> DataFrame:
    """pairs with sig_a and sig_b -> pairs whose estimated similarity reaches LEAST_ESTIMATE, as (a, b, est)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
            est = _agreement(a, b)
            mask = pa.array(est >= LEAST_ESTIMATE)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(est)], names=["a", "b", "est"]).filter(mask)

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long, est double")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough; texts holds (doc_id, text) of every document in them."""
    def run(batches):
        shingler, last, own = Shingler(), None, None
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("text_a"), batch.column("text_b")):
                left = left.as_py()
                if left != last:
                    last, own = left, shingler(left)
                other = shingler(right.as_py())
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(both > 0 and 100 * both >= 75 * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    named = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    return pairs.select("a", "b").join(named("b"), "b").join(named("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity from the share of equal signature bytes (one in 256 agrees by chance)."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def _mixed(members: DataFrame) -> DataFrame:
    """Buckets that hold more than one component: (bucket, largest, members, others, pairs); others are the members outside the largest."""
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    found = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("members"), F.max("n").alias("most"), F.count("*").alias("parts"))
    others = F.col("members") - F.col("most")
    return found.where("parts > 1").select("bucket", "largest", "members", others.alias("others"), (F.col("members") * others).alias("pairs"))


def _in_blocks(members: DataFrame, mixed: DataFrame, sets: DataFrame, texts: DataFrame) -> DataFrame:
    """Confirmed links (a, b) across components of large mixed buckets: blocks of the others meet blocks of all members.

    A block compares signatures, then the full sets of likely pairs, and joins what it has linked as it goes: pairs that are linked already need no
    test, and what leaves a block is a forest over its components, not its pairs. A pair that shares several buckets is tested in the first of them
    only: every bucket that holds two components is gone through, here or directly."""
    def compare(key, pdf):
        x, y = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        sig = np.frombuffer(b"".join(y["sig"]), np.uint8).reshape(len(y), -1) if len(y) else np.zeros((0, MINIMA), np.uint8)
        shingler, known, above = Shingler(), {}, {}

        def full(rep, text):
            if rep not in known:
                known[rep] = shingler(text)
            return known[rep]

        def root(part):
            while above.get(part, part) != part:
                above[part] = above.get(above[part], above[part])
                part = above[part]
            return part

        parts, out = y["component"].to_numpy(), []
        reps, y_texts = y["rep"].to_numpy(), y["text"].to_list()
        y_bands = np.stack(y["bands"].to_list()) if len(y) else np.zeros((0, 1), np.int64)
        for rep, component, own, text, bands in zip(x["rep"], x["component"], x["sig"], x["text"], x["bands"]):
            likely = np.flatnonzero((parts != component) & (_agreement(np.frombuffer(own, np.uint8)[None, :], sig) >= LEAST_ESTIMATE))
            likely = likely[bands[(y_bands[likely] == bands).argmax(axis=1)] == key[0]] if len(likely) else likely
            for j in likely.tolist():
                if root(component) == root(parts[j]):
                    continue
                left, right = full(rep, text), full(reps[j], y_texts[j])
                both = len(np.intersect1d(left, right, assume_unique=True))
                if both and 100 * both >= 75 * (len(left) + len(right) - both):
                    above[root(component)] = root(parts[j])
                    out.append((min(rep, reps[j]), max(rep, reps[j])))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    side = F.when(F.col("pairs") > HUGE, 8 * BLOCK).otherwise(BLOCK)
    parts = mixed.select("bucket", "largest", F.ceil(F.col("others") / side).alias("nx"), F.ceil(F.col("members") / side).alias("ny"))
    rows = members.join(parts, "bucket")
    at = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "rep"), F.col(n)).cast("long")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    x = rows.where("component <> largest").select("bucket", "rep", "component", F.lit(0).alias("side"), at("nx", 1).alias("xb"), upto("ny").alias("yb"))
    y = rows.select("bucket", "rep", "component", F.lit(1).alias("side"), upto("nx").alias("xb"), at("ny", 2).alias("yb"))
    full = sets.select("rep", "sig", "bands").join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep")
    return x.unionByName(y).join(full, "rep").groupBy("bucket", "xb", "yb").applyInPandas(compare, "a long, b long").distinct()


def _across(members: DataFrame, sets: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Likely pairs of small mixed buckets and confirmed links of large ones: what is outside a bucket's largest component meets all its other members."""
    sig = lambda c: sets.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}"))
    mixed = stash(_mixed(members), "mixed-buckets")
    x = members.join(mixed.where(F.col("pairs") <= DIRECT).select("bucket", "largest"), "bucket").select("bucket", "largest", "rep", "component")
    y = x.select("bucket", F.col("rep").alias("other"), F.col("component").alias("theirs"))
    pairs = (x.where("component <> largest").join(y, "bucket").where("component <> theirs")
             .select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct())
    direct = _estimated(pairs.join(sig("b"), "b").join(sig("a"), "a")).select("a", "b").distinct()
    return direct, _in_blocks(members, mixed.where(F.col("pairs") > DIRECT), sets, texts)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiled = stash(profiles(docs), "profiles")
    rows = stash(profiled.select("doc_id", "n_shingles", "set_key"), "set-keys")
    own = F.min_by(F.struct("bands", "sig"), "doc_id")
    sets = stash(profiled.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"), own.alias("own"))
                 .where("rep is not null").select("set_key", "rep", "own.bands", "own.sig"), "representatives")
    reps = sets.select("set_key", "rep")
    unstash(profiled)
    banded = sets.select("rep", F.explode("bands").alias("bucket"))
    buckets = stash(banded.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).where("pivot < last").select("bucket", "pivot"), "buckets")
    banded = stash(banded.join(buckets, "bucket"), "band-members")
    starred = stash(banded.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct(), "star-pairs")
    sig = lambda c: sets.select(F.col("rep").alias(c), F.col("sig").alias(f"sig_{c}"))
    likely = stash(_estimated(starred.join(sig("b"), "b").join(sig("a"), "a")), "likely-pairs")

    # every document with its likeliest pivot first; of the other pairs only those across components matter then
    first = stash(likely.groupBy("b").agg(F.max_by("a", F.struct("est", -F.col("a"))).alias("a")), "first-pairs")
    involved = banded.select(F.col("rep").alias("doc_id")).distinct()
    texts = stash(docs.join(involved, "doc_id", "left_semi"), "texts")
    links = stash(confirmed(first, texts), "links-first")
    comp = stash(components(links), "components-first")

    def labelled(pairs: DataFrame) -> DataFrame:
        of = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias(f"comp_{c}"))
        joined = pairs.join(of("b"), "b", "left").join(of("a"), "a", "left")
        return joined.where(F.coalesce("comp_a", "a") != F.coalesce("comp_b", "b")).select("a", "b")

    second = labelled(likely.join(first, ["a", "b"], "left_anti"))
    links = stash(links.unionByName(confirmed(second, texts)), "links-second")
    comp = stash(components(links), "components-second")

    labels = comp.withColumnRenamed("node", "rep")
    members = stash(banded.select("rep", "bucket").join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "band-components")
    direct, linked = _across(members, sets, texts)
    third = stash(direct.join(likely, ["a", "b"], "left_anti"), "pairs-across")
    more = stash(confirmed(third, texts).unionByName(linked), "links-third")
    if not more.isEmpty():
        comp = stash(components(links.unionByName(more)), "components")

    found = stash(reps.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("found")), "found")
    out = rows.select("doc_id", "n_shingles", "set_key").join(found, "set_key", "left")
    component = F.coalesce("found", "doc_id")
    unstash(texts)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.col("found").isNull()).alias("kept"))


@query("op7_minhash_dedup")
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Rows keep their columns."""
    gone = near_duplicates(docs).where("not kept and doc_id is not null").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone.hint("merge"), docs["doc_id"] == F.col("_gone"), "left_anti")

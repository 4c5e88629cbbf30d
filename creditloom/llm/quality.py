"""Quality rules: boosted trees with monotone constraints over document statistics.

Edge cases: a null text is an empty text (no words, so the base rule fails and it is not kept); with no
labelled row of either class the trees say the base rate; repeated rows are judged each on its own; rows with null
ids are scored like others; extra columns pass through and one named like the result is replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm import trees
from creditloom.llm.common import query, table, with_column_batches

SYMBOLS = re.compile(r"[#*$%&|<>]")
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: feature -> direction in which quality may move when it grows (0: free)
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "symbol_word_share": -1,
    "upper_share": -1, "digit_share": 0, "mark_share": -1, "distinct_share": 0, "line_words": 0, "longest_word": 0,
}
STATS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("features", T.ArrayType(T.DoubleType()))])
VERDICT = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]
                       + [T.StructField("base_failed", T.BooleanType()), T.StructField("quality", T.DoubleType()), T.StructField("kept", T.BooleanType())])

_MULTIPLIERS = np.random.default_rng(7).integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


def repeated_words(words: list) -> int:
    """Words inside windows of eight words that occur at least twice, the first occurrence included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    codes: dict = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.uint64, len(words))
    if len(codes) == len(words):
        return 0
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    key = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        key += mixed[i:i + n] * _MULTIPLIERS[i]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    cover[:n] += twice
    cover[WINDOW:WINDOW + n] -= twice
    return int((np.cumsum(cover) > 0).sum())


def duplicate_lines(raw: bytes) -> tuple[int, int]:
    """Lines with a word, and those among them that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """Counts of a text, and the features that the trees read."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    joined = b"".join(words)
    word_chars = len(joined.decode("utf-8", "surrogatepass"))
    symbols = len(SYMBOLS.findall(text))
    lines, dup = duplicate_lines(raw)
    repeat = repeated_words(words)
    size, low = max(word_chars, 1), joined.lower()
    upper = sum(a != b for a, b in zip(joined, low)) if joined != low and len(joined) < 64 else _differ(joined, low)
    digits = len(joined) - len(joined.translate(None, b"0123456789"))
    marks = joined.count(b"!") + joined.count(b"?")
    marked = sum(1 for w in words if SYMBOLS.search(w.decode("utf-8", "surrogatepass"))) if symbols else 0
    features = [float(np.log1p(n)), word_chars / max(n, 1), symbols / size, dup / max(lines, 1), repeat / max(n, 1), marked / max(n, 1),
                upper / size, digits / size, marks / size, len(set(words)) / max(n, 1), n / max(lines, 1), float(max(map(len, words), default=0))]
    return [n, word_chars, symbols, dup, repeat], features


def _differ(a: bytes, b: bytes) -> int:
    return int((np.frombuffer(a, np.uint8) != np.frombuffer(b, np.uint8)).sum())


def base_failed(counts: list[int]) -> bool:
    return counts[0] < 20 or 100 * counts[4] > 30 * counts[0]


def document_statistics(df: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    """df with a struct of counts and the feature vector of each text."""
    def run(texts):
        return [dict(zip(COUNTS, counts)) | {"features": features} for counts, features in map(statistics, texts)]

    return with_column_batches(df, run, text, into, STATS)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, trees_n: int = 60) -> trees.Forest:
    """Trees fitted on labelled documents, on about max_rows of them chosen by a hash of the id (all, if fewer).

    That bound is what makes the sample fit the driver; scoring covers every row.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("_label"))
    share = min(1.0, max_rows / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about max_rows rows, whatever the input
    data = document_statistics(rows).select("_label", "stats.features").toPandas()
    x = np.array(data["features"].tolist(), float).reshape(-1, len(FEATURES))
    y = (data["_label"].to_numpy(float) > 0).astype(float)
    order = np.lexsort(x.T)  # the same model whatever the order in which rows arrive
    return trees.fit(x[order], y[order], list(FEATURES.values()), trees_n)


def judge(df: DataFrame, forest: trees.Forest, threshold: float = 0.5, text: str = "text", into: str = "verdict") -> DataFrame:
    """df with the counts, the base rule, the trees' probability of good quality and the verdict."""
    def run(texts):
        found = [statistics(t) for t in texts]
        if not found:
            return []
        p = np.concatenate([forest.probability(np.array([f for _, f in found[i:i + 1024]])) for i in range(0, len(found), 1024)])
        return [dict(zip(COUNTS, counts)) | {"base_failed": base_failed(counts), "quality": float(q), "kept": bool(not base_failed(counts) and q >= threshold)}
                for (counts, _), q in zip(found, p)]

    return with_column_batches(df, run, text, into, VERDICT)


def keep_good(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were."""
    verdict = "_quality_verdict"
    return judge(df, fit(df, labels), into=verdict).where(f"{verdict}.kept").drop(verdict)


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, fit(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *[f"verdict.{c}" for c in (*COUNTS, "base_failed", "quality", "kept")])

"""Benchmark decontamination by Wu-Manber search for windows of benchmark words.

A window is a run of `length` words of a benchmark item (a shorter item is one window). Windows of one length make one matcher: its shift table
says how far the search may move on after reading a block of words, a block that ends some window selects a bucket by that
suffix and by the window's first block, and the windows in the bucket are compared word by word. All occurrences are found,
overlapping ones too.

The distinct (window, item) rows are dealt into blocks of at most MAX_WINDOWS by a hash of both, so a window of very many items is split too. Each block is a
stated, bounded query set that is sent to the tasks; documents are read once for each block and never shuffled. Nothing else is
collected, and a lost task is simply run again.

Edge cases: a null or empty text, document or item, has no words; items without words match nothing; a null item id hits but is not
listed; repeated documents are searched each; repeated items are one window; texts of any length are searched whole, split
piece by piece; without documents the result is empty, without items nothing is hit. Extra columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.common import arrow_type, query, stash, table, unstash
from creditloom.llm.words import raw_texts, word_runs

LENGTH = 10
#: Words in a block of the shift table.
BLOCK = 3
#: Windows that are sent to the tasks at a time.
MAX_WINDOWS = 100_000
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
])


class WuManber:
    """Search for word windows of one length; owners holds the items of each window."""

    def __init__(self, owners: dict[tuple, set], length: int, block: int = BLOCK):
        self.length, self.block = length, min(block, length)
        self.shifts: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = {}
        for window, items in owners.items():
            for end in range(self.block, length + 1):
                key = window[end - self.block:end]
                self.shifts[key] = min(self.shifts.get(key, length), length - end)
            by_prefix = self.buckets.setdefault(window[-self.block:], {})
            by_prefix.setdefault(window[:self.block], []).append((list(window), items))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(first word, items) of every occurrence, in order."""
        length, block, shifts, buckets = self.length, self.block, self.shifts, self.buckets
        far, n, at = length - block + 1, len(words), length
        while at <= n:
            key = tuple(words[at - block:at])
            shift = shifts.get(key, far)
            if shift:
                at += shift
                continue
            start = at - length
            for window, items in buckets[key].get(tuple(words[start:start + block]), ()):
                if words[start:at] == window:
                    yield start, items
            at += 1


class Matchers:
    """Matchers for windows of every length that occurs among (window, item) rows."""

    def __init__(self, rows: Iterable[tuple[bytes, str | None]]):
        by_length: dict[int, dict[tuple, set]] = {}
        names: dict[bytes, bytes] = {}
        for text, item in rows:
            window = tuple(names.setdefault(w, w) for w in text.split(b" "))
            items = by_length.setdefault(len(window), {}).setdefault(window, set())
            if item is not None:
                items.add(item)
        self.all = [WuManber(owners, n) for n, owners in sorted(by_length.items())]
        self.longest = max(by_length, default=1)

    def search(self, raw: bytes | None) -> tuple[int, list[tuple[int, int]], set]:
        """(words, merged spans of hit words, items) of a text."""
        spans, items, carried, seen = [], set(), [], 0
        for run in word_runs(raw):
            words = carried + run
            base = seen - len(carried)
            for m in self.all:
                # occurrences that lie in the carried words alone were found with the run before
                skip = max(0, len(carried) - m.length + 1)
                for start, owners in m.occurrences(words[skip:] if skip else words):
                    spans.append((base + skip + start, base + skip + start + m.length))
                    items |= owners
            seen += len(run)
            carried = words[max(0, len(words) - self.longest + 1):]
        return seen, merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, as disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_MADE: dict[str, Matchers] = {}


def _matchers(name: str, rows: list[tuple]) -> Matchers:
    """The matchers of this Python worker; the last ones are kept for its next task."""
    if name not in _MADE:
        _MADE.clear()
        _MADE[name] = Matchers(rows)
    return _MADE[name]


def windows(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """Distinct (window, item) of items (item_id, text); a window is its words joined by blanks."""
    def run(batches):
        for batch in batches:
            found, owners = [], []
            for item, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                carried: list[bytes] = []
                made = False
                for words in word_runs(raw):
                    words = carried + words
                    for i in range(len(words) - length + 1):
                        found.append(b" ".join(words[i:i + length]))
                        owners.append(item)
                        made = True
                    carried = words[max(0, len(words) - length + 1):]
                if carried and not made:
                    found.append(b" ".join(carried))
                    owners.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(owners, pa.string())], names=["window", "item"])

    return items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(run, "window binary, item string").distinct()


def _search(docs: DataFrame, rows: list[tuple], found_before: bool) -> DataFrame:
    """docs with the results of one block of windows, joined with those of the blocks before."""
    results = RESULT.fieldNames()
    keep = [c for c in docs.columns if c not in results]
    name = uuid.uuid4().hex
    kinds = [arrow_type(f.dataType) for f in RESULT]

    def run(batches):
        matchers = _matchers(name, rows)
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            got = [matchers.search(raw) for raw in raw_texts(column["text"])]
            if found_before:
                old = zip(column["spans"].to_pylist(), column["item_ids"].to_pylist())
                got = [(n, merged(spans + [(s["start"], s["end"]) for s in o]), items.union(i)) for (n, spans, items), (o, i) in zip(got, old)]
            made = [[n for n, _, _ in got], [[{"start": a, "end": b} for a, b in spans] for _, spans, _ in got], [sorted(items) for _, _, items in got]]
            yield pa.RecordBatch.from_arrays([column[c] for c in keep] + [pa.array(v, k) for v, k in zip(made, kinds)], names=keep + results)

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in keep] + RESULT.fields))


def find_leaks(docs: DataFrame, items: DataFrame, length: int = LENGTH, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """docs (text, ...) with n_words, the spans of words that lie in a window of items (item_id, text), and the ids of these items in order."""
    known = stash(windows(items, length), "benchmark-windows")
    blocks = max(1, -(-known.count() // max_windows))
    # twice the blocks that an even share needs, so that none gets more than max_windows rows by chance
    blocks = 2 * blocks if blocks > 1 else 1
    known = known.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    out = docs.drop(*RESULT.fieldNames())
    for b in range(blocks):
        rows = [(bytes(r["window"]), r["item"]) for r in known.where(F.col("block") == b).collect()]  # bounded by max_windows
        before = out
        out = _search(out, rows, found_before=b > 0)
        if blocks > 1:
            out = stash(out, "leaks")  # blocks follow one another; no task holds two
            unstash(before)
    unstash(known)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs without those that hold a window of items."""
    return find_leaks(docs, items, length).where(F.size("spans") == 0).select(*docs.columns)


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
         FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
runs AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
         FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n, -1) + 2)) AS i FROM d, (SELECT DISTINCT n FROM wins))),
found AS (SELECT DISTINCT doc_id, i, n, item_id FROM runs JOIN wins USING (n, p)),
hits AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)
"""


@query("op12_decontaminate", ORACLE)
def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))

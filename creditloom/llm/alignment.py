"""Alignment of two tokenizers over the same bytes: byte-level BPE (A) and pieces with byte fallback (B).

Inside tasks, documents are taken in blocks of about BLOCK_BYTES of text. Both token sequences of a block are laid out by
byte position and joined by `merge_asof` in both directions, keyed by document: the start of each token finds the token of the other side that covers it.
The union of both directions is every overlapping pair once; positions where both sides end cut the documents into groups.

How often two ids are linked in the corpus is counted from one row per block and distinct id pair. The totals go back the same
way, as one array per block, and meet the documents of their block in a cogroup; so neither links nor texts are shuffled, a
pair of which every document is full costs one row a block, and no table of pairs is ever broadcast or collected.

Edge cases: texts that are null or empty, and those whose tokens don't spell a blank and the text on both sides, have no tokens (zeros, no groups, digest '');
strings of special tokens are plain text; a null id passes through; repeated rows are aligned and counted each, ties for the highest count are all
best; an empty table gives an empty result; a text longer than a block is a block of its own, aligned whole. Extra columns pass
through, those named like a result are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.common import query, stash, table

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Text that is aligned, and whose id pairs are counted, together.
BLOCK_BYTES = 1 << 21
#: Id pairs are single numbers: id of A times this plus id of B.
RADIX = 1 << 20


class ByteLevel:
    """Encoder of a byte-level BPE vocabulary file; token i stands for the bytes spelled[i]."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        of_char = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(map(of_char.__getitem__, t)): i for t, i in model["vocab"].items() if all(c in of_char for c in t) and t != "<|endoftext|>"}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError("merges must stand in the order of their ids")
        self.spelled = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.spelled[i] = t
        self.encoding = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """Encoder of a sentence-piece model, which puts the blank before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        self.spelled = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.model.id_to_piece(i)) for i in ids)]

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@functools.lru_cache(1)
def encoders(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    """The encoders of this Python worker, kept for its next task."""
    return ByteLevel(path_a), Pieces(path_b)


class Side:
    """Tokens of one side of a block: document, id, and byte positions that go on from one document to the next."""

    def __init__(self, ids: list[list[int]], spelled: list[bytes], lengths: np.ndarray):
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        self.counts = counts
        self.doc = np.repeat(np.arange(len(ids)), counts)
        self.id = np.fromiter((i for x in ids for i in x), np.int64, int(counts.sum()))
        self.end = np.cumsum(lengths[self.id])
        self.start = self.end - lengths[self.id]

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"start": self.start, "doc": self.doc, name: np.arange(len(self.id))})


class Aligned:
    """Links and groups of a block of texts; documents without tokens have empty ranges."""

    def __init__(self, texts: list[str | None], a: ByteLevel, b: Pieces):
        given = [t or "" for t in texts]
        full = [i for i, t in enumerate(given) if t]
        ids_a, ids_b = [[] for _ in given], [[] for _ in given]
        chosen = [given[i] for i in full]
        for i, x, y in zip(full, a(chosen), b(chosen)):
            want = (" " + given[i]).encode("utf-8", "surrogatepass")
            if b"".join(map(a.spelled.__getitem__, x)) == want and b"".join(map(b.spelled.__getitem__, y)) == want:
                ids_a[i], ids_b[i] = x, y
        self.a = Side(ids_a, a.spelled, _lengths(a))
        self.b = Side(ids_b, b.spelled, _lengths(b))
        over_a = pd.merge_asof(self.a.frame("a"), self.b.frame("b"), on="start", by="doc")
        over_b = pd.merge_asof(self.b.frame("b"), self.a.frame("a"), on="start", by="doc")
        # where both start together the pair is in both directions
        found = {c: (over_a[c].to_numpy(np.int64), over_b[c].to_numpy(np.int64)) for c in "ab"}
        new = self.a.start[found["a"][1]] != self.b.start
        self.link_a, self.link_b = (np.concatenate([found[c][0], found[c][1][new]]) for c in "ab")
        cuts = np.intersect1d(self.a.end, self.b.end, assume_unique=True)
        self.group_a = np.searchsorted(cuts, self.a.end)
        self.group_b = np.searchsorted(cuts, self.b.end)
        self.last_a = np.isin(self.a.end, cuts, assume_unique=True)
        self.last_b = np.isin(self.b.end, cuts, assume_unique=True)
        self.n = len(given)
        self.n_groups = np.bincount(self.a.doc[self.last_a], minlength=self.n)
        self.link_doc = self.a.doc[self.link_a]
        self.n_links = np.bincount(self.link_doc, minlength=self.n)

    def spelled_groups(self) -> list[str]:
        """The groups of each document: ids of A, then ids of B, decimal."""
        a_ends, b_ends = self.last_a, self.last_b
        final = np.zeros(len(self.b.id), bool)
        ends = np.cumsum(self.b.counts)
        final[ends[self.b.counts > 0] - 1] = True
        parts_a = np.where(a_ends, _decimal("|")[self.a.id], _decimal(",")[self.a.id])
        parts_b = np.where(final, _decimal("")[self.b.id], np.where(b_ends, _decimal(";")[self.b.id], _decimal(",")[self.b.id]))
        order = np.argsort(np.concatenate([2 * self.group_a, 2 * self.group_b + 1]), kind="stable")
        parts = np.concatenate([parts_a, parts_b])[order].tolist()
        out, at = [], 0
        for n in (self.a.counts + self.b.counts).tolist():
            out.append("".join(parts[at:at + n]))
            at += n
        return out


@functools.lru_cache(8)
def _decimal(after: str) -> np.ndarray:
    return np.array([f"{i}{after}" for i in range(100_000)], object)


def _lengths(encoder) -> np.ndarray:
    return np.fromiter(map(len, encoder.spelled), np.int64, len(encoder.spelled))


def blocks_of(batch: pa.RecordBatch, text: int, most: int):
    """Slices of a batch with about `most` bytes of text each; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def align(docs: DataFrame, path_a: str, path_b: str, most: int = BLOCK_BYTES) -> DataFrame:
    """docs (text, ...) with the ids of both sides and, for each token, the number of its group; links holds overlapping places in both."""
    links = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    made = T.StructType([T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("a_ids", "b_ids", "a_groups", "b_groups")] + [T.StructField("links", T.ArrayType(links))])
    keep = [c for c in docs.columns if c not in made.fieldNames()]

    def run(batches):
        a, b = encoders(path_a, path_b)
        for batch in batches:
            names = batch.schema.names
            for part in blocks_of(batch, names.index("text"), most):
                got = Aligned(part.column(names.index("text")).to_pylist(), a, b)
                ends_a, ends_b = np.append(0, np.cumsum(got.a.counts)), np.append(0, np.cumsum(got.b.counts))
                ends_groups = np.append(0, np.cumsum(got.n_groups))
                order = np.lexsort((got.link_b, got.link_a))
                link_ends = np.append(0, np.cumsum(got.n_links))
                pairs = pa.StructArray.from_arrays([pa.array((x[order] - e[got.link_doc[order]]).astype(np.int32)) for x, e in ((got.link_a, ends_a), (got.link_b, ends_b))], names=["a", "b"])
                lists = [pa.ListArray.from_arrays(pa.array(e.astype(np.int32)), pa.array(v.astype(np.int32))) for e, v in (
                    (ends_a, got.a.id), (ends_b, got.b.id), (ends_a, got.group_a - ends_groups[got.a.doc]), (ends_b, got.group_b - ends_groups[got.b.doc]))]
                yield pa.RecordBatch.from_arrays([part.column(names.index(c)) for c in keep] + lists + [pa.ListArray.from_arrays(pa.array(link_ends.astype(np.int32)), pairs)], names=keep + made.fieldNames())

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in keep] + made.fields))


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _measure(docs: DataFrame, path_a: str, path_b: str, most: int) -> DataFrame:
    """A row for each document (kind 0) with its counts and the slots of its id pairs, and one for each block (kind 1) with its distinct pairs."""
    def run(batches):
        a, b = encoders(path_a, path_b)
        task = TaskContext.get().partitionId()
        seen = 0
        for batch in batches:
            for part in blocks_of(batch, 1, most):
                block, seen = (task << 32) + seen, seen + 1
                got = Aligned(part.column(1).to_pylist(), a, b)
                pairs, slot, n = np.unique(got.a.id[got.link_a] * RADIX + got.b.id[got.link_b], return_inverse=True, return_counts=True)
                own, times = np.unique(got.link_doc * max(1, len(pairs)) + slot, return_counts=True)
                doc, slot = np.divmod(own, max(1, len(pairs)))
                ends = np.append(0, np.cumsum(np.bincount(doc, minlength=got.n))).astype(np.int32)
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in got.spelled_groups()]
                rows = got.n
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * rows, pa.int64()), pa.array([0] * rows, pa.int32()), part.column(0)]
                    + [pa.array(x.astype(np.int64)) for x in (got.a.counts, got.b.counts, got.n_groups, got.n_links)]
                    + [pa.array(digests), pa.ListArray.from_arrays(pa.array(ends), pa.array(slot.astype(np.int32))),
                       pa.ListArray.from_arrays(pa.array(ends), pa.array(times.astype(np.int64))), pa.nulls(rows, pa.list_(pa.int64()))], names=names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([1], pa.int32()), pa.nulls(1, pa.int64())] + [pa.nulls(1, pa.int64())] * 4
                    + [pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32())), pa.array([n.astype(np.int64)], pa.list_(pa.int64())), pa.array([pairs], pa.list_(pa.int64()))], names=names)

    names = ["block", "kind", "doc_id", *_COUNTS, "groups_sha256", "slots", "times", "pairs"]
    schema = "block long, kind int, doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", groups_sha256 string, slots array<int>, times array<long>, pairs array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n, best) over the corpus from rows (pair, n) of blocks; best marks the highest n of an id of B, ties included."""
    counted = stash(blocks.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    b = F.col("pair") % RADIX
    most = counted.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counted.withColumn("b", b).join(most, "b").select("pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best"))


def _sum_up(key, documents: pa.Table, values: pa.Table) -> pa.Table:
    """Of one block: the documents with the sums of the corpus-wide counts over their links."""
    slot = values.column("slot").to_numpy()
    total, best = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
    total[slot], best[slot] = values.column("total").to_numpy(), values.column("best").cast(pa.int64()).to_numpy()
    slots, times = documents.column("slots").combine_chunks(), documents.column("times").combine_chunks()
    own, n = np.asarray(slots.flatten()), np.asarray(times.flatten())
    ends = np.append(0, np.cumsum(np.asarray(slots.value_lengths())))
    sums = [np.append(0, np.cumsum(v[own] * n)) for v in (total, best)] if len(own) else [np.zeros(1, np.int64)] * 2
    count_sum, n_best = (s[ends[1:]] - s[ends[:-1]] for s in sums)
    keep = ["doc_id", *_COUNTS, "groups_sha256"]
    return pa.table([documents.column(c) for c in keep] + [pa.array(n_best), pa.array(count_sum)], names=keep + ["n_best", "count_sum"])


def link_statistics(docs: DataFrame, path_a: str, path_b: str, most: int = BLOCK_BYTES) -> DataFrame:
    """Per row of docs (doc_id, text): n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum."""
    measured = stash(_measure(docs, path_a, path_b, most), "aligned")
    documents = measured.where("kind = 0").select("block", "doc_id", *_COUNTS, "groups_sha256", "slots", "times")
    lists = measured.where("kind = 1").select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("slot", "x"))
    of_blocks = lists.select("block", "slot", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    totals = stash(pair_counts(of_blocks), "pair-totals")
    values = of_blocks.join(totals, "pair").select(F.col("block").alias("owner"), "slot", "total", "best")
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", groups_sha256 string, n_best long, count_sum long"
    return documents.groupBy("block").cogroup(values.groupBy("owner")).applyInArrow(_sum_up, schema)


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_statistics(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B))

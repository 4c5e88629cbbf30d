"""Best-fit packing of tokenized documents into fixed-length sequences, in bulk-synchronous rounds.

Pieces and open sequences are ordered by size. In each round the gaps of all open sequences are counted by size, a successor
sweep from the longest pieces down gives each length the smallest gaps that take it, and rows are matched by their
rank within a size: the i-th gap of a size takes the next pieces of its length. Then all gaps are updated and the next round
begins. Pieces that fit no gap open new sequences, no more of them than their volume needs.

Sizes are integers up to the capacity, so what reaches the driver in a round is a histogram of at most capacity + 1
counts; pieces and sequences stay in Spark. Ranks are counted in salted parts, so one length may hold any share of the rows.

Edge cases: a null or empty text is the end token alone; a null id is an ordinary value; repeated rows are packed each; an
empty table gives no sequence; extra columns are ignored; a text of any length is encoded whole and cut by tokens; ties within a length go by (doc_id, piece).
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.llm.common import query, stash, table
from creditloom.session import shuffle_width

CAPACITY = 4096
END = 1
VOCABULARY = "word_bpe_49k.json"
#: Sequences made from one row when new ones are opened.
CHUNK = 50_000
#: Words that are encoded in one call.
JOINED = 512
#: A capital and the first byte of a mark from U+0300 to U+037F; no others compose with ASCII letters.
_COMPOSING = re.compile(rb"[A-Z][\xcc\xcd]")


class WordEncoder:
    """Token ids of a text as little-endian 32-bit bytes.

    The vocabulary's pre-tokenizer never joins text across white space, so each word between ASCII blanks is encoded once
    and remembered (the memory is emptied when full). Final full stops and commas are pieces of their own after a letter or digit.
    Words are remembered in lower case, but in texts where a capital may compose with a mark before the vocabulary lowers it
    only those of ASCII alone. Texts that hold the string of a special token are encoded whole.
    """

    def __init__(self, path: str, cached: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        self.cached = cached

    def _encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. JOINED words are encoded in one call and told apart by where their tokens start, which is cheaper than a call each."""
        out = []
        for i in range(0, len(words), JOINED):
            part = [w.decode("utf-8", "replace") for w in words[i:i + JOINED]]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            starts = np.array([at for at, _ in found.offsets], np.int64)
            cuts = np.searchsorted(starts, np.cumsum([len(w) + 1 for w in part])).tolist()
            out += [ids[a:b].tobytes() for a, b in zip([0, *cuts], cuts)]
        return out

    def _whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        parts, tails = {}, {}
        for w in words:
            core = w.rstrip(b".,")
            if core != w and core and core[-1:].isalnum():
                tails[w] = (core, w[len(core):])
            else:
                parts[w] = None
        known = self.known
        for core, tail in tails.values():
            for x in (core, tail):
                if x not in known:
                    parts[x] = None
        new = list(parts)
        known.update(zip(new, self._encode(new)))
        for w, (core, tail) in tails.items():
            known[w] = known[core] + known[tail]

    def __call__(self, texts: list) -> list[bytes]:
        out, known = [], self.known
        for i in range(0, len(texts), 256):
            raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts[i:i + 256]]
            whole = {j for j, t in enumerate(raw) if b"<|" in t and any(s in t for s in self.special)}
            split = [[] if j in whole else [w.lower() if w.isascii() else w for w in t.split()] if _COMPOSING.search(t) else t.lower().split() for j, t in enumerate(raw)]
            if len(known) > self.cached:
                known.clear()
            missing = {w for words in split for w in words if w not in known}
            if missing:
                self._learn(missing)
            out += [self._whole(raw[j]) if j in whole else b"".join(map(known.__getitem__, words)) for j, words in enumerate(split)]
        return out


@functools.lru_cache(1)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker; a worker that runs several tasks keeps what it has learnt."""
    return WordEncoder(path)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for each document, cut only where longer than capacity; with_ids adds the ids."""
    tail = array("I", [end]).tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * with_ids

    def run(batches):
        encoder = word_encoder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder(part.column(1).to_pylist())):
                    ids += tail
                    n = len(ids) // 4
                    for piece, start in enumerate(range(0, n, capacity)):
                        own = ids[4 * start:4 * (start + capacity)]
                        rows.append((doc_id, piece, start, len(own) // 4, zlib.crc32(own)) + ((np.frombuffer(own, "<u4").astype(np.int64),) if with_ids else ()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def ranked(df: DataFrame, size: str, order: list[str], salt, into: str = "rank") -> DataFrame:
    """df with a dense rank from 0 among the rows of the same size, counted in salted parts."""
    parts = max(1, shuffle_width(df.sparkSession))
    df = df.withColumn("_salt", F.pmod(salt, F.lit(parts)))
    counts = df.groupBy(size, "_salt").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(size).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)))
    inner = F.row_number().over(Window.partitionBy(size, "_salt").orderBy(*order))
    return (df.withColumn("_inner", inner).join(before.select(size, "_salt", "_before"), [size, "_salt"])
            .withColumn(into, F.coalesce("_before", F.lit(0)) + F.col("_inner") - 1).drop("_salt", "_inner", "_before"))


def sweep(left: dict[int, int], taken: dict[int, int], gaps: dict[int, int]) -> list[tuple]:
    """One successor sweep over the counts: left pieces by length, gaps by size; both are used up as they are matched.

    Rows are (gap, first gap rank, gaps, length, first piece rank, pieces, pieces a gap): each gap serves one length in a round.
    """
    matches, used = [], dict.fromkeys(gaps, 0)
    sizes = sorted(gaps)
    free = np.array([gaps[g] for g in sizes], np.int64)
    values = np.array(sizes, np.int64)
    for length in sorted((n for n, c in left.items() if c), reverse=True):
        at = int(np.searchsorted(values, length))
        while left[length] and at < len(values):
            if free[at]:
                gap = sizes[at]
                each = gap // length
                n = int(min(free[at], -(-left[length] // each)))
                pieces = min(left[length], n * each)
                matches.append((gap, used[gap], n, length, taken[length], pieces, each))
                used[gap] += n
                free[at] -= n
                taken[length] += pieces
                left[length] -= pieces
            else:
                later = np.flatnonzero(free[at:])
                if not len(later):
                    break
                at += int(later[0])
                continue
            at += not free[at]
    return matches


def openings(left: dict[int, int], taken: dict[int, int], largest_gap: int, capacity: int) -> list[tuple]:
    """New sequences for the longest pieces that fit no gap: (sequences, length, first piece rank, pieces, pieces a sequence)."""
    homeless = sorted((n for n, c in left.items() if c and n > largest_gap), reverse=True)
    quota = -(-sum(n * left[n] for n in homeless) // capacity)
    opened = []
    for length in homeless:
        each = capacity // length
        n = -(-left[length] // each)
        if each > 1:
            n = min(n, quota)
        if n <= 0:
            break
        pieces = min(left[length], n * each)
        opened.append((n, length, taken[length], pieces, each))
        taken[length] += pieces
        left[length] -= pieces
        quota -= n
    return opened


def _opened(spark: SparkSession, plan: list[tuple], first_id: int, capacity: int) -> DataFrame:
    rows, at = [], first_id
    for n, length, rank, pieces, each in plan:
        rows.append((at, n, length, rank, pieces, each))
        at += n
    wide = spark.createDataFrame(rows, "first long, n long, length long, at long, pieces long, each long")
    chunks = wide.withColumn("c", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / CHUNK).cast("long")))).repartition(shuffle_width(spark), "first", "c")
    made = chunks.withColumn("i", F.explode(F.expr(f"sequence(c * {CHUNK}, least(n, (c + 1) * {CHUNK}) - 1)")))
    return made.select((F.col("first") + F.col("i")).alias("sequence_id"), F.lit(capacity).cast("long").alias("gap"), "length",
                       (F.col("at") + F.col("i") * F.col("each")).alias("rank"), F.expr("least(each, pieces - i * each)").alias("k"))


def _matched(seqs: DataFrame, plan: list[tuple]) -> DataFrame:
    """Sequences that are matched in this round, by (gap, rank of the gap)."""
    spark = seqs.sparkSession
    rows = spark.createDataFrame(plan, "gap long, first long, n long, length long, at long, pieces long, each long")
    ordered = ranked(seqs, "gap", ["sequence_id"], F.col("sequence_id"), "gap_rank")
    # the plan has at most a few rows for each of the capacity + 1 gap sizes, whatever the input
    joined = ordered.join(F.broadcast(rows), "gap", "left").where("first is null or gap_rank between first and first + n - 1")
    hit = joined.where("first is not null").withColumn("i", F.col("gap_rank") - F.col("first"))
    return hit.select("sequence_id", "gap", "length", (F.col("at") + F.col("i") * F.col("each")).alias("rank"), F.expr("least(each, pieces - i * each)").alias("k"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (doc_id, piece, length, ...; lengths from 1 to capacity) with sequence_id and offset, gapless within a sequence."""
    spark = pieces.sparkSession
    items = stash(ranked(pieces, "length", ["doc_id", "piece"], F.xxhash64("doc_id", "piece")), "ranked-pieces")
    left = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    taken = dict.fromkeys(left, 0)
    rounds, seqs, gaps, next_id = [], None, {}, 0
    while any(left.values()):
        largest = max(gaps, default=0)
        new = openings(left, taken, largest, capacity)
        plan = sweep(left, taken, gaps)
        state = None
        if plan:
            state = _matched(seqs, plan)
        if new:
            opened = _opened(spark, new, next_id, capacity)
            next_id += sum(x[0] for x in new)
            state = opened if state is None else state.unionByName(opened)
        state = stash(state, "packing-round")
        rounds.append(state)
        least = min((n for n, c in left.items() if c), default=capacity + 1)
        after = state.select("sequence_id", (F.col("gap") - F.col("k") * F.col("length")).alias("gap"))
        if seqs is not None:
            same = seqs.join(state.select("sequence_id"), "sequence_id", "left_anti") if plan else seqs
            after = after.unionByName(same)
        seqs = stash(after.where(F.col("gap") >= least), "open-sequences")
        gaps = {r["gap"]: r["n"] for r in seqs.groupBy("gap").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    places = None
    for state in rounds:
        places = state if places is None else places.unionByName(state)
    if places is None:
        return items.drop("rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    each = places.select("sequence_id", "length", "rank", (F.lit(capacity) - F.col("gap")).alias("fill"), F.explode(F.expr("sequence(0L, k - 1)")).alias("i"))
    spots = each.select("length", (F.col("rank") + F.col("i")).alias("rank"), "sequence_id", (F.col("fill") + F.col("i") * F.col("length")).alias("offset"))
    return items.join(spots, ["length", "rank"]).drop("rank")


def packed(docs: DataFrame, path: str | None = None) -> DataFrame:
    # written once: ranking reads the pieces twice, and tokens are dear
    pieces = stash(token_pieces(docs, path or public_tokenizers.path(VOCABULARY)), "token-pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))

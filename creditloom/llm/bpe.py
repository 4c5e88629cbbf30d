"""Byte-level BPE encoding by merge replay over a block of the corpus, and decoding.

The distinct pre-tokens of a block of documents are laid out as one sequence of symbols. An inverted index leads from each merge to
the places where its pair stands. Merges are applied in rank order, each at all its places, and only the neighbours of a
merged pair enter the index anew. Within a word the result is that of merging the lowest rank first, leftmost first. Blocks are Arrow
batches of the partitions, so the work is spread like the documents and memory stays bounded; no vocabulary is trained.

Edge cases: a null text is encoded as an empty one (no ids); null or unknown ids decode to nothing; repeated rows are encoded each; a text of any length is encoded
whole, one longer than a block alone; ties between merges go by rank, then from the left; an empty
table gives an empty result; extra columns pass through, and one named like the result is replaced.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditloom.llm.common import query, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text whose pre-tokens are merged together, about, and documents at most.
BLOCK_BYTES, BLOCK = 4 << 20, 4096
#: Bytes of pre-tokens and ids that an encoder remembers, about.
MEMORY = 192 << 20


@functools.lru_cache(2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class MergeReplay:
    """Encoder for one vocabulary. Encoded pre-tokens are remembered; the memory is emptied when full."""

    def __init__(self, path: str, pattern: str, memory: int = MEMORY):
        self.ranks = read_ranks(path)
        self.width = max(self.ranks.values()) + 1
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {self.ranks[t[:i]] * self.width + self.ranks[t[i:]]: r for t, r in self.ranks.items()
                 for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        left, right = self.pair_keys // self.width, self.pair_keys % self.width
        self.risky = set(left[self.pair_ranks < left].tolist()) | set(right[self.pair_ranks < right].tolist())
        self.doubled = set(self.pair_ranks[left == right].tolist())
        self.known: dict[str, bytes] = {}
        self.memory, self.used = memory, 0
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.written: dict[str, tuple[int, str, bytes]] = {}

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where they don't merge."""
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the end of each word among them."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1  # a stop after each word, which merges with nothing
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(words) else 0
        token = self.single[np.frombuffer(b"\0".join(words) + b"\0", np.uint8)] if total else np.zeros(0, np.int64)
        token[ends - 1] = -1
        word = np.repeat(np.arange(len(words)), sizes)
        after, before = np.arange(1, total + 1), np.arange(-1, total - 1)
        now = np.append(self._ranks_of(token[:-1], token[1:]), -1)  # rank of the pair that begins at each place
        order = np.argsort(now, kind="stable")
        order = order[np.searchsorted(now[order], 0):]
        starts = np.flatnonzero(np.diff(now[order], prepend=-2))
        index: dict[int, list] = {int(now[p[0]]): [p] for p in np.split(order, starts[1:]) if len(p)}
        heap = list(index)
        heapify(heap)
        merging = np.zeros(total + 1, bool)
        while heap:
            rank = heappop(heap)
            found = index.pop(rank, None)
            if found is None:
                continue
            if isinstance(found[0], np.ndarray):
                p = np.concatenate([found[0], np.array(found[1:], np.int64)]) if len(found) > 1 else found[0]
            else:
                p = np.array(found, np.int64)
            p = p[now[p] == rank]
            if not len(p):
                continue
            if rank in self.risky or rank in self.doubled:
                p = np.sort(p)
            if rank in self.risky:  # merging may bring up a lower rank, which then goes first in that word
                first = np.diff(word[p], prepend=-1) != 0
                if not first.all():
                    index[rank] = p[~first].tolist()
                    heappush(heap, rank)
                    p = p[first]
            elif rank in self.doubled and len(p) > 1:  # of overlapping pairs every other one, from the left
                head = np.ones(len(p), bool)
                head[1:] = after[p[:-1]] != p[1:]
                place = np.arange(len(p))
                p = p[(place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0]
            q = after[p]
            r = after[q]
            token[p], token[q] = rank, -2
            now[q] = -1
            after[p] = r
            before[r] = p
            merging[p] = True
            o = before[p]
            o = o[o >= 0]
            o = o[~merging[o]]
            merging[p] = False
            changed = np.concatenate([p, o])
            new = self._ranks_of(token[changed], token[after[changed]])
            now[changed] = new
            hit = new >= 0
            for n, at in zip(new[hit].tolist(), changed[hit].tolist()):
                if n in index:
                    index[n].append(at)
                else:
                    index[n] = [at]
                    heappush(heap, n)
        alive = token >= 0
        return token[alive], np.cumsum(alive)[ends - 1]

    def _learn(self, missing: set[str]) -> None:
        parts = []
        for w in missing:
            raw = w.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(raw)
            if whole is None:
                parts.append((w, raw))
            else:
                self.known[w] = np.array([whole], "<i4").tobytes()
        if parts:
            ids, ends = self.replay([raw for _, raw in parts])
            flat, start = ids.astype("<i4").tobytes(), 0
            for (w, _), end in zip(parts, (4 * ends).tolist()):
                self.known[w] = flat[start:end]
                start = end

    def __call__(self, texts: list) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        split, _ = self._split(texts)
        known = self.known
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def _split(self, texts: list) -> tuple[list[list[str]], set[str]]:
        """The pre-tokens of each text, and the distinct ones, all of them known."""
        if self.used > self.memory:
            self.known.clear()
            self.written.clear()
            self.used = 0
        split = [self.pattern.findall(t) if t else [] for t in texts]
        words = set().union(*split)
        missing = words.difference(self.known)
        if missing:
            self._learn(missing)
            self.used += sum(200 + 4 * len(w) + len(self.known[w]) for w in missing)
        return split, words

    def digests(self, texts: list) -> list[tuple[int, str, str]]:
        """(ids, SHA-256 of the decimal ids joined by commas, SHA-256 of the bytes they decode to) of each text."""
        out, written, tokens = [], self.written, self.tokens
        split, distinct = self._split(texts)
        for w in distinct.difference(written):
            ids = struct.unpack(f"<{len(self.known[w]) // 4}i", self.known[w])
            written[w] = (len(ids), ",".join(map(str, ids)), b"".join(map(tokens.__getitem__, ids)))
            self.used += 250 + 10 * len(ids)
        for words in split:
            counts, decimals, raw = zip(*map(written.__getitem__, words)) if words else ((), (), ())
            out.append((sum(counts), hashlib.sha256(",".join(decimals).encode()).hexdigest(), hashlib.sha256(b"".join(raw)).hexdigest()))
        return out


@functools.lru_cache(1)
def merge_replay(path: str, pattern: str) -> MergeReplay:
    """The encoder of this Python worker; a worker that runs several tasks keeps what it has learnt."""
    return MergeReplay(path, pattern)


def _lists(values: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(v) // 4 for v in values])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(values), "<i4")))


def _blocks(batch: pa.RecordBatch, sizes: list[int]):
    """Slices of at most BLOCK rows with about BLOCK_BYTES by the sizes of their rows; a longer row is alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (total + n > BLOCK_BYTES or i - start >= BLOCK):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def _passing(df: DataFrame, source: str, into: dict[str, T.DataType], worker) -> DataFrame:
    """df with the columns `into` made from `source` by worker(), which is called once in a task and gives a function from an Arrow array to Arrow arrays."""
    keep = [c for c in df.columns if c not in into]

    def run(batches):
        made = worker()
        for batch in batches:
            names = batch.schema.names
            column = batch.column(names.index(source))
            sizes = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
            for part in _blocks(batch, pc.fill_null(sizes, 0).to_pylist()):
                own = [part.column(names.index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays(own + made(part.column(names.index(source))), names=[*keep, *into])

    return df.mapInArrow(run, T.StructType([df.schema[c] for c in keep] + [T.StructField(c, k) for c, k in into.items()]))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """df with the token ids of `text` as an array."""
    def worker():
        encoder = merge_replay(path, pattern)
        return lambda column: [_lists(encoder(column.to_pylist()))]

    return _passing(df, text, {into: T.ArrayType(T.IntegerType())}, worker)


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """df with the bytes that the ids in `ids` stand for."""
    def worker():
        tokens = {r: t for t, r in read_ranks(path).items()}
        get = tokens.get
        return lambda column: [pa.array([b"".join([get(i, b"") for i in x] if x else []) for x in column.to_pylist()], pa.binary())]

    return _passing(df, ids, {into: T.BinaryType()}, worker)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """df with n_tokens, ids_sha256 and decoded_sha256 of `text`: encoded and decoded again in one step, without arrays of ids."""
    def worker():
        encoder = merge_replay(path, pattern)

        def made(column):
            rows = encoder.digests(column.to_pylist())
            return [pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[i] for r in rows], pa.string()) for i in (1, 2)]]
        return made

    return _passing(df, text, {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}, worker)


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, path, public_tokenizers.PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")

"""Near-dedup, embeddings, packing, BPE, toxicity and the pipeline against brute force and odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from creditloom.llm import bpe, components, gridjoin, minhash, packing, toxicity

from .conftest import ODD, prose


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, a):
        while self.up[a] != a:
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# --- components
def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 20)] + [(1000, j) for j in range(1001, 1200)] + [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)]
    edges += [(7, 7), (None, 3), (3, 2), (2, 3)]
    truth = Groups({x for e in edges for x in e if x is not None})
    for a, b in edges:
        if a is not None and b is not None:
            truth.join(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if None not in (a, b) and a != b for x in (a, b)}
    assert got == {n: truth.find(n) for n in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- MinHash
def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_near(rows):
    sets = {i: shingles(t) for i, t in rows}
    truth = Groups(sets)
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    shared = Counter(p for v in where.values() for p in combinations(sorted(v), 2))
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            truth.join(a, b)
    return {i: (len(s), truth.find(i)) for i, s in sets.items()}


def changed(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randint(0, 99999)}"
    return " ".join(words)


def near_rows():
    """A family with copies and changes around the threshold, a chain, a passage that many documents share, short texts and case changes."""
    rows, base = [], prose(300, 11)
    rows += [(i, changed(base, i % 14, i)) for i in range(120)] + [(200 + i, base) for i in range(30)]
    step = prose(200, 12).split()
    for i in range(8):
        step = step[8:] + prose(8, 100 + i).split()
        rows.append((300 + i, " ".join(step)))
    passage = prose(60, 13)
    rows += [(400 + i, passage + " " + prose(40 + i % 30, 500 + i)) for i in range(90)]
    return rows + [(600, "one two"), (601, "ONE two"), (602, "one two three"), (603, ""), (604, " \n"), (605, None), (606, "é É"), (607, "é é")]


def test_near_duplicates(spark):
    rows = near_rows()
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_near(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_with_small_blocks(spark, monkeypatch):
    """Mixed buckets over the block size are cut by further bands and lose no link."""
    for name, value in (("DIRECT", 6), ("BLOCK", 8), ("HUGE", 600)):
        monkeypatch.setattr(minhash, name, value)
    rows = [r for r in near_rows() if r[0] < 60 or 400 <= r[0] < 440]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_near(rows)


def test_huge_buckets_keep_their_links(spark, monkeypatch):
    """All components of a bucket over HUGE are joined even where further bands do not cut it, by no more links than a block has members."""
    for name, value in (("DIRECT", 1), ("BLOCK", 2), ("HUGE", 1), ("BANDS", 1)):
        monkeypatch.setattr(minhash, name, value)
    sig = bytearray(range(256))
    sets = spark.createDataFrame([(i, [7], sig) for i in range(40)], "rep long, bands array<long>, sig binary")
    members = spark.createDataFrame([(i, 0 if i < 37 else i, 7) for i in range(40)], "rep long, component long, bucket long")
    texts = spark.createDataFrame([(i, "six words that all rows share" if i != 38 else "not at all like the other rows") for i in range(40)], "doc_id long, text string")
    direct, linked = minhash._across(members, sets, texts)
    got = [(r.a, r.b) for r in linked.collect()]
    part = Groups(range(40))
    for a, b in [*got, *[(0, i) for i in range(37)]]:
        part.join(a, b)
    assert direct.isEmpty() and {part.find(i) for i in range(40) if i != 38} == {part.find(0)} != {part.find(38)}
    assert all(b in (37, 39) for _, b in got) and len(got) <= 3 * 40


def test_near_duplicates_odd_rows(spark, odd, no_documents):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    assert [(r.component_id, r.kept) for r in got if r.doc_id == 8] == [(5, False)] and all(r.kept for r in got if r.doc_id in (1, 2, 3, 4, 5, 6, 7))
    assert minhash.keep_one(odd).count() == len(ODD) - 1 and minhash.keep_one(odd).columns == odd.columns
    assert minhash.near_duplicates(no_documents).count() == 0


# --- embeddings
def test_grid_join(spark):
    rng = np.random.default_rng(2)
    rows, at = [], 0
    for label in (0, 1, None):
        for _ in range(25):
            centre = rng.normal(size=16)
            for _ in range(rng.integers(1, 12)):
                rows.append((at, (centre + rng.normal(size=16) * rng.choice([0.0, 0.05, 0.12, 0.3])).astype(np.float32).tolist(), label))
                at += 1
    rows += [(at + i, rows[3][1], 0) for i in range(4)] + [(at + 10, None, 0), (at + 11, [0.0] * 16, 0), (at + 12, [float("nan")] + [1.0] * 15, 1), (at + 13, [None] + [1.0] * 15, 1), (at + 14, [], 1),
             (at + 15, [1.0, 0.0], 0), (at + 16, [2.0, 0.0], 0), (None, [1.0, 0.0], 0)]
    truth, links = Groups([r[0] for r in rows if r[0] is not None]), Counter()
    for (a, x, k), (b, y, m) in combinations([r for r in rows if r[0] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])], 2):
        if k is not None and k == m and len(x) == len(y):
            x, y = np.array(x, float), np.array(y, float)
            if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98:
                links[a] += 1
                links[b] += 1
                truth.join(a, b)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("raw", F.lit(1))
    for block in (512, 8):
        gridjoin.BLOCK, before = block, gridjoin.BLOCK
        got = gridjoin.near_vectors(df).collect()
        gridjoin.BLOCK = before
        assert {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None} == {n: (links[n], truth.find(n)) for n in truth.up}
        assert len(got) == len(rows) and all(not r.kept for r in got if r.vec_id is None)
    assert max(links.values()) > 5
    assert gridjoin.near_vectors(df.limit(0)).count() == 0


# --- packing
def check_sequences(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spots in by.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_are_the_tokenizers(spark, sf, odd):
    path = public_tokenizers.path(packing.VOCABULARY)
    whole = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(odd.where("doc_id is not null and doc_id <> 5").selectExpr("doc_id + 1000000 as doc_id", "text"))
    docs = docs.unionByName(spark.createDataFrame([(2_000_000, "H\u0331 T\u0308x W\u030a J\u030c a<|startoftext|>B <|STARTOFTEXT|> Don't stop.,. Îİ ǅ  x　y I'VE, a.b.c., É́. x, <|endoftext|>. ΟΔΟΣ ΟΔΟΣ. 12.5. ́., ...")], "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    ids = {i: whole.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    want = {(i, k // 4096): (k, len(x[k:k + 4096]), zlib.crc32(np.array(x[k:k + 4096], "<u4").tobytes())) for i, x in ids.items() for k in range(0, len(x), 4096)}
    rows = packing.packed(docs).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    assert check_sequences(rows, 4096) <= -(-sum(map(len, ids.values())) // 4096) + 1
    some = packing.token_pieces(docs.where("doc_id < 5"), path, with_ids=True).collect()
    assert all(list(r.ids) == ids[r.doc_id][r.start:r.start + r.length] for r in some)


def test_packing_is_tight(spark):
    rng = random.Random(4)
    for lengths in ([rng.randint(1, 100) for _ in range(3000)], [34] * 1000, [51] * 300 + [49] * 300, [100] * 20, [60] * 50 + [1] * 1500, [1]):
        df = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
        rows = packing.pack(df, 100).collect()
        assert len(rows) == len(lengths) and len({r.doc_id for r in rows}) == len(lengths)
        gaps = []  # best-fit decreasing, one by one
        for n in sorted(lengths, reverse=True):
            fits = [g for g in gaps if g >= n]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - n)
            else:
                gaps.append(100 - n)
        assert check_sequences(rows, 100) <= 1.02 * len(gaps) + 1


def test_packing_odd_rows(odd, no_documents):
    rows = packing.packed(odd).collect()
    assert Counter(r.doc_id for r in rows)[5] == 2 and {r.length for r in rows if r.doc_id in (1, 2, 3)} == {1}
    check_sequences(rows, 4096)
    assert packing.packed(no_documents).count() == 0


# --- byte-level BPE
def test_bpe_is_tiktokens(spark, sf, odd, no_documents):
    path = public_tokenizers.path(bpe.VOCABULARY)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab cAd é你0\n.,'st\U0001f600") for _ in range(rng.randint(0, 80))) for _ in range(500)] + ["aaaa aaaaaaa" * 9, "ab" * 2000, "<|endoftext|>"]
    docs = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(texts)], "doc_id long, text string").unionByName(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    rows = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path).collect()
    for r in rows:
        assert r.ids == own.encode_ordinary(r.text) and bytes(r.decoded) == r.text.encode()
    many = bpe.decode(bpe.encode(odd.withColumn("ids", F.lit(1)), path, public_tokenizers.PATTERN), path).collect()
    assert len(many) == len(ODD) and all(bytes(r.decoded).decode() == (r.text or "") and r.piece == 2 for r in many)
    assert bpe.encode(no_documents, path, public_tokenizers.PATTERN).count() == 0
    out = {r.doc_id: r for r in bpe.op6_byte_bpe(spark, sf).collect()}
    text = {r.doc_id: r.text for r in docs.where("doc_id >= 0").collect()}
    for i, t in text.items():
        ids = own.encode_ordinary(t)
        assert (out[i].n_tokens, out[i].ids_sha256, out[i].decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


# --- toxicity
def test_kneser_ney_tables(spark):
    """Class probabilities that the ratios stand for sum to one over the letters of a context, and seen words score as counted."""
    docs = spark.createDataFrame([("nasty nasto word other", 1), ("word other words wording nice", 0), ("nice other", 0), (None, 0), ("", 1)], "text string, toxic int")
    words = {r.word: (r.toxic, r.ordinary) for r in toxicity.word_counts(docs).collect()}
    assert words["other"] == (1, 2) and words["nasty"] == (1, 0)
    top = toxicity.top_grams(toxicity.word_counts(docs))
    shared = toxicity.shared_backoff(top).join(top.groupBy("ctx").agg(F.count("*").alias("n")), "ctx")
    for r in shared.groupBy("ctx").agg(F.sum("shared").alias("s")).collect():
        assert 0 < r.s <= 1 + 1e-9
    ratio = toxicity.fit_ratio(docs)
    assert ratio.word("nastier") > 0.5 > ratio.word("nice") and ratio.word("nasty") > ratio.word("other") > ratio.word("wording")


def test_toxicity_held_out(spark, sf):
    path = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    rows = toxicity.score(docs, labels).join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.toxic is not None]
    bad, fine = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    assert np.mean([(a > b) + (a == b) / 2 for a in bad for b in fine]) > 0.8


def test_toxicity_odd_rows(spark, odd, no_documents):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (1, None)], "doc_id long, toxic int")
    assert len(toxicity.score(odd, labels).collect()) == len(ODD)
    assert toxicity.score(no_documents, labels).count() == 0
    assert {r.score for r in toxicity.score(odd, labels.limit(0)).collect()} == {0.0}


def test_toxicity_keeps_all_ngrams(spark, sf, monkeypatch):
    """Scores are the same however few words are broadcast, and words score as by look-up in the whole tables."""
    path = sf.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    whole = sorted((r.doc_id, r.score) for r in toxicity.score(docs, labels).collect())
    monkeypatch.setattr(toxicity, "COMMON", 3, raising=False)
    monkeypatch.setattr(toxicity, "KEYS_AT_ONCE", 20_000)
    few = sorted((r.doc_id, r.score) for r in toxicity.score(docs, labels).collect())
    assert [i for i, _ in few] == [i for i, _ in whole] and np.allclose([v for _, v in few], [v for _, v in whole])
    words = toxicity.word_counts(docs.join(labels, "doc_id").select("text", "toxic")).persist()
    ratio = toxicity.fit_ratio(docs.join(labels, "doc_id").select("text", "toxic"))
    texts = [(1, "Unseen wordings and other words, words é你好 end"), (2, ""), (3, None), (4, "the")]
    for r in toxicity.measured(spark.createDataFrame(texts, "doc_id long, text string"), words, toxicity.ratio_table(words)).collect():
        found = Counter(re.findall(r"[^\W\d_]+", (texts[r.doc_id - 1][1] or "").lower()))
        best = sorted((ratio.word(w) for w in found), reverse=True)
        over = sum(max(v - toxicity.TELLING, 0) for v in best)
        mean = sum(ratio.word(w) * n for w, n in found.items()) / max(1, sum((len(w) + 1) * n for w, n in found.items()))
        assert np.allclose(r.x, [mean, *[best[min(k, len(best)) - 1] for k in toxicity.BEST], over, over / len(best), np.log1p(found.total())] if found else [0] * len(toxicity.MEASURES))


def test_toxicity_counts_calibration_rows(spark, monkeypatch):
    """An expression whose labelled rows all serve the curve is known to the models that score."""
    class Mean:
        def probability(self, x):
            return 1 / (1 + np.exp(-x[:, 0]))

    monkeypatch.setattr(toxicity.trees, "fit", lambda *a, **b: Mean())
    fold = {r.id: r.fold for r in spark.range(400).selectExpr("id", "pmod(xxhash64('fold', id), 4L) as fold").collect()}
    train = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    rare = set([i for i in train if fold[i] == 0 and i % 2][:12])
    docs = [(i, f"{prose(8, i)} {'zqxjkv' if i in rare else 'nasty' if i % 2 else 'nice'}") for i in train] + [(1000, "zqxjkv"), (1001, "zwyfhd")]
    labels = spark.createDataFrame([(i, i % 2) for i in train], "doc_id long, toxic int")
    score = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(docs, "doc_id long, text string"), labels).collect()}
    assert len(rare) == 12 and score[1000] > score[1001] + 0.1


# --- pipeline
def test_pipeline_stages(spark, sf):
    path = sf.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path).cache()
        assert docs.columns == columns, name
        seen.append(docs.count())
    assert seen[0] > seen[1] == seen[2] > seen[3] == seen[4]
    left = {r.doc_id: r.text for r in docs.collect()}
    assert not any("@" in t and re.search(r"mail\d\.example", t) for t in left.values())
    sets = brute_near(list(left.items()))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r.doc_id for r in packed} == set(left) and len(sets) == len(left)
    check_sequences(packed, 4096)
    run = corpus_pipeline.run(spark, path).collect()
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in run} == {(r.doc_id, r.piece, r.ids_crc32) for r in packed}


def test_pipeline_odd_rows(spark, odd, no_documents, sf):
    for docs in (odd, no_documents):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
        assert docs.count() >= 0

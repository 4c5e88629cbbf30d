"""Token alignment, benchmark search and importance resampling against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from creditloom.llm import alignment, decontaminate, resampling
from creditloom.llm.common import table
from creditloom.llm.words import word_runs

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(FOLD))


ODD = ["", None, " ", "a", "Ünïcode ÉCOLE İI 東京 12", "x" * 3000, "\n\n  tab\tand   blanks ", "<|endoftext|> <s> </s> <0x41>", "a b a b a b a b a b a b a b a b", "é ▁ ok", "no\x00nul"]


def texts_of(spark, extra=()):
    rows = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    return rows + [(10**6 + i, t) for i, t in enumerate([*ODD, *extra])]


def test_words_are_split_alike_at_any_run():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("aZ9 -.é東\n_`{") for _ in range(rng.randint(0, 60)))
        for size in (1, 7, 1 << 20):
            assert [w.decode() for run in word_runs(text.encode(), size) for w in run] == words_of(text)
    assert list(word_runs(None)) == []


# --- alignment ---

def tokens(text, a, b):
    """((id, bytes), ...) of both sides, from the tokenizers' own calls."""
    if not text:
        return [], []
    x = a.encode(" " + text, add_special_tokens=False).ids
    y = b.encode(text)
    table_a = {v: k for k, v in a.get_vocab().items()}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}
    left = [(i, bytes(chars[c] for c in table_a[i])) for i in x]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in y]
    want = (" " + text).encode()
    return (left, right) if b"".join(t for _, t in left) == want == b"".join(t for _, t in right) else ([], [])


def placed(side):
    at, out = 0, []
    for i, t in side:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs, counts = [], Counter()
    for doc_id, text in rows:
        left, right = (placed(s) for s in tokens(text, a, b))
        links, j = [], 0
        for i, s, e in left:
            while j < len(right) and right[j][2] <= s:
                j += 1
            k = j
            while k < len(right) and right[k][1] < e:
                links.append((i, right[k][0]))
                k += 1
        cuts = sorted({e for _, _, e in left} & {e for _, _, e in right})
        groups, start = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, s, e in left if start <= s and e <= c) + "|" + ",".join(str(i) for i, s, e in right if start <= s and e <= c))
            start = c
        counts.update(links)
        docs.append((doc_id, len(left), len(right), links, groups))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return {d: (n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for d, n_a, n_b, links, groups in docs}


@pytest.mark.parametrize("most", [2000, 1 << 21])
def test_alignment_against_brute_force(spark, most):
    rows = [r for r in texts_of(spark) if r[1] is None or len(r[1]) < 4000][-90:]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = alignment.link_statistics(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), most)
    found = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect()}
    assert found == brute_alignment(rows)


def test_align_keeps_columns_and_links(spark):
    docs = spark.createDataFrame([(1, "Hello wörld", 5), (2, None, 6), (3, "", 7)], "doc_id long, text string, links int")
    got = {r.doc_id: r for r in alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got[2].links == [] == got[2].a_ids == got[3].b_groups
    r = got[1]
    assert len(r.a_ids) == len(r.a_groups) and set(r.a_groups) == set(r.b_groups) == set(range(max(r.a_groups) + 1))
    assert {x.a for x in r.links} == set(range(len(r.a_ids))) and {x.b for x in r.links} == set(range(len(r.b_ids)))
    assert alignment.link_statistics(docs.limit(0), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    twice = docs.select("doc_id", "text").unionAll(docs.select(F.lit(None).cast("long"), "text"))
    stats = alignment.link_statistics(twice, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(stats) == 6 and {(r.n_a, r.n_b) for r in stats if r.n_a} == {(len(got[1].a_ids), len(got[1].b_ids))}


def test_vocabulary_file_and_fast_encoder_agree():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    rng = random.Random(11)
    pool = [chr(c) for c in (*range(32, 127), 9, 10, 13, 0x85, 0xA0, 0xAD, 0x2028, 0x3000, 0x200B)] + [chr(rng.randint(0xA1, 0x2FFF)) for _ in range(300)] + ["'s", "'LL", "😀", " " * 4]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 40))) for _ in range(3000)] + ["a" * 200_000, " " * 50_000, "ab" * 50_000]
    assert alignment.ByteLevel(path)(texts) == [e.ids for e in plain.encode_batch([" " + t for t in texts], add_special_tokens=False)]


# --- benchmark search ---

def brute_leaks(docs, items, length=10):
    wins = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(0, len(w) - length) + 1) if w else ():
            wins.setdefault(tuple(w[i:i + length]), set()).add(item)
    out = {}
    for doc_id, text in docs:
        w, hit, owners = words_of(text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                found = wins.get(tuple(w[i:i + n]))
                if found is not None:
                    hit |= set(range(i, i + n))
                    owners |= found
        out[doc_id] = (len(w), sorted(hit), sorted(str(o) for o in owners if o is not None))
    return out


def found_leaks(df):
    return {r.doc_id: (r.n_words, [i for s in r.spans for i in range(s.start, s.end)], r.item_ids) for r in df.collect()}


@pytest.mark.parametrize("max_windows", [100_000, 40])
def test_leaks_against_brute_force(spark, max_windows):
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    items += [(900, "one two three"), (901, "ONE two-three!"), (902, ""), (903, None), (None, "five six"), (904, "a b a b a b a b a b a b"), (904, "a b a b a b a b a b a b"), (905, "solo")]
    docs = texts_of(spark, ["x one two three y", "one two", "five six five six", "Solo", " ".join(["one two three"] * 2000), items[0][1] + " " + items[1][1]])
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), max_windows=max_windows)
    assert found_leaks(got) == brute_leaks(docs, items)


def test_leaks_of_random_words(spark):
    """Few distinct words, so that windows overlap, repeat and share blocks; texts are split into short runs."""
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 200)))) for i in range(60)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 7)))) for i in range(30)]
    want = brute_leaks(docs, items, 6)
    rows = [(" ".join(w).encode(), str(item)) for item, text in items for w in [words_of(text)[i:i + 6] for i in range(max(0, len(words_of(text)) - 6) + 1)]]
    matchers = decontaminate.Matchers(rows)
    for size in (1, 13, 1 << 20):
        for doc_id, text in docs:
            runs = decontaminate.word_runs
            try:
                decontaminate.word_runs = lambda raw, size=size: word_runs(raw, size)
                n, spans, owners = matchers.search(text.encode())
            finally:
                decontaminate.word_runs = runs
            assert (n, [i for s, e in spans for i in range(s, e)], sorted(owners)) == want[doc_id]


def test_leaks_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "kept")], "doc_id long, text string, spans string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert found_leaks(decontaminate.find_leaks(docs, none)) == {1: (2, [], [])}
    assert decontaminate.find_leaks(docs.limit(0), none).count() == 0
    items = spark.createDataFrame([(7, "a b")], "item_id long, text string")
    assert decontaminate.drop_leaks(docs, items).count() == 0 and decontaminate.drop_leaks(docs, none).columns == docs.columns


# --- resampling ---

def brute_resample(docs, target, share=(25, 100), least=20):
    def features(text):
        w = words_of(text)
        return [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]
    s, t = (Counter(f for x in texts for f in features(x)) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000) / ((s[b] + 1.0) * (t_all + 10000)))) for b in range(10000)}
    rows = []
    for doc_id, text in docs:
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(able) * share[0] // share[1]
    return sorted([(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(able)] + [(*r[:4], None) for r in rows if not r[4]], key=str)


@pytest.mark.parametrize("few", [10_000, 3])
def test_resample_against_brute_force(spark, few):
    docs = texts_of(spark) + [(None, "word " * 30), (None, "word " * 30)] + [(5, "same " * 25)] * 9
    target = [r.text for r in table(spark, SMALL, "benchmark").collect()] + [None, ""]
    got = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), few=few)
    found = sorted([(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()], key=str)
    assert found == brute_resample(docs, target)


def test_cutoff_is_exact(spark):
    rng = random.Random(8)
    rows = [(rng.choice([-5, 0, 0, 0, 9]), rng.randint(0, 3), i) for i in range(500)]
    keys = spark.createDataFrame(rows, "k_score long, k_id long, k_row long").repartition(7)
    for k in (1, 2, 137, 250, 499, 500):
        assert resampling.cutoff(keys, k, few=10) == sorted(rows)[k - 1]
    assert resampling.cutoff(keys, 0) is None


def test_resample_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 3)], "doc_id long, text string, rank int")
    none = docs.limit(0)
    assert resampling.resample(none, docs).count() == 0
    (row,) = resampling.resample(docs, none).collect()
    assert row["rank"] is None and row.n_features == 3 and set(row.asDict()) == {"doc_id", "text", "rank", "n_words", "n_features", "weight", "score"}

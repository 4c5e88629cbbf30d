"""Quality rules, line dedup, license scans, PII and chat against brute force and odd rows."""

import hashlib

import re

import duckdb
import numpy as np
import pytest
from checks.compare import diff, oracle_connection

from pyspark.sql import functions as F

from creditloom.llm import chat, licenses, lines, pii, quality, trees

from .conftest import ODD, prose


# --- quality rules
def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    rows = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(rows) - len(set(rows)), len(covered)]


def test_quality_counts(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()] + [t for _, t, _ in ODD]
    texts += ["a b c d e f g h i " * 3, "same same " * 30, "x\n\nx\n x\nx", "a b c d e f g h X a b c d e f g h Y b c d e f g h Y"]
    for t in texts:
        assert quality.statistics(t)[0] == brute_counts(t)


def test_quality_odd_rows(spark, odd, no_documents):
    labels = spark.createDataFrame([(4, 1), (5, 1), (6, 0), (7, 0), (None, 1), (8, None)], "doc_id long, quality int")
    forest = quality.fit(odd, labels, trees_n=3)
    got = quality.judge(odd, forest).select("doc_id", "source", "score", "verdict.*").collect()
    assert len(got) == len(ODD) and all(r.score == 1 for r in got)
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (1, 2, 3, 6, 7))
    assert quality.keep_good(no_documents, labels).count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_quality_accuracy(spark, sf):
    """Fitted on two thirds of the labelled documents, it finds poor ones among the rest and keeps good ones."""
    path = sf.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    forest = quality.fit(docs, labels.where("doc_id % 3 <> 0"))
    rows = quality.judge(docs.join(labels.where("doc_id % 3 = 0"), "doc_id").drop("toxic"), forest).select("quality", "verdict.base_failed", "verdict.kept").collect()
    good = [r for r in rows if r.quality and not r.base_failed]
    poor = [r for r in rows if not r.quality]
    assert sum(r.kept for r in good) >= 0.97 * len(good) and sum(not r.kept for r in poor) >= 0.85 * len(poor)


def test_trees_are_monotone_and_flat():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] + np.sin(3 * x[:, 1]) + rng.normal(size=3000) > 0).astype(float)
    forest = trees.fit(x, y, [1, 0, -1], 30, 4)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.75
    grid = np.linspace(-3, 3, 50)
    for f, sign in ((0, 1), (2, -1)):
        for row in x[:20]:
            many = np.repeat(row[None], len(grid), 0)
            many[:, f] = grid
            assert (np.diff(forest.margin(many)) * sign >= -1e-9).all()

    def walk(node, row):
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
        return forest.value[node]

    assert np.allclose(forest.margin(x[:50]), [forest.base + sum(walk(r, row) for r in forest.roots) for row in x[:50]])
    assert trees.fit(np.zeros((0, 2)), np.zeros(0), [0, 0]).probability(np.zeros((3, 2))).tolist() == [0.5] * 3


# --- line dedup
def test_line_dedup_spread(spark):
    rows = [(i, f"own {i}\n  shared \r\nnear{'' if i < 9 else i}\n\n", f"s{i % 12}") for i in range(40)] + [(99, "shared", None), (100, None, "s1"), (101, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("_extra", F.lit(1))
    got = {r.doc_id: r for r in lines.remove_lines(docs).collect()}
    assert got[0].text == "own 0\nnear\n\n" and got[0]["_line_removed"] == 1 and got[0]["_line_count"] == 3
    assert got[99].text == "" and got[100].text is None and got[101].text == "" and got[100]["_line_count"] == 0
    exact = spark.createDataFrame([(i, "edge", f"s{i}") for i in range(10)] + [(i, "below", f"s{i}") for i in range(9)] * 3, "doc_id long, text string, source string")
    assert {(r["_line_hash"]) for r in lines.spread(exact).collect()} == {exact.select(F.xxhash64(F.lit("edge"))).first()[0]}


def test_line_dedup_odd_rows(odd, no_documents):
    out = lines.drop_boilerplate(odd)
    assert out.columns == odd.columns and out.count() == len(ODD)
    assert {r.text for r in out.collect()} == {t for _, t, _ in ODD}
    assert lines.drop_boilerplate(no_documents).count() == 0


# --- licenses
def plain_patience(a, b):
    if not a or not b:
        return 0
    if a[0] == b[0]:
        return 1 + plain_patience(a[1:], b[1:])
    if a[-1] == b[-1]:
        return 1 + plain_patience(a[:-1], b[:-1])
    both = [(i, b.index(w)) for i, w in enumerate(a) if a.count(w) == 1 and b.count(w) == 1]
    best = {}
    for i, j in both:  # longest increasing by dynamic programming
        best[(i, j)] = max(([*v, (i, j)] for k, v in best.items() if k[1] < j), key=len, default=[(i, j)])
    run = max(best.values(), key=len, default=[])
    if not run:
        return 0
    edges = [(-1, -1), *run, (len(a), len(b))]
    return len(run) + sum(plain_patience(a[p[0] + 1:q[0]], b[p[1] + 1:q[1]]) for p, q in zip(edges, edges[1:]))


def test_patience_alignment():
    import random

    rng = random.Random(3)
    for _ in range(300):
        a = [rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 14))]
        b = list(a) if rng.random() < 0.5 else [rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 14))]
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randint(0, len(b)), rng.choice("abxyz"))
        pairs = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        lis = licenses.increasing([rng.randint(0, 9) for _ in range(8)])
        assert lis == sorted(lis)
        if len(set(a)) == len(a) and len(set(b)) == len(b):
            assert len(pairs) == plain_patience(a, b)


def test_license_finds(spark, odd, no_documents):
    mit = licenses.TEMPLATES["MIT"]
    changed = mit.replace("person", "body").replace("merge, ", "").replace("furnished", "given")
    texts = [prose(300, 1) + "\n" + mit + "\n" + prose(300, 2) + " Licensed under the Apache License, Version 2.0.", changed, "released under the mit license " * 2, prose(400, 3),
             "The license of this work is under version 3", None, ""]
    got = [r.finds for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert [(f.license, f.coverage) for f in got[0]] == [("MIT", 1.0), ("Apache-2.0", 1.0)] and got[0][0].start == 300
    assert [f.license for f in got[1]] == ["MIT"] and 0.9 < got[1][0].coverage < 1
    assert [(f.license, f.start) for f in got[2]] == [("MIT-notice", 0), ("MIT-notice", 5)]
    assert not any(got[3:])
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(no_documents).count() == 0


def test_license_lines_in_documents(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = docs.select("doc_id", F.rlike("text", F.lit("(?i)licensed? under|under the MIT")).alias("says")).join(licenses.scan(docs), "doc_id").collect()
    assert all(bool(r.finds) == r.says for r in rows) and any(r.says for r in rows)


# --- PII
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(x if k % 2 == 0 else 2 * x - 9 * (2 * x > 9) for k, x in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute_pii(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


HARD = ["a@b.c_d@e.f g@h.i.", "1.2.3.4.5.6.7.8 +1+2 (3) 456-78-90 12 4111 1111 1111 1111-", "x@y @z.w foo@bar.baz@qux.quux", "é 𝒳 me@site.org 300.1.2.3 001.002.003.004",
        "+49 30 123456789. +12", "a" * 3_000 + "@b.c", "9" * 30 + " 4111111111111111", "a@" + "b." * 20_000 + "c", "4" * 3_000, "1 " * 50_000, "+1" + "(" * 50_000]


def test_pii_base_spans(spark, sf, odd, no_documents):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-i - 1, t) for i, t in enumerate(HARD)], "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.find_pii(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_pii(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(k + ":") for k in BASE]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    assert pii.find_pii(odd).count() == len(ODD) and pii.find_pii(no_documents).count() == 0


def test_pii_bootstrap(spark):
    """Numbers with a bad check digit where only card numbers stand are found by their context; the same shape elsewhere is not."""
    valid = [c for c in (f"45{k:014d}" for k in range(10**6, 10**6 + 400)) if luhn(c)][:30]
    rows = [(i, f"please charge cardholder {c} thanks a lot") for i, c in enumerate(valid)]
    rows += [(100, "please charge cardholder 4500000000000003 thanks a lot"), (101, "order reference 4500000000000003x4 is open"), (102, "the part 4599999999999995 is here")]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].spans == "card:25:41" and got[100].n_card == 0
    assert got[101].spans == "" and got[102].spans == ""
    assert all(got[i].n_card == 1 for i in range(30))


def test_pii_redaction(spark, odd):
    rows = [(1, "mail a@b.co or +1 (017) 555-7713, é 𝒳 10.0.0.1!"), (2, None), (3, "x@1.2.3.4 5"), (4, "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: "mail [EMAIL] or [PHONE], é 𝒳 [IP]!", 2: None, 3: "[EMAIL] 5", 4: "nothing"}
    assert pii.redact(odd).columns == odd.columns and pii.redact(odd).count() == len(ODD)


# --- chat
TALK = [(1, 0, "user", "Hello there\nHow are you?"), (1, 1, "assistant", "> Hello there\nFine"), (1, 2, "user", "> > hello   THERE\n> Fine\nGood"),
        (1, 3, "user", "> How are you?\nstill waiting"), (1, 4, "user", "new topic"), (1, 4, "user", "new topic"), (2, 0, "user", "> never said\nx"), (2, 1, "user", None),
        (2, 5000, "user", "> x\ny"), (2, 5001, "user", ">y\n\nz\n"), (None, 3, "user", "> x\nq"), (3, None, "user", "hm"), (3, 1, None, ""), (3, 2, "a", "> \n>\n"),
        (4, 9, "u", "a > b"), (4, 10, "u", ">a > b\nc"), *[(5, i, "u", f"> m{i - 1}\nm{i}") for i in range(1, 40)], (5, 0, "u", "m0")]


def test_chat_against_sql(spark, tmp_path):
    df = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string").withColumn("thread", F.lit("clash"))
    got = chat.reply_order(df).selectExpr("conv_id", "turn", "role", "reply_to", "thread", "position", "quoted_lines", "text as body").toPandas()
    df.drop("thread").write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/c/*.parquet'")
    said = diff(got, con.sql(chat.OP5_SQL).df())
    assert not said or said.startswith("types"), said
    one = got[got.conv_id == 1].sort_values(["position", "turn"])
    assert one.body.tolist()[:4] == ["Hello there\nHow are you?", "Fine", "Good", "still waiting"] and one.reply_to.tolist()[1:4] == [0, 1, 0]
    assert chat.reply_order(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op2_line_dedup", "op5_chat_formatting"])
def test_sql_twins(spark, sf, name):
    from creditloom.llm.common import ORACLES, QUERIES

    assert not diff(QUERIES[name](spark, sf).toPandas(), oracle_connection(sf).sql(ORACLES[name]).df())


def test_pii_bootstrap_follows_long_chains(spark, monkeypatch):
    """Instances that are linked to the seed only over seven others are found; an unlinked one is not."""
    for name, value in (("MIN_SUPPORT", 0.01), ("MIN_CONFIDENCE", 0.01), ("MIN_SCORE", 0.01)):
        monkeypatch.setattr(pii, name, value)
    names = "alpha beta gamma delta epsilon zeta eta theta iota".split()
    rows = [(f"v{i}", "email" if i == 0 else None, f"call {names[j]}", names[j], "a9") for i in range(8) for j in (i, i + 1)]
    rows.append(("v99", None, "call omega", "omega", "a9"))
    inst = spark.createDataFrame(rows, "value string, seed string, before string, after string, shape string")
    got = {r.value: (r.kind, r.score) for r in pii.bootstrap(inst).collect()}
    assert set(got) == {f"v{i}" for i in range(1, 8)} and {k for k, _ in got.values()} == {"email"}
    assert all(got[f"v{i}"][1] > got[f"v{i + 1}"][1] for i in range(1, 7))

"""Embedding near-dedup by an epsilon grid order join.

Unit vectors with cosine >= 0.98 are at most epsilon = sqrt(2 - 2 * 0.98) apart, and so are their projections. Vectors are sorted by label
and grid cell (side epsilon) on leading principal dimensions, and the sequence is cut into blocks. Block pairs are found by recursion over
sequence intervals: an interval pair whose boxes are further apart than epsilon is skipped with all that it holds. The
remaining block pairs are compared exactly, in double precision, inside tasks; a task emits for each linked vector its number of links and the
smallest vector of its local component, never pairs.

Principal dimensions come from a bounded sample; they shape the grid only, no link depends on them. Equal vectors with equal labels are merged
first and counted. Vectors of different length are never linked.

Edge cases: a vector that is null, all zero, or holds a null or non-finite component, a null label and a null id link with nothing; repeated rows
are copies that are linked with each other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm.common import query, stash, table
from creditloom.llm.components import components
from creditloom.session import shuffle_width

LEAST_COSINE = 0.98
DIMENSIONS = 8
BLOCK = 512
SAMPLE = 10_000
#: Bits of the sequence number that one level of the recursion takes away.
STEP = 2


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, key, raw) of rows that can link; raw holds doubles, key is a digest of label and raw."""
    def run(batches):
        for batch in batches:
            out = []
            for vec_id, label, v in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if vec_id is None or label is None or not v or None in v:
                    continue
                x = np.array(v, np.float64) + 0.0
                if np.isfinite(x).all() and x.any() and 0 < np.sqrt(x @ x) < np.inf:
                    raw = x.tobytes()
                    out.append((vec_id, label, hashlib.blake2b(f"{label}\0".encode() + raw, digest_size=16).digest(), raw))
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.binary(), pa.binary()))], names=["vec_id", "label", "key", "raw"])

    kept = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("embedding").cast("array<double>"))
    return kept.mapInArrow(run, "vec_id long, label string, key binary, raw binary")


def principal(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Leading directions for each vector length, from at most about SAMPLE vectors."""
    n = distinct.count()
    share = min(1.0, SAMPLE / max(n, 1))
    rows = distinct.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(share * (1 << 20))).select("raw").toPandas()["raw"] if n else []
    found: dict[int, list] = {}
    for raw in rows:
        v = np.frombuffer(raw, np.float64)
        found.setdefault(len(v), []).append(v / np.sqrt(v @ v))
    axes = {}
    for size, vectors in found.items():
        x = np.array(vectors)
        _, v = np.linalg.eigh(np.cov(x.T, bias=True).reshape(size, size))
        axes[size] = v[:, ::-1][:, :DIMENSIONS]
    return axes


def projected(axes: dict[int, np.ndarray], raw: list[bytes]) -> list[np.ndarray]:
    out = []
    for r in raw:
        v = np.frombuffer(r, np.float64)
        a = axes.get(len(v))
        a = a if a is not None else np.eye(len(v), min(len(v), DIMENSIONS))  # a length that the sample missed
        out.append((v / np.sqrt(v @ v)) @ a)
    return out


def blocks(distinct: DataFrame, epsilon: float) -> DataFrame:
    """Blocks of vectors that follow each other in grid order: (part, seq, label, size, ids, copies, raw, lo, hi)."""
    axes = principal(distinct)

    def place(batches):
        for batch in batches:
            cells = [np.floor(p / epsilon).astype(np.int64).tolist() for p in projected(axes, batch.column("raw").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int64()))], names=[*batch.schema.names, "cell"])

    def cut(batches):
        from pyspark import TaskContext

        part, seq, held, of = TaskContext.get().partitionId(), 0, [], None

        def block():
            points = np.array(projected(axes, [h[2] for h in held]))
            row = [part], [seq], [of[0]], [of[1]], [[h[0] for h in held]], [[h[1] for h in held]], [b"".join(h[2] for h in held)], [points.min(0)], [points.max(0)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=names)

        for batch in batches:
            for rep, copies, label, raw in zip(*(batch.column(c).to_pylist() for c in ("rep", "copies", "label", "raw"))):
                if held and (of != (label, len(raw) // 8) or len(held) == BLOCK):
                    yield block()
                    seq, held = seq + 1, []
                of = label, len(raw) // 8
                held.append((rep, copies, raw))
        if held:
            yield block()

    names = ["part", "seq", "label", "size", "ids", "copies", "raw", "lo", "hi"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    placed = distinct.select("rep", "copies", "label", "raw").mapInArrow(place, "rep long, copies long, label string, raw binary, cell array<bigint>")
    # the id ends the order, so a cell with any share of the vectors is still cut evenly
    ordered = placed.repartitionByRange(shuffle_width(distinct.sparkSession), "label", F.length("raw"), "cell", "rep").sortWithinPartitions("label", F.length("raw"), "cell", "rep")
    return ordered.mapInArrow(cut, "part long, seq long, label string, size long, ids array<long>, copies array<long>, raw binary, lo array<double>, hi array<double>")


def block_pairs(made: DataFrame, epsilon: float) -> DataFrame:
    """Pairs (a, b), a <= b, of blocks that may hold linked vectors. Interval pairs are split level by level."""
    top = made.agg(F.max("a").alias("a")).first()["a"] or 0
    levels = -(-int(top).bit_length() // STEP)

    def nodes(level: int) -> DataFrame:
        edges = lambda f, c: F.array(*[f(F.get(c, i)) for i in range(DIMENSIONS)])
        return (made.groupBy("label", "size", F.shiftright("a", STEP * level).alias("node")).agg(edges(F.min, F.col("lo")).alias("lo"), edges(F.max, F.col("hi")).alias("hi")))

    def close(pairs: DataFrame) -> DataFrame:
        apart = F.aggregate(F.sequence(F.lit(0), F.lit(DIMENSIONS - 1)), F.lit(0.0), lambda s, i: s + F.pow(F.greatest(
            F.get("lo_b", i) - F.get("hi_a", i), F.get("lo_a", i) - F.get("hi_b", i), F.lit(0.0)), 2))
        return pairs.where("a <= b").where(F.coalesce(apart, F.lit(0.0)) <= epsilon * epsilon).select("label", "size", "a", "b")

    def named(side: str, level: int) -> DataFrame:
        return nodes(level).select("label", "size", F.col("node").alias(side), F.shiftright("node", STEP).alias(f"up_{side}"), F.col("lo").alias(f"lo_{side}"), F.col("hi").alias(f"hi_{side}"))

    pairs = nodes(levels).select("label", "size", F.col("node").alias("a"), F.col("node").alias("b"))
    for level in range(levels - 1, -1, -1):
        above = pairs.select("label", "size", F.col("a").alias("up_a"), F.col("b").alias("up_b"))
        pairs = close(above.join(named("a", level), ["label", "size", "up_a"]).join(named("b", level), ["label", "size", "up_b"]))
    return pairs.select("a", "b")


def local_components(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of rows and columns of a bipartite link matrix: the smallest row number that can be reached (rows without links keep their own)."""
    rows = np.arange(len(mask))
    big = len(mask)
    while True:
        cols = np.where(mask, rows[:, None], big).min(axis=0)
        new = np.minimum(rows, np.where(mask, cols[None, :], big).min(axis=1))
        if (new == rows).all():
            return rows, cols
        rows = new


def compare(pairs: DataFrame, made: DataFrame, least: float) -> DataFrame:
    """(vec_id, links, root) for the linked vectors of each block pair."""
    def run(batches):
        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            for i in range(batch.num_rows):
                size = col["size"][i]
                x, y = (np.frombuffer(col[c][i], np.float64).reshape(-1, size) for c in ("raw_a", "raw_b"))
                nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
                mask = (x @ y.T) / (nx[:, None] * ny[None, :]) >= least
                ids, other = np.array(col["ids_a"][i]), np.array(col["ids_b"][i])
                mine, theirs = np.array(col["copies_a"][i]), np.array(col["copies_b"][i])
                same = col["a"][i] == col["b"][i]
                if same:
                    np.fill_diagonal(mask, False)
                # within one block a vector is the same as row and as column
                rows, cols = local_components(mask | np.eye(len(mask), dtype=bool) if same else mask)
                out = []
                smallest = np.full(len(ids), np.iinfo(np.int64).max)
                np.minimum.at(smallest, rows, ids)
                sides = [(ids, mask @ theirs, rows)] if same else [(ids, mask @ theirs, rows), (other, mine @ mask, cols)]
                if not same:
                    linked = mask.any(axis=0)
                    np.minimum.at(smallest, cols[linked], other[linked])
                for own, links, root in sides:
                    hit = links > 0
                    out.append((own[hit], links[hit], smallest[root[hit]]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=["vec_id", "links", "root"])

    side = lambda c: made.select(F.col("a").alias(c), "size" if c == "a" else F.col("size").alias("_size"), *[F.col(n).alias(f"{n}_{c}") for n in ("raw", "ids", "copies")])
    rows = pairs.repartition(shuffle_width(pairs.sparkSession), "a", "b").join(side("a"), "a").join(side("b").drop("_size"), "b")
    return rows.mapInArrow(run, "vec_id long, links long, root long")


def near_vectors(rows: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of rows (vec_id, embedding, label)."""
    epsilon = float(np.sqrt(2 - 2 * least)) * (1 + 1e-9) + 1e-12
    vectors = stash(usable(rows), "vectors")
    merged = vectors.groupBy("key", "label", "raw").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    distinct = stash(merged, "distinct-vectors")
    cut = stash(blocks(distinct, epsilon), "grid-blocks")
    bits = int(cut.agg(F.max("seq")).first()[0] or 0).bit_length()
    made = cut.withColumn("a", F.shiftleft("part", bits) + F.col("seq"))
    pairs = stash(block_pairs(made.select("a", "label", "size", "lo", "hi"), epsilon), "block-pairs")
    found = stash(compare(pairs, made, least), "block-links")
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    comp = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    of_rep = stash(distinct.select("key", "rep", "copies").join(links.withColumnRenamed("vec_id", "rep"), "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "vector-groups")
    linked = vectors.select("vec_id", "key").join(of_rep, "key").select("vec_id", "n_links", "component_id")
    # every row of the table, whether it can link or not: repeated ids stay as often as they are
    once = linked.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select(F.col("vec_id").cast("long").alias("vec_id")).join(once, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


@query("op9_grid_join")
def op9_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))

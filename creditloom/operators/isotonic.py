"""Isotonic calibration on the cluster: pooled blocks of score slices, merged pairwise.

Pooling adjacent violators inside a slice of the score axis is final: what is pooled there stays pooled in the whole. So each slice reduces
itself to its blocks (the convex minorant of its running sums), neighbours are merged and pooled again, and so on up. The driver gets
the steps of the fit, which are the model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binning import slice_index
from ..session import cut_lineage
from .prefix import _slices, slice_count

c = F.col
BLOCKS = "slice long, first double, last double, n double, total double"


@dataclass
class IsotonicSteps:
    """Block ends and values of an isotonic fit; between blocks the value is interpolated, beyond them it is constant."""

    xs: list
    ys: list

    def apply(self, df: DataFrame, x: str, out: str) -> DataFrame:
        if not self.xs:
            return df.withColumn(out, F.lit(None).cast("double"))
        steps = df.sparkSession.createDataFrame([(list(map(float, self.xs)), list(map(float, self.ys)))], "xs array<double>, ys array<double>")
        df = df.withColumns({"_xs": steps.select("xs").scalar(), "_ys": steps.select("ys").scalar()})
        v, last = c(x).cast("double"), len(self.xs) - 1
        df = df.withColumn("_hi", slice_index(v, c("_xs"), len(self.xs), strict=True))
        lo = F.greatest(c("_hi") - 1, F.lit(0))
        hi = F.least(c("_hi"), F.lit(last))
        x0, x1, y0, y1 = (F.get(a, i) for a in (c("_xs"), c("_ys")) for i in (lo, hi))
        return df.withColumn(out, F.when(v.isNotNull(), F.when(x1 > x0, y0 + (y1 - y0) * (F.least(F.greatest(v, x0), x1) - x0) / (x1 - x0)).otherwise(y1))).drop("_xs", "_ys", "_hi")


def pooled(blocks: Sequence[tuple]) -> list[list]:
    """Sorted blocks (first, last, n, total) with adjacent violators pooled."""
    out: list[list] = []
    for first, last, n, total in blocks:
        out.append([first, last, n, total])
        while len(out) > 1 and out[-2][3] * out[-1][2] >= out[-1][3] * out[-2][2]:
            _, last, n, total = out.pop()
            out[-1][1] = last
            out[-1][2] += n
            out[-1][3] += total
    return out


def _pool(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = pdf.sort_values("first")
    made = pooled(rows[["first", "last", "n", "total"]].itertuples(index=False, name=None))
    return pd.DataFrame([(pdf["slice"].iloc[0], *m) for m in made], columns=["slice", "first", "last", "n", "total"])


def blocks(df: DataFrame, score: str, label: str, n_slices: int | None = None) -> DataFrame:
    """(first, last, n, total) of every block of the isotonic fit of label on score."""
    counts = df.where(c(score).isNotNull() & ~F.isnan(c(score).cast("double")) & c(label).isNotNull()).groupBy(c(score).cast("double").alias("first")).agg(
        F.count("*").cast("double").alias("n"), F.sum(c(label).cast("double")).alias("total"))
    n = n_slices or slice_count(df)
    sliced, index = _slices(cut_lineage(counts), "first", n, ())
    now = sliced.select(index.cast("long").alias("slice"), "first", c("first").alias("last"), "n", "total")
    while True:
        now = cut_lineage(now.groupBy("slice").applyInPandas(_pool, BLOCKS))
        if n <= 1:
            return now.drop("slice")
        n = -(-n // 2)
        now = now.withColumn("slice", F.floor(c("slice") / 2).cast("long"))


def fit_isotonic(df: DataFrame, score: str, label: str = "is_bad", n_slices: int | None = None) -> IsotonicSteps:
    xs, ys = [], []
    for r in sorted(blocks(df, score, label, n_slices).collect()):  # the steps of the model
        ends = [r["first"]] if r["first"] == r["last"] else [r["first"], r["last"]]
        xs += ends
        ys += [r["total"] / r["n"]] * len(ends)
    return IsotonicSteps(xs, ys)

"""Logistic regression by Newton steps over distinct feature cells.

Rows with equal features (weights of evidence, flags, composites take few values) are one cell with its count and bads, per fold. A step sums
gradient and Hessian of any number of models over the cells at once, a model being a penalty and the fold it leaves out,
so a whole cross-validated grid costs as many passes as one fit. The driver gets these sums, never a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .metrics import ranking_of_counts

c = F.col
MAX_STEPS, TOLERANCE = 50, 1e-10


@dataclass(frozen=True)
class Task:
    """One model of a grid: the inverse penalty of the summed loss (None: no penalty) and the fold that is left out (None: all rows)."""

    c_value: float | None
    without: int | None = None


def feature_cells(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None, fold: str | None = None) -> DataFrame:
    """(fold, x0.., n, bad): rows and bads of each distinct combination of features; missing values are not allowed."""
    w = c(weight).cast("double") if weight else F.lit(1.0)
    x = [c(f).cast("double").alias(f"x{j}") for j, f in enumerate(features)]
    rows = df.where(c(label).isNotNull()).select((c(fold).cast("int") if fold else F.lit(-1)).alias("fold"), *x, w.alias("w"), (w * c(label).cast("double")).alias("wb"))
    return rows.groupBy("fold", *[f"x{j}" for j in range(len(features))]).agg(F.sum("w").alias("n"), F.sum("wb").alias("bad"))


def _sums(cells: DataFrame, p: int, tasks: Sequence[Task], betas: np.ndarray) -> np.ndarray:
    """Per task: loss, gradient and upper Hessian of the unpenalised sum over its cells."""
    upper = np.triu_indices(p + 1)
    width = 1 + (p + 1) + len(upper[0])

    def run(batches):
        total = np.zeros((len(tasks), width))
        for batch in batches:
            if not batch.num_rows:
                continue
            col = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            fold, n, bad = col[0], col[-2], col[-1]
            x = np.column_stack([np.ones(len(n)), *col[1:-2]])
            use = np.stack([np.ones(len(n), bool) if t.without is None else fold != t.without for t in tasks], 1)
            z = x @ np.asarray(betas).T
            mu = 1 / (1 + np.exp(-z))
            m, b = n[:, None] * use, bad[:, None] * use
            total[:, 0] += (m * np.logaddexp(0, z) - b * z).sum(0)
            total[:, 1:p + 2] += (b - m * mu).T @ x
            # the products of features are made once for all tasks
            total[:, p + 2:] += (m * mu * (1 - mu)).T @ (x[:, upper[0]] * x[:, upper[1]])
        at = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(at[0].ravel().astype(np.int32)), pa.array(at[1].ravel().astype(np.int32)), pa.array(total.ravel())], names=["t", "i", "v"])

    out = np.zeros((len(tasks), width))
    for r in cells.mapInArrow(run, "t int, i int, v double").groupBy("t", "i").agg(F.sum("v").alias("v")).collect():  # tasks x width numbers
        out[r["t"], r["i"]] = r["v"]
    return out


def newton(cells: DataFrame, p: int, tasks: Sequence[Task], written: bool = False) -> np.ndarray:
    """Coefficients of each task, the intercept (which has no penalty) first; cells that are not written yet are written once."""
    cells = cells if written else cut_lineage(cells)
    upper = np.triu_indices(p + 1)
    ridge = np.array([[0.0] + [1 / t.c_value if t.c_value else 0.0] * p for t in tasks])

    def at(betas):
        s = _sums(cells, p, tasks, betas)
        hess = np.zeros((len(tasks), p + 1, p + 1))
        hess[:, upper[0], upper[1]] = s[:, p + 2:]
        hess = hess + hess.transpose(0, 2, 1) - hess * np.eye(p + 1)
        return s[:, 0] + 0.5 * (ridge * betas ** 2).sum(1), s[:, 1:p + 2] - ridge * betas, hess + ridge[:, :, None] * np.eye(p + 1)

    betas = np.zeros((len(tasks), p + 1))
    loss, grad, hess = at(betas)
    size = np.ones(len(tasks))
    for _ in range(MAX_STEPS):
        # a column without variation gets a coefficient of 0
        step = np.stack([np.linalg.lstsq(h, g, rcond=1e-12)[0] for h, g in zip(hess, grad)])
        tried = betas + size[:, None] * step
        new_loss, new_grad, new_hess = at(tried)
        good = new_loss <= loss + 1e-9 * (1 + np.abs(loss))
        done = np.abs(size[:, None] * step).max(1) < TOLERANCE * (1 + np.abs(betas).max(1))
        betas[good], loss[good], grad[good], hess[good] = tried[good], new_loss[good], new_grad[good], new_hess[good]
        size = np.where(good, 1.0, size / 2)
        if (done | (size < 1e-6)).all():
            break
    return betas


def grid(cells: DataFrame, p: int, penalties: Sequence[float], folds: int) -> list[tuple[float, float, np.ndarray]]:
    """(mean held-out AUC, inverse penalty, coefficients on all rows) for each penalty; cells carry their fold."""
    cells = cut_lineage(cells)
    tasks = [Task(v, k) for v in penalties for k in range(folds)] + [Task(v) for v in penalties]
    betas = newton(cells, p, tasks, written=True)
    linear = lambda b: sum((c(f"x{j}") * float(v) for j, v in enumerate(b[1:])), F.lit(float(b[0])))
    scores = []
    for i in range(len(penalties)):
        value = F.lit(None).cast("double")
        for k in range(folds):
            value = F.when(c("fold") == k, linear(betas[i * folds + k])).otherwise(value)
        scores.append(F.struct(F.lit(i).alias("name"), value.alias("value")))
    held = cells.select("fold", "n", "bad", F.inline(F.array(*scores))).groupBy("fold", "name", "value").agg(F.sum("bad").alias("pos"), F.sum(c("n") - c("bad")).alias("neg"))
    auc = {r["name"]: r["auc"] for r in ranking_of_counts(held, ["fold", "name"]).groupBy("name").agg(F.avg("auc").alias("auc")).collect()}
    return [(auc.get(i) or 0.0, v, betas[len(penalties) * folds + i]) for i, v in enumerate(penalties)]

"""Partial likelihood of a Cox model with Efron ties, as Spark aggregates.

The score and the information split into sums over rows and sums over days. Rows are reduced to one line per duration day with the weights and
weighted features of those at that day (built-in sums, combined before the shuffle); sums over the risk sets are running sums over calendar
slices of that table. The matrix part needs no moments per day: a row's share is its weight times the hazard accumulated up to its
day, so p x p numbers are summed over all rows at once. Only these and the vector of p numbers reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import running_sums

c = F.col
#: Tied events that one row sums over, and days in a calendar slice.
TIES, SLICE_DAYS = 4096, 64.0
_TIE_SUMS = ("a0", "a1", "b0", "b1", "b2", "logs")


@dataclass
class Likelihood:
    """What one set of coefficients gives: the penalised log-likelihood, and the day table that everything else follows from."""

    value: float
    days: DataFrame
    beta: np.ndarray


def standardised(df: DataFrame, features: Sequence[str], mean: Sequence[float], scale: Sequence[float]) -> DataFrame:
    """(z0, z1, .., duration, event)."""
    return df.select(*[((c(f) - float(m)) / float(s)).alias(f"z{j}") for j, (f, m, s) in enumerate(zip(features, mean, scale))], "duration", "event")


def _linear(beta: np.ndarray):
    return sum((c(f"z{j}") * float(b) for j, b in enumerate(beta)), F.lit(0.0))


def _tie_sums(days: DataFrame) -> DataFrame:
    """Per day with d events: sums over its ties of 1/den, phi/den, 1/den^2, phi/den^2, phi^2/den^2 and log den, with den = s0 - phi e0 and phi = k/d.

    Days with very many events are cut into rows of TIES of them."""
    some = days.where("d > 0").select("duration", "d", "s0", "e0", F.explode(F.sequence(F.lit(0).cast("long"), c("d") - 1, F.lit(TIES).cast("long"))).alias("first"))
    phi = lambda k: k / c("d")
    den = lambda k: c("s0") - phi(k) * c("e0")
    zero = F.struct(*[F.lit(0.0).alias(n) for n in _TIE_SUMS])
    terms = {"a0": lambda k: 1 / den(k), "a1": lambda k: phi(k) / den(k), "b0": lambda k: 1 / den(k) ** 2, "b1": lambda k: phi(k) / den(k) ** 2,
             "b2": lambda k: phi(k) ** 2 / den(k) ** 2, "logs": lambda k: F.log(den(k))}
    ks = F.sequence(c("first"), F.least(c("first") + TIES, c("d")) - 1)
    summed = F.aggregate(ks, zero, lambda acc, k: F.struct(*[(acc[n] + t(k)).alias(n) for n, t in terms.items()]))
    return some.select("duration", summed.alias("t")).groupBy("duration").agg(*[F.sum(f"t.{n}").alias(n) for n in _TIE_SUMS])


def day_table(data: DataFrame, beta: np.ndarray) -> DataFrame:
    """A row per duration day: events d, their linear predictor xb, e0 and e1.. over its events, s0 and s1.. over its risk set, and the sums over its ties."""
    p = len(beta)
    w, e = c("w"), c("event")
    rows = data.withColumn("xb", _linear(beta)).withColumn("w", F.exp("xb"))
    own = rows.groupBy("duration").agg(
        F.sum(e).cast("long").alias("d"), F.sum(c("xb") * e).alias("xb"), F.sum(w).alias("o0"), F.sum(w * e).alias("e0"),
        *[F.sum(w * c(f"z{j}")).alias(f"o{j + 1}") for j in range(p)], *[F.sum(w * e * c(f"z{j}")).alias(f"e{j + 1}") for j in range(p)])
    own = cut_lineage(own.withColumn("back", -c("duration")))
    sums = [f"o{j}" for j in range(p + 1)]
    risk = running_sums(own, ["back"], sums, merge=False, slice_width=SLICE_DAYS)
    risk = risk.select((-c("back")).alias("duration"), *[(c(f"o{j}") + c(f"o{j}_before")).alias(f"s{j}") for j in range(p + 1)])
    both = cut_lineage(own.drop("back", *sums).join(risk, "duration"))
    return cut_lineage(both.join(_tie_sums(both), "duration", "left").fillna(0.0, list(_TIE_SUMS)))


def likelihood(data: DataFrame, beta: np.ndarray, ridge: float) -> Likelihood:
    """Penalised log-likelihood at beta; ridge is the weight of half the squared norm."""
    days = day_table(data, beta)
    value = days.agg(F.sum(c("xb") - c("logs"))).first()[0]
    return Likelihood(float(value) - ridge * 0.5 * float(beta @ beta), days, beta)


def score_and_information(data: DataFrame, at: Likelihood, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and negative Hessian: p and p x p numbers reach the driver."""
    beta, p = at.beta, len(at.beta)
    upper = np.triu_indices(p)
    width = p + len(upper[0])
    passed = running_sums(at.days.select("duration", "a0"), ["duration"], ["a0"], merge=False, slice_width=SLICE_DAYS).select("duration", (c("a0") + c("a0_before")).alias("hazard"))
    # a row a calendar day
    hazard = passed.join(at.days.select("duration", "a1"), "duration")
    share = F.exp(_linear(beta)) * (c("hazard") - c("event") * c("a1"))
    rows = data.join(F.broadcast(hazard), "duration").select(*[f"z{j}" for j in range(p)], c("event").cast("double").alias("event"), share.alias("share"))

    def flat(total):
        return pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], names=["i", "v"])

    def matrix(batch, first, n):
        return np.column_stack([batch.column(first + j).to_numpy(zero_copy_only=False) for j in range(n)])

    def over_rows(batches):
        total = np.zeros(width)
        for batch in batches:
            z, event, r = matrix(batch, 0, p), batch.column(p).to_numpy(), batch.column(p + 1).to_numpy()
            total[:p] += z.T @ (event - r)
            total[p:] += (z.T @ (z * r[:, None]))[upper]
        yield flat(total)

    def over_days(batches):
        total = np.zeros(width)
        for batch in batches:
            s, e = matrix(batch, 0, p), matrix(batch, p, p)
            b0, b1, b2 = (batch.column(2 * p + k).to_numpy()[:, None] for k in range(3))
            cross = s.T @ (e * b1)
            total[p:] -= (s.T @ (s * b0) - cross - cross.T + e.T @ (e * b2))[upper]
        yield flat(total)

    days = at.days.where("d > 0").select(*[f"s{j + 1}" for j in range(p)], *[f"e{j + 1}" for j in range(p)], "b0", "b1", "b2")
    parts = rows.mapInArrow(over_rows, "i int, v double").unionByName(days.mapInArrow(over_days, "i int, v double"))
    sums = np.zeros(width)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():  # p + p (p + 1) / 2 rows
        sums[r["i"]] = r["v"]
    info = np.zeros((p, p))
    info[upper] = sums[p:]
    info = info + info.T - np.diag(np.diag(info))
    return sums[:p] - ridge * beta, info + ridge * np.eye(p)


def baseline(at: Likelihood) -> tuple[list, list]:
    """Duration days and the cumulative baseline hazard at them: parameters of the model, one for each calendar day."""
    rows = at.days.select("duration", (c("d") / c("s0")).alias("h")).orderBy("duration").collect()
    return [r["duration"] for r in rows], list(np.cumsum([r["h"] for r in rows]))

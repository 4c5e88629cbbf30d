"""Time to default: Kaplan-Meier, Cox proportional hazards, concordance, horizon checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from ..functions.binning import slice_index, steps_at_or_below
from ..session import compiled, cut_lineage
from . import cox
from .prefix import quantiles, running_sums

c = F.col


def life_table(df: DataFrame, by: Sequence[str] = (), duration: str = "duration_days", event: str = "event") -> DataFrame:
    """Kaplan-Meier: at risk, events and survival per (by, duration).

    Rows are first counted per duration day, so windows see at most one row per
    calendar day of the portfolio and per group."""
    t = df.groupBy(*by, c(duration).alias("duration")).agg(F.count("*").alias("n"), F.sum(c(event).cast("bigint")).alias("events"))
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(1))
    later = group.orderBy(F.desc("duration")).rowsBetween(W.unboundedPreceding, 0)
    t = t.withColumn("at_risk", F.sum("n").over(later))
    # a step where everyone at risk fails takes survival to 0
    dead = F.max((c("events") == c("at_risk")).cast("int")).over(group.orderBy("duration"))
    logs = F.sum(F.when(c("events") < c("at_risk"), F.ln(1 - c("events") / c("at_risk"))).otherwise(0.0)).over(group.orderBy("duration"))
    return t.withColumn("survival", F.when(dead == 1, 0.0).otherwise(F.exp(logs)))


def survival_at(table: DataFrame, days: Sequence[int] = K.HORIZON_DAYS, by: Sequence[str] = ()) -> DataFrame:
    """Survival at each horizon: value of the last step not after it, 1 before the first."""
    aggs = [F.coalesce(F.max_by(F.when(c("duration") <= d, c("survival")), F.when(c("duration") <= d, c("duration"))), F.lit(1.0))
            .alias(f"survival_{m}mo") for m, d in zip(K.HORIZON_MONTHS, days)]
    g = table.groupBy(*by) if by else table
    return g.agg(F.sum("n").alias("n"), F.sum("events").alias("events"), *aggs)


def tier_by_percentile(df: DataFrame, hazard: str, low: float, high: float, labels: Sequence[str], inclusive_low: bool,
                       out: str) -> DataFrame:
    """Three tiers at two exact percentiles of the hazard. inclusive_low puts a value on the
    cut into the lower tier (evaluation), otherwise into the upper one (training)."""
    q = quantiles(df, [hazard], [low, high]).select("q").scalar()
    h = c(hazard)
    df = df.withColumn("_q", q)
    lo, hi = c("_q")[0], c("_q")[1]
    first = (h <= lo) if inclusive_low else (h < lo)
    second = (h <= hi) if inclusive_low else (h < hi)
    return df.withColumn(out, F.when(first, labels[0]).when(second, labels[1]).otherwise(labels[2])).drop("_q")


# --- Cox ---------------------------------------------------------------------
@dataclass
class CoxModel:
    """Coefficients on the original scale, means, and the baseline cumulative hazard steps."""

    coef: dict
    mean: dict
    stderr: dict
    durations: list
    cumulative: list
    thresholds: tuple | None = None

    def hazard_ratio(self):
        z = F.lit(0.0)
        for k, b in self.coef.items():
            z = z + (F.coalesce(c(k).cast("double"), F.lit(0.0)) - float(self.mean[k])) * float(b)
        return F.exp(z)

    def base_at(self, days: float) -> float:
        """Baseline cumulative hazard at the observed duration nearest to days (the later one on ties)."""
        d = np.array(self.durations, float)
        i = min(range(len(d)), key=lambda j: (abs(d[j] - days), -d[j]))
        return float(self.cumulative[i])

    def predict(self, feat: DataFrame) -> DataFrame:
        """survival_/pd_ at the horizons, hazard_ratio, median_survival_months, risk_tier."""
        df = feat.withColumn("hazard_ratio", self.hazard_ratio())
        out = {}
        for m, d in zip(K.HORIZON_MONTHS, K.HORIZON_DAYS):
            s = F.exp(c("hazard_ratio") * -self.base_at(d))
            out[f"survival_{m}mo"], out[f"pd_{m}mo"] = F.round(s, 4), F.round(1 - s, 4)
        # the first day by which half of such loans have failed: a binary search in the steps, which are model parameters
        steps = df.sparkSession.createDataFrame([(list(map(float, self.durations)), list(map(float, self.cumulative)))], "days array<double>, cum array<double>")
        df = df.withColumns({"_days": steps.select("days").scalar(), "_cum": steps.select("cum").scalar()})
        step = slice_index(F.log(F.lit(2.0)) / c("hazard_ratio"), c("_cum"), len(self.durations), strict=True)
        out["median_survival_months"] = F.round(F.get("_days", step) / K.DAYS_PER_MONTH, 1)
        if self.thresholds:
            lo, hi = self.thresholds
            out["risk_tier"] = F.when(c("hazard_ratio") >= hi, "early_default").when(c("hazard_ratio") >= lo, "late_default").otherwise("low_risk")
        else:
            out["risk_tier"] = F.lit("unknown")
        return df.withColumns(out).drop("_days", "_cum")

    def coefficients(self, spark, top: int = 15) -> DataFrame:
        """Largest coefficients by size with hazard ratio, z and significance mark."""
        rows = [(k, float(b), float(np.exp(b)), float(b / self.stderr[k]) if self.stderr[k] else None) for k, b in self.coef.items()]
        t = spark.createDataFrame(rows, "feature string, coef double, hazard_ratio double, z double")
        mark = F.when(F.abs("z") > 3.290527, "***").when(F.abs("z") > 2.575829, "**").when(F.abs("z") > 1.959964, "*").otherwise("")
        return t.withColumn("significance", mark).orderBy(F.desc(F.abs("coef"))).limit(top)


def fit_cox(df: DataFrame, features: Sequence[str] = K.SURVIVAL_FEATURES, duration: str = "duration_days", event: str = "event",
            penalizer: float = 0.1, max_iter: int = 25, tol: float = 1e-7) -> CoxModel:
    """Newton steps on the penalised partial likelihood (see `cox`). No row leaves the cluster."""
    features = list(features)
    raw = df.select(*[c(f).cast("double").alias(f) for f in features], c(duration).cast("bigint").alias("duration"),
                    c(event).cast("int").alias("event"))
    with compiled(df.sparkSession):
        # the features are deep expressions: computed and written once, read by every pass
        raw = cut_lineage(raw).dropna()
        st = raw.agg(F.count("*").alias("n"), *[F.avg(f).alias(f"m_{f}") for f in features],
                     *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).first()
    mean, scale = [st[f"m_{f}"] for f in features], [st[f"s_{f}"] or 1.0 for f in features]
    ridge = st["n"] * penalizer
    data = cox.standardised(raw, features, mean, scale)
    now = cox.likelihood(data, np.zeros(len(features)), ridge)
    score, info = cox.score_and_information(data, now, ridge)
    for _ in range(max_iter):
        step, size = np.linalg.solve(info, score), 1.0
        nxt = cox.likelihood(data, now.beta + step, ridge)
        while nxt.value < now.value - 1e-9 and size > 1e-3:
            size /= 2
            nxt = cox.likelihood(data, now.beta + size * step, ridge)
        done = abs(nxt.value - now.value) < tol * (1 + abs(now.value))
        now = nxt
        score, info = cox.score_and_information(data, now, ridge)
        if done:
            break
    coef = {f: float(b / s) for f, b, s in zip(features, now.beta, scale)}
    err = {f: float(np.sqrt(v) / s) for f, v, s in zip(features, np.diag(np.linalg.inv(info)), scale)}
    durations, cumulative = cox.baseline(now)
    return CoxModel(coef, dict(zip(features, mean)), err, durations, cumulative)


def score_equations(model: CoxModel, df: DataFrame, duration: str = "duration_days", event: str = "event", penalizer: float = 0.1) -> DataFrame:
    """(feature, residual) of the penalised score at a fitted model, per loan and standard deviation: 0 at the optimum.

    From the definition, in SQL functions: each loan's feature times its event less the hazard of its days, Efron ties."""
    features = list(model.coef)
    rows = df.select(*[c(f).cast("double").alias(f) for f in features], c(duration).cast("bigint").alias("t"), c(event).cast("int").alias("e")).dropna()
    rows = cut_lineage(rows.withColumn("w", model.hazard_ratio()))
    later = W.orderBy(F.desc("t"))  # a row a calendar day
    days = rows.groupBy("t").agg(F.sum("w").alias("own"), F.sum(c("w") * c("e")).alias("tied"), F.sum("e").alias("d")).withColumn("risk", F.sum("own").over(later))
    phi = F.transform(F.sequence(F.lit(1), F.greatest("d", F.lit(1))), lambda k: (k - 1) / F.greatest("d", F.lit(1)))
    each = lambda f: F.when(c("d") > 0, F.aggregate(phi, F.lit(0.0), lambda s, x: s + f(x) / (c("risk") - x * c("tied")))).otherwise(0.0)
    days = days.select("t", each(lambda x: F.lit(1.0)).alias("h"), each(lambda x: x).alias("h_tied")).withColumn("hazard", F.sum("h").over(W.orderBy("t")))
    left = rows.join(F.broadcast(days), "t").withColumn("left", c("e") - c("w") * (c("hazard") - c("e") * c("h_tied")))
    n = F.count("*")
    cells = [F.struct(F.lit(f).alias("feature"), (F.try_divide(F.sum(c("left") * (c(f) - float(model.mean[f]))), n * F.coalesce(F.nullif(F.stddev_samp(f), F.lit(0.0)), F.lit(1.0)))
             - penalizer * float(model.coef[f]) * F.coalesce(F.nullif(F.stddev_samp(f), F.lit(0.0)), F.lit(1.0))).alias("residual")) for f in features]
    return left.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def fit_hazard_tiers(model: CoxModel, train: DataFrame) -> CoxModel:
    """Tier cuts at the 33rd and 67th percentile of the training hazard."""
    with compiled(train.sparkSession):
        ratios = cut_lineage(train.select(model.hazard_ratio().alias("hazard_ratio")))
    q = quantiles(ratios, ["hazard_ratio"], [0.33, 0.67]).first()["q"]
    model.thresholds = (q[0], q[1])
    return model


def concordance(df: DataFrame, risk: str, duration: str = "duration_days", event: str = "event") -> DataFrame:
    """Event-aware concordance of a risk score (higher = earlier event), ties half, as one row (c_index); exact, NULL without comparable pairs.

    A later loan has a lower rank than a failed one if, at the highest bit in which the two ranks differ, it has the 0. So
    pairs are counted bit by bit: per (bit, ranks above the bit), failed loans with a 1 times later ones with a 0. Each such group
    has at most one row per calendar day, and no pair is formed. Two events at the same time are no pair; loans censored then are later.
    """
    rows = df.where(c(risk).isNotNull() & c(duration).isNotNull()).select(c(risk).cast("double").alias("r"), c(duration).alias("t"), c(event).cast("bigint").alias("e"))
    cells = cut_lineage(rows.groupBy("r", "t").agg(F.count("*").alias("n"), F.sum("e").alias("e")))
    ranks = cut_lineage(running_sums(cells.select("r").distinct().withColumn("one", F.lit(1)), ["r"], ["one"], merge=False).select("r", c("one_before").cast("bigint").alias("rank")))
    bits = int(ranks.agg(F.max("rank")).first()[0] or 0).bit_length()
    ranked = cells.join(ranks, "r").select("rank", "t", "n", "e")
    levels = F.array(F.struct(F.lit(-1).alias("bit"), c("rank").alias("above"), F.lit(True).alias("failed"), F.lit(True).alias("later")),
                     F.struct(F.lit(-2).alias("bit"), F.lit(0).cast("bigint").alias("above"), F.lit(True).alias("failed"), F.lit(True).alias("later")),
                     *[F.struct(F.lit(b).alias("bit"), F.shiftright("rank", b + 1).alias("above"), (F.getbit("rank", F.lit(b)) == 1).alias("failed"),
                                (F.getbit("rank", F.lit(b)) == 0).alias("later")) for b in range(bits)])  # -1: equal ranks, -2: all pairs
    flat = ranked.select("t", "n", "e", F.inline(levels))
    days = flat.groupBy("bit", "above", "t").agg(F.sum(F.when(c("failed"), c("e")).otherwise(0)).alias("failed"), F.sum(F.when(c("later"), c("n")).otherwise(0)).alias("n"),
                                                F.sum(F.when(c("later"), c("n") - c("e")).otherwise(0)).alias("censored"))
    after = W.partitionBy("bit", "above").orderBy(F.desc("t")).rowsBetween(W.unboundedPreceding, -1)  # a row a day
    pairs = days.withColumn("pairs", c("failed").cast("double") * (F.coalesce(F.sum("n").over(after), F.lit(0)) + c("censored")))
    total = pairs.agg(*[F.sum(F.when(c("bit") == b, c("pairs"))).alias(k) for b, k in ((-1, "tied"), (-2, "all"))], F.sum(F.when(c("bit") >= 0, c("pairs")).otherwise(0.0)).alias("right"))
    return total.select(F.try_divide(c("right") + 0.5 * c("tied"), c("all")).alias("c_index"))


def horizon_checks(scored: DataFrame, duration: str = "duration_days", event: str = "event", min_n: int = 20) -> DataFrame:
    """Brier score and calibration gap at each horizon over loans observed that long."""
    out = []
    for m, d in zip(K.HORIZON_MONTHS, K.HORIZON_DAYS):
        seen = c(duration) >= d
        alive, s = 1.0 - c(event), c(f"survival_{m}mo")
        n = F.count_if(seen)
        guard = lambda v: F.when(n >= min_n, v)  # noqa: E731, B023
        out.append(F.struct(
            F.lit(m).alias("months"), n.alias("n"), guard(F.avg(F.when(seen, F.pow(s - alive, 2)))).alias("brier"),
            guard(F.avg(F.when(seen, s))).alias("predicted_survival"), guard(F.avg(F.when(seen, alive))).alias("actual_survival")))
    t = scored.agg(F.array(*out).alias("a")).select(F.inline("a"))
    return t.withColumn("gap", F.abs(c("predicted_survival") - c("actual_survival")))


def tier_separation(scored: DataFrame, tier: str = "risk_tier", event: str = "event") -> DataFrame:
    t = scored.groupBy(c(tier).alias("tier")).agg(F.count("*").alias("n"), F.sum(c(event).cast("bigint")).alias("n_bad"),
                                                  F.avg(c(event).cast("double")).alias("bad_rate"))
    return t.withColumn("pct", c("n") / F.sum("n").over(W.partitionBy(F.lit(1))))


def profiles(spark) -> DataFrame:
    """The five representative borrowers as input rows."""
    names = "profile string, fico double, d30 double, d60 double, inq6 double, revutil double, pastdue double, " \
            "instbal double, revbal double, tl_total double, tl_paid double, tl_delin double, mopmt double, crhist double, qi string"
    rows = [(r[0], *map(float, r[1:-1]), r[-1]) for r in K.PROFILES]
    return spark.createDataFrame(rows, names)

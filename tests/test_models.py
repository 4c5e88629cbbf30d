"""Metrics, models and survival against small independent computations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from creditloom.operators import drift, metrics, models, survival, woe
from creditloom.functions.special import chi2_tail
from creditloom.operators.models import LogitModel, isotonic_steps
from creditloom.sources import writers


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(5)
    n = 1500
    x, z = rng.normal(size=n), rng.normal(size=n)
    p = 1 / (1 + np.exp(-(-1.5 + 1.2 * x - 0.5 * z)))
    return pd.DataFrame({"application_id": np.arange(n), "x": x, "z": z, "s": np.round(p, 2), "is_bad": (rng.random(n) < p).astype(int),
                         "day": rng.integers(1, 60, n)})


def _auc(s, y):
    pos, neg = s[y == 1], s[y == 0]
    d = pos[:, None] - neg[None, :]
    return ((d > 0).sum() + 0.5 * (d == 0).sum()) / d.size


def test_auc_ties_and_symmetry(spark, sample):
    df = spark.createDataFrame(sample).withColumn("m", -F.col("s"))
    r = {x.name: x for x in metrics.ranking(df, ["s", "m"]).collect()}
    assert abs(r["s"].auc - _auc(sample.s.to_numpy(), sample.is_bad.to_numpy())) < 1e-12
    assert abs(r["s"].auc + r["m"].auc - 1) < 1e-12
    one = metrics.ranking(df.where("is_bad = 1"), ["s"]).first()
    assert one.auc is None and one.ks is None


def test_psi_of_itself_is_zero(spark, sample):
    df = spark.createDataFrame(sample).withColumn("k", F.col("day").cast("string"))
    assert all(abs(r.psi) < 1e-9 for r in drift.psi_continuous(drift.psi_baseline(df, ["x", "s"]), df, ["x", "s"]).collect())
    assert abs(drift.psi_categorical(drift.category_baseline(df, ["k"]), df, ["k"]).first().psi) < 1e-9


def test_chi2_p_value(spark):
    df = spark.createDataFrame([("A", 0)] * 60 + [("B", 1)] * 40, "grade string, is_bad int")
    other = spark.createDataFrame([("A", 0)] * 40 + [("B", 1)] * 60, "grade string, is_bad int")
    r = drift.grade_chi2(df, other, ("A", "B")).first()
    assert abs(r["chi2"] - 16.6667) < 1e-3 and r["level"] == "RED" and abs(r["p_value"] - 4.4557e-5) < 1e-8
    assert drift.grade_chi2(df, df, ("A", "B")).first()["level"] == "STABLE"
    # published quantiles
    for dof, value, tail in ((1, 3.841459, 0.05), (2, 5.991465, 0.05), (3, 11.344867, 0.01), (5, 1.145476, 0.95), (6, 16.811894, 0.01), (9, 27.877165, 0.001)):
        p = spark.range(1).select(chi2_tail(F.lit(value), dof)).first()[0]
        assert abs(p - tail) < 1e-6 * max(1, tail / 0.01)
    assert spark.range(1).select(chi2_tail(F.lit(0.0), 3)).first()[0] == 1.0


def test_woe_of_long_category_values(spark):
    m = woe.WoeModel(["k"], {"k": "category"}, {"k": []}, {"k": {"v0.12345678": 1.7, "v3.0": -0.4}}, {"k": 1.0})
    assert [r[0] for r in m.transform(spark.createDataFrame([(0.12345678,), (3.0,), (0.123457,), (None,)], "k double")).select("k_woe").collect()] == [1.7, -0.4, 0.0, 0.0]


def test_isotonic_is_monotone_and_keeps_the_mean():
    xs, ys = isotonic_steps([0, 1, 2, 3], [0.1, 0.3, 0.2, 0.5], [10, 10, 30, 5])
    assert ys == sorted(ys) and xs == [0, 1, 2, 3]
    assert abs(ys[1] - 0.225) < 1e-12 and ys[1] == ys[2]


def test_logit_fit_and_expression(spark, sample):
    df = spark.createDataFrame(sample)
    m = models.fit_logit(df, ["x", "z"])
    assert abs(m.coef["x"] - 1.2) < 0.3 and abs(m.coef["z"] + 0.5) < 0.3
    got = df.select(m.column().alias("p"), "x", "z").first()
    assert abs(got.p - 1 / (1 + np.exp(-(m.intercept + m.coef["x"] * got.x + m.coef["z"] * got.z)))) < 1e-12


def test_woe_open_ends_null_and_unknown(spark):
    rows = [(float(i), 1 if i % 7 == 0 or i > 80 else 0) for i in range(100)] + [(None, 1)] * 5
    df = spark.createDataFrame(rows, "crhist double, is_bad int")
    m = woe.fit_woe(df, features=["crhist"])
    new = spark.createDataFrame([(-1e9,), (1e9,), (None,), (0.0,)], "crhist double")
    lo, hi, none, first = [r[0] for r in m.transform(new).select("crhist_woe").collect()]
    assert lo == first != 0 and hi < lo and none < 0
    cat = woe.fit_woe(spark.createDataFrame([(float(i % 3), i % 2) for i in range(60)], "is_repeat double, is_bad int"), features=["is_repeat"])
    assert cat.transform(spark.createDataFrame([(9.0,)], "is_repeat double")).first()["is_repeat_woe"] == 0.0


def test_scorecard_fit_save_load(spark, sample, tmp_path):
    rng = np.random.default_rng(3)
    n = len(sample)
    pdf = pd.DataFrame({"application_id": np.arange(n), "is_bad": sample.is_bad, "fico": 650 - 60 * sample.x, "qi": rng.choice(["HFHT", "LFLT", "MISSING"], n),
                        "partner": rng.choice(["PARTNER_A", "PARTNER_B"], n), "tl_total": rng.integers(1, 30, n).astype(float), "inq6": rng.integers(0, 9, n).astype(float)})
    df = spark.createDataFrame(pdf)
    m = models.fit_scorecard(df, rounds=3, oof_folds=2, cv_folds=2)
    out = m.predict(df)
    r = models.evaluate_scorecard(out).where("name = 'pd'").first()
    assert r.auc > 0.6 and 1.0 <= m.multiplier <= 3.0
    writers.save_scorecard(spark, m, str(tmp_path / "m"))
    back = writers.load_scorecard(spark, str(tmp_path / "m")).predict(df)
    assert out.select("application_id", "pd", "default_score").exceptAll(back.select("application_id", "pd", "default_score")).isEmpty()
    new, diag = models.recalibrate(m, df.where("application_id % 2 = 0"))
    d = {x.stage: x for x in diag.collect()}
    assert d["after"].brier <= d["before"].brier + 1e-9 and abs(d["after"].pred_over_act - 1) < 0.05
    v = {x.feature: x.violations for x in models.monotonicity(out, ["fico", "inq6"]).collect()}
    assert set(v) == {"fico", "inq6"}
    only_fico = m.predict(spark.createDataFrame([(1, 300.0), (2, 850.0)], "application_id long, fico double")).collect()
    assert all(0 < x.pd < 1 for x in only_fico)


def test_trees_keep_their_signs(spark, sample):
    """Raising a signed feature alone never moves the probability against its sign, and the model as rows scores alike."""
    from creditloom.operators import boosting
    df = spark.createDataFrame(sample)
    m = boosting.fit(df, ["x", "z"], {"x": 0.0, "z": 0.0}, rounds=12, depth=3, step=0.3, signs={"x": 1, "z": -1}, min_rows=20)
    other = [np.quantile(sample.z, q) for q in (0.1, 0.5, 0.9)]
    lines = [(i, float(v), float(z)) for i, z in enumerate(other) for v in np.linspace(sample.x.min() - 1, sample.x.max() + 1, 60)]
    got = spark.createDataFrame(lines, "i int, x double, z double").select("i", "x", m.column().alias("p")).toPandas()
    for _, part in got.groupby("i"):
        assert (np.diff(part.sort_values("x").p) >= -1e-12).all() and part.p.max() > part.p.min()
    from creditloom.operators.metrics import ranking
    assert ranking(df.withColumn("p", m.column()), ["p"]).first().auc > 0.65
    rows = {(r.tree, r.node): r for r in m.rows(spark).collect()}
    for r in df.withColumn("p", m.column()).limit(30).collect():
        total = m.base
        for t in range(len(m.trees)):
            node = rows[t, 0]
            while node.feature:
                node = rows[t, node.left if r[node.feature] <= node.threshold else node.right]
            total += node.value
        assert abs(r.p - 1 / (1 + np.exp(-total))) < 1e-12
    # scores that are written on the way change nothing
    before, boosting.CHECKPOINT = boosting.CHECKPOINT, 3
    try:
        again = boosting.fit(df, ["x", "z"], {"x": 0.0, "z": 0.0}, rounds=12, depth=3, step=0.3, signs={"x": 1, "z": -1}, min_rows=20)
    finally:
        boosting.CHECKPOINT = before
    assert [[(n.feature, n.bin) for n in t] for t in again.trees] == [[(n.feature, n.bin) for n in t] for t in m.trees]


def test_kaplan_meier(spark, sample):
    df = spark.createDataFrame(sample[["day", "is_bad"]])
    got = {r.duration: r.survival for r in survival.life_table(df, duration="day", event="is_bad").collect()}
    s = 1.0
    for t in sorted(sample.day.unique()):
        at = (sample.day >= t).sum()
        s *= 1 - sample.is_bad[sample.day == t].sum() / at
        assert abs(got[t] - s) < 1e-9


def _cox_numpy(x, t, e, lam):
    mu, sd = x.mean(0), x.std(0, ddof=1)
    z = (x - mu) / sd
    b = np.zeros(x.shape[1])
    n = len(x)
    for _ in range(30):
        g, h = -n * lam * b, n * lam * np.eye(len(b))
        w = np.exp(z @ b)
        for day in np.unique(t[e == 1]):
            risk, ev = t >= day, (t == day) & (e == 1)
            d = ev.sum()
            s0, s1, s2 = w[risk].sum(), (w[risk, None] * z[risk]).sum(0), (w[risk, None, None] * z[risk, :, None] * z[risk, None, :]).sum(0)
            t0, t1, t2 = w[ev].sum(), (w[ev, None] * z[ev]).sum(0), (w[ev, None, None] * z[ev, :, None] * z[ev, None, :]).sum(0)
            g = g + z[ev].sum(0)
            for k in range(d):
                f = k / d
                den, a, m = s0 - f * t0, s1 - f * t1, s2 - f * t2
                g = g - a / den
                h = h + m / den - np.outer(a / den, a / den)
        step = np.linalg.solve(h, g)
        b = b + step
        if np.abs(step).max() < 1e-10:
            break
    return b / sd


def test_cox_matches_direct_newton(spark, sample):
    m = survival.fit_cox(spark.createDataFrame(sample), ["x", "z"], "day", "is_bad")
    want = _cox_numpy(sample[["x", "z"]].to_numpy(), sample.day.to_numpy(), sample.is_bad.to_numpy(), 0.1)
    assert np.allclose([m.coef["x"], m.coef["z"]], want, atol=1e-5)
    m = survival.fit_hazard_tiers(m, spark.createDataFrame(sample))
    p = m.predict(spark.createDataFrame(sample)).toPandas()
    assert ((p.survival_6mo >= p.survival_12mo) & (p.survival_12mo >= p.survival_18mo)).all()
    assert set(p.risk_tier) == {"early_default", "late_default", "low_risk"}


def test_concordance_brute_force(spark, sample):
    s, t, e = sample.s.to_numpy(), sample.day.to_numpy(), sample.is_bad.to_numpy()
    num = den = 0.0
    for i in np.where(e == 1)[0]:
        later = (t > t[i]) | ((t == t[i]) & (e == 0))
        num += (s[i] > s[later]).sum() + 0.5 * (s[i] == s[later]).sum()
        den += later.sum()
    df = spark.createDataFrame(sample)
    assert abs(survival.concordance(df, "s", "day", "is_bad").first()["c_index"] - num / den) < 1e-12
    x, num = sample.x.to_numpy(), 0.0  # about as many values as rows
    for i in np.where(e == 1)[0]:
        later = (t > t[i]) | ((t == t[i]) & (e == 0))
        num += (x[i] > x[later]).sum() + 0.5 * (x[i] == x[later]).sum()
    assert abs(survival.concordance(df, "x", "day", "is_bad").first()["c_index"] - num / den) < 1e-12
    assert survival.concordance(df.where("is_bad = 0"), "s", "day", "is_bad").first()["c_index"] is None


def test_logit_model_fills():
    assert LogitModel(0.0, {"a": 1.0}, {"a": 2.0}).fills["a"] == 2.0


def test_boosted_bins_follow_from_the_counts_of_values(spark):
    from creditloom.operators import boosting, conform, prefix, woe
    from pyspark.sql import functions as F
    df = spark.range(2000).select(F.when(F.col("id") % 7 != 0, F.col("id") * 37 % 101).cast("double").alias("fico"), (F.col("id") * 13 % 1999 / 7).alias("d30"), (F.col("id") % 3 == 0).cast("int").alias("is_bad"))
    counts = woe.value_counts(df, ["fico", "d30"])
    m = models.fit_boosted(df, features=["fico", "d30"], rounds=2, counts=counts)
    fills = {r["name"]: r["median"] for r in conform.medians(df, ["fico", "d30"]).collect()}
    assert m.fills == fills and m.trees == boosting.fit(df, ["fico", "d30"], fills, rounds=2).trees
    # values that cover no wanted position are dropped before positions are compared with them
    q = prefix.quantiles(df, ["fico", "d30"], [0.0, 0.1, 1 / 3, 0.5, 1.0])
    assert "_places" in q._jdf.queryExecution().analyzed().toString()
    pdf = df.toPandas()
    for r in q.collect():
        assert max(abs(a - b) for a, b in zip(r["q"], pdf[r["name"]].quantile([0.0, 0.1, 1 / 3, 0.5, 1.0]))) < 1e-9

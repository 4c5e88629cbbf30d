"""Running sums, ranks and quantiles against numpy, with hot keys and ties."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from creditloom.operators.prefix import quantiles, ranked, running_sums


def _frame(spark, n=2000, seed=1):
    rng = np.random.default_rng(seed)
    # one key holds most rows, one order value a third of them
    key = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 40, n))
    t = np.where(rng.random(n) < 0.33, 50, rng.integers(0, 100, n))
    return pd.DataFrame({"id": np.arange(n), "k": key, "t": t, "v": rng.integers(0, 5, n)})


def test_running_sums_by_key(spark):
    pdf = _frame(spark)
    got = running_sums(spark.createDataFrame(pdf), ["t"], ["v"], keys=["k"]).toPandas()
    g = pdf.groupby(["k", "t"], as_index=False)["v"].sum().sort_values(["k", "t"])
    g["v_before"] = g.groupby("k")["v"].cumsum() - g["v"]
    m = got.merge(g, on=["k", "t"], suffixes=("", "_x"))
    assert len(m) == len(g) == len(got)
    assert (m["v"] == m["v_x"]).all() and (m["v_before"] == m["v_before_x"]).all()


def test_running_sums_many_slices_same_result(spark):
    df = spark.createDataFrame(_frame(spark))
    rows = lambda n: sorted(map(tuple, running_sums(df, ["t"], ["v"], n_slices=n).collect()))
    assert rows(2) == rows(17) == rows(64)


def test_ranked_is_a_permutation_in_order(spark):
    pdf = _frame(spark)
    got = ranked(spark.createDataFrame(pdf), "t", "id").toPandas()
    want = pdf.sort_values(["t", "id"])["id"].tolist()
    assert got.sort_values("rank")["id"].tolist() == want
    assert sorted(got["rank"]) == list(range(1, len(pdf) + 1))


def test_quantiles_match_linear_interpolation(spark):
    pdf = _frame(spark)
    pdf["x"] = np.random.default_rng(2).normal(size=len(pdf))
    probs = [0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 1]
    q = {r["name"]: r["q"] for r in quantiles(spark.createDataFrame(pdf), ["x", "t"], probs).collect()}
    for c in ("x", "t"):
        assert np.allclose(q[c], np.quantile(pdf[c], probs))


def test_quantiles_ignore_missing(spark):
    df = spark.range(10).select(F.when(F.col("id") < 5, F.col("id").cast("double")).alias("x"))
    assert quantiles(df, ["x"], [0.5]).first()["q"] == [2.0]

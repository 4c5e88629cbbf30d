"""Weight of evidence: bins, WoE/IV tables, selection and transform.

All features are counted in one pass, by distinct value; binning and counting bins work on these counts.
Bins are decided at fit time and identified by index: outer edges are open, NULL
is a bin of its own, unknown categories get 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from ..functions.binning import quantile_bin
from ..session import cut_lineage
from .prefix import long_values, quantiles_of_counts


def value_counts(df: DataFrame, features: Sequence[str] = K.WOE_FEATURES, label: str = "is_bad") -> DataFrame:
    """(name, value, n, n_good, n_bad), written once: edges, kinds, bins and information values all follow from it."""
    features = [f for f in features if f in df.columns]
    y = F.col(label).cast("bigint")
    return cut_lineage(long_values(df, features, carry=[label]).groupBy("name", "value").agg(
        F.count("*").alias("n"), F.sum(1 - y).alias("n_good"), F.sum(y).alias("n_bad")))


def bin_spec(counts: DataFrame, n: int = K.WOE_QUANTILES, max_categories: int = K.WOE_MAX_CATEGORIES) -> DataFrame:
    """(name, kind, edges) from value_counts: expert, category (few distinct values, no edges) or quantile."""
    known = counts.where(F.col("value").isNotNull())
    q = quantiles_of_counts(known.where(~F.isnan("value")).select("name", "value", "n"), [i / n for i in range(n + 1)])
    edges = q.select("name", F.array_distinct("q").alias("edges"))
    few = known.groupBy("name").agg(F.count("*").alias("n_values"))
    expert = F.array(*[F.lit(float(e)) for e in K.FICO_WOE_EDGES])
    spec = few.join(F.broadcast(edges), "name")
    kind = F.when(F.col("name") == "fico", "expert").when(F.col("n_values") <= max_categories, "category").otherwise("quantile")
    return spec.select("name", kind.alias("kind"), F.when(F.col("name") == "fico", expert).otherwise(F.col("edges")).alias("edges"))


def _bin(value: Column, kind: Column, edges: Column) -> Column:
    """Bin label: index of a (a, b] bin with open ends, the value itself for categories, NULL -> 'null'."""
    width = max(len(K.FICO_WOE_EDGES) - 1, K.WOE_QUANTILES)
    idx = quantile_bin(value, edges, width, open_ends=True)
    label = F.when(kind == "category", F.concat(F.lit("v"), value.cast("string"))).otherwise(
        F.concat(F.lit("b"), idx.cast("string")))
    return F.when(value.isNull() | F.isnan(value), "null").otherwise(label)


def woe_table(counts: DataFrame, spec: DataFrame) -> DataFrame:
    """(name, kind, bin, n_good, n_bad, woe, iv) from value_counts: ln(%good/%bad) with counts floored at 0.5."""
    counts = (counts.join(F.broadcast(spec), "name")  # a row for each feature
              .groupBy("name", "kind", _bin(F.col("value"), F.col("kind"), F.col("edges")).alias("bin"))
              .agg(F.sum("n_good").alias("n_good"), F.sum("n_bad").alias("n_bad")))
    per = W.partitionBy("name")  # one feature's bins: a dozen rows
    good, bad = F.sum("n_good").over(per), F.sum("n_bad").over(per)
    t = counts.withColumns({
        "pg": F.greatest(F.col("n_good").cast("double"), F.lit(0.5)) / good,
        "pb": F.greatest(F.col("n_bad").cast("double"), F.lit(0.5)) / bad})
    return t.withColumn("woe", F.ln(F.col("pg") / F.col("pb"))).select(
        "name", "kind", "bin", "n_good", "n_bad", "woe", ((F.col("pg") - F.col("pb")) * F.col("woe")).alias("iv"))


def information_values(table: DataFrame) -> DataFrame:
    return table.groupBy("name").agg(F.sum("iv").alias("iv"), F.count("*").alias("n_bins"))


def select_features(iv: DataFrame, min_iv: float = K.MIN_IV, top: int = K.MAX_IV_FEATURES,
                    fallback: int = K.FALLBACK_FEATURES) -> DataFrame:
    """IV >= min_iv, best first, at most ``top``; if none passes, the best ``fallback``."""
    rank = F.row_number().over(W.orderBy(F.desc("iv"), "name"))  # one row per feature
    passing = F.count_if(F.col("iv") >= min_iv).over(W.partitionBy(F.lit(1)))
    r = iv.withColumns({"rank": rank, "passing": passing})
    keep = F.when(F.col("passing") > 0, (F.col("iv") >= min_iv) & (F.col("rank") <= top)).otherwise(F.col("rank") <= fallback)
    return r.where(keep).select("name", "iv", F.col("rank").cast("int").alias("rank"))


@dataclass
class WoeModel:
    """Fitted bins as plain data: features in IV order, edges, bin -> WoE, medians for fill."""

    features: list
    kinds: dict
    edges: dict
    woe: dict
    iv: dict
    fills: dict = field(default_factory=dict)

    def value(self, name: str) -> Column:
        """WoE of one feature as a CASE expression; unknown bins give 0."""
        x = F.col(name).cast("double")
        x = F.when(~F.isnan(x), x)
        if name in self.fills:
            x = F.coalesce(x, F.lit(float(self.fills[name])))
        table = self.woe[name]
        expr = F.when(x.isNull(), F.lit(float(table.get("null", 0.0))))
        if self.kinds[name] == "category":
            for k, v in sorted(table.items()):
                if k != "null":
                    expr = expr.when(x == float(k[1:]), F.lit(float(v)))
            return expr.otherwise(F.lit(0.0))
        inner = self.edges[name][1:-1]
        for i, hi in enumerate(inner):
            expr = expr.when(x <= hi, F.lit(float(table.get(f"b{i}", 0.0))))
        return expr.otherwise(F.lit(float(table.get(f"b{len(inner)}", 0.0))))

    def transform(self, df: DataFrame, suffix: str = "_woe") -> DataFrame:
        have = set(df.columns)
        return df.withColumns({f + suffix: self.value(f) if f in have else F.lit(0.0) for f in self.features})


def fit_woe(df: DataFrame, label: str = "is_bad", features: Sequence[str] = K.WOE_FEATURES,
            fill_medians: bool = False, counts: DataFrame | None = None) -> WoeModel:
    """Fit bins, WoE and the IV selection, from value_counts of the features if given. Only the bin table (features x bins) leaves the cluster."""
    features = [f for f in features if f in df.columns]
    fills = {}
    if fill_medians:
        from .conform import medians
        fills = {r.name: r["median"] for r in medians(df, features).collect()}
        df = df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(float(v))) for f, v in fills.items()})
    counts = value_counts(df, features, label) if counts is None else counts
    spec_rows = bin_spec(counts).collect()
    spec = df.sparkSession.createDataFrame([(r["name"], r["kind"], r["edges"]) for r in spec_rows],
                                           "name string, kind string, edges array<double>")
    rows = woe_table(counts, spec).collect()
    iv: dict = {}
    table: dict = {}
    for r in rows:
        iv[r["name"]] = iv.get(r["name"], 0.0) + r["iv"]
        table.setdefault(r["name"], {})[r["bin"]] = r["woe"]
    order = sorted(iv.items(), key=lambda kv: (-kv[1], kv[0]))
    chosen = [f for f, v in order if v >= K.MIN_IV][:K.MAX_IV_FEATURES] or [f for f, _ in order[:K.FALLBACK_FEATURES]]
    return WoeModel(chosen, {r["name"]: r["kind"] for r in spec_rows}, {r["name"]: list(r["edges"]) for r in spec_rows},
                    table, iv, fills)

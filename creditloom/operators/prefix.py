"""Distributed running sums, ranks and exact quantiles.

A global window puts every row into one task, and a window over a hot key puts
that key into one task. Here the order axis is first cut into slices at
approximate quantiles (a bounded sketch, found lazily in the same plan). A
slice index is a pure function of the row, so the slice totals and the in-slice
window agree without any pinned partitioning: executors may be lost between
them. Each window group is one (key, slice), about 1/n of the rows even when one
key holds them all, because rows are merged to distinct (key, order) first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.binning import slice_index
from ..session import cut_lineage, shuffle_width

SKETCH_ACCURACY = 2000
HOT_ROWS = 500


def _number(df: DataFrame, name: str) -> Column:
    """The ordering column as a double that keeps its order."""
    kind, col = df.schema[name].dataType.typeName(), F.col(name)
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return (F.unix_date(F.to_date(col)) * 86400.0 + F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)).cast("double")
    return col.cast("double")


def _slices(df: DataFrame, order: str, n: int, by: Sequence[str]) -> tuple[DataFrame, Column]:
    probs = [i / n for i in range(1, n)]
    value = _number(df, order)
    sketch = F.percentile_approx(value, probs, SKETCH_ACCURACY).alias("_bounds")
    if by:
        # one row per named series (a fixed list of scores or features, not data keys)
        df = df.join(F.broadcast(df.groupBy(*by).agg(sketch)), list(by))
    else:
        df = df.withColumn("_bounds", df.agg(sketch).scalar())
    return df, slice_index(value, F.col("_bounds"), n - 1)


def slice_count(df: DataFrame) -> int:
    """As many slices as the shuffle has partitions."""
    return max(2, shuffle_width(df.sparkSession))


def split_hot(df: DataFrame, key: str, limit: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys with up to ``limit`` rows, which one task may order by itself, and the rows of larger keys (None if there are none)."""
    hot = cut_lineage(df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > limit).select(key))
    if hot.isEmpty():
        return df, None
    return df.join(hot, key, "left_anti"), df.join(hot, key, "left_semi")


def running_sums(df: DataFrame, order: Sequence[str], values: Sequence[str], keys: Sequence[str] = (),
                 series: Sequence[str] = (), n_slices: int | None = None, merge: bool = True,
                 slice_width: float | None = None) -> DataFrame:
    """Sums of ``values`` and, as ``<v>_before``, their totals over strictly earlier
    ``order`` within ``keys`` + ``series``.

    ``keys`` may be unbounded data keys; ``series`` names a short fixed list (score
    or feature names) that gets its own slice bounds. The result has one row per
    distinct (keys, series, order). ``order[0]`` must be numeric or a timestamp.

    ``slice_width`` cuts the axis at multiples of a fixed width (seconds for timestamps,
    days for dates) instead of sketching quantiles: right for calendar axes, where the
    number of slices is bounded anyway, and it saves reading the input for the sketch.
    """
    group = [*series, *keys]
    if merge:
        df = df.groupBy(*group, *order).agg(*[F.sum(v).alias(v) for v in values])
    if slice_width:
        sliced = df.withColumn("_slice", F.floor(_number(df, order[0]) / slice_width).cast("int"))
    else:
        sliced, index = _slices(df, order[0], n_slices or slice_count(df), series)
        sliced = sliced.withColumn("_slice", index).drop("_bounds")

    inside = W.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = sliced.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})

    totals = sliced.groupBy(*group, "_slice").agg(*[F.sum(v).alias(f"_{v}_total") for v in values])
    # one row per slice and group
    earlier = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*group, "_slice", *[
        F.coalesce(F.sum(f"_{v}_total").over(earlier), F.lit(0)).alias(f"_{v}_offset") for v in values])
    if not keys and not slice_width:
        offsets = F.broadcast(offsets)  # n rows per series
    joined = local.join(offsets, [*group, "_slice"])
    return joined.select(*group, *order, *values,
                         *[(F.col(f"{v}_before") + F.col(f"_{v}_offset")).alias(f"{v}_before") for v in values])


def ranked(df: DataFrame, key: str, tie: str, name: str = "rank", n_slices: int | None = None) -> DataFrame:
    """Global 1-based position by (key, tie) ascending; ``tie`` is a unique numeric id.

    Rows are sliced on the tie-breaker, so a key value shared by a third of the
    rows is still spread over all slices."""
    n = n_slices or slice_count(df)
    sliced, index = _slices(df, tie, n, ())
    sliced = sliced.withColumn("_part", index).drop("_bounds")
    totals = sliced.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    offsets = running_sums(totals, [key, "_part"], ["_n"], merge=False).select(
        key, "_part", F.col("_n_before").alias("_offset"))
    local = sliced.withColumn("_rn", F.row_number().over(W.partitionBy(key, "_part").orderBy(tie)))
    return (local.join(offsets, [key, "_part"])
            .withColumn(name, F.col("_rn") + F.col("_offset")).drop("_part", "_rn", "_offset"))


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """(by, carry, name, value): one row per column, columns as doubles."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*by, *carry, F.explode(pairs).alias("_p")).select(*by, *carry, "_p.name", "_p.value")


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles of many columns in one pass.

    Returns (by, name, n, q) with q an array over ``probs``. ``percentile`` would
    hold every distinct value of a column in one task; this ranks distinct values
    with running_sums and picks the two neighbours of each target position.
    """
    values = long_values(df, cols, by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return quantiles_of_counts(values.groupBy(*by, "name", "value").agg(F.count("*").alias("n")), probs, by)


def quantiles_of_counts(hist: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """The same from (by, name, value, n): counts of the distinct values."""
    series = [*by, "name"]
    cum = running_sums(hist, ["value"], ["n"], series=series, merge=False)
    total = hist.groupBy(*series).agg(F.sum("n").alias("total"))
    ps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    wanted = F.transform(ps, lambda s: F.struct(
        s["i"].alias("i"),
        ((F.col("total") - 1) * s["p"]).alias("pos"),
    ))
    covers = F.filter(wanted, lambda s: (
        ((F.floor(s["pos"]) >= F.col("n_before")) & (F.floor(s["pos"]) < F.col("n_before") + F.col("n")))
        | ((F.ceil(s["pos"]) >= F.col("n_before")) & (F.ceil(s["pos"]) < F.col("n_before") + F.col("n")))))
    # most values cover no position: one binary search among the positions tells, before each is compared
    places = F.flatten(F.array(*[F.array(F.floor((F.col("total") - 1) * float(p)), F.ceil((F.col("total") - 1) * float(p))) for p in probs]))
    total = total.withColumn("_places", F.array_sort(F.array_distinct(places)))
    following = F.get("_places", slice_index(F.col("n_before"), F.col("_places"), 2 * len(probs), strict=True))
    hits = (cum.join(F.broadcast(total), series).where(following < F.col("n_before") + F.col("n"))
            .select(*series, "value", "n", "n_before", "total", F.explode(covers).alias("s")))
    lo, hi = F.floor("s.pos"), F.ceil("s.pos")
    inside = lambda k: (k >= F.col("n_before")) & (k < F.col("n_before") + F.col("n"))
    points = hits.groupBy(*series, "total", F.col("s.i").alias("i"), F.col("s.pos").alias("pos")).agg(
        F.max(F.when(inside(lo), F.col("value"))).alias("lo"),
        F.max(F.when(inside(hi), F.col("value"))).alias("hi"))
    q = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("pos") - F.floor("pos"))
    # one small array per series: len(probs) entries
    return (points.groupBy(*series, F.col("total").alias("n"))
            .agg(F.sort_array(F.collect_list(F.struct("i", q.alias("q")))).alias("a"))
            .select(*series, "n", F.col("a.q").alias("q")))


def quantile_scalar(df: DataFrame, col: str, probs: Sequence[float]) -> Column:
    """The same for one column, usable as an expression (scalar subquery)."""
    return quantiles(df, [col], probs).select("q").scalar()


def quantile_edges(df: DataFrame, cols: Sequence[str], n: int, by: Sequence[str] = ()) -> DataFrame:
    """Distinct sorted edges of n equal-frequency bins: (by, name, edges)."""
    q = quantiles(df, cols, [i / n for i in range(n + 1)], by)
    return q.select(*by, "name", F.array_distinct("q").alias("edges"))

"""History of linked loans: same identity, same shop, connected shops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from ..functions.clean import text_or_null
from ..session import cut_lineage
from .labels import bad_state
from .prefix import running_sums, split_hot


def identity_loans(loans: DataFrame, owners: DataFrame, key: str = "ident_key") -> DataFrame:
    """Loans with the identity keys of their owners; (identity, loan) pairs are unique, so a
    loan with several owners of one identity is counted once."""
    return loans.join(owners, "application_id").dropDuplicates([key, "loan_id"])


def prior_history(linked: DataFrame, key: str = "ident_key", date: str = "signing_date") -> DataFrame:
    """Strictly earlier loans of the same identity: counts, bads, paids, distinct shops.

    All four measures are additive once a shop is counted at its first loan, so the
    range self join becomes a running sum over (identity, date). The rows are shuffled once, by identity;
    an identity may hold any share of them: those with more than HOT_ROWS loans are cut into date slices.
    """
    few, many = split_hot(linked.where(F.col(key).isNotNull() & F.col(date).isNotNull()), key)
    out = _in_order(few, key, date)
    return out if many is None else out.unionByName(_in_slices(many, key, date))


def _in_order(linked: DataFrame, key: str, date: str) -> DataFrame:
    """The history by windows over each identity's loans."""
    state, shop = F.col("loan_state"), F.col("shop_id")
    first = (F.row_number().over(W.partitionBy(key, "shop_id").orderBy(date)) == 1) & shop.isNotNull()
    rows = linked.repartition(key).withColumn("_shop", first.cast("bigint"))
    so_far, today = W.partitionBy(key).orderBy(date), W.partitionBy(key, date)
    earlier = lambda x: F.coalesce(F.sum(x).over(so_far), F.lit(0)) - F.coalesce(F.sum(x).over(today), F.lit(0))
    rows = rows.withColumns({
        "prior_loans_ssn": earlier(F.lit(1).cast("bigint")), "prior_bad_ssn": earlier(bad_state(state).cast("bigint")),
        "prior_paid_ssn": earlier(state.isin(*K.GOOD_STATES).cast("bigint")), "prior_shops_ssn": earlier(F.col("_shop"))})
    return history_flags(rows.drop("_shop"))


def _in_slices(linked: DataFrame, key: str, date: str) -> DataFrame:
    """The history of identities too large for one task, as running sums over slices of the dates."""
    step = F.col(date)
    bad = bad_state(F.col("loan_state"))
    paid = F.col("loan_state").isin(*K.GOOD_STATES).cast("int")
    loans = linked.groupBy(key, date).agg(
        F.count("*").alias("loans"), F.sum(bad).alias("bads"), F.sum(paid).alias("paids"))
    shops = linked.where(F.col("shop_id").isNotNull()).groupBy(key, "shop_id").agg(F.min(step).alias(date))
    firsts = shops.groupBy(key, date).agg(F.count("*").alias("shops"))
    zero = F.lit(0).cast("bigint")
    steps = loans.withColumn("shops", zero).unionByName(
        firsts.select(key, date, *[zero.alias(k) for k in ("loans", "bads", "paids")], "shops"))
    cum = running_sums(steps, [date], ["loans", "bads", "paids", "shops"], keys=[key],
                       slice_width=30.0 if linked.schema[date].dataType.typeName() == "date" else 30 * 86400.0)
    prior = cum.select(key, date, *[F.col(f"{a}_before").alias(b) for a, b in (
        ("loans", "prior_loans_ssn"), ("bads", "prior_bad_ssn"),
        ("paids", "prior_paid_ssn"), ("shops", "prior_shops_ssn"))])
    return history_flags(linked.join(prior, [key, date]))


def history_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "has_prior_bad": (F.col("prior_bad_ssn") > 0).cast("int"),
        "has_prior_paid": (F.col("prior_paid_ssn") > 0).cast("int"),
        "is_repeat": (F.col("prior_loans_ssn") > 0).cast("int"),
        "is_cross_entity": (F.col("prior_shops_ssn") > 1).cast("int"),
    })


def shop_lookup(loans: DataFrame, date: str = "signing_date") -> DataFrame:
    """Per shop, the resolved loans strictly before its latest loan.

    The latest loan has the largest prior set, so two aggregates are enough:
    totals minus the totals at the latest date. Shops without a hit are left out.
    """
    bad = bad_state(F.col("loan_state"))
    done = F.col("loan_state").isin(*K.BAD_STATES, *K.GOOD_STATES).cast("int")
    daily = loans.groupBy("shop_id", date).agg(F.sum(done).alias("done"), F.sum(bad).alias("bad"))
    last = F.max_by(F.struct("done", "bad"), F.col(date))
    out = daily.groupBy("shop_id").agg(F.sum("done").alias("d"), F.sum("bad").alias("b"), last.alias("last"))
    return (out.select(F.col("shop_id").cast("string").alias("key"),
                       (F.col("b") - F.col("last.bad") > 0).cast("int").alias("has_prior_bad"),
                       (F.col("d") - F.col("last.done")).alias("connected_count"))
            .where(F.col("connected_count") > 0))


def lookup_from_history(entity: DataFrame, key: str = "application_id", last: str = "signing_date") -> DataFrame:
    """Keyed lookup table from entity history; the newest row of a key wins."""
    cols = {"has_prior_bad": F.col("has_prior_bad"), "connected_count": F.col("prior_shops_ssn"),
            "connected_loans": F.col("prior_loans_ssn"), "is_repeat": F.col("is_repeat"),
            "is_cross_entity": F.col("is_cross_entity")}
    order = F.struct(F.col(last), *cols.values()) if last in entity.columns else F.struct(*cols.values())
    pick = F.max_by(F.struct(*[v.alias(k) for k, v in cols.items()]), order)
    return (entity.groupBy(F.col(key).cast("string").alias("key")).agg(pick.alias("r"))
            .select("key", *[F.coalesce(F.col(f"r.{k}"), F.lit(0)).alias(k) for k in cols]))


def attach_lookup(df: DataFrame, lookup: DataFrame, key: str = "application_id", fallback: str = "shop_id",
                  prefix: str = "lu_") -> DataFrame:
    """Left join the lookup on key, on the fallback column where key is NULL.

    The lookup grows with the portfolio, so the join strategy is left to AQE."""
    parts: list[Column] = [text_or_null(F.col(k)) for k in (key, fallback) if k in df.columns]
    side = lookup.select(F.col("key").alias("_k"), *[F.col(k).alias(prefix + k) for k in lookup.columns if k != "key"])
    return df.withColumn("_key", F.coalesce(*parts)).join(side, F.col("_key") == F.col("_k"), "left").drop("_key", "_k")


def components(members: DataFrame, node: str = "shop_id", identifier: str = "identifier") -> DataFrame:
    """(node, component) of nodes sharing any identifier; component is the smallest node.

    Alternates two aggregates, node labels to identifiers and back, so an
    identifier shared by a third of all nodes is one hash-aggregate group and no
    pair is ever formed. Each round is written to the shared checkpoint folder; rounds
    go on until no label changes.
    """
    edges = cut_lineage(members.where(F.col(identifier).isNotNull()).select(node, identifier).distinct())
    labels = cut_lineage(members.select(node).distinct().withColumn("component", F.col(node)))
    while True:
        seen = edges.join(labels, node).groupBy(identifier).agg(F.min("component").alias("m"))
        offered = edges.join(seen, identifier).groupBy(node).agg(F.min("m").alias("m"))
        nxt = labels.join(offered, node, "left").select(
            node, F.col("component").alias("old"), F.least("component", "m").alias("component"))
        # pointer jump: take the label of the label
        hop = nxt.select(F.col(node).alias("_n"), F.col("component").alias("_c"))
        nxt = nxt.join(hop, F.col("component") == F.col("_n"), "left").select(
            node, "old", F.least("component", "_c").alias("component"))
        nxt = cut_lineage(nxt)
        changed = not nxt.where(F.col("component") != F.col("old")).isEmpty()
        labels = nxt.select(node, "component")
        if not changed:
            return labels


def component_bad_flag(loans: DataFrame, labels: DataFrame) -> DataFrame:
    """Per component: shops, loans, bad loans and whether any is bad."""
    return (loans.join(labels, "shop_id").groupBy("component").agg(
        F.count_distinct("shop_id").alias("n_shops"), F.count("*").alias("n_loans"),
        F.sum(bad_state(F.col("loan_state")).cast("bigint")).alias("n_bad"))
        .withColumn("has_bad", (F.col("n_bad") > 0).cast("int")))

"""The sales star schema: dimensions, fact, the wide mart and its reports.

Join strategy of the wide mart: the fact (line items x orders) is the big
side. Regions are nations, which bounds their broadcast. Users, items and
payment methods are joined without a hint: AQE broadcasts them where their
measured size allows and else uses sort-merge joins, which it splits when one
key is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_half_up
from .joins import join_dimension, orphans


def dim_users(users: DataFrame) -> DataFrame:
    """Distinct users."""
    return users.select("user_id", "username", "region_id", "rank").distinct()


def dim_regions(regions: DataFrame) -> DataFrame:
    return regions.select("region_id", "region_name", "avg_player_spending").distinct()


def dim_payment_methods(methods: DataFrame) -> DataFrame:
    return methods.select("payment_method_id", "method_name").distinct()


def dim_items(items: DataFrame) -> DataFrame:
    return items.select("skin_id", "skin_name", "weapon", "rarity", "base_price_vp", "collection").distinct()


def fact_transactions(tx: DataFrame) -> DataFrame:
    return tx.select("transaction_id", "user_id", "skin_id", "payment_method_id", "purchase_date",
                     "final_price_vp", "discount_percent", "bundle_purchase")


def wide_mart(fact: DataFrame, users: DataFrame, regions: DataFrame, items: DataFrame,
              methods: DataFrame) -> DataFrame:
    """D8 + J3: fact INNER JOIN users, regions (through the user), items and
    payment methods; one row per fact row with a match in every dimension."""
    u = users.select("user_id", "username", "region_id", "rank")
    r = regions.select("region_id", "region_name").distinct()
    i = items.select("skin_id", "skin_name", "weapon", "rarity", "collection")
    m = methods.select("payment_method_id", F.col("method_name").alias("payment_method"))
    j = join_dimension(fact, u, "user_id", "inner")
    j = join_dimension(j, r, "region_id", "inner", bounded=True)
    j = join_dimension(join_dimension(j, i, "skin_id", "inner"), m, "payment_method_id", "inner")
    return j.select("transaction_id", "username", "region_name", "rank", "skin_name", "weapon", "rarity",
                    "collection", "payment_method", "purchase_date", "final_price_vp", "discount_percent",
                    "bundle_purchase")


def sales_by_region(mart: DataFrame) -> DataFrame:
    """Sales count and total per region, largest total first."""
    return mart.groupBy("region_name").agg(F.count(F.lit(1)).alias("total_sales"),
                                           round_half_up(F.sum("final_price_vp"), 2).alias("total_vp")) \
        .orderBy(F.col("total_vp").desc(), "region_name")


def share_of_total(df: DataFrame, key: str, count_name: str = "votes", digits: int = 1) -> DataFrame:
    """W2 + P17: rows per key and their percentage of all rows, most first.

    ``SUM(COUNT(*)) OVER ()`` would be a window over one partition holding a
    row per key (unbounded as keys grow); the grand total is instead a
    one-row aggregate joined to every key row (a broadcast of one row)."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    total = g.agg(F.sum(count_name).alias("_total"))
    return g.crossJoin(F.broadcast(total)).select(
        key, count_name, round_half_up(F.col(count_name) * 100.0 / F.col("_total"), digits).alias("percentage")) \
        .orderBy(F.col(count_name).desc(), key)


def beneficiary_totals(donations: DataFrame) -> DataFrame:
    """Donated total and purchases per beneficiary, largest total first."""
    return donations.groupBy("beneficiary").agg(round_half_up(F.sum("amount_vp"), 2).alias("total_donated"),
                                                F.count(F.lit(1)).alias("purchases")) \
        .orderBy(F.col("total_donated").desc(), "beneficiary")


def sales_report(mart: DataFrame) -> dict[str, DataFrame]:
    """The sales report's charts."""
    return {
        "by_date": mart.groupBy("purchase_date").agg(round_half_up(F.sum("final_price_vp"), 2).alias("total_vp")),
        "by_item": mart.groupBy("skin_name").agg(F.count("transaction_id").alias("transactions")),
        "by_rarity": mart.groupBy("rarity").agg(round_half_up(F.sum("final_price_vp"), 2).alias("total_vp")),
        "by_method": mart.groupBy("payment_method").agg(F.count("transaction_id").alias("transactions")),
    }


def voting_view(events: DataFrame, items: DataFrame, regions: DataFrame) -> DataFrame:
    """The live voting view over the events table: every ``click`` is a
    vote for an item; the voted charity is the user's region, the device is
    derived from the event id, premium players are ``purchase``-event users.

    (The original names this view but does not ship its SQL; these column
    derivations are ours.)
    """
    votes = events.where(F.col("event_type") == "click")
    n_items = items.agg(F.count(F.lit(1)).alias("_k"))
    n_regions = regions.agg(F.count(F.lit(1)).alias("_r"))
    v = votes.crossJoin(F.broadcast(n_items)).crossJoin(F.broadcast(n_regions)).select(
        F.col("event_id").alias("vote_id"),
        (F.col("user_id") % F.col("_k") + 1).alias("skin_id"),
        F.col("ts").alias("voted_at"),
        (F.col("user_id") % F.col("_r")).cast("long").alias("region_id"),
        F.when(F.col("event_id") % 3 == 0, F.lit("mobile")).when(F.col("event_id") % 3 == 1, F.lit("pc"))
        .otherwise(F.lit("console")).alias("device_type"),
        F.col("user_id"))
    premium = events.where(F.col("event_type") == "purchase").select("user_id").distinct() \
        .withColumn("is_premium_player", F.lit(True))
    j = join_dimension(v, items.select("skin_id", "skin_name"), "skin_id", "inner")
    j = join_dimension(j, regions.select("region_id", F.col("region_name").alias("charity_voted")),
                       "region_id", "left", bounded=True)
    j = j.join(premium, "user_id", "left")
    return j.select("vote_id", "skin_name", "voted_at", "charity_voted", "device_type",
                    F.coalesce(F.col("is_premium_player"), F.lit(False)).alias("is_premium_player"))


def donations_view(events: DataFrame, regions: DataFrame) -> DataFrame:
    """Donations: every ``purchase`` event gives its value to the
    charity of the user's region (our derivation, as above)."""
    n_regions = regions.agg(F.count(F.lit(1)).alias("_r"))
    p = events.where(F.col("event_type") == "purchase").crossJoin(F.broadcast(n_regions)).select(
        (F.col("user_id") % F.col("_r")).cast("long").alias("region_id"), F.col("value").alias("amount_vp"))
    j = join_dimension(p, regions.select("region_id", F.col("region_name").alias("beneficiary")),
                       "region_id", "left", bounded=True)
    return j.select("beneficiary", "amount_vp")


def duplicate_transactions(fact: DataFrame) -> DataFrame:
    """Same user, item and day bought more than once."""
    return (fact.groupBy("user_id", "skin_id", "purchase_date").agg(F.count(F.lit(1)).alias("occurrences"))
            .where(F.col("occurrences") > 1))


def anomalous_amounts(fact: DataFrame, lo: float = 0.0, hi: float = 100_000.0) -> DataFrame:
    """Transactions whose amount is outside [lo, hi] or NULL."""
    a = F.col("final_price_vp")
    return fact.where(a.isNull() | (a < lo) | (a > hi))


def orphan_transactions(fact: DataFrame, users: DataFrame) -> DataFrame:
    """Transactions whose user is not in the user dimension."""
    return orphans(fact, users, "user_id")

"""Item-to-item recommendation on the long (item, user, value) form."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brambling.operators.aggregate import pivot_mean
from brambling.session import settle


def item_user(transactions: DataFrame) -> DataFrame:
    """One value per (item, user)."""
    return pivot_mean(transactions, "item", "user", "quantity", "q")


def shared_users(transactions: DataFrame, item: int) -> DataFrame:
    """Users and dot product each item shares with one item: the chosen item's rows meet the
    matrix on the user, so the work is linear in the matrix and no pair list is built."""
    m = item_user(transactions)
    seed = m.filter(F.col("item") == item).select("user", F.col("q").alias("q0"))
    return (m.join(seed, "user").groupBy(F.col("item").alias("other"))
            .agg(F.count(F.lit(1)).alias("users"), F.sum(F.col("q") * F.col("q0")).alias("dot")))


def item_norms(m: DataFrame) -> DataFrame:
    return m.groupBy("item").agg(F.sqrt(F.sum(F.col("q") * F.col("q"))).alias("norm"))


def similar_to(transactions: DataFrame, seeds: DataFrame) -> DataFrame:
    """Cosine of every seed item with every item it shares a user with: (seed, item, users, similarity).

    ``seeds(seed)`` is a short list of items.  Items without a common user have similarity 0 and
    are not listed.
    """
    m = settle(item_user(transactions))
    seed_rows = m.join(seeds, F.col("item") == F.col("seed")).select("seed", "user", F.col("q").alias("q0"))
    dots = (m.join(seed_rows, "user").groupBy("seed", "item")
            .agg(F.count(F.lit(1)).alias("users"), F.sum(F.col("q") * F.col("q0")).alias("dot")))
    norms = item_norms(m)
    return (dots.join(norms, "item").join(norms.select(F.col("item").alias("seed"), F.col("norm").alias("norm0")), "seed")
            .select("seed", "item", "users", (F.col("dot") / (F.col("norm") * F.col("norm0"))).alias("similarity")))


def item_similarity(transactions: DataFrame, item: int, items: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` items most like one item (itself included) with their attributes."""
    seeds = transactions.sparkSession.createDataFrame([(item,)], "seed bigint")
    near = similar_to(transactions, seeds).orderBy(F.desc(F.round("similarity", 9)), "item").limit(k)
    return near.join(items, "item", "left").orderBy(F.desc(F.round("similarity", 9)), "item")


def recommend(transactions: DataFrame, user: int, k: int = 10) -> DataFrame:
    """Items the user does not own by their summed similarity to the owned ones.

    The sum over owned items is taken inside each user first (what a user holds of the owned
    items, each divided by its norm), so one number per user meets the matrix and no pair of
    items is ever formed.
    """
    m = settle(item_user(transactions))
    norms = item_norms(m)
    owned = transactions.filter(F.col("user") == user).select("item").distinct()
    weight = (m.join(owned, "item").join(norms, "item").groupBy("user")
              .agg(F.sum(F.col("q") / F.col("norm")).alias("w")))
    score = m.join(weight, "user").groupBy("item").agg(F.sum(F.col("q") * F.col("w")).alias("_s"))
    fresh = (score.join(norms, "item").select("item", (F.col("_s") / F.col("norm")).alias("score"))
             .join(owned, "item", "left_anti"))
    return fresh.orderBy(F.desc(F.round("score", 9)), "item").limit(k)


def jaccard_to(transactions: DataFrame, seeds: DataFrame) -> DataFrame:
    """Users in common over users of either, for each seed and the items it shares a user with."""
    pairs = settle(transactions.select("item", "user").distinct())
    sizes = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    seed_rows = pairs.join(seeds, F.col("item") == F.col("seed")).select("seed", "user")
    common = pairs.join(seed_rows, "user").groupBy("seed", "item").agg(F.count(F.lit(1)).alias("common"))
    return (common.join(sizes, "item").join(sizes.select(F.col("item").alias("seed"), F.col("n").alias("n0")), "seed")
            .select("seed", "item", "common", (F.col("common") / (F.col("n") + F.col("n0") - F.col("common"))).alias("jaccard")))

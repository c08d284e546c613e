"""Rating clean-up, entity sets and per-entity statistics (DST*, AGG2-9, IDX*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.functions.encoding import numbered
from likeness.session import materialize


def dedupe_ratings(
    ratings: DataFrame,
    user_col: str = "user_id",
    item_col: str = "item_id",
    rating_col: str = "rating",
    order_col: str | Column | None = None,
) -> DataFrame:
    """One rating per (user, item): the last one by ``order_col`` wins (DST4).

    Files carry no order Spark can rely on, so "last" must be an explicit
    column (file position, timestamp, ...).  Ties on the order fall to the
    larger rating.  ``max_by`` aggregates partially on the map side, so a
    heavily repeated key costs one row per task, not one group in one task.
    """
    if order_col is None:
        raise ValueError("order_col says which rating is the last; rows of a file have no order of their own")
    oc = F.col(order_col) if isinstance(order_col, str) else order_col
    order = F.struct(oc, F.col(rating_col))
    return ratings.groupBy(user_col, item_col).agg(
        F.max_by(F.col(rating_col), order).alias(rating_col)
    )


def distinct_users(ratings: DataFrame, user_col: str = "user_id") -> DataFrame:
    """DST1."""
    return ratings.select(user_col).distinct()


def distinct_items(ratings: DataFrame, item_col: str = "item_id") -> DataFrame:
    """DST2."""
    return ratings.select(item_col).distinct()


def entity_means(
    ratings: DataFrame, key_col: str, rating_col: str = "rating", prefix: str = ""
) -> DataFrame:
    """(key, mean, count) per user or item over de-duplicated ratings (AGG7-9)."""
    return ratings.groupBy(key_col).agg(
        F.avg(rating_col).alias(f"{prefix}mean"), F.count(F.lit(1)).alias(f"{prefix}n")
    )


def baskets(sets: DataFrame, id_col: str = "id", element_col: str = "element") -> DataFrame:
    """Per id: row count, distinct-element count and the smallest / largest
    element (AGG2-4, SNK3).  The basket itself stays in long form; it is never
    gathered into one array, so a basket holding a third of all rows still
    aggregates partially across tasks."""
    return sets.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(element_col).alias("n_elements"),
        F.min(element_col).alias("first_element"),
        F.max(element_col).alias("last_element"),
    )


def basket_members(sets: DataFrame, id_col: str = "id", element_col: str = "element") -> DataFrame:
    """The members themselves, long form: (id, element, n_rows) with repeats counted (SNK3)."""
    return sets.groupBy(id_col, element_col).agg(F.count(F.lit(1)).alias("n_rows"))


def dense_ids(df: DataFrame, col: str, idx_col: str = "idx", partitions: int | None = None) -> DataFrame:
    """Sorted distinct values of ``col`` numbered 0..n-1 (IDX1), see ``encoding.numbered``."""
    values = materialize(df.select(col).distinct())
    return numbered(values, [F.col(col)], idx_col, partitions=partitions).select(col, idx_col)

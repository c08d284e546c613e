"""Inputs built from the driver's parquet tables (fixtures F-* of FIXTURES.md).

Each builder reads only the columns it needs (Catalyst prunes the parquet scan)
and returns long-form rows; nothing here aggregates into arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id = user_id, element = day), one row an event."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.to_date("ts").alias("element"))


def day_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-DAY: (id = user_id, element = day of an event), distinct."""
    return event_days(spark, sf_dir).distinct()


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text), dealt by id: a table of one file or row group is then read by
    one task, but its texts are cut by all, and what is told by id of their words
    (distinct ones, minima) needs no exchange of the many times larger words."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf_dir, "documents").select("doc_id", "text").repartition(n, "doc_id")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id = doc_id, element = word of lower(text) split on ' ') at every place
    of every whole text."""
    docs = texts(spark, sf_dir)
    return docs.select(F.col("doc_id").alias("id"), F.explode(F.split(F.lower("text"), " ")).alias("element"))


def word_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-DOC: the distinct words of every document."""
    return words(spark, sf_dir).distinct()


def shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id = doc_id, element = three consecutive words of lower(text) split on ' ')
    at every place of every whole text; texts of fewer words have none."""
    words = texts(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.split(F.lower("text"), " ").alias("_w")
    )
    places = ", ".join(f"slice(_w, {i}, size(_w) - 2)" for i in (1, 2, 3))
    runs = words.where(F.size("_w") >= 3).select("id", F.expr(f"inline(arrays_zip({places}))").alias("_1", "_2", "_3"))
    return runs.select("id", F.concat_ws(" ", "_1", "_2", "_3").alias("element"))


def shingle_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-SHG: the distinct shingles of every document."""
    return shingles(spark, sf_dir).distinct()


def shingle_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-SHV: (id, element = shingle, value = its count), sparse vectors."""
    return shingles(spark, sf_dir).groupBy("id", "element").agg(F.count(F.lit(1)).cast("double").alias("value"))


def nation_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-NAT: (id = l_partkey, element = nation of a customer who ordered it), distinct."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .join(cu, od.o_custkey == cu.c_custkey)
        .select(F.col("l_partkey").alias("id"), F.col("c_nationkey").alias("element"))
        .distinct()
    )


def event_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-EVT: (id = user_id, element = props.k, value = number of events)."""
    ev = table(spark, sf_dir, "events")
    return (
        ev.select(F.col("user_id").alias("id"), F.get_json_object("props", "$.k").alias("element"))
        .groupBy("id", "element")
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
    )


def raw_cf_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-CF raw rows: one per lineitem; user = o_custkey, item = l_partkey,
    rating = ceil(l_quantity / 10), plus the columns that order duplicates."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
        "l_orderkey",
        "l_linenumber",
    )


def cf_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-CF: one rating per (user, item): ceil(max(l_quantity) / 10)."""
    from likeness.operators.dedupe import dedupe_ratings

    return dedupe_ratings(raw_cf_ratings(spark, sf_dir), order_col="rating")


def _is_test(user: str = "user_id", item: str = "item_id"):
    return F.pmod(F.col(user) * 7 + F.col(item) * 13, F.lit(20)) == 0


def _is_cold(user: str = "user_id", item: str = "item_id"):
    return (F.pmod(F.col(user), F.lit(50)) == 0) | (F.pmod(F.col(item), F.lit(50)) == 0)


def cf_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Deterministic train / test partition of F-CF.

    1 in 20 (user, item) cells is held out for testing, and all ratings of
    every 50th user and item, so that the test side has cold users and cold
    items.  Train and test together are all ratings, which are made once and
    written: both sides are read several times by every query.
    """
    from likeness.session import materialize

    r = materialize(cf_ratings(spark, sf_dir))
    test = r.where(_is_test() | _is_cold()).select("user_id", "item_id", "rating")
    train = r.where(~_is_test() & ~_is_cold()).select("user_id", "item_id", "rating")
    return train, test

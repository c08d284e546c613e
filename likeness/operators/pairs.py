"""Pairs within groups and equi-joins, with hot keys split on both sides.

A plain join on a key sends every row of a key to one task and makes that task
emit all its pairs.  Here the sizes of the keys are counted (each task sends one
row a key, whatever its rows), and only keys above ``block`` rows are treated
differently: their rows are cut into blocks by a hash, and a pair of blocks is
one join key, so that the pairs spread over many tasks of at most ``block``^2
pairs each.  A row is copied to the block pairs it takes part in -- for ordinary
keys that is exactly one copy and the plan is a plain equi-join.  Without any
hot key the blocks are not even columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.session import materialize

DEFAULT_BLOCK = 1024
SALTS = 16

Keep = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def key_sizes(rows: DataFrame, keys: list[str], name: str = "_n") -> DataFrame:
    """(keys..., name); counted where the rows are first, so that a task sends one row a key."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def attach(rows: DataFrame, small: DataFrame, keys: list[str], salts: int = SALTS) -> DataFrame:
    """``rows`` left-joined with ``small`` (one row a key), a key's rows spread over ``salts`` tasks."""
    dealt = rows.withColumn("_s", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copied = small.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copied, [*keys, "_s"], "left").drop("_s")


def grid_join(left: DataFrame, right: DataFrame, keys: list[str], block: int = DEFAULT_BLOCK) -> DataFrame:
    """Inner equi-join; keys with more than ``block`` rows on a side become a grid
    of blocks of both sides, all others stay a plain join."""
    sizes = key_sizes(left, keys, "_nl").join(key_sizes(right, keys, "_nr"), keys)
    hot = materialize(sizes.where((F.col("_nl") > block) | (F.col("_nr") > block)).select(
        *keys, F.ceil(F.col("_nl") / block).cast("int").alias("_bl"), F.ceil(F.col("_nr") / block).cast("int").alias("_br")))
    if hot.isEmpty():
        return left.join(right, keys)

    def cut(rows: DataFrame, mine: str, other: str, own: str, to: str) -> DataFrame:
        return (
            attach(rows, hot, keys)
            .withColumn(own, F.pmod(F.xxhash64(*rows.columns), F.coalesce(mine, F.lit(1)).cast("long")).cast("int"))
            .withColumn(to, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))).drop("_bl", "_br")
        )

    return cut(left, "_bl", "_br", "_bi", "_bj").join(cut(right, "_br", "_bl", "_bj", "_bi"), [*keys, "_bi", "_bj"]).drop("_bi", "_bj")


def group_pairs(
    members: DataFrame,
    group_cols: list[str],
    id_col: str = "id",
    block: int = DEFAULT_BLOCK,
    min_size: int = 2,
    keep: Keep | None = None,
) -> DataFrame:
    """(group cols..., id_1, id_2) with id_1 < id_2 for every pair in a group.

    ``members`` must be distinct on (group cols, id).  Groups smaller than
    ``min_size`` make no pairs (FLT1).  ``keep`` is a condition on a pair: it
    gets two functions that give the columns of the members, and is evaluated in
    the join itself, so that a pair it refuses is never a row.
    """
    if min_size > 2:
        wanted = key_sizes(members.select(*group_cols, id_col), group_cols).where(F.col("_n") >= min_size)
        members = attach(members, wanted, group_cols).where(F.col("_n").isNotNull()).drop("_n")
    rest = [c for c in members.columns if c not in group_cols and c != id_col]
    hot = materialize(key_sizes(members.select(*group_cols, id_col), group_cols).where(F.col("_n") > block))
    keys = list(group_cols)
    if hot.isEmpty():
        left = right = members
    else:
        m = attach(members, hot, group_cols).withColumn("_nb", F.coalesce(F.ceil(F.col("_n") / F.lit(block)), F.lit(1)).cast("int")).withColumn(
            "_blk", F.pmod(F.xxhash64(F.col(id_col)), F.col("_nb").cast("long")).cast("int"))
        keys += ["_bi", "_bj"]
        # left copy: own block as bi, paired with every bj >= bi; right copy: own block as bj
        left = m.withColumn("_bi", F.col("_blk")).withColumn("_bj", F.explode(F.sequence(F.col("_blk"), F.col("_nb") - 1)))
        right = m.withColumn("_bj", F.col("_blk")).withColumn("_bi", F.explode(F.sequence(F.lit(0), F.col("_blk"))))
    left = left.select(*keys, F.col(id_col).alias("id_1"), *[F.col(c).alias(f"{c}_1") for c in rest])
    right = right.select(*keys, F.col(id_col).alias("id_2"), *[F.col(c).alias(f"{c}_2") for c in rest])
    # within one block both orders meet, across blocks only (bi, bj) with bi < bj:
    # keep id_1 < id_2 in the first case, canonicalise in the second.
    once = F.col("id_1") < F.col("id_2")
    if not hot.isEmpty():
        once = (F.col("_bi") < F.col("_bj")) | once
    if keep is not None:
        once = once & keep(lambda c: F.col(f"{c}_1"), lambda c: F.col(f"{c}_2"))
    return left.join(right, keys).where(once).select(
        *group_cols,
        F.least("id_1", "id_2").alias("id_1"),
        F.greatest("id_1", "id_2").alias("id_2"),
    )

"""Exact integer codes for arbitrary element values, most frequent first.

Joins on bigint keys are about twice as fast as on strings, but a hash is not
exact.  ``element_codes`` numbers the distinct values 0..V-1 by falling frequency
(ties by value), so that popular values get small codes: sorted by falling code
a set has its rarest elements first, and the codes of common elements lie close
together, many in one word of a bitmap.

The numbering itself (``numbered``) has no bound on the rows and no window over
all of them: rows are range-partitioned into as many ranges as the data needs,
numbered inside their range, and shifted by prefix sums over the range sizes,
which are themselves summed level by level, so that no window holds more rows
than a range or ``fan`` sizes.  What is broadcast are the offsets, one number
for ``bound`` rows, and only while they are few; beyond that they are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from likeness.session import materialize

RANGE_ROWS = 1 << 20
FAN = 1 << 12
HEAVY_SHARE = 1024

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integral(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, _INTEGRAL)


def prefix_sums(sizes: DataFrame, key: str, size: str, n: int, fan: int = FAN) -> DataFrame:
    """(key, offset): the sum of ``size`` over all smaller keys 0..n-1.

    Level by level: windows run over ``fan`` keys at most, and the sums of these
    runs are summed the same way."""
    before = Window.partitionBy("_g").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.withColumn("_g", F.expr(f"{key} div {fan}")).withColumn(
        "_in", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long"))
    if n <= fan:
        return inner.select(key, F.col("_in").alias("offset"))
    runs = sizes.groupBy(F.expr(f"{key} div {fan}").alias("_g")).agg(F.sum(size).cast("long").alias("_s"))
    outer = prefix_sums(runs.select(F.col("_g").alias("_k"), "_s"), "_k", "_s", -(-n // fan), fan)
    return inner.join(outer.select(F.col("_k").alias("_g"), F.col("offset").alias("_out")), "_g").select(
        key, (F.col("_in") + F.col("_out")).alias("offset"))


def numbered(rows: DataFrame, order: list[Column], name: str, bound: int = RANGE_ROWS, fan: int = FAN,
             partitions: int | None = None) -> DataFrame:
    """``rows`` with a bigint ``name`` 0..n-1 in the given order (which must be total).

    ``rows`` should be written already: it is counted, sampled and read.  The
    ranges are written once, since their bounds are sampled anew whenever the
    exchange runs."""
    spark = rows.sparkSession
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // bound))
    ranged = materialize(rows.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = prefix_sums(sizes, "_p", "_n", n, fan)
    if n <= FAN:
        offsets = F.broadcast(offsets)  # at most FAN rows
    inside = ranged.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    return inside.join(offsets, "_p").withColumn(name, (F.col("offset") + F.col("_r") - 1).cast("long")).drop("_p", "_r", "offset")


def element_codes(values: DataFrame, col: str, code_col: str = "code", bound: int = RANGE_ROWS) -> DataFrame:
    """(col, code, freq) for every distinct value of ``col``, written; codes are
    0..V-1, the most frequent value first."""
    freq = materialize(values.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("freq")))
    return materialize(numbered(freq, [F.col("freq").desc(), F.col(col)], code_col, bound).select(col, code_col, "freq"))


def join_codes(df: DataFrame, codes: DataFrame, col: str, code_col: str = "code") -> DataFrame:
    """``df`` with the code of ``col``; rows without a value go.

    Values that hold at least one row in HEAVY_SHARE are at most HEAVY_SHARE
    values, whatever the data: these are broadcast, so that no popular value is
    a join key that gathers its rows.  All others are joined."""
    total = codes.agg(F.sum("freq")).first()[0] or 0
    heavy = F.col("freq") * HEAVY_SHARE >= F.lit(total)
    tagged = df.join(F.broadcast(codes.where(heavy).select(col, code_col)), col, "left")
    light = tagged.where(F.col(code_col).isNull()).drop(code_col).join(codes.where(~heavy).select(col, code_col), col)
    return tagged.where(F.col(code_col).isNotNull()).unionByName(light)


def with_codes(df: DataFrame, col: str, code_col: str = "code") -> DataFrame:
    """``df`` plus a bigint ``code_col`` for ``col``: the value itself when it is
    already integral, else its dictionary code.  Rows without a value go, whatever the type."""
    if is_integral(df, col):
        return df.where(F.col(col).isNotNull()).withColumn(code_col, F.col(col).cast("long"))
    return join_codes(df, element_codes(df, col, code_col), col, code_col)

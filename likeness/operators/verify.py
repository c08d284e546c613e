"""Exact similarity of given pairs, computed in long form (SIM3, SIM6, JN3-4).

The pair list drives the work: each pair is joined to the rows of its smaller
side and probed against the other, so the cost is the sum of the smaller sizes
over the pairs -- never the all-pairs co-occurrence of a popular element.  Sets
are compared as bitmaps (``bitmaps``), vectors element by element; neither is
ever gathered into an array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.functions.encoding import with_codes
from likeness.operators.bitmaps import COMMON, intersections, profiles, set_words, sift
from likeness.session import materialize as _materialize


def spread(pairs: DataFrame) -> DataFrame:
    """Hash the pair list over ``spark.sql.shuffle.partitions`` partitions.

    Verification does far more work per pair than moving the pair costs, and
    when the joins that follow are broadcasts (small sides) nothing else
    would redistribute it: a pair list read back as one file stays one task.
    An explicit partition count keeps AQE from coalescing the tiny pair rows
    back into a few partitions.
    """
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(n, "id_1", "id_2")


def co_occurrences(
    pairs: DataFrame, long_df: DataFrame, id_col: str, element_col: str, value_cols: list[str],
    sizes: DataFrame | None = None, ordered: bool = False,
) -> DataFrame:
    """(id_1, id_2, _e, <v>_a, <v>_b) for every element both ids of a pair hold.

    The id with fewer rows drives: the pair is expanded by that id's elements
    and each is probed against (other id, element).  The work is therefore
    Σ min(n1, n2) over the pairs, so a hot id holding a third of all rows
    costs only its partners' sizes.  ``_a`` / ``_b`` are the driving / probed
    sides -- callers aggregate symmetric expressions of them, unless ``ordered``
    gives ``_a`` to id_1 and ``_b`` to id_2.
    """
    if sizes is None:
        sizes = long_df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n"))
    n1 = sizes.select(F.col(id_col).alias("id_1"), F.col("n").alias("_s1"))
    n2 = sizes.select(F.col(id_col).alias("id_2"), F.col("n").alias("_s2"))
    first_drives = F.col("_s1") <= F.col("_s2")
    oriented = spread(pairs.select("id_1", "id_2")).join(n1, "id_1").join(n2, "id_2").select(
        "id_1", "id_2",
        F.when(first_drives, F.col("id_1")).otherwise(F.col("id_2")).alias("_drive"),
        F.when(first_drives, F.col("id_2")).otherwise(F.col("id_1")).alias("_probe"),
    )
    a = long_df.select(
        F.col(id_col).alias("_drive"), F.col(element_col).alias("_e"), *[F.col(c).alias(f"{c}_a") for c in value_cols]
    )
    b = long_df.select(
        F.col(id_col).alias("_probe"), F.col(element_col).alias("_e"), *[F.col(c).alias(f"{c}_b") for c in value_cols]
    )
    both = oriented.join(a, "_drive").join(b, ["_probe", "_e"])
    if not ordered:
        return both.drop("_drive", "_probe")
    mine = F.col("_drive") == F.col("id_1")
    sides = [(F.col(f"{c}_a"), F.col(f"{c}_b"), c) for c in value_cols]
    return both.select("id_1", "id_2", "_e", *[F.when(mine, a_).otherwise(b_).alias(f"{c}_a") for a_, b_, c in sides],
                       *[F.when(mine, b_).otherwise(a_).alias(f"{c}_b") for a_, b_, c in sides])


LIST_ROWS = 1024  # an element's rows that are one list at most
HOT_ID = 1 << 16  # rows of an id from which its lists are dealt to several tasks
TASK_MEETINGS = 1 << 20


def co_sums(pairs: DataFrame, long_df: DataFrame, id_col: str, element_col: str, value_col: str, list_rows: int | None = None) -> DataFrame:
    """(id_1, id_2, _num, _s1, _s2): sums of a*b, a*a and b*b over the elements
    that both ids hold, for the distinct given pairs (id_1 <= id_2); NULL, or no
    row, for a pair that shares none.

    ``co_occurrences`` moves a row for every element of a pair's smaller id,
    shared or not.  Here an element of few rows becomes one list of (id, value),
    and a list goes once to each of its ids, to the task where the pairs of that
    id are: two holders of an element move as an entry of a list, and are summed
    where they meet; sums of no given pair go.  Tasks are as many as their
    meetings need, so that these sums stay in memory.
    Elements of more rows than a pair-driven row is worth (by the mean number of
    pairs of an id, at most ``LIST_ROWS``; or ``list_rows``) go the way of
    ``co_occurrences``.  Lists of a hot id are dealt to several tasks by partner.
    """
    pairs = _materialize(pairs.select("id_1", "id_2").where("id_1 <= id_2").distinct())
    rows = _materialize(long_df.select(F.col(id_col).alias("_k"), F.col(element_col).alias("_e"), F.col(value_col).alias("_d")).where(
        F.col("_k").isNotNull() & F.col("_e").isNotNull()))
    ids = rows.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    if list_rows is None:
        # bytes: a row of the pair-driven way is six times an entry of a list, which half of the holders get
        list_rows = max(1, min(LIST_ROWS, 6 * pairs.count() // max(1, ids.count())))
    holders = _materialize(rows.groupBy("_e").agg(F.count(F.lit(1)).alias("_h")))
    meetings, many = holders.agg(
        F.sum(F.when(F.col("_h") <= list_rows, F.col("_h") * F.col("_h"))), F.max(F.col("_h")) > list_rows).first()
    out = []
    if meetings:
        common = holders.where(F.col("_h") > list_rows).select("_e")
        some = rows.join(common, "_e", "left_anti") if many else rows
        # ids that fit travel as ints, ids and values as arrays of their own: entries are most of what is moved
        key = rows.schema["_k"].dataType.simpleString()
        low, high = some.agg(F.min("_k"), F.max("_k")).first() if key == "bigint" else (None, None)
        small = "int" if low is not None and -(1 << 31) <= low and high < 1 << 31 else key
        lists = some.groupBy("_e").agg(F.sort_array(F.collect_list(F.struct("_k", "_d"))).alias("_l")).select(
            F.col("_l._k").cast(f"array<{small}>").alias("_ks"), F.col("_l._d").alias("_ds"))
        after = "slice({0}, cast(array_position(_ks, _k) as int), size({0}))"
        sent = lists.select("_ks", "_ds", F.posexplode("_ks").alias("_i", "_k")).select(
            F.col("_k").cast(key).alias("id_1"), F.expr("_ds[_i]").alias("_d_a"),
            F.expr(after.format("_ks")).alias("_ks"), F.expr(after.format("_ds")).alias("_ds"))
        hot = _materialize(ids.where(F.col("_n") > HOT_ID).select(F.col("_k").alias("id_1"), F.ceil(F.col("_n") / HOT_ID).cast("int").alias("_p")))
        parts = F.coalesce("_p", F.lit(1))
        wait, at = pairs, ["id_1"]
        if not hot.isEmpty():
            at = ["id_1", "_s"]
            wait = pairs.join(F.broadcast(hot), "id_1", "left").withColumn("_s", F.pmod(F.xxhash64("id_2"), parts).cast("int"))
            mine = F.expr(f"filter(arrays_zip(_ks, _ds), x -> pmod(xxhash64(cast(x._ks as {key})), coalesce(_p, 1)) = _s)")
            sent = sent.join(F.broadcast(hot), "id_1", "left").withColumn("_s", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn(
                "_z", mine).select("id_1", "_s", "_d_a", F.col("_z._ks").alias("_ks"), F.col("_z._ds").alias("_ds"))
        n = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-meetings // (2 * TASK_MEETINGS)))
        both = sent.select(*at, "_d_a", "_ks", "_ds").unionByName(wait.select(*at, "id_2"), allowMissingColumns=True).repartition(n, *at)
        given = F.col("id_2").isNotNull()
        one = F.array(F.struct(F.col("id_2").cast(small).alias("_ks"), F.lit(None).cast(rows.schema["_d"].dataType).alias("_ds")))
        met = both.select(*at, given.alias("_given"), "_d_a", F.explode(F.when(given, one).otherwise(F.arrays_zip("_ks", "_ds"))).alias("_b")).select(
            *at, "_given", F.col("_b._ks").cast(key).alias("id_2"), "_d_a", F.col("_b._ds").alias("_d_b"))
        out.append(met.groupBy(*at, "id_2"))
    if many:
        common = rows.join(holders.where(F.col("_h") > list_rows).select("_e"), "_e", "left_semi")
        out.append(co_occurrences(pairs, common, "_k", "_e", ["_d"], ordered=True).withColumn("_given", F.lit(True)).groupBy("id_1", "id_2"))
    sums = [
        g.agg(F.sum(F.col("_d_a") * F.col("_d_b")).alias("_num"), F.sum(F.col("_d_a") * F.col("_d_a")).alias("_s1"),
              F.sum(F.col("_d_b") * F.col("_d_b")).alias("_s2"), F.max("_given").alias("_given"))
        .where("_given").select("id_1", "id_2", "_num", "_s1", "_s2") for g in out]
    if not sums:
        return pairs.select("id_1", "id_2", *[F.lit(None).cast("double").alias(c) for c in ("_num", "_s1", "_s2")])
    if len(sums) == 1:
        return sums[0]
    return sums[0].unionByName(sums[1]).groupBy("id_1", "id_2").agg(*[F.sum(c).alias(c) for c in ("_num", "_s1", "_s2")])


def only(sets: DataFrame, pairs: DataFrame, id_col: str = "id") -> DataFrame:
    """The rows of ``sets`` whose id is in one of the pairs."""
    ids = pairs.select(F.col("id_1").alias(id_col)).union(pairs.select("id_2")).distinct()
    return sets.join(ids, id_col, "left_semi")


def jaccard_of(
    pairs: DataFrame, sets: DataFrame, id_col: str = "id", element_col: str = "element",
    min_similarity: float | None = None,
) -> DataFrame:
    """(id_1, id_2, similarity) = |A∩B| / |A∪B| for each given pair.

    ``sets`` may hold rows more than once.  Pairs without a common element get
    similarity 0.  With ``min_similarity`` only pairs reaching it are returned,
    and sizes and parity sketches drop hopeless pairs before any element is
    encoded or compared.  Only the sets of ids that are in a pair are read on,
    and only those of pairs that are left get codes and bitmaps.
    """
    pairs = _materialize(pairs.select("id_1", "id_2"))
    rows = sets.select(id_col, element_col).where(F.col(element_col).isNotNull())
    rows = _materialize(only(rows, pairs, id_col).distinct())
    prof = profiles(rows, f"xxhash64({element_col})", id_col)
    if min_similarity is not None:
        pairs = _materialize(sift(pairs, prof, min_similarity, id_col))
        rows = only(rows, pairs, id_col)
    else:
        pairs = pairs.join(prof.select(F.col(id_col).alias("id_1"), F.col("n").alias("n_1")), "id_1").join(
            prof.select(F.col(id_col).alias("id_2"), F.col("n").alias("n_2")), "id_2")
    words = _materialize(set_words(with_codes(rows, element_col, "_code"), id_col, "_code"))
    return similar(spread(pairs), words, id_col, min_similarity)


def similar(pairs: DataFrame, words: DataFrame, id_col: str, min_similarity: float | None, common: str = COMMON) -> DataFrame:
    """Similarities of pairs (id_1, id_2, n_1, n_2) from the bitmaps of their sets."""
    common = intersections(pairs, words, id_col, common)
    n = F.col("n_1") + F.col("n_2")
    if min_similarity is None:
        out = pairs.join(common, ["id_1", "id_2"], "left").withColumn("common", F.coalesce("common", F.lit(0)))
    else:  # a threshold is above 0, so a pair without a common element goes
        out = pairs.join(common, ["id_1", "id_2"])
    out = out.select("id_1", "id_2", (F.col("common") / (n - F.col("common"))).alias("similarity"))
    return out if min_similarity is None else out.where(F.col("similarity") >= min_similarity)


def vector_norms(vectors: DataFrame, id_col: str = "id", value_col: str = "value") -> DataFrame:
    """Squared L2 norm of the whole vector, once per id (AGG11)."""
    return vectors.groupBy(id_col).agg(F.sum(F.col(value_col) * F.col(value_col)).alias("nsq"))


def cosine_of(
    pairs: DataFrame, vectors: DataFrame, id_col: str = "id", element_col: str = "element",
    value_col: str = "value", norms: DataFrame | None = None,
) -> DataFrame:
    """(id_1, id_2, similarity) = dot / (sqrt(|a|²) * sqrt(|b|²)) over the full
    vectors (not centred).  A zero vector gives NULL (the pair is undefined).
    ``vectors`` must hold one value per (id, element)."""
    if norms is None:
        norms = vector_norms(vectors, id_col, value_col)
    dot = co_occurrences(pairs, vectors, id_col, element_col, [value_col]).groupBy("id_1", "id_2").agg(
        F.sum(F.col(f"{value_col}_a") * F.col(f"{value_col}_b")).alias("_dot")
    )
    n1 = norms.select(F.col(id_col).alias("id_1"), F.col("nsq").alias("_n1"))
    n2 = norms.select(F.col(id_col).alias("id_2"), F.col("nsq").alias("_n2"))
    out = (
        pairs.select("id_1", "id_2")
        .join(dot, ["id_1", "id_2"], "left")
        .join(n1, "id_1")
        .join(n2, "id_2")
    )
    den = F.sqrt("_n1") * F.sqrt("_n2")
    return out.select(
        "id_1", "id_2",
        F.when(den == 0, F.lit(None).cast("double"))
        .otherwise(F.coalesce("_dot", F.lit(0.0)) / den)
        .alias("similarity"),
    )

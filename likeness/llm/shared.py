"""Helpers that the training-data operators share: written intermediates,
bounded membership bitmaps, salted joins and connected components."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()
#: Bits of a membership bitmap; 2^23 bits are 1 MB, so the broadcast below has a fixed bound.
BITMAP_BITS = 1 << 23
_BUCKET_BITS = 32768  # of Spark's bitmap functions


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; one of our own only for a
    local master, where driver and executors are one process."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = _LOCAL.setdefault(sc.applicationId, "")
        if not path:
            path = _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="likeness-llm-")
    return path.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    Cuts the lineage, so a lost executor costs a re-read, and lets Spark drop
    the shuffle files behind it: the collector only removes those of plans
    that the driver no longer holds, hence the explicit collection.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(t.shared_path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for an application."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        to = os.path.join(tempfile.mkdtemp(prefix="likeness-py-"), "likeness_package")
        sc.addPyFile(shutil.make_archive(to, "zip", top, "likeness"))
        _SHIPPED.add(sc.applicationId)


def tidy(run):
    """``run`` of a mapInArrow that gives freed memory back to the system when
    its task ends: Python workers serve one stage after another, and what one
    of them freed but kept counts against the executor in the next."""

    def run_and_tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):  # glibc only
            libc.malloc_trim(0)

    return run_and_tidy


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(name: str, *tables: DataFrame) -> str:
    """``name``, lengthened until none of the tables has such a column."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def maybe_in(df: DataFrame, column: str, wanted: DataFrame, bits: int = BITMAP_BITS, flag: str = "_maybe") -> DataFrame:
    """``df`` with a boolean ``flag``: false only where ``column`` is surely not
    among the values of ``wanted`` (one column).

    A hashed bitmap of ``bits`` bits, so what is broadcast never exceeds
    bits / 8 bytes however many values there are; at more values than bits it
    merely stops ruling rows out.  Callers join exactly afterwards.
    """
    name = wanted.columns[0]
    p, b, words = (fresh(x, df) for x in ("_p", "_b", "_bits"))

    def pos(c):
        return F.pmod(F.xxhash64(c), F.lit(bits))

    maps = (
        wanted.select(pos(F.col(name)).alias(p))
        .groupBy(F.expr(f"int({p} div {_BUCKET_BITS})").alias(b))
        .agg(F.expr(f"bitmap_construct_agg({p} % {_BUCKET_BITS})").alias(words))
    )
    bit = F.expr(
        f"{words} is not null and shiftright(conv(hex(substring({words}, int(({p} % 32768) div 8) + 1, 1)), 16, 10)::int,"
        f" int({p} % 8)) & 1 = 1"
    )
    return (
        df.withColumn(p, pos(F.col(column)))
        .withColumn(b, F.expr(f"int({p} div {_BUCKET_BITS})"))
        .join(F.broadcast(maps), b, "left")
        .withColumn(flag, bit)
        .drop(p, b, words)
    )


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key (the columns of ``dropped``) is not in
    ``dropped``.  Only rows that a 1 MB bitmap cannot rule out are shuffled."""
    keys = dropped.columns
    if dropped.isEmpty():
        return docs
    key, flag = fresh("_key", docs), fresh("_maybe", docs)
    marked = maybe_in(docs.withColumn(key, F.xxhash64(*keys)), key, dropped.select(F.xxhash64(*keys).alias(key)), flag=flag)
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    rest = marked.where(F.col(flag)).alias("l").join(dropped.distinct().alias("r"), same, "left_anti")
    return marked.where(~F.col(flag)).unionByName(rest).drop(key, flag)


def salted_join(big: DataFrame, small: DataFrame, keys: list[str] | str, how: str = "left", salt: int = 16) -> DataFrame:
    """Equi-join in which a key with very many rows of ``big`` is spread over
    ``salt`` tasks; ``small`` has at most one row for a key.  Never by broadcast:
    the copies of ``small`` are far larger than the table they are judged by."""
    keys = [keys] if isinstance(keys, str) else keys
    name = fresh("_salt", big, small)
    salts = F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))
    return (
        big.withColumn(name, F.pmod(F.monotonically_increasing_id(), F.lit(salt)).cast("int"))
        .join(small.withColumn(name, salts).hint("merge"), [*keys, name], how)
        .drop(name)
    )


def hubs(pairs: DataFrame, most: int = 4096) -> DataFrame | None:
    """(node, _parts) of the nodes with more than ``most`` of the pairs (x, y) on
    one side, and the parts to cut them into; None without any."""
    ends = pairs.select(F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("node")), F.struct(F.lit(1).alias("side"), F.col("y").alias("node")))).alias("e"))
    many = ends.groupBy("e.side", "e.node").agg(F.count("*").alias("_m")).where(F.col("_m") > most)
    found = materialize(many.groupBy("node").agg(F.ceil(F.max("_m") / most).cast("int").alias("_parts")))
    return None if found.isEmpty() else found


def split_join(pairs: DataFrame, rows: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Inner equi-join on ``key`` (x or y) with ``rows`` (one row a key, of any
    width); the pairs of a hub are spread over its parts, and only the rows of
    hubs are copied."""
    if hot is None:
        return pairs.join(rows, key)
    hot = hot.withColumnRenamed("node", key)
    parts = F.coalesce("_parts", F.lit(1))
    dealt = salted_join(pairs, hot, key).withColumn("_part", F.pmod(F.monotonically_increasing_id(), parts).cast("int")).drop("_parts")
    copied = rows.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copied.hint("merge"), [key, "_part"]).drop("_part")


def merge_components(labels: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """``labels`` (node, component) after more ``edges`` (x, y): only what joins
    two components is followed, between the components."""
    if edges.isEmpty():
        return labels
    if labels is None:
        return components(edges)
    x, y = (labels.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in "xy")
    of = [F.coalesce(f"c{c}", c).alias(c) for c in "xy"]
    between = materialize(edges.join(x, "x", "left").join(y, "y", "left").select(*of).where("x <> y").distinct())
    if between.isEmpty():
        return labels
    up = components(between).select(F.col("node").alias("component"), F.col("component").alias("top"))
    lone = up.select(F.col("component").alias("node"), "component").join(labels.select("node"), "node", "left_anti")
    return materialize(labels.union(lone).join(up, "component", "left").select("node", F.coalesce("top", "component").alias("component")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (x, y): component is the
    smallest node reachable.

    Each round hooks every node to its smallest neighbour, follows the hook
    once more, and contracts the edges; rounds are written to the shared
    folder.  Only partially aggregated minima and equi-joins, so a hub costs
    no more than its edges.
    """
    e = materialize(edges.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).where("x <> y").distinct())
    both = e.select("x").union(e.select("y")).distinct()
    labels = both.select(F.col("x").alias("node"), F.col("x").alias("component"))
    while not e.isEmpty():
        ways = e.union(e.select("y", "x"))
        hook = ways.groupBy("x").agg(F.min("y").alias("p")).select(F.col("x").alias("v"), F.least("x", "p").alias("p"))
        far = hook.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        hook = materialize(hook.join(far, "p", "left").select("v", F.coalesce("pp", "p").alias("p")))
        labels = materialize(
            labels.join(hook, labels.component == hook.v, "left")
            .select("node", F.coalesce("p", "component").alias("component"))
        )
        hx = hook.select(F.col("v").alias("x"), F.col("p").alias("px"))
        hy = hook.select(F.col("v").alias("y"), F.col("p").alias("py"))
        e = materialize(
            e.join(hx, "x").join(hy, "y")
            .select(F.least("px", "py").alias("x"), F.greatest("px", "py").alias("y"))
            .where("x <> y").distinct()
        )
    return labels

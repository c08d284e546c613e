"""Operator 9: exact dedup with an extendible-hash index on shared files.

Every row becomes an index entry (hash, length, SHA-256, id), written once to
the shared folder.  The directory has one slot for each value of the hash's
first ``max_depth`` bits; a bucket holds the slots that agree in its first
``depth`` bits, and doubles (takes one bit more) as long as it has more than
``capacity`` entries and bits are left.  Growing a directory by insertion ends
in that same state, so it is computed from the slot counts directly; with at
most 2^max_depth rows it is the only thing broadcast.  Entries of equal key are
combined before they move, to at most ``SALT`` rows a key however many copies a
group has.  Then every entry goes to the task that owns its (bucket, hash)
range: the owners chain the entries of a hash by length and digest, and tell
last row and size of each chain; no other shuffle groups the index.  A bucket
that is overfull with all bits used is several ranges of hashes, so its owners
are several tasks.

Keys that several rows have are chains: their texts are compared byte by byte
(smallest against largest text of the key, again combined before moving), and
a chain of differing texts is split by text.

DataFrame functions only.  Nulls: a null text counts as empty; a null id is
smaller than any other, and takes part.  Of repeated rows (same id, same text)
one is kept.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.shared import fresh, materialize, maybe_in, partitions, salted_join, without

KEY = ["h", "len", "sha"]
SALT = 16


def directory(index: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """(slot, depth, bucket) of every slot in use; at most 2^max_depth rows, and
    twice as many buckets of all depths, which are broadcast."""
    slots = index.groupBy(F.shiftrightunsigned("h", 64 - max_depth).alias("slot")).agg(F.count("*").alias("n"))
    depths = slots.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(max_depth)))).withColumn(
        "bucket", F.expr(f"shiftright(slot, {max_depth} - depth)"))
    fits = depths.groupBy("depth", "bucket").agg(F.sum("n").alias("n")).where((F.col("n") <= capacity) | (F.col("depth") == max_depth))
    return (
        depths.drop("n").join(F.broadcast(fits.drop("n")), ["depth", "bucket"])
        .groupBy("slot").agg(F.min(F.struct("depth", "bucket")).alias("b")).select("slot", "b.depth", "b.bucket")
    )


def owned_chains(index: DataFrame, slots: DataFrame, max_depth: int, tasks: int) -> DataFrame:
    """(bucket, depth, key, last, group_size) of every key, grouped by the owners
    of the (bucket, hash) ranges: the last exchange is the one that deals the
    entries to them."""
    last = F.max(F.struct("doc_id", "row")).alias("last")
    dealt = index.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALT)))
    entries = dealt.groupBy(*KEY, "salt").agg(last, F.count("*").alias("n")).withColumn("slot", F.shiftrightunsigned("h", 64 - max_depth))
    return (
        entries.join(F.broadcast(slots), "slot").repartitionByRange(tasks, "bucket", "h")
        .groupBy("bucket", "depth", *KEY).agg(F.max("last").alias("last"), F.sum("n").alias("group_size"))
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 100_000, max_depth: int = 12,
    hash_of: Callable[[Column], Column] = F.xxhash64, digest: Callable[[Column], Column] = lambda c: F.sha2(c, 256),
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, bucket, depth) of every
    row; of equal texts the row with the largest id is kept.  ``hash_of`` and
    ``digest`` make the key; any functions of the text give right results."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    index = materialize(docs.select(
        F.col(id_col).alias("doc_id"), hash_of(text).alias("h"), F.octet_length(text).alias("len"), digest(text).alias("sha"),
        F.monotonically_increasing_id().alias("row"), F.sha2(text, 256).alias("text_sha256")))
    slots = materialize(directory(index, capacity, max_depth))
    owned = materialize(owned_chains(index, slots, max_depth, partitions(spark)))
    chains = owned.where("group_size > 1").select(*KEY)
    members = maybe_in(docs.select(text.alias("text")).withColumn("h", hash_of(F.col("text"))), "h", chains.select("h")).where("_maybe")
    members = members.withColumn("len", F.octet_length("text")).withColumn("sha", digest(F.col("text")))
    differ = materialize(
        members.groupBy(*KEY).agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").select(*KEY))
    # an entry whose key no other has is its own group; only the others are joined
    several = owned.where("group_size > 1").select(*KEY, "last", "group_size")
    kept = (
        salted_join(index, several, KEY).withColumn("slot", F.shiftrightunsigned("h", 64 - max_depth)).join(F.broadcast(slots), "slot")
        .withColumn("last", F.coalesce("last", F.struct("doc_id", "row"))).withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long"))))
    if not differ.isEmpty():
        texts = docs.select(
            F.col(id_col).alias("doc_id"), hash_of(text).alias("h"), F.octet_length(text).alias("len"), digest(text).alias("sha"),
            F.monotonically_increasing_id().alias("row"), F.sha2(text, 256).alias("text_sha256"), text.alias("text"))
        split = materialize(texts.join(differ, KEY).join(owned.select(*KEY, "bucket", "depth"), KEY))
        chain = split.groupBy("text").agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count("*").alias("group_size"))
        columns = [*KEY, "doc_id", "row", "text_sha256", "last", "group_size", "bucket", "depth"]
        kept = kept.join(differ, KEY, "left_anti").select(*columns).union(salted_join(split, chain, "text", "inner").select(*columns))
    return kept.select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"),
        "text_sha256", "bucket", "depth")


def keep_last(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that exact_dedup drops."""
    found = materialize(exact_dedup(docs, id_col, text_col))
    sha, key, flag = (fresh(x, docs) for x in ("_sha", "_key", "_maybe"))
    marked = docs.withColumn(sha, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    keys = [F.col("doc_id").alias(id_col), F.col("text_sha256").alias(sha)]
    tied = found.where("not kept and doc_id <=> keep_id").select(*keys)
    out = without(marked, found.where("not kept and not doc_id <=> keep_id").select(*keys))
    if not tied.isEmpty():  # the same row more than once
        ties = maybe_in(out.withColumn(key, F.xxhash64(id_col, sha)), key, tied.select(F.xxhash64(id_col, sha).alias(key)), flag=flag)
        out = ties.where(~F.col(flag)).unionByName(ties.where(F.col(flag)).dropDuplicates([id_col, sha])).drop(key, flag)
    return out.drop(sha)

"""Operator 10: benchmark decontamination by size-partitioned MinHash containment.

Test items are sets of k-word shingles, partitioned by size (powers of two).
The MinHash sketch of an item is the shingles with the smallest hashes, and its
length follows from the partition: if percent of n shingles are in a document,
any n - ceil(percent n / 100) + 1 of them contain one that is.  So a document
that contains an item to that degree always holds a shingle of the item's
sketch, however long the document is -- no chance of a miss, unlike bands of
MinHashes of the whole document, whose Jaccard similarity to a short item is
near zero.  Each partition has its own index of sketches, and a document probes,
with all its shingles, those of items small enough to be in it; for each
(document, item) found, the exact number of the item's shingles in the document
is counted.

The partitions are broadcast in passes of at most about ``block`` shingles: small
partitions share a pass, a large one is cut by the items' hashes into several;
one pass over the documents each; the documents are never shuffled.

Nulls: null or empty texts and items match nothing.  An item of fewer than k
words is its whole sequence and matches a document of just these words.  Rows
with null ids take part; repeated rows give repeated results.  An item with
more shingles than a block goes into one pass all the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm import words as W
from likeness.llm.shared import fresh, materialize, ship, tidy, without

BLOCK = 1 << 20


def _items(items: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """(item_id, n, size of the sketch, items, band) of every item with words;
    band is the size partition: n is over 2^(band - 1) and at most 2^band."""

    def run(batches):
        for b in batches:
            for s in W.slices(b.column(1)):
                data = W.lowered(s.data)
                t = W.tokenize(data, s.offsets, W.NOT_SPACE)
                row, h = W.distinct(*W.shingles(W.hash_words(data, t), t, k))
                cuts = np.searchsorted(row, np.arange(s.hi - s.lo + 1))
                n = np.diff(cuts)
                band = np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)
                top = 1 << band  # the longest sketch that a size of the band needs
                size = np.minimum(n, top - -(-top * percent // 100) + 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.lo, s.hi - s.lo), pa.array(n), pa.array(size), W.binary_cuts(h, cuts), pa.array(band)],
                    names=["item_id", "n", "size", "items", "band"]).filter(pa.array(n > 0))

    return items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).mapInArrow(
        tidy(run), "item_id long, n long, size long, items binary, band long")


def passes(totals: dict[int, int], block: int) -> list[list[tuple[int, int, int]]]:
    """(band, part, parts) of what each pass broadcasts, from the shingles of each band."""
    out, room = [[]], block
    for band, n in sorted(totals.items()):
        parts = -(-n // block)
        for part in range(parts):
            if n // parts > room:
                out.append([])
                room = block
            out[-1].append((band, part, parts))
            room -= n // parts
    return out


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", k: int = 5, percent: int = 80, block: int = BLOCK,
    with_hash: bool = False,
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every document that
    has at least ``percent`` per cent of an item's shingles; with_hash: and the
    text_hash (xxhash64) of its text."""
    spark = docs.sparkSession
    ship(spark)
    index = materialize(_items(items, item_id, item_text, k, percent))
    totals = {r.band: r.n for r in index.groupBy("band").agg(F.sum("n").alias("n")).collect()}  # at most 64 rows
    place = F.xxhash64("item_id", "items")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    out = None
    for chosen in passes(totals, block):
        some = F.lit(False)
        for band, number, parts in chosen:
            some |= (F.col("band") == band) & (F.pmod(place, F.lit(parts)) == number)
        rows = index.where(some).toArrow()
        part = _probe(docs, k, percent, spark.sparkContext.broadcast(_table(rows, percent)))
        out = part if out is None else out.union(part)
    return out if with_hash else out.drop("text_hash")


def _table(rows: pa.Table, percent: int) -> tuple:
    """Item ids and sizes; (shingle, item) sorted by shingle of the whole items;
    and of each size partition the shingles that a document needs at least to
    contain one of its items, and (shingle, item) of its sketches."""
    rows = rows.combine_chunks()
    if not len(rows):
        none = np.zeros(0, np.int64)
        return rows.column("item_id").to_pylist(), none, (none.view(np.uint64), none), []
    h, cuts = W.from_binary(rows.column("items").chunk(0))
    n = np.diff(cuts)
    item = np.repeat(np.arange(len(n)), n)
    first = np.arange(len(h)) - cuts[item] < rows.column("size").to_numpy()[item]
    o = np.argsort(h, kind="stable")
    band = rows.column("band").to_numpy()[item]
    sketches = []
    for x in np.unique(band):
        s = o[(first & (band == x))[o]]
        least = int(n[item[s]].min())
        sketches.append((-(-least * percent // 100), (h[s], item[s])))
    return rows.column("item_id").to_pylist(), n, (h[o], item[o]), sketches


def _lookup(index: tuple, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, item) for each shingle of a row that items of the index have."""
    keys, item = index
    lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
    n = hi - lo
    at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else lo
    return np.repeat(row, n), item[at]


def _probe(docs: DataFrame, k: int, percent: int, table) -> DataFrame:
    def run(batches):
        names, n, whole, sketches = table.value
        near = np.zeros(1 << 16, bool)
        near[(whole[0] & np.uint64(0xFFFF)).astype(np.int64)] = True
        for b in batches:
            for s in W.slices(b.column(1)):
                data = W.lowered(s.data)
                t = W.tokenize(data, s.offsets, W.NOT_SPACE)
                row, h = W.shingles(W.hash_words(data, t), t, k)
                held = np.bincount(row, minlength=s.hi - s.lo)  # no fewer than there are different ones
                some = near[(h & np.uint64(0xFFFF)).astype(np.int64)]
                row, h = W.distinct(row[some], h[some])
                found = [np.zeros(0, np.int64)]
                for least, sketch in sketches:
                    fits = held[row] >= least
                    r, i = _lookup(sketch, row[fits], h[fits])
                    found.append(r * len(n) + i)
                found = np.unique(np.concatenate(found))
                in_found = np.isin(row, found // max(len(n), 1))
                r, i = _lookup(whole, row[in_found], h[in_found])
                pair, both = np.unique(r * len(n) + i, return_counts=True)
                ok = np.isin(pair, found)
                pair, both = pair[ok], both[ok]
                r, i = pair // max(len(n), 1), pair % max(len(n), 1)
                ok = both * 100 >= n[i] * percent
                r, i, both = r[ok], i[ok], both[ok]
                if len(r):
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(r + s.lo)), pa.array([names[x] for x in i.tolist()], pa.int64()), pa.array(n[i]),
                         pa.array(both.astype(np.int64)), pa.array(both / n[i]), b.column(2).take(pa.array(r + s.lo))],
                        names=["doc_id", "item_id", "n_item", "n_shared", "containment", "text_hash"])

    return docs.mapInArrow(tidy(run), "doc_id long, item_id long, n_item long, n_shared long, containment double, text_hash long")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    found = materialize(contaminated(docs, items, id_col, text_col, with_hash=True, **options))
    name = fresh("_hash", docs)
    hashed = docs.withColumn(name, F.xxhash64(text_col))
    return without(hashed, found.select(F.col("doc_id").alias(id_col), F.col("text_hash").alias(name)).distinct()).drop(name)

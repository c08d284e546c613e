"""Operator 1: n-gram Jaccard join by parity sketches.

A document is the set of its distinct k-word shingles.  Its *parity sketch*
XORs the 64-bit hash of every shingle into one of K words picked by that same
hash.  A shingle that only one of two documents has changes one word at most,
so the Hamming distance of two sketches (words that differ) is a lower bound of
the symmetric difference d of the sets.  Jaccard >= p/100 means
d (100 + p) <= (100 - p)(a + b), hence within a size band a largest d follows;
with K > d words at least one word of two linked documents is the same
(pigeonhole), and joining equal (band, place, word) finds every link.

Empty words say nothing and are not joined on.  A document with so many of
them that the pigeonhole fails (K - empty - d < 1; nearly always a tiny set)
also gives its prefix -- the n - ceil(p n / 100) + 1 smallest hashes, of which
two linked documents share one.  Both ways are exact, no cap on partners.

Candidates pass a second, 512-bit parity sketch and the size bound, then one of
their own size, then the exact intersection of the shingle sets.  See linkage
for how groups of any size are connected without emitting their pairs.

Nulls: a null or empty text, or one of white space, has an empty set and links
with nothing.  Rows with a null id take part; a component's id is the smallest
id that is not null (null if there is none).  Repeated rows are copies.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm import words as W
from likeness.llm.linkage import connect
from likeness.llm.shared import discard, fresh, hubs, materialize, maybe_in, partitions, salted_join, ship, split_join, tidy, without

SKETCH_WORDS = 8  # of 64 bits
GROWTH = 1.6  # of the size bands
FLUSH = 1 << 21
NO_ID = -(1 << 63)


def _bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest size, largest size and words of the sketch, by band."""
    los, his, ks, lo = [], [], [], 1
    while lo < 1 << 40:
        hi = max(lo, int(lo * GROWTH) - 1)
        d = (100 - percent) * (hi + hi * 100 // percent) // (100 + percent)
        los.append(lo)
        his.append(hi)
        ks.append(d + 1 + (-(-d * 6 // 100) + 1 if d else 0))
        lo = hi + 1
    return np.array(los), np.array(his), np.array(ks)


def _sets(batch: pa.RecordBatch, text: str, k: int) -> Iterator[tuple]:
    """(first row, rows, row, hash, cuts) of the distinct shingles, by slice."""
    for s in W.slices(batch.column(batch.schema.get_field_index(text))):
        data = W.lowered(s.data)
        t = W.tokenize(data, s.offsets, W.NOT_SPACE)
        row, h = W.distinct(*W.shingles(W.hash_words(data, t), t, k))
        yield s.lo, s.hi - s.lo, row, h, np.searchsorted(row, np.arange(s.hi - s.lo + 1))


def _nodes(h: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """An id of each set: a hash of the sum and the XOR of its hashes."""
    out = np.zeros(len(cuts) - 1, np.uint64)
    full = np.flatnonzero(cuts[:-1] < cuts[1:])
    if len(full):
        both = np.add.reduceat(W.mix(h), cuts[full]), np.bitwise_xor.reduceat(h, cuts[full])
        out[full] = W.mix(both[0] ^ W.mix(both[1] + np.diff(cuts)[full].astype(np.uint64)))
    return out


def _sketch(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """512-bit parity sketches, (rows, 64) bytes."""
    bits = 64 * SKETCH_WORDS
    n = np.bincount(row * bits + (h & np.uint64(bits - 1)).astype(np.int64), minlength=rows * bits)
    return np.packbits((n & 1).astype(np.uint8).reshape(rows, bits), axis=1)


def _wide(row: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity sketches of at least 4 n bits (a power of two): bytes and cuts."""
    bits = np.where(n > 0, 1 << np.ceil(np.log2(np.maximum(4 * n, 64 * SKETCH_WORDS))).astype(np.int64), 0)
    base = np.concatenate([[0], np.cumsum(bits)])
    at = base[row] + (h & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=base[-1]) & 1).astype(np.uint8)), base // 8


def profile(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, text_hash, n, node, sketch, wide) of every row; node is null for an empty set."""

    def run(batches):
        for b in batches:
            for lo, rows, row, h, cuts in _sets(b, "text", shingle):
                n = np.diff(cuts)
                sk = _sketch(row, h, rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, rows), b.column(1).slice(lo, rows), pa.array(n), pa.array(_nodes(h, cuts).view(np.int64), mask=n == 0),
                     W.binary_cuts(sk.reshape(-1), np.arange(rows + 1) * sk.shape[1]), W.binary_cuts(*_wide(row, h, n))],
                    names=["id", "text_hash", "n", "node", "sketch", "wide"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")).mapInArrow(
        tidy(run), "id long, text_hash long, n long, node long, sketch binary, wide binary")


def _keys(row, h, cuts, percent: int, bands) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the sketch words of every row in its band and, where a row
    may be the larger partner, in the band below; prefixes of poor sketches."""
    los, his, ks = bands
    n = np.diff(cuts)
    band = np.searchsorted(los, n, "right") - 1
    below = (n > 0) & (band > 0)
    below[below] = n[below] * percent <= 100 * his[band[below] - 1]
    out_row, out_key = [], []
    poor = np.zeros(len(n), bool)
    for use, level in ((n > 0, band), (below, band - 1)):
        k = np.where(use, ks[np.where(use, level, 0)], 0)
        base = np.concatenate([[0], np.cumsum(k)])
        word = np.zeros(base[-1], np.uint64)
        mine = use[row]
        r, x = row[mine], h[mine]
        np.bitwise_xor.at(word, base[r] + ((x >> np.uint64(24)) % k[r].astype(np.uint64)).astype(np.int64), x)
        owner = np.repeat(np.arange(len(n)), k)
        place = (np.arange(base[-1]) - base[owner]).astype(np.uint64)
        tag = W.mix((level[owner].astype(np.uint64) << np.uint64(40)) + place)
        kept = np.flatnonzero(word)
        out_row.append(owner[kept])
        out_key.append(W.mix(word[kept] ^ tag[kept]))
        most = np.minimum(n * 100 // percent, his[np.where(use, level, 0)]) if level is not band else n * 100 // percent
        d = (100 - percent) * (n + most) // (100 + percent)
        poor |= use & (np.bincount(owner[kept], minlength=len(n)) - d < 1)
    length = np.where(poor, n - -(-n * percent // 100) + 1, 0)
    take = np.arange(len(row)) - cuts[row] < length[row]
    out_row.append(row[take])
    out_key.append(W.mix(h[take] ^ np.uint64(0x5851F42D4C957F2D)))
    return np.concatenate(out_row), np.concatenate(out_key)


def _shared_keys(docs: DataFrame, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(key, node) of every key that at least two different sets have.

    Keys travel as sorted binary blocks by key range, 16 bytes a key; the
    receiving side sorts one range at a time and passes on what is shared.
    Of a range it holds one node a key, so a key of many nodes takes no memory.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    bits = max(1, (8 * parts - 1).bit_length())

    def cut(keys, nodes):
        o = np.argsort(keys)
        keys, nodes = keys[o], nodes[o]
        bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
        at = np.flatnonzero(np.diff(bucket, prepend=-1))
        cuts = np.append(at, len(keys))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[at].astype(np.int32)), W.binary_cuts(keys, cuts), W.binary_cuts(nodes, cuts)],
            names=["bucket", "keys", "nodes"])

    def send(batches):
        bands, seen, keys, nodes, held = _bands(percent), set(), [], [], 0
        for b in batches:
            for _, _, row, h, cuts in _sets(b, "text", shingle):
                node = _nodes(h, cuts)
                new = np.zeros(len(node), bool)
                for i, v in enumerate(node.tolist()):  # copies within the task count once
                    if v and v not in seen:
                        seen.add(v)
                        new[i] = True
                if not new.all():
                    keep = new[row]
                    row, h = row[keep], h[keep]
                    cuts = np.searchsorted(row, np.arange(len(node) + 1))
                r, key = _keys(row, h, cuts, percent, bands)
                keys.append(key)
                nodes.append(node[r])
                held += len(key)
                if held >= FLUSH:
                    yield cut(np.concatenate(keys), np.concatenate(nodes))
                    keys, nodes, held = [], [], 0
        if held:
            yield cut(np.concatenate(keys), np.concatenate(nodes))

    def receive(batches):
        now, keys, nodes, held = -1, [], [], 0
        kept = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool))

        def shared():
            """Emit what is shared so far; keep one node a key."""
            nonlocal kept
            key = np.concatenate([kept[0], *keys])
            node = np.concatenate([kept[1], *nodes])
            told = np.concatenate([kept[2], np.zeros(len(key) - len(kept[2]), bool)])
            o = np.lexsort((~told, node, key))
            key, node, told = key[o], node[o], told[o]
            once = np.ones(len(key), bool)
            once[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            key, node, told = key[once], node[once], told[once]
            at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            many = np.diff(np.append(at, len(key))) > 1
            spread = np.repeat(many, np.diff(np.append(at, len(key))))
            out = spread & ~told
            any_told = np.logical_or.reduceat(told, at) if len(at) else told
            out |= np.repeat(any_told & ~many, np.diff(np.append(at, len(key)))) & ~told
            kept = key[at], node[at], many | any_told
            return pa.RecordBatch.from_arrays([W.longs(key[out]), W.longs(node[out])], names=["key", "node"])

        for b in batches:
            ks, kc = W.from_binary(b.column(1))
            ns, nc = W.from_binary(b.column(2))
            for i, bucket in enumerate(b.column(0).to_pylist()):
                if bucket != now:
                    if held:
                        yield shared()
                    now, keys, nodes, held = bucket, [], [], 0
                    kept = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool))
                keys.append(ks[kc[i] : kc[i + 1]].copy())
                nodes.append(ns[nc[i] : nc[i + 1]].copy())
                held += len(keys[-1])
                if held >= 2 * FLUSH:
                    yield shared()
                    keys, nodes, held = [], [], 0
        if held:
            yield shared()

    sent = docs.select(F.col(text_col).alias("text")).mapInArrow(tidy(send), "bucket int, keys binary, nodes binary")
    return sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(receive), "key long, node long")


def _sift(pairs: DataFrame, info: DataFrame, percent: int, hot: DataFrame | None) -> DataFrame:
    """The pairs whose sketches of their own size allow a link."""

    def fold(bits, size):
        """A parity sketch made as short as another: halves XORed."""
        while len(bits) > size:
            half = len(bits) // 2
            bits = bits[:half] ^ bits[half:]
        return bits

    def run(batches):
        for b in batches:
            n, m = b.column(2).to_numpy(), b.column(3).to_numpy()
            (a, ac), (c, cc) = W.from_binary(b.column(4), np.uint8), W.from_binary(b.column(5), np.uint8)
            keep = np.zeros(len(b), bool)
            for i in range(len(b)):
                s, t = a[ac[i] : ac[i + 1]], c[cc[i] : cc[i + 1]]
                size = min(len(s), len(t))
                d = int(np.bitwise_count(fold(s, size) ^ fold(t, size)).sum(dtype=np.int64))
                keep[i] = d * (100 + percent) <= (100 - percent) * (n[i] + m[i])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["x", "y"]).filter(pa.array(keep))

    return (
        split_join(
            split_join(pairs, info.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("wide").alias("wx")), "x", hot),
            info.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("wide").alias("wy")), "y", hot)
        .select("x", "y", "nx", "ny", "wx", "wy").mapInArrow(tidy(run), "x long, y long")
    )


def _verify(pairs: DataFrame, sets: DataFrame, percent: int, hot: DataFrame | None) -> DataFrame:
    """The pairs (x, y) whose sets have the Jaccard similarity asked for."""

    def run(batches):
        for b in batches:
            (a, ac), (c, cc) = W.from_binary(b.column(2)), W.from_binary(b.column(3))
            keep = np.zeros(len(b), bool)
            for i in range(len(b)):
                s, t = a[ac[i] : ac[i + 1]], c[cc[i] : cc[i + 1]]
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                both = int((t[at] == s).sum())
                keep[i] = 100 * both >= percent * (len(s) + len(t) - both)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["x", "y"]).filter(pa.array(keep))

    return (
        split_join(
            split_join(pairs, sets.select(F.col("node").alias("x"), F.col("items").alias("xs")), "x", hot),
            sets.select(F.col("node").alias("y"), F.col("items").alias("ys")), "y", hot)
        .select("x", "y", "xs", "ys").mapInArrow(tidy(run), "x long, y long")
    )


def _wanted_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """(node, items: sorted 64-bit hashes) of the sets in ``wanted`` (id,
    text_hash, node).  Only their rows are shuffled, plus the few that a 1 MB
    bitmap lets through."""

    def run(batches):
        for b in batches:
            expect = b.column(0).to_numpy()
            for lo, rows, row, h, cuts in _sets(b, "text", shingle):
                same = _nodes(h, cuts).view(np.int64) == expect[lo : lo + rows]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, rows), W.binary_cuts(h, cuts)], names=["node", "items"]).filter(pa.array(same))

    own = ["id", "text_hash"]
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    texts = maybe_in(texts, "text_hash", wanted.select("text_hash")).where("_maybe").drop("_maybe")
    return texts.join(wanted, own).dropDuplicates(own).select("node", "text").mapInArrow(tidy(run), "node long, items binary")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash) of every row of ``docs``,
    linked where 100 |A and B| >= percent |A or B|.  See the module for cases and method."""
    ship(docs.sparkSession)
    prof = materialize(profile(docs, id_col, text_col, shingle))
    live = materialize(_shared_keys(docs, text_col, shingle, percent))
    first_row = F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "text_hash", "n", "sketch", "wide")
    one = prof.where("node is not null").groupBy("node").agg(
        F.min_by(first_row, F.coalesce("id", F.lit(NO_ID))).alias("row"), F.min("id").alias("least_id")).select("node", "least_id", "row.*")
    used = live.select("node").distinct()
    info = materialize(one.join(used, "node"))

    def links(pairs):
        hot = hubs(pairs)
        pairs = materialize(_sift(pairs, info, percent, hot))
        nodes = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()
        wanted = materialize(info.select("id", "text_hash", "node").join(nodes, "node"))
        sets = materialize(_wanted_sets(docs, id_col, text_col, shingle, wanted))
        out = materialize(_verify(pairs, sets, percent, hot))
        discard(sets, wanted)
        return out

    def allow(n, m, d):
        return (np.maximum(n, m) * percent <= 100 * np.minimum(n, m)) & (d * (100 + percent) <= (100 - percent) * (n + m))

    labels = connect(live, info.select("node", "n", "sketch", "wide"), allow, links)
    least = one.join(labels, "node").groupBy("component").agg(F.min("least_id").alias("component_id"))
    own = one.join(labels, "node", "left").join(least, "component", "left").select(
        "node", F.when(F.col("component").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("component_id"))
    return salted_join(prof.select("id", "n", "node", "text_hash"), own, "node").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"), "text_hash")


def keep_least(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest
    id (rows without id, if the component has no other)."""
    found = materialize(ngram_join(docs, id_col, text_col, **options))
    gone = found.where("component_id is not null and not doc_id <=> component_id")
    name = fresh("_hash", docs)
    hashed = docs.withColumn(name, F.xxhash64(text_col))
    return without(hashed, gone.select(F.col("doc_id").alias(id_col), F.col("text_hash").alias(name)).distinct()).drop(name)

"""Operator 7: substring dedup with a count-min prefilter.

A window is ``k`` consecutive words.  First pass: every task counts its windows
in a count-min sketch of ``DEPTH`` rows of cells; sketches travel as the sorted
cells they touch (gaps of one byte), by cell range, and are merged into one bit
a cell: "two or more".  A repeated window hits such cells in every row, so the
estimate never misses one.  The merged bits are broadcast: their number is
fixed by the size of the input, and never more than DEPTH * 2^MOST_BITS (64 MB).
With more windows than that the prefilter lets more through, but loses none.

Second pass: windows whose cells are all set travel with a 96-bit hash, their
document and place, as sorted blocks by hash range.  One range at a time, the
smallest document of each window is found; the places in other documents are
what is removed.  Of a window only its smallest document so far is held, so a
passage that very many documents share takes no memory.

Third pass: documents that lose words are joined with their places, the others
(a bitmap rules them out) are written straight from the scan.

Nulls: a null or empty text has no words.  A row with a null id is compared with
none: it neither loses words nor makes others lose them.  Rows with the same id
do not affect each other.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm import words as W
from likeness.llm.shared import materialize, maybe_in, partitions, ship, tidy

DEPTH, MOST_BITS = 2, 28
FLUSH = 1 << 21


def _windows(batch: pa.RecordBatch, column: int, k: int):
    """(slice, tokens, window positions, 64-bit hash of each window)."""
    for s in W.slices(batch.column(column)):
        t = W.tokenize(s.data, s.offsets, W.NOT_SPACE)
        at = W.windows(t, k)
        yield s, t, at, W.fold(W.hash_words(s.data, t), at, k)


def _check(s: W.Slice, t: W.Tokens, at: np.ndarray, k: int) -> np.ndarray:
    """32 more bits, of word hashes independent of the first ones."""
    return (W.fold(W.hash_words(s.data, t, 1), at, k) >> np.uint64(32)).astype(np.uint32)


def _cells(h: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(W.mix(h + np.uint64(r)) >> np.uint64(64 - bits)).astype(np.uint32) for r in range(DEPTH)]


def gaps(cells: np.ndarray) -> np.ndarray:
    """Sorted distinct cells as bytes: gaps, where 255 means "255 on, and more"."""
    d = np.diff(cells.astype(np.int64), prepend=-1) - 1
    n = d // 255 + 1
    out = np.full(int(n.sum()), 255, np.uint8)
    out[np.cumsum(n) - 1] = d % 255
    return out


def ungaps(raw: np.ndarray) -> np.ndarray:
    at = np.cumsum(raw.astype(np.int64))
    last = raw < 255
    return at[last] + np.arange(int(last.sum()))


def _sketch(docs: DataFrame, k: int, bits: int, parts: int) -> list[np.ndarray]:
    """One bit for each cell of each row of the merged sketch."""
    shard_bits = min(bits - 3, max(3, (parts - 1).bit_length()))
    width = 1 << (bits - shard_bits)

    def send(batches):
        held, many = [], 0

        def cut():
            shards, ones, twos = [], [], []
            h = np.concatenate(held)
            for r, cells in enumerate(_cells(h, bits)):
                cells.sort()
                new = np.append(True, cells[1:] != cells[:-1]) if len(cells) else np.zeros(0, bool)
                more = np.unique(cells[~new])
                cells = cells[new]
                edges = np.arange(0, (1 << shard_bits) + 1, dtype=np.int64) * width
                a, b = np.searchsorted(cells, edges), np.searchsorted(more, edges)
                for i in np.flatnonzero(np.diff(a)):
                    shards.append((r << shard_bits) + int(i))
                    ones.append(gaps(cells[a[i] : a[i + 1]] - np.uint32(i * width)).tobytes())
                    twos.append(gaps(more[b[i] : b[i + 1]] - np.uint32(i * width)).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(ones, pa.binary()), pa.array(twos, pa.binary())], names=["shard", "ones", "twos"])

        for b in batches:
            for _, _, _, h in _windows(b, 0, k):
                held.append(h)
                many += len(h)
                if many >= 2 * FLUSH:
                    yield cut()
                    held, many = [], 0
        if many:
            yield cut()

    def merge(batches):
        now, one, two = None, None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(two).tobytes()], pa.binary())], names=["shard", "bits"])

        for b in batches:
            for shard, ones, twos in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if shard != now:
                    if now is not None:
                        yield done()
                    now, one, two = shard, np.zeros(width, bool), np.zeros(width, bool)
                cells = ungaps(np.frombuffer(ones, np.uint8))
                two[cells] |= one[cells]
                one[cells] = True
                two[ungaps(np.frombuffer(twos, np.uint8))] = True
        if now is not None:
            yield done()

    sent = docs.select("text").mapInArrow(tidy(send), "shard int, ones binary, twos binary")
    merged = sent.repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(tidy(merge), "shard int, bits binary")
    out = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(DEPTH)]
    for shard, part in materialize(merged).toLocalIterator():  # of fixed size, see the module
        r, i = shard >> shard_bits, shard & ((1 << shard_bits) - 1)
        out[r][i * width // 8 : (i + 1) * width // 8] = np.frombuffer(part, np.uint8)
    return out


def _removed(docs: DataFrame, k: int, bits: int, parts: int, seen) -> DataFrame:
    """(doc_id, places): blocks of (place, check) of windows that a smaller document has."""
    bucket_bits = max(1, (8 * parts - 1).bit_length())
    kind = np.dtype([("check", np.uint32), ("place", np.uint32), ("doc", np.int64)])

    def send(batches):
        keys, rest, many = [], [], 0
        maps = seen.value

        def cut():
            key, x = np.concatenate(keys), np.concatenate(rest)
            o = np.argsort(key)
            key, x = key[o], x[o]
            bucket = (key >> np.uint64(64 - bucket_bits)).astype(np.int64)
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            cuts = np.append(at, len(key))
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[at].astype(np.int32)), W.binary_cuts(key, cuts), W.binary_cuts(x, cuts)], names=["bucket", "keys", "rest"])

        for b in batches:
            ids = b.column(0).fill_null(0).to_numpy()
            known = b.column(0).is_valid().to_numpy(zero_copy_only=False)
            for s, t, at, h in _windows(b, 1, k):
                hit = known[s.lo : s.hi][t.row[at]]
                for m, cells in zip(maps, _cells(h, bits), strict=True):
                    hit &= (m[cells >> np.uint32(3)] >> (7 - (cells & np.uint32(7))).astype(np.uint8)) & 1 == 1
                at, h = at[hit], h[hit]
                x = np.empty(len(at), kind)
                x["check"], x["place"], x["doc"] = _check(s, t, at, k), at - t.first[t.row[at]], ids[s.lo : s.hi][t.row[at]]
                keys.append(h)
                rest.append(x)
                many += len(at)
                if many >= FLUSH:
                    yield cut()
                    keys, rest, many = [], [], 0
        if many:
            yield cut()

    def receive(batches):
        none = (np.zeros(0, np.uint64), np.zeros(0, kind))
        now, keys, rest, many, held = -1, [], [], 0, none

        def beaten():
            """Places beaten so far; holds the smallest document of each window."""
            nonlocal held
            key, x = np.concatenate([held[0], *keys]), np.concatenate([held[1], *rest])
            o = np.lexsort((x["doc"], x["check"], key))
            key, x = key[o], x[o]
            new = np.append(True, (key[1:] != key[:-1]) | (x["check"][1:] != x["check"][:-1])) if len(key) else np.zeros(0, bool)
            at = np.flatnonzero(new)
            least = np.repeat(x["doc"][at], np.diff(np.append(at, len(key))))
            lost = x["doc"] > least
            held = key[~lost], x[~lost]
            x = x[lost]
            x = x[np.argsort(x["doc"], kind="stable")]
            at = np.flatnonzero(np.append(True, x["doc"][1:] != x["doc"][:-1])) if len(x) else np.zeros(0, np.int64)
            pairs = np.empty(len(x), np.uint64)
            pairs[:] = (x["place"].astype(np.uint64) << np.uint64(32)) | x["check"]
            return pa.RecordBatch.from_arrays([pa.array(x["doc"][at]), W.binary_cuts(pairs, np.append(at, len(x)))], names=["doc_id", "places"])

        for b in batches:
            ks, kc = W.from_binary(b.column(1))
            xs, xc = W.from_binary(b.column(2), kind)
            for i, bucket in enumerate(b.column(0).to_pylist()):
                if bucket != now:
                    if many:
                        yield beaten()
                    now, keys, rest, many, held = bucket, [], [], 0, none
                keys.append(ks[kc[i] : kc[i + 1]].copy())
                rest.append(xs[xc[i] : xc[i + 1]].copy())
                many += len(keys[-1])
                if many >= 2 * FLUSH:
                    yield beaten()
                    keys, rest, many = [], [], 0
        if many:
            yield beaten()

    sent = docs.select("doc_id", "text").mapInArrow(tidy(send), "bucket int, keys binary, rest binary")
    return sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(receive), "doc_id long, places binary")


def _render(k: int, keep_text: bool):
    def run(batches):
        for b in batches:
            for s, t, at, _ in _windows(b, 1, k):
                n = np.diff(t.first)
                gone = np.zeros(len(t.row) + 1, np.int64)
                check = None
                for i, blocks in enumerate(b.column(2).slice(s.lo, s.hi - s.lo).to_pylist()):
                    if not blocks:
                        continue
                    if check is None:
                        check = np.zeros(len(t.row), np.int64) - 1
                        check[at] = _check(s, t, at, k)
                    x = np.frombuffer(b"".join(blocks), np.uint64)
                    place = (x >> np.uint64(32)).astype(np.int64)
                    x, place = (x & np.uint64(0xFFFFFFFF)).astype(np.int64), place + t.first[i]
                    ok = place < t.first[i + 1]
                    place = np.unique(place[ok][check[place[ok]] == x[ok]])  # of this row, not of another with its id
                    np.add.at(gone, place, 1)
                    np.add.at(gone, place + k, -1)
                kept = np.cumsum(gone[:-1]) == 0
                size = np.where(kept, t.ends - t.starts + 1, 0)
                to = np.concatenate([[0], np.cumsum(size)])
                src = np.repeat(t.starts - to[:-1], size) + np.arange(to[-1])
                out = s.data[np.minimum(src, len(s.data) - 1)] if len(s.data) else np.zeros(0, np.uint8)
                out[to[1:][kept] - 1] = 0x20
                cuts = to[t.first]
                left = [out[a : max(a, e - 1)].tobytes() for a, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                removed = n - np.diff(np.concatenate([[0], np.cumsum(kept)])[t.first])
                columns = [b.column(0).slice(s.lo, s.hi - s.lo), pa.array(n), pa.array(removed), pa.array([hashlib.sha256(x).hexdigest() for x in left])]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if keep_text:
                    columns.append(pa.array([x.decode() for x in left], pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 13, keep_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]): every row without
    the words covered by a window of ``k`` words that a smaller id has too."""
    spark = docs.sparkSession
    ship(spark)
    parts = partitions(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(16, (size // 4).bit_length()))
    seen = spark.sparkContext.broadcast(_sketch(docs, k, bits, parts))
    lost = materialize(_removed(docs, k, bits, parts, seen)).groupBy("doc_id").agg(F.collect_list("places").alias("places"))
    lost = materialize(lost)
    seen.unpersist()
    marked = maybe_in(docs, "doc_id", lost.select("doc_id"))
    whole = marked.where("not _maybe").select("doc_id", "text", F.lit(None).cast("array<binary>").alias("places"))
    cut = marked.where("_maybe").select("doc_id", "text").join(lost, "doc_id", "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if keep_text else "")
    return whole.union(cut.select("doc_id", "text", "places")).mapInArrow(tidy(_render(k, keep_text)), schema)

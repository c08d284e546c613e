"""Operator 4: line dedup by a segment-partition edit join.

Two lines are linked if their edit distance (code points) is at most ``most``;
lines shorter than ``min_chars`` only if they are equal.  Every line is split
into most + 1 segments of nearly equal length.  Of two linked lines, the
shorter one has a segment that no edit touches; it stands in the longer one,
and by the number of edits that can lie before and after it, at one of a few
places.  Lines are therefore indexed by (length, segment number, segment) and
probe the indexes of the lengths up to ``most`` below their own with substrings
at just these places.  Keys travel as hashes, 16 bytes each, by key range, the
index before the probes.

Candidates must agree in length (up to ``most``) and in a 256-bit parity sketch
of their character pairs, of which an edit changes four at most, and are then
verified with bit-parallel edit distance in a band of 2 most + 1 diagonals.
See linkage for how groups of any size are connected.  A class is a component
of links; of each class the first line by (id, line number) stays.

Nulls: a null or empty text has no lines to remove; blank lines always stay.  A
null id is smaller than all others.  Rows with the same id and text do not
affect each other.  Other columns are not read; lines of any length are whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm import words as W
from likeness.llm.linkage import connect
from likeness.llm.shared import discard, hubs, materialize, maybe_in, partitions, salted_join, ship, split_join, tidy

FLUSH = 1 << 21
SKETCH_BITS = 256
NO_ID = -(1 << 63)
_SOMETHING = r"[^\x20\x09-\x0D]"  # a line without is blank
_BASE = 0x9FB21C651E98DF25
_UNDO = np.uint64(pow(_BASE, -1, 1 << 64))


def split_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, at, line, node) of the lines that are not blank."""
    return (
        docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.posexplode(F.split(text_col, "\n")).alias("at", "line"))
        .where(F.col("line").rlike(_SOMETHING)).withColumn("node", F.xxhash64("line"))
    )


def _points(lines: pa.Array):
    """(first, rows, code points, cuts) of slices of a string array."""
    for s in W.slices(lines):
        part = lines.slice(s.lo, s.hi - s.lo)
        cuts = np.concatenate([[0], np.cumsum(pc.utf8_length(part).to_numpy(zero_copy_only=False))]).astype(np.int64)
        yield s.lo, s.hi - s.lo, np.frombuffer(s.data.tobytes().decode().encode("utf-32-le"), np.uint32), cuts


class _Substrings:
    """Hashes of substrings, from prefix sums of hash(c) * base^place."""

    def __init__(self, points: np.ndarray):
        n = len(points) + 1
        base, undo = np.full(n, _BASE, np.uint64), np.full(n, _UNDO, np.uint64)
        base[0] = undo[0] = 1
        base, self.undo = np.multiply.accumulate(base), np.multiply.accumulate(undo)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(points.astype(np.uint64)) * base[:-1], dtype=np.uint64)])

    def __call__(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.undo[start]


def _segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and size of segment i of lines of a length; the last ones are longer."""
    size, longer = length // parts, length % parts
    short = parts - longer
    return size * i + np.maximum(0, i - short), size + (i >= short)


def _keys(points: np.ndarray, cuts: np.ndarray, rows: np.ndarray, most: int):
    """(row, key, probes) of the index and probe keys of ``rows``."""
    sub, parts = _Substrings(points), most + 1
    first, length = cuts[rows], cuts[rows + 1] - cuts[rows]
    for less in range(most + 1):
        target = length - less
        for i in range(parts):
            place, size = _segment(target, i, parts)
            tag = W.mix(target.astype(np.uint64) * np.uint64(64) + np.uint64(i))
            # an untouched segment i has at most i edits before it and most - i after it
            for shift in range(max(-i, less - (most - i)), min(i, less + (most - i)) + 1):
                at = place + shift
                ok = (at >= 0) & (at + size <= length) & (size > 0)
                key = W.mix(sub(np.where(ok, first + at, 0), np.where(ok, size, 0)) ^ tag)
                yield rows[ok], key[ok], True
                if less == 0 and shift == 0:
                    yield rows[ok], key[ok], False


def _sketch(points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Parity sketches of the character pairs of each line."""
    rows = len(cuts) - 1
    row = np.repeat(np.arange(rows), np.diff(cuts))
    pair = W.mix(points[:-1].astype(np.uint64) << np.uint64(32) | points[1:].astype(np.uint64)) if len(points) > 1 else np.zeros(0, np.uint64)
    same = row[:-1] == row[1:] if len(row) > 1 else np.zeros(0, bool)
    at = row[:-1][same] * SKETCH_BITS + (pair[same] & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=rows * SKETCH_BITS) & 1).astype(np.uint8))


def _receive(batches):
    """The shared (key, node) of sorted blocks (bucket, probe, keys, nodes): a run
    of one key range at a time.  Of a range it holds one node a key of the index,
    so a key of many lines takes no memory."""
    now, keys, nodes, held = (-1, 0), [], [], 0
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    kept = none  # key, one of its nodes, whether that has been passed on

    def shared(probe):
        """Pass on what is shared so far; keep one node a key."""
        nonlocal kept
        key, node = np.concatenate(keys), np.concatenate(nodes)
        if probe:  # only keys of the index matter, and it is complete
            at = np.searchsorted(kept[0], key)
            known = at < len(kept[0])
            known[known] = kept[0][at[known]] == key[known]
            key, node = key[known], node[known]
        key, node = np.concatenate([kept[0], key]), np.concatenate([kept[1], node])
        told = np.concatenate([kept[2], np.zeros(len(key) - len(kept[2]), bool)])
        o = np.lexsort((~told, node, key))
        key, node, told = key[o], node[o], told[o]
        once = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))[: len(key)]
        key, node, told = key[once], node[once], told[once]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        size = np.diff(np.append(at, len(key)))
        many = size > 1
        any_told = np.logical_or.reduceat(told, at) if len(at) else told
        out = np.repeat(many, size) & ~told
        kept = key[at], node[at], many | any_told
        return pa.RecordBatch.from_arrays([W.longs(key[out]), pa.array(node[out])], names=["key", "node"])

    for b in batches:
        ks, kc = W.from_binary(b.column(2))
        ns, nc = W.from_binary(b.column(3), np.int64)
        for i, kind in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
            if kind != now:
                if held:
                    yield shared(now[1])
                kept = kept if kind[0] == now[0] else none
                now, keys, nodes, held = kind, [], [], 0
            keys.append(ks[kc[i] : kc[i + 1]].copy())
            nodes.append(ns[nc[i] : nc[i + 1]].copy())
            held += len(keys[-1])
            if held >= 2 * FLUSH:
                yield shared(now[1])
                keys, nodes, held = [], [], 0
    if held:
        yield shared(now[1])


def _shared_keys(lines: DataFrame, most: int, min_chars: int) -> DataFrame:
    """(key, node) of keys that index one line and that another one probes.

    The index entries of a key range reach the receiving side before the probes.
    """
    spark = lines.sparkSession
    parts = partitions(spark)
    bits = max(1, (8 * parts - 1).bit_length())

    def send(batches):
        seen, held, many = set(), [], 0

        def cut():
            key, node, probe = (np.concatenate(c) for c in zip(*held, strict=True))
            o = np.lexsort((key, probe))
            key, node, probe = key[o], node[o], probe[o]
            bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
            at = np.flatnonzero((np.diff(bucket, prepend=-1) != 0) | (np.diff(probe, prepend=probe[:1]) != 0))
            cuts = np.append(at, len(key))
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[at].astype(np.int32)), pa.array(probe[at].astype(np.int32)), *(W.binary_cuts(c, cuts) for c in (key, node))],
                names=["bucket", "probe", "keys", "nodes"])

        for b in batches:
            nodes = b.column(0).to_numpy()
            for lo, n, points, cuts in _points(b.column(1)):
                rows = []
                for i, node in enumerate(nodes[lo : lo + n].tolist()):  # copies within the task count once
                    if cuts[i + 1] - cuts[i] >= min_chars and node not in seen:
                        seen.add(node)
                        rows.append(i)
                if rows:
                    for r, key, probe in _keys(points, cuts, np.array(rows), most):
                        held.append((key, nodes[lo + r], np.full(len(r), probe, np.uint8)))
                        many += len(r)
                if many >= FLUSH:
                    yield cut()
                    held, many = [], 0
        if many:
            yield cut()

    sent = lines.select("node", "line").mapInArrow(tidy(send), "bucket int, probe int, keys binary, nodes binary")
    return sent.repartition(parts, "bucket").sortWithinPartitions("bucket", "probe").mapInArrow(tidy(_receive), "key long, node long")


def edit_distance_within(a: str, b: str, most: int) -> bool:
    """Whether at most ``most`` edits make b of a: bit-parallel, one bit vector
    for each number of edits, kept to the band around the diagonal."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    end = 0
    while end < hi - lo and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[lo : len(a) - end], b[lo : len(b) - end]
    if abs(len(a) - len(b)) > most:
        return False
    places: dict[str, int] = {}
    for j, c in enumerate(a):
        places[c] = places.get(c, 0) | 2 << j
    # bit j of state d: the first j characters of a, with at most d edits
    state = [(2 << d) - 1 for d in range(most + 1)]
    band, full = (2 << 2 * most) - 1, (2 << len(a)) - 1
    for i, c in enumerate(b, 1):
        mask = (band << (i - most) if i >= most else band >> (most - i)) & full
        match, new = places.get(c, 0), []
        for d, old in enumerate(state):
            x = old << 1 & match
            if d:
                x |= state[d - 1] | state[d - 1] << 1 | new[d - 1] << 1
            new.append(x & mask | (d >= i))
        state = new
        if not state[-1]:
            return False
    return bool(state[-1] >> len(a) & 1)


def _verify(pairs: DataFrame, texts: DataFrame, most: int) -> DataFrame:
    def run(batches):
        for b in batches:
            keep = [edit_distance_within(x, y, most) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    hot = hubs(pairs)
    left = split_join(pairs, texts.select(F.col("node").alias("x"), F.col("line").alias("a")), "x", hot)
    return (
        split_join(left, texts.select(F.col("node").alias("y"), F.col("line").alias("b")), "y", hot)
        .select("x", "y", "a", "b").mapInArrow(tidy(run), "x long, y long")
    )


def _profile(lines: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for lo, n, points, cuts in _points(b.column(1)):
                sk = _sketch(points, cuts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n), pa.array(np.diff(cuts)), W.binary_cuts(sk, np.arange(n + 1) * (SKETCH_BITS // 8))], names=["node", "n", "sketch"])

    return lines.select("node", "line").mapInArrow(tidy(run), "node long, n long, sketch binary")


def line_classes(lines: DataFrame, most: int, min_chars: int) -> DataFrame:
    """(node, component) of the lines that are linked with a different one."""
    live = materialize(_shared_keys(lines, most, min_chars))
    used = live.select("node").distinct()
    # the texts of lines that share a key, each once
    texts = materialize(maybe_in(lines.select("node", "line"), "node", used).where("_maybe").drop("_maybe").dropDuplicates(["node"]).join(used, "node"))
    facts = materialize(_profile(texts))

    def allow(n, m, d):
        return (np.abs(n - m) <= most) & (d <= 4 * most)

    return connect(live, facts, allow, lambda pairs: materialize(_verify(pairs, texts, most)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 2, min_chars: int = 30) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256, kept_text) of every row: its text
    without the lines of which an earlier document, or line, has one of the class."""
    ship(docs.sparkSession)
    lines = split_lines(docs, id_col, text_col)
    labels = line_classes(lines, most, min_chars)
    own = ["doc_id", "text_hash"]  # rows without an id by their text, so that no two share a list
    places = materialize(lines.select(*own, "at", "node", F.xxhash64("at", "line").alias("mark")))
    classed = salted_join(places, labels, "node").withColumn("class", F.coalesce("component", "node"))
    first = classed.groupBy("class").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    lost = materialize(
        salted_join(classed, first, "class", "inner").where(F.struct("doc_id", "at") > F.col("first"))
        .groupBy(*own).agg(F.collect_set("mark").alias("marks")))
    discard(places)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.xxhash64(text_col)).alias("_own"),
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("lines"))
    lost = lost.select(F.xxhash64(*own).alias("_own"), "marks")
    marked = maybe_in(rows, "_own", lost.select("_own"))
    whole = marked.where("not _maybe").select("doc_id", "lines", F.col("lines").alias("kept"))
    cut = marked.where("_maybe").join(lost, "_own", "left").select(
        "doc_id", "lines",
        F.when(F.col("marks").isNull(), F.col("lines")).otherwise(F.expr("filter(lines, (x, i) -> not array_contains(marks, xxhash64(i, x)))")).alias("kept"))
    text = F.concat_ws("\n", "kept")
    filled = F.size(F.filter("lines", lambda x: x.rlike(_SOMETHING))).cast("long")
    return whole.union(cut).select(
        "doc_id", filled.alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
        F.sha2(text, 256).alias("kept_sha256"), text.alias("kept_text"))

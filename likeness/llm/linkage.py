"""Components of links among items that share keys, without all pairs of a group.

Items (nodes) that share a key are candidates.  In groups of up to SMALL nodes
all candidates are checked.  Larger groups go through three kinds of rounds, and
after each one the links found are verified and contracted to components:

1. *Near*, SWEEPS times: the group is dealt into blocks of about BLOCK nodes by
   another hash each time; in its block every node keeps its nearest and its
   best-connected partner.  Two rows a node, whatever the size of the group.
   Members of one family meet anew in each sweep, so that families spread over
   many blocks grow together.
2. *Best*: of keys whose nodes still differ in component all pairs of blocks
   meet, and every node keeps its nearest partner of each other component.
3. *Rest*: every candidate left between different components.

Of keys that the same nodes have one is kept.  The keys of a group of one block
go where its least node sends them, so that those of a family, which share most
of their nodes, meet in one task; what a task has found is combined before it
leaves: a pair once, of a node the best partners only.

Nodes travel to the tasks, none holds more than two blocks, and a pair only
leaves a task if sizes and sketches allow it; rounds 2 and 3 use the sketches of
the nodes' own size.  Nothing is capped: two nodes that share a key and are
linked always end in one component.  The rows made by rounds 1 grow with the
rows of ``live``, those of round 2 with nodes times components of their group;
only the comparisons of sketches inside the tasks of rounds 2 and 3 grow with
the square of what is still apart.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm import words as W
from likeness.llm.shared import materialize, merge_components, partitions, salted_join, split_join, tidy

SMALL, BLOCK, SWEEPS = 8, 1024, 2
PAIRS = 1 << 20  # of the cells handled at a time, if more than one
COMPARED = 1 << 23  # bytes of sketches compared at a time
HELD = 1 << 19  # found rows that a task holds to combine
HOT = 4096  # rows of a key that a task joins
Allow = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _widths(column: pa.Array) -> np.ndarray:
    """Sketches as rows, folded to the shortest (halves XORed: parities stay)."""
    data, cuts = W.from_binary(column, np.uint8)
    sizes = np.diff(cuts)
    width = int(sizes.min())
    out = np.zeros((len(sizes), width), np.uint8)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        part = data[cuts[rows][:, None] + np.arange(size)]
        while part.shape[1] > width:
            half = part.shape[1] // 2
            part = part[:, :half] ^ part[:, half:]
        out[rows] = part
    return out.view(np.uint64) if width % 8 == 0 else out


class _Found:
    """Rows (x, y, rank, large, of) that a task has found, combined: a pair once;
    of a node the smallest rank by ``of`` (None: a pair of a small group or of round 3)."""

    def __init__(self):
        self.few, self.best, self.held = [], [], 0

    def add(self, x, y, rank, of=None):
        (self.few if of is None else self.best).append((x, y, rank) if of is None else (x, y, rank, of))
        self.held += len(x)
        if self.held >= 2 * HELD:
            self._combine()

    def _combine(self):
        if self.few:
            x, y, rank = (np.concatenate(c) for c in zip(*self.few, strict=True))
            o = np.lexsort((rank, y, x))
            first = o[_rank_first(x[o], y[o])]
            self.few = [(x[first], y[first], rank[first])]
        if self.best:
            x, y, rank, of = (np.concatenate(c) for c in zip(*self.best, strict=True))
            o = np.lexsort((y, rank, of, x))
            first = o[_rank_first(x[o], of[o])]
            self.best = [(x[first], y[first], rank[first], of[first])]
        self.held = sum(len(c[0]) for c in (*self.few, *self.best))

    def batches(self, least: int):
        """What is held, if that is at least so many rows."""
        if not self.held or self.held < least:
            return
        self._combine()
        if self.held < least:
            return
        for large, (x, y, rank, *_) in [*((False, c) for c in self.few), *((True, c) for c in self.best)]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x), pa.array(y), pa.array(rank.astype(np.float64)), pa.array(np.full(len(x), large))],
                names=["x", "y", "rank", "large"])
        self.__init__()


def _rank_first(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins in sorted columns."""
    new = np.append(True, np.zeros(len(columns[0]) - 1, bool)) if len(columns[0]) else np.zeros(0, bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def compare(rows: DataFrame, allow: Allow, step: str, sweep: int = 0) -> DataFrame:
    """Candidates (x, y, rank, large) that size and sketch allow, of rows
    (key, home, node, n, sketch, component, m) that share a key and differ in
    component; m is the size of the key's group, if that is over BLOCK, home a
    value that keys of like groups share.

    ``allow`` takes two arrays of sizes and the Hamming distances of the
    sketches.  ``step``: near, best or rest, as the module says.
    """
    spark = rows.sparkSession
    dealt = rows.withColumn("blocks", F.coalesce(F.ceil(F.col("m") / BLOCK), F.lit(1)).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(sweep)), F.col("blocks")).cast("int"))
    others = F.array("block") if step == "near" else F.sequence(F.lit(0), F.col("blocks") - 1)
    split = dealt.withColumn("other", F.explode(others)).select(
        F.when(F.col("blocks") == 1, F.col("key"))
        .otherwise(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))).alias("cell"),
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
        .cast("byte").alias("side"),
        (F.col("blocks") > 1).alias("large"), "node", "n", "sketch", "component",
        F.when(F.col("blocks") == 1, F.col("home")).alias("home")).withColumn("home", F.coalesce("home", "cell"))

    def groups(batches):
        """Whole groups: batches cut where the cell changes."""
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b] if rest is None else [rest, b]).combine_chunks()
            cell = t.column("cell").to_numpy()
            changes = np.flatnonzero(cell[1:] != cell[:-1])
            last = int(changes[-1]) + 1 if len(changes) else 0
            b = t.to_batches()[0] if len(t) else None
            if b is None:
                continue
            if last:
                yield b.slice(0, last)
            rest = b.slice(last)
        if rest is not None and len(rest):
            yield rest

    def run(batches):
        found = _Found()
        for b in groups(batches):
            cell = b.column(0).to_numpy()
            at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            size = np.diff(np.append(at, len(cell)))
            # whole cells, as many as have PAIRS pairs (one at least)
            pairs, lo = np.concatenate([[0], np.cumsum(size * (size - 1) // 2)]), 0
            while lo < len(at):
                hi = max(lo + 1, int(np.searchsorted(pairs, pairs[lo] + PAIRS, "right")) - 1)
                cells(found, b.slice(int(at[lo]), int(size[lo:hi].sum())), size[lo:hi])
                yield from found.batches(HELD)
                lo = hi
        yield from found.batches(0)

    def cells(into, b, sizes):
        col = {f: b.column(i) for i, f in enumerate(b.schema.names)}
        node, n, comp, side = (col[c].to_numpy() for c in ("node", "n", "component", "side"))
        number = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(sizes)
        large = (sizes[number] > SMALL) | col["large"].to_numpy(zero_copy_only=False)
        after = ends[number] - np.arange(len(b)) - 1
        total = np.concatenate([[0], np.cumsum(after)])
        sk = _widths(col["sketch"])
        most, found, lo = max(1, COMPARED // sk[0].nbytes), [], 0
        while lo < len(b):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + most, "right")) - 1)
            i = np.repeat(np.arange(lo, hi), after[lo:hi])
            j = i + 1 + np.arange(len(i)) - np.repeat(total[lo:hi] - total[lo], after[lo:hi])
            lo = hi
            ok = (comp[i] != comp[j]) & (node[i] != node[j]) & ((side[i] == 0) | (side[i] != side[j]))
            ok &= allow(n[i], n[j], 0)
            i, j = i[ok], j[ok]
            dist = np.bitwise_count(sk[i] ^ sk[j]).sum(1, dtype=np.int64)
            ok = allow(n[i], n[j], dist)
            i, j, dist = i[ok], j[ok], dist[ok]
            found.append((i.astype(np.int32), j.astype(np.int32), (dist / (n[i] + n[j])).astype(np.float32)))
        i, j, near = (np.concatenate(c) for c in zip(*found, strict=True))
        few = ~large[i] | (step == "rest")
        into.add(node[i[few]], node[j[few]], near[few])
        i, j, near = i[~few], j[~few], near[~few]
        if len(i):
            degree = np.bincount(i, minlength=len(b)) + np.bincount(j, minlength=len(b))
            x, y, near = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([near, near])
            # the nearest (of each other component in round 2), and in round 1 the best-connected
            of = comp[y] if step == "best" else np.zeros(len(x), np.int64)
            into.add(node[x], node[y], near, of)
            if step == "near":
                into.add(node[x], node[y], near - degree[y], of + 1)

    return (
        split.repartition(partitions(spark), "home").sortWithinPartitions("home", "cell").drop("home")
        .mapInArrow(tidy(run), "x long, y long, rank double, large boolean")
    )


def _distinct_groups(live: DataFrame) -> DataFrame:
    """(key, home, m) of one of the keys that the same nodes have: home is the
    least node, m the number of rows if over BLOCK.  Groups are told by their
    number of rows and 128 bits of sums of hashes."""
    hashes = [F.xxhash64("node"), F.xxhash64("node", F.lit(1))]
    sums = [F.sum(part).alias(f"h{i}{k}") for i, h in enumerate(hashes) for k, part in enumerate((F.shiftright(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))))]
    groups = live.groupBy("key").agg(F.count("*").alias("m"), F.min("node").alias("home"), *sums)
    same = groups.groupBy("m", "home", *[f"h{i}{k}" for i in range(2) for k in range(2)]).agg(F.min("key").alias("key"))
    return same.select("key", "home", F.when(F.col("m") > BLOCK, F.col("m")).alias("m"))


def connect(live: DataFrame, facts: DataFrame, allow: Allow, links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of the nodes with links; ``live``: (key, node) of keys
    that several nodes have, ``facts``: (node, n, sketch, wide), the sketch of one
    size and that of the node's own, ``links``: the pairs (x, y) of those given
    that are linked indeed."""
    wide = "wide" if "wide" in facts.columns else "sketch"
    distinct = materialize(_distinct_groups(live))
    hot = distinct.where("m is not null").select(F.col("key").alias("node"), F.ceil(F.col("m") / HOT).cast("int").alias("_parts"))
    whole = hot.isEmpty()  # no group of several blocks: the first round sees every pair
    live = materialize(split_join(live, distinct, "key", None if whole else materialize(hot)))
    rows = live.join(facts.select("node", "n", "sketch").withColumn("component", F.col("node")), "node")
    done, labels, step, sweep = None, None, "near", 0
    either = [F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")]
    while True:
        made = materialize(compare(rows, allow, step, sweep))
        pairs, best = made.where("not large").select(*either), made.where("large")
        if step == "near":  # over all its keys, two for a node
            best = best.withColumn("hub", F.col("rank") < 0).groupBy("x", "hub").agg(F.min(F.struct("rank", "y")).alias("best")).select("x", F.col("best.y").alias("y"))
        pairs = pairs.union(best.select(*either)).distinct()
        if done is not None:
            pairs = pairs.join(done, ["x", "y"], "left_anti")
        pairs = materialize(pairs)
        if not pairs.isEmpty():
            done = pairs if done is None else done.union(pairs)
            labels = merge_components(labels, links(pairs))
        if step == "rest" or (whole or step == "best") and made.isEmpty():
            break
        mine = live.drop("m").withColumn("component", F.col("node")) if labels is None else live.drop("m").join(labels, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        still = materialize(
            mine.groupBy("key").agg(F.count("*").alias("m"), F.min("component").alias("a"), F.max("component").alias("b"))
            .where((F.col("m") > SMALL) & (F.col("a") != F.col("b"))).select("key", "m"))
        apart, sketch = still.where(F.col("m") > BLOCK), "sketch"  # groups of one block met already
        if step == "near" and sweep + 1 < SWEEPS and not apart.isEmpty():
            sweep += 1
        else:
            step, apart, sketch = "best" if step == "near" else "rest", still, wide
            if still.isEmpty():
                break
        held = salted_join(mine, apart.select("key", F.when(F.col("m") > BLOCK, F.col("m")).alias("m")), "key", "inner")
        rows = held.join(facts.select("node", "n", F.col(sketch).alias("sketch")), "node")
    return live.sparkSession.createDataFrame([], "node long, component long") if labels is None else labels

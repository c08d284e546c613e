"""Operator 13: approximate nearest neighbours by 2-stable projections and kd-trees.

Vectors are projected to ``m`` dimensions by a matrix of normal variables.  The
normal distribution is 2-stable: of two vectors at distance s, the squared
distance of the projections divided by s^2 is chi-square with m degrees of
freedom.  So a search that walks the projections by growing distance r may stop
as soon as r^2 exceeds chi2(p, m) d^2, with d the k-th smallest distance verified
so far: any true neighbour not seen by then, whose distance is below d, has a
projection beyond r with probability below 1 - p.

The index.  A kd-tree over the projections of a bounded sample (``sample`` rows)
deals all rows to at most sample / 16 cells; a cell is dealt to blocks of about
``block`` rows by the hash of the vector.  Each block holds all its vectors, with a
kd-tree of its own over their projections, as one row of a written table.  Of
equal vectors only the k + 1 smallest ids are held, as no other can be in a
result: a query ranks at least k of these before it.

The search.  A query first walks the block that it falls into, in the task that
builds it, which bounds its k-th distance; then it is sent to the blocks of all
cells whose box is within the stopping radius of that bound, and walks each
until the test holds there.  Every walk computes exact distances of the original
vectors in double precision.  Equal query vectors are searched once.

How many vectors a query verifies depends on the data: in data without
structure, whose distances hardly differ, the test holds late, and a large part
of the index is verified.

Takes no part: a null vector, one without components, of zeros only, or with a
null or not finite component, and a row with a null id.  Vectors of different
lengths are never compared.  Repeated rows count once; different vectors under
one id are candidates of their own.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.llm.shared import materialize, partitions, salted_join, ship, tidy

DIMS, CHANCE, SAMPLE, BLOCK, LEAF, SEED = 8, 0.95, 1 << 16, 1 << 15, 128, 13
LEAST = 1024  # rows of a block, where all are fewer than the tasks could hold


def chi2(p: float, m: int) -> float:
    """The p-quantile of the chi-square distribution with an even number m of
    degrees of freedom."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        x = (lo + hi) / 2
        term = total = 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        lo, hi = (x, hi) if 1 - math.exp(-x / 2) * total < p else (lo, x)
    return hi


def stable(length: int, m: int) -> np.ndarray:
    """The projection of vectors of ``length`` components; the same everywhere."""
    return np.random.default_rng([SEED, length, m]).standard_normal((length, m))


class KdTree:
    """Splits of points at medians of their widest dimension, down to ``leaf`` points."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # (first, last, dimension or -1, cut, left, right)
        boxes = []
        todo = [(0, len(points), -1, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            if parent >= 0:
                self.nodes[parent][4 + side] = len(self.nodes)
            mine = points[self.order[lo:hi]]
            low, high = mine.min(0), mine.max(0)
            dim = int(np.argmax(high - low))
            node = [lo, hi, -1, 0.0, -1, -1]
            if hi - lo > leaf and high[dim] > low[dim]:
                x = mine[:, dim]
                cut = np.partition(x, len(x) // 2)[len(x) // 2]
                if cut == low[dim]:  # at least one point goes left
                    cut = x[x > cut].min()
                left = x < cut
                self.order[lo:hi] = np.concatenate([self.order[lo:hi][left], self.order[lo:hi][~left]])
                mid = lo + int(left.sum())
                node[2:4] = dim, float(cut)
                todo += [(mid, hi, len(self.nodes), 1), (lo, mid, len(self.nodes), 0)]
            self.nodes.append(node)
            boxes.append((low, high))
        self.low, self.high = (np.array([b[i] for b in boxes]) for i in (0, 1))

    def walk(self, q: np.ndarray):
        """(least squared distance, first, last) of the leaves, nearest first."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0)
        least = (gap * gap).sum(1)
        heap = [(least[0], 0)]
        while heap:
            r, at = heapq.heappop(heap)
            lo, hi, dim, _, left, right = self.nodes[at]
            if dim < 0:
                yield r, lo, hi
            else:
                heapq.heappush(heap, (least[left], left))
                heapq.heappush(heap, (least[right], right))


class Cells:
    """The kd-tree of a sample's projections, for vectors of one length."""

    def __init__(self, points: np.ndarray, cells: int):
        points = np.unique(points, axis=0)
        self.nodes = np.array(KdTree(points, max(1, -(-len(points) // cells))).nodes, float)

    def of(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        while True:
            dim = self.nodes[at, 2].astype(np.int64)
            inner = np.flatnonzero(dim >= 0)
            if not len(inner):
                return at
            here = at[inner]
            right = points[inner, dim[inner]] >= self.nodes[here, 3]
            at[inner] = np.where(right, self.nodes[here, 5], self.nodes[here, 4]).astype(np.int64)


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and cuts of a list column without nulls."""
    offs = np.asarray(column.offsets)
    return column.values.to_numpy(zero_copy_only=False)[offs[0] : offs[-1]], offs - offs[0]


def _by_length(column: pa.Array):
    """(length, rows, vectors in double precision) of a list column."""
    values, cuts = _matrix(column)
    sizes = np.diff(cuts)
    for length in np.unique(sizes):
        rows = np.flatnonzero(sizes == length)
        yield int(length), rows, values[cuts[rows][:, None] + np.arange(length)].astype(np.float64)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part; -0.0 is 0.0."""
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    v = F.col("vector")
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector")).where(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    ).withColumn("vector", F.transform(v, lambda x: (x + F.lit(0).cast(kind)).cast(kind)))


def _sample(rows: DataFrame, total: int, size: int, m: int) -> dict[int, np.ndarray]:
    """Projections of about ``size`` rows, by length of the vector."""

    def run(batches):
        for b in batches:
            for length, _, x in _by_length(b.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), length)), pa.array(list(x @ stable(length, m)), pa.list_(pa.float64()))], names=["length", "point"])

    share = 1 << 30
    picked = rows.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(share)) < F.lit(int(share * min(1.0, size / max(total, 1)))))
    t = picked.select("vector").mapInArrow(tidy(run), "length long, point array<double>").limit(2 * size).toArrow().combine_chunks()
    lengths = t.column("length").to_numpy()
    points = np.array(t.column("point").to_pylist(), float).reshape(-1, m)
    return {int(n): points[lengths == n] for n in np.unique(lengths)}


class _Search:
    """One block: vectors, their ids (of equal vectors the smallest), kd-tree."""

    def __init__(self, x: np.ndarray, ids: list[np.ndarray], m: int):
        self.project = stable(x.shape[1], m)
        p = x @ self.project
        self.tree = KdTree(p, LEAF)
        o = self.tree.order
        self.x, self.p, self.ids = x[o], p[o], [ids[i] for i in o]

    def nearest(self, q: np.ndarray, k: int, bound: float, limit: float) -> list[tuple[float, int]]:
        """The k (distance, id) nearest to q that the walk verifies, none beyond ``bound``."""
        at = q @ self.project
        found: list[tuple[float, int]] = []
        for r, lo, hi in self.tree.walk(at):
            reach = limit * bound * bound
            if r > reach:
                break
            d = self.p[lo:hi] - at
            near = np.flatnonzero((d * d).sum(1) <= reach) if reach < math.inf else np.arange(hi - lo)
            d = self.x[lo + near] - q
            s = np.sqrt((d * d).sum(1))
            ok = np.flatnonzero(s <= bound)
            if len(ok):
                found += [(float(s[i]), int(v)) for i in ok for v in self.ids[lo + near[i]]]
                found = heapq.nsmallest(k, found)
                if len(found) == k:
                    bound = min(bound, found[-1][0])
        return found


def _grouped(batches, keys: int):
    """Batches cut so that none splits a run of equal first ``keys`` columns."""
    rest = None
    for b in batches:
        t = b if rest is None else pa.Table.from_batches([rest, b]).combine_chunks().to_batches()[0]
        at = _starts(t, keys)
        if len(at) > 1:
            yield t.slice(0, int(at[-1]))
            t = t.slice(int(at[-1]))
        rest = t if len(t) else None
    if rest is not None:
        yield rest


def _starts(t, keys: int) -> np.ndarray:
    if not len(t):
        return np.zeros(0, np.int64)
    new = np.zeros(len(t), bool)
    new[0] = True
    for i in range(keys):
        c = t.column(i).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _deal(rows: DataFrame, queries: DataFrame, cells, salts: int, m: int, k: int) -> DataFrame:
    """Vectors and queries, each with the block it falls into.  Of equal vectors
    a task passes on the k + 1 smallest ids that it has met so far."""

    def run(batches, kind):
        met: dict[bytes, list[int]] = {}
        for b in batches:
            ids = b.column(0).to_numpy()
            for length, at, x in _by_length(b.column(1)):
                cell = cells.value[length].of(x @ stable(length, m)) if length in cells.value else np.zeros(len(x), np.int64)
                salt = b.column(2).to_numpy()[at] % salts
                keep = np.ones(len(x), bool)
                if kind == 0:
                    for i in range(len(x)):
                        have = met.setdefault(x[i].tobytes(), [])
                        v = int(ids[at[i]])
                        if v in have or (len(have) > k and v > have[-1]):
                            keep[i] = False
                        else:
                            have.append(v)
                            have.sort()
                            del have[k + 1 :]
                x, at, cell, salt = x[keep], at[keep], cell[keep], salt[keep]
                n = len(x)
                for lo in range(0, n, 8192):
                    hi = min(n, lo + 8192)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(hi - lo, length)), pa.array(cell[lo:hi]), pa.array(salt[lo:hi]), pa.array(np.full(hi - lo, kind, np.int32)),
                         pa.array(ids[at[lo:hi]]),
                         pa.ListArray.from_arrays(pa.array((np.arange(hi - lo + 1) * length).astype(np.int32)), pa.array(x[lo:hi].reshape(-1)))],
                        names=["length", "cell", "salt", "kind", "id", "vector"])
            if len(met) > 1 << 16:  # forgetting only passes on more
                met.clear()

    hashed = F.pmod(F.xxhash64("vector"), F.lit(1 << 40)).alias("hash")
    schema = "length long, cell long, salt long, kind int, id long, vector array<double>"
    return rows.select("vec_id", "vector", hashed).mapInArrow(tidy(lambda b: run(b, 0)), schema).union(
        queries.select("vec_id", "vector", hashed).mapInArrow(tidy(lambda b: run(b, 1)), schema))


def _pack(lists: list[np.ndarray]) -> tuple[bytes, bytes]:
    return np.array([len(x) for x in lists], np.int32).tobytes(), np.concatenate(lists).astype(np.int64).tobytes()


def _build(dealt: DataFrame, m: int, k: int, limit: float) -> DataFrame:
    """Blocks (kind 0) with their box, and queries (kind 1) with what their own
    block has for them."""

    def run(batches):
        def blocks():
            """Vectors and queries of one block after the other."""
            for t in _grouped(batches, 3):
                at = _starts(t, 3)
                for lo, hi in zip(at, np.append(at[1:], len(t)), strict=True):
                    yield t.slice(int(lo), int(hi - lo))

        for t in blocks():
            length, cell, salt = (t.column(i)[0].as_py() for i in range(3))
            kind, ids = t.column(3).to_numpy(), t.column(4).to_numpy()
            x = _matrix(t.column(5))[0].reshape(len(t), length)
            data = np.flatnonzero(kind == 0)
            search = None
            if len(data):
                o = data[np.lexsort((ids[data], *x[data].T[::-1]))] if len(data) > 1 else data
                new = np.append(True, (x[o][1:] != x[o][:-1]).any(1))
                first = np.flatnonzero(new)
                own = [np.unique(ids[o[a:b]])[: k + 1] for a, b in zip(first, np.append(first[1:], len(o)), strict=True)]
                search = _Search(x[o[first]], own, m)
                sizes, flat = _pack(search.ids)
                yield pa.RecordBatch.from_pylist([{
                    "length": length, "cell": cell, "salt": salt, "kind": 0, "vectors": search.x.tobytes(), "sizes": sizes, "ids": flat,
                    "low": search.p.min(0).tolist(), "high": search.p.max(0).tolist()}], schema=_BLOCK)
            out = []
            for i in np.flatnonzero(kind == 1):
                found = search.nearest(x[i], k + 1, math.inf, limit) if search else []
                out.append({
                    "length": length, "cell": cell, "salt": salt, "kind": 1, "query": int(ids[i]), "vector": x[i].tolist(),
                    "bound": found[k][0] if len(found) > k else math.inf, "found": [{"score": s, "vec_id": v} for s, v in found]})
                if len(out) == 1024:
                    yield pa.RecordBatch.from_pylist(out, schema=_BLOCK)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_BLOCK)

    spark = dealt.sparkSession
    keys = ["length", "cell", "salt"]
    return dealt.repartition(partitions(spark), *keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), _BLOCK_SQL)


_FOUND = pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())]))
_BLOCK = pa.schema([
    ("length", pa.int64()), ("cell", pa.int64()), ("salt", pa.int64()), ("kind", pa.int32()), ("vectors", pa.binary()), ("sizes", pa.binary()),
    ("ids", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("query", pa.int64()),
    ("vector", pa.list_(pa.float64())), ("bound", pa.float64()), ("found", _FOUND)])
_BLOCK_SQL = (
    "length long, cell long, salt long, kind int, vectors binary, sizes binary, ids binary, low array<double>, high array<double>,"
    " query long, vector array<double>, bound double, found array<struct<score: double, vec_id: long>>")


def _route(queries: DataFrame, boxes, m: int, limit: float) -> DataFrame:
    """(length, cell, salt, kind 1, query, vector, bound) of the blocks, other than
    its own, that a query has to walk."""

    def run(batches):
        for b in batches:
            col = {f: b.column(i) for i, f in enumerate(b.schema.names)}
            own, salt, bound, query = (col[c].to_numpy() for c in ("cell", "salt", "bound", "query"))
            for length, rows, x in _by_length(col["vector"]):
                cells, n_salts, low, high = boxes.value[length]
                p = x @ stable(length, m)
                for lo in range(0, len(rows), max(1, (1 << 20) // len(cells))):
                    part = slice(lo, lo + max(1, (1 << 20) // len(cells)))
                    gap = np.zeros((len(rows[part]), len(cells)))
                    for d in range(m):
                        g = np.maximum(np.maximum(low[None, :, d] - p[part, None, d], p[part, None, d] - high[None, :, d]), 0)
                        gap += g * g
                    i, c = np.nonzero(gap <= limit * bound[rows[part], None] ** 2)
                    i, c = np.repeat(i, n_salts[c]), np.repeat(c, n_salts[c])
                    s = np.arange(len(i)) - np.searchsorted(i * len(cells) + c, i * len(cells) + c)
                    r = rows[part][i]
                    other = (cells[c] != own[r]) | (s != salt[r])
                    r, c, s = r[other], c[other], s[other]
                    for at in range(0, len(r), 4096):
                        rr = r[at : at + 4096]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(rr), length)), pa.array(cells[c[at : at + 4096]]), pa.array(s[at : at + 4096]),
                             pa.array(query[rr]), col["vector"].take(pa.array(rr)), pa.array(bound[rr])],
                            names=["length", "cell", "salt", "query", "vector", "bound"])

    return queries.select("length", "cell", "salt", "query", "vector", "bound").mapInArrow(
        tidy(run), "length long, cell long, salt long, query long, vector array<double>, bound double")


def _walk(index: DataFrame, routed: DataFrame, m: int, k: int, limit: float) -> DataFrame:
    """(query, found) of every routed query in its block."""

    def run(batches):
        key, search = None, None
        for b in batches:
            col = {f: b.column(i) for i, f in enumerate(b.schema.names)}
            keys = np.stack([col[c].to_numpy() for c in ("length", "cell", "salt")], 1)
            kind, bound, query = col["kind"].to_numpy(), col["bound"].to_numpy(zero_copy_only=False), col["query"].to_numpy(zero_copy_only=False)
            out = []
            for i in range(len(b)):
                if kind[i] == 0:
                    x = np.frombuffer(col["vectors"][i].as_py()).reshape(-1, keys[i, 0])
                    sizes = np.frombuffer(col["sizes"][i].as_py(), np.int32)
                    key, search = tuple(keys[i]), _Search(x, np.split(np.frombuffer(col["ids"][i].as_py(), np.int64), np.cumsum(sizes)[:-1]), m)
                elif key == tuple(keys[i]):
                    found = search.nearest(np.array(col["vector"][i].as_py()), k + 1, float(bound[i]), limit)
                    if found:
                        out.append({"query": int(query[i]), "found": [{"score": s, "vec_id": v} for s, v in found]})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("query", pa.int64()), ("found", _FOUND)]))

    spark = index.sparkSession
    keys = ["length", "cell", "salt"]
    both = index.select(*keys, "kind", "vectors", "sizes", "ids").unionByName(
        routed.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition(partitions(spark), *keys).sortWithinPartitions(*keys, "kind").mapInArrow(
        tidy(run), "query long, found array<struct<score: double, vec_id: long>>")


def nearest(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    m: int = DIMS, chance: float = CHANCE, sample: int = SAMPLE, block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` found nearest to
    each row of ``queries`` (same columns), its own id left out.  ``chance`` is the least
    probability with which each true neighbour is found; ``m`` must be even."""
    spark = vectors.sparkSession
    ship(spark)
    limit = chi2(chance, m)
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    total = rows.count()
    least = max(1, min(block, max(LEAST, total // partitions(spark))))
    points = _sample(rows, total, sample, m)
    n = max(1, sum(map(len, points.values())))
    cells = {length: Cells(p, max(1, min(-(-total * len(p) // n // least), sample // 16))) for length, p in points.items()}
    leaves = sum(int((c.nodes[:, 2] < 0).sum()) for c in cells.values()) or 1
    salts = max(1, -(-total // (leaves * 2 * block)))
    # equal query vectors are searched once, under their smallest id
    asked = materialize(asked.distinct())
    one = asked.groupBy("vector").agg(F.min("vec_id").alias("vec_id"))
    built = materialize(_build(_deal(rows, one, spark.sparkContext.broadcast(cells), salts, m, k), m, k, limit))
    index, mine = built.where("kind = 0"), built.where("kind = 1")
    # a box for each cell: at most sample / 16 of a length
    boxes: dict[int, tuple] = {}
    per_cell = index.groupBy("length", "cell").agg(
        (F.max("salt") + 1).alias("salts"), *[F.min(F.col("low")[d]).alias(f"low{d}") for d in range(m)],
        *[F.max(F.col("high")[d]).alias(f"high{d}") for d in range(m)]).toPandas()
    for length, part in per_cell.groupby("length"):
        boxes[int(length)] = (
            part["cell"].to_numpy(), part["salts"].to_numpy(), part[[f"low{d}" for d in range(m)]].to_numpy(), part[[f"high{d}" for d in range(m)]].to_numpy())
    routed = _route(mine.where(F.col("length").isin(list(boxes))), spark.sparkContext.broadcast(boxes), m, limit)
    found = mine.select("query", "found").union(_walk(index, routed, m, k, limit))
    # a query's lists, one of each block, are merged; no more than k + 1 remain of each
    best = (
        found.select("query", F.explode("found").alias("f")).select("query", "f.*")
        .withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))).where(F.col("place") <= k + 1)
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("found"))
    )
    lists = one.select("vector", F.col("vec_id").alias("query")).join(best, "query").select("vector", "found")
    return salted_join(asked.withColumnRenamed("vec_id", "query_id"), lists, ["vector"], "inner").select(
        "query_id", F.posexplode(F.slice(F.filter("found", lambda x: x.vec_id != F.col("query_id")), 1, k)).alias("at", "f")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))


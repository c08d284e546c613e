"""Pairs of ids whose vectors are dense: compared block by block.

Where most pairs share elements or buckets, a row for each shared element or
bucket is far more than the pairs themselves.  Here an id is one row (its
vector, of at most ``DENSE_CODES`` coordinates, and whatever tells candidates),
ids are cut into blocks, and a task takes a pair of blocks and multiplies their
matrices: what is moved are the ids times the blocks, and only pairs that are
results become rows.  Exact, as the joins that it stands in for.

Sets are compared the same way (``set_pairs``): an id is one row with its bitmap,
or with a parity sketch (see ``bitmaps``) as wide as its set needs, and its band
keys if it must meet in one.  Blocks are runs of the ids in order of size, so
that blocks whose sizes do not allow the threshold never meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.functions.encoding import numbered
from likeness.session import materialize

DENSE_CODES = 1 << 14  # elements at most, so that a vector is a bounded row
BLOCK_IDS = 2048
STRIP = 256  # rows of a block that are compared at a time
COLUMNS = 1024  # coordinates that are multiplied at a time
SET_IDS = 1 << 16  # ids of a block of sets at most
KEY_IDS = (1 << 15) - 1  # the same where only keys are compared: the keys of two blocks are numbered with 16 bits
BLOCK_BYTES = 1 << 25  # of the bitmaps, sketches and keys of a block of sets
SET_COLUMNS = 4096  # sets that a strip is compared with at a time
SET_STRIP = 32  # sets of a block that are compared at a time
EXACT_CODES = 1024  # elements at most that a bitmap in a row has
SKETCH_MOST = 512  # words of 64 cells that a sketch has at most


def finite(norms: DataFrame) -> bool:
    """Whether no norm is infinite or NaN: only then zeros may stand for absent coordinates."""
    return norms.where("not (nsq < double('infinity'))").isEmpty()


def dense_cosine(
    coded: DataFrame, norms: DataFrame, threshold: float, marks=None,
    probes: str | None = None, block: int = BLOCK_IDS,
) -> DataFrame:
    """(id_1, id_2, similarity), id_1 < id_2, of all pairs with cosine >= threshold.

    ``coded`` holds (id, code, value), ``norms`` (id, nsq).  With ``marks`` (of
    ``lsh``: rows (id, s0..., m0...), one an id), only pairs with a field in which
    the s agree outside of the bits of either m.  With ``probes``, SQL on ``id``,
    only pairs with such an id.
    """
    lists = coded.where("value is not null").groupBy("id").agg(
        F.collect_list(F.struct(F.col("code").cast("int").alias("code"), F.col("value").cast("double").alias("value"))).alias("_v"))
    rows = lists.join(norms.where("nsq > 0"), "id").where("id is not null").select(
        "id", F.sqrt("nsq").alias("norm"), F.col("_v.code").alias("codes"), F.col("_v.value").alias("values"),
        (F.expr(probes) if probes else F.lit(True)).alias("probe"))
    words, fields = 0, []
    if marks is not None:
        rows, words = rows.join(marks.rows, "id"), marks.words
        fields = marks.fields()
    n = max(1, -(-norms.count() // block))
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    # a block meets every other and itself; a row says of which side it is
    both = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(
        F.least("_b", "_o").alias("_bi"), F.greatest("_b", "_o").alias("_bj"), (F.col("_b") > F.col("_o")).alias("right"), *rows.columns[:-1])
    strip, columns = STRIP, COLUMNS

    def pairs(table):  # a closure of its own, so that workers need no package
        right = table.column("right").to_numpy()
        sides = [table.filter(pa.array(~right)).combine_chunks(), table.filter(pa.array(right)).combine_chunks()]
        alone = len(sides[1]) == 0 and table.column("_bi")[0] == table.column("_bj")[0]
        if alone:
            sides[1] = sides[0]

        def flat(t, name):
            lists_ = t.column(name).combine_chunks()
            lists_ = lists_.chunk(0) if isinstance(lists_, pa.ChunkedArray) else lists_
            return lists_.flatten().to_numpy(zero_copy_only=False), np.diff(lists_.offsets.to_numpy())

        out = [[], [], []]
        if len(sides[0]) and len(sides[1]):
            cells = []
            for t in sides:
                codes, sizes = flat(t, "codes")
                cells.append((np.repeat(np.arange(len(t)), sizes), codes, flat(t, "values")[0]))
            known = np.unique(np.concatenate([c[1] for c in cells]))
            dots = np.zeros((len(sides[0]), len(sides[1])))
            for at in range(0, len(known), columns):
                some = known[at : at + columns]
                parts = []
                for t, (row, code, value) in zip(sides, cells, strict=True):
                    m = (code >= some[0]) & (code <= some[-1])
                    place = row[m] * len(some) + np.searchsorted(some, code[m])
                    parts.append(np.bincount(place, value[m], len(t) * len(some)).reshape(len(t), len(some)))
                dots += parts[0] @ parts[1].T
            norm, probe = ([t.column(c).to_numpy() for t in sides] for c in ("norm", "probe"))
            sign, free = ([[t.column(f"{c}{w}").to_numpy() for w in range(words)] for t in sides] for c in "sm")
            for a in range(0, len(dots), strip):
                cut = slice(a, a + strip)
                score = dots[cut] / (norm[0][cut, None] * norm[1])
                ok = (score >= threshold) & (probe[0][cut, None] | probe[1])
                if alone:
                    ok &= np.arange(len(dots))[cut, None] < np.arange(len(dots))
                i, j = np.nonzero(ok)
                if words:
                    met = np.zeros(len(i), bool)
                    for w in range(words):
                        x = (sign[0][w][cut][i] ^ sign[1][w][j]) & ~(free[0][w][cut][i] | free[1][w][j])
                        low, high = fields[w]
                        met |= ((x - low) & ~x & high) != 0  # a field of zeros
                    i, j = i[met], j[met]
                out[0].append(i + a)
                out[1].append(j)
                out[2].append(score[i, j])
        i, j, score = (np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, (np.int64, np.int64, float), strict=True))
        return pa.table({"a": sides[0].column("id").take(pa.array(i)), "b": sides[1].column("id").take(pa.array(j)), "similarity": pa.array(score)})

    kind = rows.schema["id"].dataType.simpleString()
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n * n // 16)
    found = both.repartition(parts, "_bi", "_bj").groupBy("_bi", "_bj").applyInArrow(pairs, f"a {kind}, b {kind}, similarity double")
    return found.select(F.least("a", "b").alias("id_1"), F.greatest("a", "b").alias("id_2"), "similarity")


def exact_words(n_codes: int) -> int | None:
    """The words of bitmaps of ``n_codes`` codes, None if these are too many for a row."""
    return max(1, -(-n_codes // 64)) if n_codes <= EXACT_CODES else None


def set_bits(sets: DataFrame, sizes: DataFrame, cell: str, words: int | None = None) -> DataFrame:
    """(id, n, bits) of the ids in ``sizes`` (id, n), from distinct rows of ``sets``.

    With ``words``, bits are the bitmap of the set, ``cell`` its code.  Else they
    are a parity sketch of 3 to 6 cells an element, at most ``SKETCH_MOST`` words
    of 64, ``cell`` being the hash that places an element.  Numbers of words are
    powers of two, so that a wide sketch folds to a narrow one."""
    at = cell if words else f"({cell}) & {SKETCH_MOST * 64 - 1}"
    most = words or SKETCH_MOST
    rows = sets.select("id", F.expr(at).alias("_h")).groupBy("id", F.expr("cast(shiftright(_h, 6) as int)").alias("_w")).agg(
        F.expr("bit_xor(shiftleft(1L, cast(_h & 63 as int)))").alias("_x"))
    width = f"{words}" if words else f"least({most}, shiftleft(1, cast(ceil(log2(greatest(n * 3 / 64.0, 4))) as int)))"
    wide = rows.join(sizes.select("id", "n"), "id").withColumn("_width", F.expr(width))
    place = "_w" if words else "_w & (_width - 1)"
    folded = wide.groupBy("id", "n", "_width", F.expr(place).alias("_w")).agg(F.expr("bit_xor(_x)").alias("_x"))
    cells = folded.groupBy("id", "n", "_width").agg(F.map_from_entries(F.collect_list(F.struct("_w", "_x"))).alias("_m"))
    return cells.select("id", "n", F.expr("transform(sequence(0, _width - 1), w -> coalesce(_m[w], 0L))").alias("bits"))


def set_pairs(
    rows: DataFrame, threshold: float | None = None, exact: bool = False, probes: str | None = None, keys: int = 0,
    block: int | None = None,
) -> DataFrame:
    """(id_1, id_2, n_1, n_2, similarity), id_1 < id_2, of the pairs of ``rows`` (id, n, ...).

    With a ``threshold``, pairs whose sizes and ``bits`` allow this Jaccard
    similarity; ``exact`` says that bits are bitmaps: then similarity is exact and
    reaches it, else it is NULL.  With ``keys``, the longs of a band, only pairs
    that have all keys of a band alike (``keys``: array of all bands); without a
    threshold just (id_1, id_2).  With ``probes``, SQL on ``id``, only pairs with
    such an id.

    An id is copied once for each block that its own meets, so blocks are as
    large as a task can hold: by ids, and by the bytes of rows of their width.
    """
    rows = materialize(rows.where("id is not null").withColumn("probe", F.expr(probes) if probes else F.lit(True)))
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if block is None:  # enough blocks that their pairs occupy all tasks
        block = min(KEY_IDS if threshold is None else SET_IDS, max(SET_STRIP, -(-rows.count() // (2 * math.isqrt(2 * n_parts) + 1))))
    # rows of a width are a run of the ids, as sketches are the wider the larger their set
    longs = " + ".join([*[f"size({c})" for c in ("bits", "keys") if c in rows.columns], "4"])
    at = numbered(rows, [F.col("n"), F.col("id")], "_at").withColumn("_w", F.expr(longs).cast("long"))
    at = at.withColumn("_b", F.expr(f"shiftleft(_w, 40) + _at div least({block}L, greatest({SET_STRIP}L, {BLOCK_BYTES}L div (8 * _w)))"))
    at = materialize(at.drop("_at", "_w"))
    spans = materialize(at.groupBy("_b").agg(F.min("n").alias("_low"), F.max("n").alias("_high")))
    # a block meets itself and all whose sizes allow it; a row says of which side it is
    fits = F.lit(True) if threshold is None else F.col("_high") >= F.col("_least") * F.lit(threshold) - F.lit(1e-9)
    met = spans.select(F.col("_b").alias("_bi"), "_high").join(
        spans.select(F.col("_b").alias("_bj"), F.col("_low").alias("_least")), (F.col("_bi") <= F.col("_bj")) & fits).select("_bi", "_bj")
    met = materialize(met)
    left = at.join(met, at["_b"] == met["_bi"]).drop("_b").withColumn("right", F.lit(False))
    right = at.join(met.where("_bi < _bj"), at["_b"] == met["_bj"]).drop("_b").withColumn("right", F.lit(True))
    both = left.unionByName(right)
    strip, columns, share = SET_STRIP, SET_COLUMNS, 0.0 if threshold is None else (1 - threshold) / (1 + threshold)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # a closure of its own, so that workers need no package
        table = pa.Table.from_batches(list(batches)).sort_by("n")
        other = table.column("right").to_numpy()
        sides = [table.filter(pa.array(~other)), table.filter(pa.array(other))]
        alone = table.column("_bi")[0] == table.column("_bj")[0]
        if alone:
            sides[1] = sides[0]

        def flat(t, name):
            lists = t.column(name).combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())

        ids = [t.column("id").combine_chunks() for t in sides]
        size, probe = ([t.column(c).to_numpy() for t in sides] for c in ("n", "probe"))
        if not len(ids[0]) or not len(ids[1]):
            return
        bands = None
        if keys:  # the keys of a band are numbered, those of both sides together
            m = [flat(t, "keys")[0].reshape(len(t), -1, keys) for t in sides]
            m = np.concatenate(m)
            bands = np.zeros((m.shape[1], m.shape[0]), np.uint16 if len(m) < 1 << 16 else np.uint32)
            for band in range(m.shape[1]):
                code = np.unique(m[:, band, 0], return_inverse=True)[1]
                for k in range(1, keys):
                    code = np.unique(code * len(m) + np.unique(m[:, band, k], return_inverse=True)[1], return_inverse=True)[1]
                bands[band] = code
            bands = [bands[:, : len(ids[0])], np.ascontiguousarray(bands[:, len(ids[0]):])]
        if threshold is not None:
            # unsigned: numpy counts the bits of a signed number's absolute value
            words = [(value.view(np.uint64), widths) for value, widths in (flat(t, "bits") for t in sides)]
            begin = [np.concatenate([[0], np.cumsum(w[1])]) for w in words]
            low = [np.floor(x * share).astype(np.int64) for x in size]
            kind = np.int16 if max(int(x[-1]) for x in size) < 8000 else np.int32
            folds = [{}, {}]

            def fold(side, width):
                """The first row whose words are at least ``width``, and all from there on, folded."""
                if width not in folds[side]:
                    value, widths = words[side]
                    first = int(np.searchsorted(widths, width))
                    parts = [value[begin[side][a]: begin[side][b]].reshape(b - a, w // width, width) for w in np.unique(widths[first:])
                             for a, b in [np.searchsorted(widths, [w, w + 1])]]
                    folds[side][width] = first, np.ascontiguousarray(np.concatenate([np.bitwise_xor.reduce(x, axis=1) for x in parts]).T)
                return folds[side][width]

        for a in range(0, len(ids[0]), strip):
            end = min(a + strip, len(ids[0]))
            for c in range(a if alone else 0, len(ids[1]), columns):
                to = min(c + columns, len(ids[1]))
                if threshold is None:
                    ok = np.zeros((end - a, to - c), bool)
                    same = np.empty_like(ok)
                    for mine, others in zip(*bands, strict=True):
                        np.logical_or(ok, np.equal(mine[a:end, None], others[None, c:to], out=same), out=ok)
                else:
                    # the sizes of a strip allow a run of sizes
                    c0 = c + int(np.searchsorted(size[1][c:to], size[0][a] * threshold - 1e-6))
                    to = c + int(np.searchsorted(size[1][c:to], size[0][end - 1] / threshold + 1e-6, side="right"))
                    if c0 >= to:
                        continue
                    c = c0
                    width = int(min(words[0][1][a], words[1][1][c]))
                    (f0, x0), (f1, x1) = fold(0, width), fold(1, width)
                    # difference less what the sizes allow, one too much for each at most
                    far = np.empty((end - a, to - c), kind)
                    far[:] = (-low[0][a:end, None] - 1).astype(kind)
                    far -= (low[1][None, c:to] + 1).astype(kind)
                    x, bits = np.empty(far.shape, np.uint64), np.empty(far.shape, np.uint8)
                    for w in range(width):
                        np.bitwise_xor(x0[w, a - f0: end - f0, None], x1[None, w, c - f1: to - f1], out=x)
                        np.add(far, np.bitwise_count(x, out=bits), out=far, casting="unsafe")
                    ok = far <= 0
                if probes is not None:
                    ok &= probe[0][a:end, None] | probe[1][None, c:to]
                if alone:
                    ok &= np.arange(a, end)[:, None] < np.arange(c, to)
                i, j = np.nonzero(ok)
                score = None
                if threshold is not None:
                    n1, n2 = size[0][a + i], size[1][c + j]
                    different = far[i, j].astype(np.int64) + low[0][a + i] + low[1][c + j] + 2
                    if exact:
                        common = (n1 + n2 - different) // 2
                        score = common / (n1 + n2 - common)
                        good = score >= threshold
                    else:
                        good = (different <= (n1 + n2) * share + 1e-9) & (np.minimum(n1, n2) >= np.maximum(n1, n2) * threshold - 1e-9)
                    i, j, score = i[good], j[good], score[good] if exact else None
                    if keys:
                        met_ = np.zeros(len(i), bool)
                        for mine, others in zip(*bands, strict=True):
                            met_ |= mine[a + i] == others[c + j]
                        i, j = i[met_], j[met_]
                        score = score[met_] if exact else None
                if len(i) and threshold is None:
                    yield pa.RecordBatch.from_arrays([ids[0].take(pa.array(a + i)), ids[1].take(pa.array(c + j))], ["a", "b"])
                elif len(i):
                    i, j = a + i, c + j
                    yield pa.RecordBatch.from_arrays([
                        ids[0].take(pa.array(i)), ids[1].take(pa.array(j)), pa.array(size[0][i]), pa.array(size[1][j]),
                        pa.nulls(len(i), pa.float64()) if score is None else pa.array(score)], ["a", "b", "na", "nb", "similarity"])

    kind = rows.schema["id"].dataType.simpleString()
    parts = max(n_parts, met.count() // 4)
    more = "" if threshold is None else ", na long, nb long, similarity double"
    found = both.repartition(parts, "_bi", "_bj").groupBy("_bi", "_bj").applyInArrow(pairs, f"a {kind}, b {kind}{more}")
    first = F.col("a") < F.col("b")
    if threshold is None:
        return found.select(F.least("a", "b").alias("id_1"), F.greatest("a", "b").alias("id_2"))
    return found.select(
        F.least("a", "b").alias("id_1"), F.greatest("a", "b").alias("id_2"), F.when(first, F.col("na")).otherwise(F.col("nb")).alias("n_1"),
        F.when(first, F.col("nb")).otherwise(F.col("na")).alias("n_2"), "similarity")

"""Locality-sensitive hashing: MinHash (Jaccard) and random hyperplanes (cosine).

Signatures are computed in long form: each (id, element) row is expanded by
the literal array of band parameters and reduced with ``min`` / ``sum``
grouped by (id, band).  The set rows, not the many times more exploded ones,
are dealt by (id, part of the element's key) first: the rows of an id then meet
in at most ``salts`` tasks, the partial reduction leaves one row per task and
band there, and only those are shuffled again.  An id holding a third of all
rows is spread over ``salts`` tasks.  Bands are compared by exact tuple
equality; candidate pairs come from ``group_pairs`` (hot buckets are split)
and are verified exactly.  Rows that stand together by id (``together``: those of a
document, made from its text by the task that reads it) need no dealing and are not
exploded: their minima are taken where they are, in Arrow batches, and leave one row
per band, id and batch.

Defaults follow the reference: MinHash 50 bands x 2 rows (100 hashes),
hyperplanes 20 bands x 20 rows (400 planes).  The 20x20 cosine setting is very
selective (about 0.6 % recall at cosine 0.5): let each id visit more buckets of a
band (``flips``), choose shorter bands, or use ``exact_cosine_join``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.functions.encoding import with_codes
from likeness.functions.hashing import PRIME, HashFamily, element_key
from likeness.operators.blocks import BLOCK_IDS, DENSE_CODES, dense_cosine, finite, set_bits, set_pairs
from likeness.operators.pairs import DEFAULT_BLOCK, attach, grid_join, group_pairs
from likeness.operators.verify import cosine_of, jaccard_of, only, vector_norms
from likeness.session import materialize as _materialize


#: Parts into which the rows of one id are dealt before its signature is reduced.
DEFAULT_SALTS = 8


def band_parameters(agreement: float, recall: float = 0.98, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the longest bands that find a pair with chance ``recall`` or more.

    ``agreement`` is the chance that one hash agrees on a pair at the
    threshold: the Jaccard threshold itself for MinHash, ``1 - acos(t) / pi``
    for hyperplanes.  Longer bands let fewer unlike pairs through; more hashes
    cost more time per signature.
    """
    if not 0 < agreement < 1 or not 0 < recall < 1:
        raise ValueError("agreement and recall must lie between 0 and 1")
    fitting = [
        (bands, rows) for rows in range(1, max_hashes + 1) if agreement**rows > 1e-12
        for bands in [math.ceil(math.log(1 - recall) / math.log1p(-(agreement**rows)))]
        if bands * rows <= max_hashes
    ]
    if not fitting:
        raise ValueError(f"no banding of {max_hashes} hashes reaches recall {recall} at agreement {agreement}")
    return max(fitting, key=lambda p: p[1])


def _dealt(rows: DataFrame, salts: int) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, F.col("id"), F.pmod(F.col("_x"), F.lit(salts)))


#: Rows of an id from which on they are dealt to several tasks.
HOT_ID = 1 << 16


def by_id(sets: DataFrame, id_col: str = "id", element_col: str = "element") -> tuple[DataFrame, bool]:
    """``sets`` with the rows of an id standing together in one task, those of a hot
    id in several, and whether there is no such id: for ``together`` and ``whole``."""
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = _materialize(sets.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ID).select(
        id_col, F.ceil(F.col("_n") / HOT_ID).alias("_p")))
    if hot.isEmpty():
        return sets.repartition(n, id_col).sortWithinPartitions(id_col), True
    parts = sets.join(F.broadcast(hot), id_col, "left").withColumn("_p", F.pmod(F.xxhash64(element_col), F.coalesce("_p", F.lit(1))))
    return parts.repartition(n, id_col, "_p").sortWithinPartitions(id_col).select(*sets.columns), False


def _h(r: str = "", modulus: int = PRIME) -> str:
    """SQL for hash ``r`` of the exploded parameter struct ``_p`` applied to ``_x``."""
    return f"pmod(_x * _p.a{r} + _p.b{r}, {modulus})"


def _sign(r: str = "", modulus: int = PRIME) -> str:
    return f"(pmod({_h(r, modulus)}, 2) * 2 - 1)"


def minhash_signatures(
    sets: DataFrame, num_hashes: int = 100, seed: int = 42, id_col: str = "id", element_col: str = "element",
    modulus: int = PRIME, salts: int = DEFAULT_SALTS, together: bool = False,
) -> DataFrame:
    """Long-form MinHash signature: (id, hash_idx, value) (SIM1, AGG5, SNK4).

    ``modulus`` is the hash family's modulus (a prime keeps the family
    universal; the default is 2^31 - 1).  Hashes are reduced several to a row."""
    rows = max(r for r in range(1, 26) if num_hashes % r == 0)
    banded = minhash_bands(sets, num_hashes // rows, rows, seed, id_col, element_col, modulus, salts, together)
    return banded.select("id", "band", F.posexplode(F.array(*[f"k{r}" for r in range(rows)])).alias("_r", "value")).select(
        "id", (F.col("band") * rows + F.col("_r")).alias("hash_idx"), "value")


def minhash_bands(
    sets: DataFrame, bands: int = 50, rows: int = 2, seed: int = 42, id_col: str = "id", element_col: str = "element",
    modulus: int = PRIME, salts: int = DEFAULT_SALTS, together: bool = False, whole: bool = False,
) -> DataFrame:
    """(id, band, k0..k{rows-1}): the band slices of the MinHash signature (SIM2).

    Hash ``band*rows + r`` fills ``k{r}``, exactly as in ``minhash_signatures``.
    ``whole`` says that no other task has rows of an id, and that they follow each
    other there (``by_id``): their minima then need no exchange.
    """
    fam = HashFamily(bands * rows, seed, modulus)
    x = sets.select(F.col(id_col).alias("id"), element_key(element_col, modulus).alias("_x"))
    if together or whole:
        least = _batch_minima(x, fam.params[: bands * rows], bands, rows, modulus, whole)
        return least if whole else least.groupBy("id", "band").agg(*[F.min(f"k{r}").alias(f"k{r}") for r in range(rows)])
    exploded = _dealt(x, salts).select("id", "_x", F.explode(F.expr(fam.banded_params_sql(bands, rows))).alias("_p"))
    aggs = [F.expr(f"min({_h(str(r), modulus)})").alias(f"k{r}") for r in range(rows)]
    return exploded.groupBy("id", F.col("_p.band").alias("band")).agg(*aggs)


def _batch_minima(x: DataFrame, params: list[tuple[int, int]], bands: int, rows: int, modulus: int, whole: bool) -> DataFrame:
    """(id, band, k0...) of the rows (id, _x) of every id in a batch; NULL where all
    its _x are.  If ids are ``whole``, the last one of a batch waits for the next batch."""
    prime, bits = PRIME, PRIME.bit_length()

    def cut(batches):
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            if batch.num_rows:
                place = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
                others = np.flatnonzero(place != place[-1])
                at = int(others[-1]) + 1 if len(others) else 0
                rest = batch.slice(at)
                yield batch.slice(0, at)
        if rest is not None:
            yield rest

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # a closure of its own, so that workers need no package
        for batch in cut(batches) if whole else batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).dictionary_encode(null_encoding="encode")
            place, n = ids.indices.to_numpy(), len(ids.dictionary)
            known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            place, value = place[known], batch.column(1).fill_null(0).to_numpy()[known]
            order = np.argsort(place, kind="stable")
            have, first = np.unique(place[order], return_index=True)
            value = value[order]
            keys, absent = np.zeros((bands * rows, n), np.int64), np.ones(n, bool)
            absent[have] = False
            hashed, high = np.empty_like(value), np.empty_like(value)
            for k, (a, b) in enumerate(params if len(have) else ()):
                np.multiply(value, a, out=hashed)
                hashed += b
                if modulus == prime:  # 2^31 is 1 there; below 0, unsigned, is more than any
                    np.right_shift(hashed, bits, out=high)
                    hashed &= prime
                    hashed += high
                    np.subtract(hashed, prime, out=high)
                    np.minimum(hashed.view(np.uint64), high.view(np.uint64), out=hashed.view(np.uint64))
                else:
                    hashed %= modulus
                keys[k, have] = np.minimum.reduceat(hashed, first)
            told = pa.array(np.tile(np.arange(n), bands))
            yield pa.RecordBatch.from_arrays(
                [ids.dictionary.take(told), pa.array(np.repeat(np.arange(bands, dtype=np.int32), n)),
                 *[pa.array(keys[r::rows].ravel(), mask=np.tile(absent, bands)) for r in range(rows)]],
                ["id", "band", *[f"k{r}" for r in range(rows)]])

    kind = x.schema["id"].dataType.simpleString()
    return x.select("id", "_x").mapInArrow(minima, f"id {kind}, band int, " + ", ".join(f"k{r} long" for r in range(rows)))


def hyperplane_signatures(
    vectors: DataFrame, num_planes: int = 400, seed: int = 42, id_col: str = "id",
    element_col: str = "element", value_col: str = "value", salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """Long-form sign sketch: (id, plane, sign) with sign = +1 if
    sum(value * s_plane(element)) >= 0 else -1 (SIM4, AGG6, FN10)."""
    fam = HashFamily(num_planes, seed)
    x = vectors.select(F.col(id_col).alias("id"), element_key(element_col).alias("_x"), F.col(value_col).alias("_v"))
    return (
        _dealt(x, salts).select("id", "_x", "_v", F.explode(F.expr(fam.params_sql())).alias("_p"))
        .groupBy("id", F.col("_p.i").alias("plane"))
        .agg(F.expr(f"sum(_v * {_sign()})").alias("_d"))
        .select("id", "plane", F.expr("IF(_d >= 0, 1, -1)").alias("sign"))
    )


def hyperplane_bands(
    vectors: DataFrame, bands: int = 20, rows: int = 20, seed: int = 42, id_col: str = "id",
    element_col: str = "element", value_col: str = "value", salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """(id, band, k0): the ``rows`` sign bits of each band packed into one
    bigint, bit r set when plane ``band*rows + r`` has sign +1 (SIM5)."""
    g = _band_sums(vectors, bands, rows, seed, id_col, element_col, value_col, salts)
    return g.select("id", "band", F.expr(_packed(rows)).alias("k0"))


def hyperplane_probes(
    vectors: DataFrame, bands: int = 20, rows: int = 20, flips: int = 6, seed: int = 42, id_col: str = "id",
    element_col: str = "element", value_col: str = "value", salts: int = DEFAULT_SALTS,
) -> DataFrame:
    """(id, band, k0): the 2^flips buckets that an id visits in each band -- its
    own, and those reached by flipping any of its ``flips`` signs of smallest
    margin (the planes it lies closest to; ties by number).

    Two ids meet in a band if every sign in which they differ is among the
    flipped ones of either: long, selective bands keep their recall, since nearly
    all signs that differ between similar vectors have a small margin.
    """
    if not 0 <= flips <= min(rows, 16):
        raise ValueError(f"flips must lie between 0 and min(rows, 16), got {flips}")
    g = _band_sums(vectors, bands, rows, seed, id_col, element_col, value_col, salts)
    return _visited(g.select("id", "band", F.expr(_packed(rows)).alias("_k"), _low(rows, flips).alias("_low")), flips)


def _low(rows: int, flips: int) -> F.Column:
    """The bits of the ``flips`` signs of smallest margin."""
    margins = ", ".join(f"struct(abs(_d{r}) as m, {r} as r)" for r in range(rows))
    return F.expr(f"transform(slice(sort_array(array({margins})), 1, {flips}), x -> shiftleft(1L, x.r))" if flips else "array(0L)")


def _visited(own: DataFrame, flips: int) -> DataFrame:
    """(id, band, k0) of the buckets that the rows (id, band, _k, _low) visit."""
    visits = own.withColumn(
        "_v", F.explode(F.sequence(F.lit(0), F.lit((1 << flips) - 1))))
    flipped = " + ".join(f"if(shiftright(_v, {j}) & 1 = 1, _low[{j}], 0L)" for j in range(flips)) or "0L"
    return visits.select("id", "band", F.expr(f"_k ^ ({flipped})").alias("k0"))


def _packed(rows: int) -> str:
    return " + ".join(f"IF(_d{r} >= 0, {1 << r}L, 0L)" for r in range(rows))


def _band_sums(
    vectors: DataFrame, bands: int, rows: int, seed: int, id_col: str, element_col: str, value_col: str, salts: int,
) -> DataFrame:
    """(id, band, _d0.._d{rows-1}): the signed sums whose signs are the bits of a band."""
    if rows > 62:
        raise ValueError("rows must be <= 62 to pack a band into a bigint")
    fam = HashFamily(bands * rows, seed)
    x = vectors.select(F.col(id_col).alias("id"), element_key(element_col).alias("_x"), F.col(value_col).alias("_v"))
    exploded = _dealt(x, salts).select("id", "_x", "_v", F.explode(F.expr(fam.banded_params_sql(bands, rows))).alias("_p"))
    sums = [F.expr(f"sum(_v * {_sign(str(r))})").alias(f"_d{r}") for r in range(rows)]
    return exploded.groupBy("id", F.col("_p.band").alias("band")).agg(*sums)


def _key_cols(banded: DataFrame) -> list[str]:
    return [c for c in banded.columns if c.startswith("k") and c[1:].isdigit()]


def bucket_members(banded: DataFrame) -> DataFrame:
    """(band, k..., id, bucket_size) for buckets with at least two members (SNK5, FLT1)."""
    keys = ["band", *_key_cols(banded)]
    sizes = banded.groupBy(*keys).agg(F.count(F.lit(1)).alias("bucket_size")).where(F.col("bucket_size") >= 2)
    return banded.join(sizes, keys).select(*keys, "id", "bucket_size")


def band_candidates(banded: DataFrame, block: int = DEFAULT_BLOCK, collapse: bool = True) -> DataFrame:
    """Distinct (id_1, id_2), id_1 < id_2, sharing a bucket in any band (SIM7, JN2, DST5).

    With ``collapse`` (default) ids whose whole signatures are equal -- e.g.
    exact copies, which meet in every band -- form one class: only one
    representative per class is bucketed, and its pairs are expanded to the
    members afterwards, plus all pairs inside each class.  The candidate set is
    the same, but a pair of copies is emitted once instead of once per band.
    Classes are told by a 128-bit hash of the signature, and expanded by blocks.

    Where most pairs meet, by a sample of ids, a row for each meeting would be
    more than the pairs: ids are then compared by blocks (``blocks``), with all
    their keys in one row, and a pair is told once.  Only ids with one bucket a
    band have such a row: those that visit more (``hyperplane_probes``) go by buckets.
    """
    keys = ["band", *_key_cols(banded)]
    banded = _materialize(banded)
    if collapse and _many_meet(banded):
        packed, longs = _packed_keys(banded)
        return set_pairs(packed.withColumn("n", F.lit(0).cast("long")), keys=longs)
    if not collapse:
        return group_pairs(banded.select(*keys, "id"), keys, "id", block=block).select("id_1", "id_2").distinct()
    place = F.xxhash64(*keys), F.xxhash64(F.lit(1), *keys)
    sig = banded.groupBy("id").agg(F.bit_xor(place[0]).alias("_s1"), F.bit_xor(place[1]).alias("_s2"))
    classes = sig.groupBy("_s1", "_s2").agg(F.min("id").alias("_rep"), F.count(F.lit(1)).alias("_m")).where("_m > 1").drop("_m")
    members = _materialize(attach(sig, classes, ["_s1", "_s2"]).where("_rep is not null").select("id", "_rep"))
    if members.isEmpty():
        return group_pairs(banded.select(*keys, "id"), keys, "id", block=block).select("id_1", "id_2").distinct()
    reps = banded.join(members.where(F.col("id") != F.col("_rep")).select("id"), "id", "left_anti")
    rep_pairs = _materialize(group_pairs(reps.select(*keys, "id"), keys, "id", block=block).select("id_1", "id_2").distinct())

    def side(rows: DataFrame, rep: str, member: str) -> DataFrame:
        others = members.where(F.col("id") != F.col("_rep")).select(F.col("_rep").alias(rep), F.col("id").alias(member))
        return rows.withColumn(member, F.col(rep)).unionByName(grid_join(rows, others, [rep], block))

    across = side(side(rep_pairs, "id_1", "_a"), "id_2", "_b").select(
        F.least("_a", "_b").alias("id_1"), F.greatest("_a", "_b").alias("id_2")
    )
    within = group_pairs(members, ["_rep"], "id", block=block).select("id_1", "id_2")
    return across.unionByName(within)


def _many_meet(banded: DataFrame) -> bool:
    """Whether a sample of the ids says that at least ``SET_SHARE`` of all pairs
    (counted once a band) share a bucket."""
    keys = _key_cols(banded)
    if any(banded.schema[c].dataType.simpleString() != "bigint" for c in keys):
        return False
    ids = banded.select("id").distinct().count()
    if ids < 2:
        return False
    some = banded.where(F.pmod(F.xxhash64("id"), F.lit(-(-ids // SAMPLE_IDS))) == 0).where(F.col(keys[0]).isNotNull())
    sampled = some.select("id").distinct().count()
    sizes = some.groupBy("band", *keys).agg(F.count(F.lit(1)).alias("n"))
    met = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1))).first()[0] or 0
    if not met >= SET_SHARE * sampled * (sampled - 1) > 0:
        return False
    return banded.groupBy("id").agg(F.count("band").alias("n"), F.collect_set("band").alias("b")).where("n > size(b)").isEmpty()


def _packed_keys(banded: DataFrame) -> tuple[DataFrame, int]:
    """(id, keys): the keys of all bands of an id in the order of the bands, and how many a band has.
    Ids without an element have no keys, and meet no other."""
    keys = _key_cols(banded)
    some = banded.where(" and ".join(f"{c} is not null" for c in keys))
    low, high = some.agg(F.min(F.array_min(F.array(*keys))), F.max(F.array_max(F.array(*keys)))).first()
    longs = [F.col(c) for c in keys]
    if low is not None and low >= 0 and high < 1 << 31:  # two of 31 bits are a long
        longs = [F.expr(f"shiftleft({a}, 31) | {b}") for a, b in zip(keys[::2], keys[1::2], strict=False)] + longs[len(keys) // 2 * 2:]
    rows = some.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("band", F.array(*longs).alias("k")))).alias("_k"))
    return rows.select("id", F.flatten(F.col("_k.k")).alias("keys")), len(longs)


def lsh_jaccard_join(
    sets: DataFrame, threshold: float = 0.5, bands: int = 50, rows: int = 2, seed: int = 42,
    id_col: str = "id", element_col: str = "element", block: int = DEFAULT_BLOCK, modulus: int = PRIME,
    together: bool = False,
) -> DataFrame:
    """(id_1, id_2, similarity) for MinHash candidates with exact Jaccard >= threshold (SIM8)."""
    sets = sets.select(F.col(id_col).alias("id"), F.col(element_col).alias("element"))
    # signatures need neither distinct rows nor codes; both wait for the few sets that are in a candidate
    banded = _materialize(minhash_bands(sets, bands, rows, seed, modulus=modulus, together=together))
    if threshold > 0 and _many_meet(banded):
        # most pairs are candidates: the sketches of their sets are compared where they meet
        sets = _materialize(sets.where("id is not null and element is not null").distinct())
        packed, longs = _packed_keys(banded)
        sizes = sets.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
        bits = set_bits(sets, sizes, "xxhash64(element)").join(packed, "id")
        return jaccard_of(set_pairs(bits, threshold, keys=longs), sets, min_similarity=threshold)
    cand = band_candidates(banded, block)
    return jaccard_of(cand, sets, min_similarity=threshold)


#: Share of all pairs, by a sample of ids, from which on pairs are compared by blocks of ids instead of by buckets.
DENSE_SHARE = 1 / 8
SAMPLE_IDS = 2048
#: The same for sets: a candidate of theirs as a row costs far more than 64 comparisons of a block.
SET_SHARE = 1 / 64


class _Marks:
    """One row an id with the signs of all its bands packed into longs (s0...), and
    the signs that it may flip (m0...): two ids share a visited bucket exactly if
    in some band they differ only in signs that one of them flips."""

    def __init__(self, own: DataFrame, bands: int, rows: int):
        self.per, self.bands, self.bits = 62 // rows, bands, rows
        self.words = -(-bands // self.per)
        place = f"shiftleft({{}}, cast((band % {self.per}) * {rows} as int))"
        bit = {"s": place.format("_k"), "m": place.format("aggregate(_low, 0L, (a, x) -> a | x)")}
        self.rows = own.groupBy("id").agg(*[
            F.expr(f"bit_or(if(band div {self.per} = {w}, {e}, 0L))").alias(f"{c}{w}") for c, e in bit.items() for w in range(self.words)])

    def fields(self) -> list[tuple[int, int]]:
        """The lowest and the highest bits of the bands in each long."""
        low = [sum(1 << self.bits * i for i in range(min(self.per, self.bands - self.per * w))) for w in range(self.words)]
        return [(x, x << self.bits - 1) for x in low]

    def meet(self, a, b):
        """Whether two ids share a bucket, as a condition of a join."""
        out = F.lit(False)
        for w, (low, high) in enumerate(self.fields()):
            x = a(f"s{w}").bitwiseXOR(b(f"s{w}")).bitwiseAND(F.bitwise_not(a(f"m{w}").bitwiseOR(b(f"m{w}"))))
            out = out | ((x - F.lit(low)).bitwiseAND(F.bitwise_not(x)).bitwiseAND(F.lit(high)) != 0)
        return out


def _marks(
    vectors: DataFrame, bands: int, rows: int, seed: int, id_col: str, element_col: str, value_col: str, flips: int,
) -> tuple[DataFrame, _Marks | None]:
    """(id, band, _k, _low), written; and the marks if a sample of the ids says
    that at least ``DENSE_SHARE`` of all pairs (counted once a band) share a bucket."""
    if not 0 <= flips <= min(rows, 16):
        raise ValueError(f"flips must lie between 0 and min(rows, 16), got {flips}")
    g = _band_sums(vectors, bands, rows, seed, id_col, element_col, value_col, DEFAULT_SALTS)
    own = _materialize(g.select("id", "band", F.expr(_packed(rows)).alias("_k"), _low(rows, flips).alias("_low")).where("id is not null"))
    ids = own.where("band = 0").count()
    if ids < 2:
        return own, None
    some = own.where(F.pmod(F.xxhash64("id"), F.lit(-(-ids // SAMPLE_IDS))) == 0)
    sampled = some.where("band = 0").count()
    sizes = _visited(some, flips).groupBy("band", "k0").agg(F.count(F.lit(1)).alias("n"))
    meetings = sizes.agg(F.sum(F.col("n") * (F.col("n") - 1))).first()[0] or 0
    return own, _Marks(own, bands, rows) if meetings >= DENSE_SHARE * sampled * (sampled - 1) > 0 else None


def cosine_candidates(
    vectors: DataFrame, bands: int = 20, rows: int = 20, seed: int = 42, id_col: str = "id", element_col: str = "element",
    value_col: str = "value", block: int = DEFAULT_BLOCK, flips: int = 0,
) -> DataFrame:
    """Distinct (id_1, id_2) that share a bucket; with ``flips`` each id visits 2^flips of a band.

    Where most pairs meet, a pair is told once by the packed signs of its ids,
    in a join of blocks of ids, and no row is made for each of its meetings."""
    own, marks = _marks(vectors, bands, rows, seed, id_col, element_col, value_col, flips)
    if marks is None:
        return band_candidates(_visited(own, flips), block)
    members = _materialize(marks.rows).select(F.lit(0).alias("_all"), "*")
    return group_pairs(members, ["_all"], "id", block=BLOCK_IDS, keep=marks.meet).select("id_1", "id_2")


def lsh_cosine_join(
    vectors: DataFrame, threshold: float = 0.5, bands: int = 20, rows: int = 20, seed: int = 42,
    id_col: str = "id", element_col: str = "element", value_col: str = "value", block: int = DEFAULT_BLOCK,
    flips: int = 0,
) -> DataFrame:
    """(id_1, id_2, similarity) for hyperplane candidates with exact cosine >= threshold (SIM9)."""
    vectors = _materialize(vectors.select(
        F.col(id_col).alias("id"), F.col(element_col).alias("element"), F.col(value_col).alias("value")
    ))
    own, marks = _marks(vectors, bands, rows, seed, "id", "element", "value", flips)
    if marks is not None and threshold > 0 and vectors.select("element").distinct().limit(DENSE_CODES + 1).count() <= DENSE_CODES:
        coded = _materialize(with_codes(vectors, "element", "_code").select("id", F.col("_code").alias("code"), "value"))
        norms = _materialize(vector_norms(coded))
        if finite(norms):
            return dense_cosine(coded, norms, threshold, marks)
    cand = _materialize(band_candidates(_visited(own, flips), block) if marks is None else cosine_candidates(
        vectors, bands, rows, seed, block=block, flips=flips))
    # only the vectors that are in a candidate are encoded
    coded = _materialize(with_codes(only(vectors, cand), "element", "_code").select("id", F.col("_code").alias("element"), "value"))
    return cosine_of(cand, coded).where(F.col("similarity") >= threshold)

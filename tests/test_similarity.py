"""Similarity operators: micro answers, brute force on driver fixtures, LSH properties."""

import hashlib
import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from likeness.functions.hashing import PRIME, HashFamily
from likeness.operators.exact import exact_cosine_join, exact_jaccard_join
from likeness.operators.lsh import (
    band_candidates, band_parameters, hyperplane_bands, lsh_cosine_join, lsh_jaccard_join, minhash_bands, minhash_signatures,
)
from likeness.operators.pairs import grid_join, group_pairs
from likeness.operators.verify import cosine_of, jaccard_of
from likeness.sources import tables as T

SF0001 = "/root/testdata/sf0.001"

MICRO_JAC = {("b1", "b2"): 1.0, ("b1", "b3"): 0.5, ("b1", "b4"): 0.5,
             ("b2", "b3"): 0.5, ("b2", "b4"): 0.5, ("b3", "b4"): 0.5}
MICRO_COS = {("b1", "b2"): 0.973329, ("b1", "b3"): 0.802377, ("b1", "b4"): 0.665306,
             ("b2", "b3"): 0.700877, ("b2", "b4"): 0.669891, ("b3", "b4"): 0.283197}


def _d(df):
    return {(r["id_1"], r["id_2"]): r["similarity"] for r in df.collect()}


def _item_sets(micro):
    return micro.select(F.col("item_id").alias("id"), F.col("user_id").alias("element"))


def _item_vecs(micro):
    return micro.select(F.col("item_id").alias("id"), F.col("user_id").alias("element"), F.col("rating").alias("value"))


def brute_jaccard(rows, t):
    sets = defaultdict(set)
    for i, e in rows:
        sets[i].add(e)
    out = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if j >= t:
            out[(a, b)] = j
    return out


def brute_cosine(rows, t):
    vec = defaultdict(dict)
    for i, e, v in rows:
        vec[i][e] = v
    out = {}
    for a, b in itertools.combinations(sorted(vec), 2):
        dot = sum(v * vec[b][e] for e, v in vec[a].items() if e in vec[b])
        na = sum(v * v for v in vec[a].values())
        nb = sum(v * v for v in vec[b].values())
        if na and nb:
            c = dot / (na ** 0.5 * nb ** 0.5)
            if c >= t:
                out[(a, b)] = c
    return out


def test_micro_jaccard_and_cosine(spark, micro):
    pairs = spark.createDataFrame(list(MICRO_JAC), "id_1 string, id_2 string")
    assert _d(jaccard_of(pairs, _item_sets(micro))) == pytest.approx(MICRO_JAC)
    assert _d(cosine_of(pairs, _item_vecs(micro))) == pytest.approx(MICRO_COS, abs=1e-6)


def test_micro_exact_joins(micro):
    assert _d(exact_jaccard_join(_item_sets(micro), 0.5)) == pytest.approx(MICRO_JAC)
    want = {k: v for k, v in MICRO_COS.items() if v >= 0.6}
    assert _d(exact_cosine_join(_item_vecs(micro), 0.6)) == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("t", [0.3, 0.5, 0.8])
def test_exact_jaccard_vs_brute_force_docs(spark, t):
    sets = T.word_sets(spark, SF0001)
    rows = [(r[0], r[1]) for r in sets.collect()]
    assert _d(exact_jaccard_join(sets, t)) == pytest.approx(brute_jaccard(rows, t))


def test_exact_jaccard_vs_brute_force_nations(spark):
    sets = T.nation_sets(spark, SF0001)
    rows = [(r[0], r[1]) for r in sets.collect()]
    assert _d(exact_jaccard_join(sets, 0.8)) == pytest.approx(brute_jaccard(rows, 0.8))


@pytest.mark.parametrize("t", [0.5, 0.9])
def test_exact_cosine_vs_brute_force_events(spark, t):
    vecs = T.event_vectors(spark, SF0001)
    rows = [(r[0], r[1], r[2]) for r in vecs.collect()]
    assert _d(exact_cosine_join(vecs, t)) == pytest.approx(brute_cosine(rows, t))


def test_lsh_subset_of_exact_and_recall(spark):
    sets = T.word_sets(spark, SF0001)
    exact = _d(exact_jaccard_join(sets, 0.5))
    lsh = _d(lsh_jaccard_join(sets, 0.5))
    assert set(lsh) <= set(exact)
    assert len(lsh) == len(exact)  # 50x2 misses a 0.5-pair with probability ~6e-7


def test_band_parameters_reach_the_recall():
    assert band_parameters(0.5, 0.98, 128) == (30, 3)
    for agreement in (0.3, 0.5, 0.8, 0.95):
        bands, rows = band_parameters(agreement, 0.95, 256)
        assert bands * rows <= 256 and 1 - (1 - agreement ** rows) ** bands >= 0.95
    for bad in ((0.0, 0.9), (1.0, 0.9), (0.5, 1.0), (0.01, 0.99)):
        with pytest.raises(ValueError):
            band_parameters(*bad)


def test_tuned_join_of_shingles(spark):
    sets = T.shingle_sets(spark, SF0001)
    rows = [(r[0], r[1]) for r in sets.collect()]
    texts = {r["doc_id"]: r["text"].lower().split(" ") for r in T.table(spark, SF0001, "documents").collect()}
    want = {(i, " ".join(w[k:k + 3])) for i, w in texts.items() for k in range(len(w) - 2)}
    assert set(rows) == want and len(rows) == len(want)
    true = brute_jaccard(rows, 0.5)
    found = _d(lsh_jaccard_join(sets, 0.5, *band_parameters(0.5)))
    assert set(found) <= set(true) and len(found) >= 0.95 * len(true)


@pytest.mark.parametrize("sketch", ["minhash_signatures", "minhash_bands", "hyperplane_signatures", "hyperplane_bands"])
def test_rows_are_dealt_before_they_are_exploded(spark, sketch):
    import likeness.operators.lsh as lsh
    rows = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0)], "id string, element string, value double")
    plan = getattr(lsh, sketch)(rows)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Generate explode", 1)
    assert above.count("Exchange hashpartitioning") == 1 and above.count("HashAggregate") + above.count("ObjectHashAggregate") >= 2
    assert "Exchange hashpartitioning(id" in below


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_signatures_do_not_depend_on_the_salts(spark, salts):
    sets, _ = _skewed_sets(spark)
    got = sorted(map(tuple, minhash_signatures(sets, 6, salts=salts).collect()))
    assert got == sorted(map(tuple, minhash_signatures(sets, 6).collect()))


def test_lsh_cosine_subset(spark):
    vecs = T.event_vectors(spark, SF0001)
    exact = _d(exact_cosine_join(vecs, 0.5))
    lsh = _d(lsh_cosine_join(vecs, 0.5, bands=50, rows=8))
    assert set(lsh) <= set(exact)
    assert len(lsh) >= 0.7 * len(exact)


def test_same_seed_same_rows_and_partitioning_invariance(spark):
    sets = T.word_sets(spark, SF0001)
    a = sorted(map(tuple, minhash_signatures(sets, 20, seed=7).collect()))
    b = sorted(map(tuple, minhash_signatures(sets.repartition(3), 20, seed=7).collect()))
    c = sorted(map(tuple, minhash_signatures(sets, 20, seed=8).collect()))
    assert a == b and a != c


def test_bands_agree_with_signatures(spark):
    sets = T.word_sets(spark, SF0001)
    sig = {(r["id"], r["hash_idx"]): r["value"] for r in minhash_signatures(sets, 12, seed=3).collect()}
    for r in minhash_bands(sets, 4, 3, seed=3).collect():
        assert [r["k0"], r["k1"], r["k2"]] == [sig[(r["id"], r["band"] * 3 + k)] for k in range(3)]


def test_identical_sets_similarity_one_transitive(spark):
    rows = [(i, e) for i in ("a", "b", "c") for e in ("x", "y")] + [("d", "x")]
    sets = spark.createDataFrame(rows, "id string, element string")
    got = _d(lsh_jaccard_join(sets, 1.0))
    assert got == {("a", "b"): 1.0, ("a", "c"): 1.0, ("b", "c"): 1.0}


@pytest.mark.parametrize("block", [1, 2, 3, 1024])
def test_group_pairs_split_equals_plain(spark, block):
    rows = [(g, i) for g, n in (("hot", 23), ("mid", 5), ("one", 1)) for i in range(n)]
    members = spark.createDataFrame(rows, "g string, id int")
    got = sorted(map(tuple, group_pairs(members, ["g"], "id", block=block).collect()))
    want = sorted((g, a, b) for g, n in (("hot", 23), ("mid", 5)) for a, b in itertools.combinations(range(n), 2))
    assert got == want


def test_zero_vector_dropped(spark):
    v = spark.createDataFrame([("a", "x", 0.0), ("b", "x", 1.0), ("c", "x", 2.0)], "id string, element string, value double")
    assert _d(exact_cosine_join(v, 0.5)) == {("b", "c"): 1.0}
    pairs = spark.createDataFrame([("a", "b")], "id_1 string, id_2 string")
    assert _d(cosine_of(pairs, v)) == {("a", "b"): None}


def test_empty_and_single_item(spark):
    empty = spark.createDataFrame([], "id string, element string")
    assert exact_jaccard_join(empty, 0.5).count() == 0
    assert lsh_jaccard_join(empty, 0.5).count() == 0
    one = spark.createDataFrame([("a", "x"), ("a", "y")], "id string, element string")
    assert exact_jaccard_join(one, 0.5).count() == 0
    assert band_candidates(minhash_bands(one)).count() == 0


def test_hyperplane_bits_match_signs(spark):
    vecs = T.event_vectors(spark, SF0001)
    from likeness.operators.lsh import hyperplane_signatures
    sig = {(r["id"], r["plane"]): r["sign"] for r in hyperplane_signatures(vecs, 12, seed=5).collect()}
    for r in hyperplane_bands(vecs, 3, 4, seed=5).collect():
        want = sum(1 << k for k in range(4) if sig[(r["id"], r["band"] * 4 + k)] == 1)
        assert r["k0"] == want


def test_bad_threshold(spark, micro):
    with pytest.raises(ValueError):
        exact_jaccard_join(_item_sets(micro), 0.0)


@pytest.mark.parametrize("buckets", [1, 3, 100])
def test_few_and_many_buckets_of_codes(spark, buckets):
    """However coarsely places are told, the joins are exact."""
    sets = T.word_sets(spark, SF0001)
    rows = [(r[0], r[1]) for r in sets.collect()]
    assert _d(exact_jaccard_join(sets, 0.4, buckets=buckets)) == pytest.approx(brute_jaccard(rows, 0.4))
    vecs = T.event_vectors(spark, SF0001)
    vrows = [(r[0], r[1], r[2]) for r in vecs.collect()]
    assert _d(exact_cosine_join(vecs, 0.6, buckets=buckets)) == pytest.approx(brute_cosine(vrows, 0.6))


@pytest.mark.parametrize("residual", [0.05, 0.3, 0.5])
def test_cosine_residuals(spark, residual):
    """Any share may stay out of the index; negative values too."""
    import random
    rng = random.Random(1)
    rows = [(i, f"e{k}", rng.choice([-1.0, 1.0, 2.0, 3.0])) for i in range(60) for k in rng.sample(range(25), 12)]
    vecs = spark.createDataFrame(rows, "id long, element string, value double")
    want = brute_cosine(rows, 0.5)
    assert _d(exact_cosine_join(vecs, 0.5, residual=residual, block=8)) == pytest.approx(want)
    probed = {k: v for k, v in want.items() if k[0] % 5 == 0 or k[1] % 5 == 0}
    assert _d(exact_cosine_join(vecs, 0.5, residual=residual, probes="id % 5 = 0")) == pytest.approx(probed)


def test_cosine_index_leaves_few_candidates(spark):
    """On dense vectors a small residual leaves far fewer candidates than all pairs."""
    from likeness.functions.encoding import element_codes, join_codes
    from likeness.operators.exact import cosine_index, cosine_scores
    from likeness.operators.verify import vector_norms
    vecs = T.event_vectors(spark, "/root/testdata/sf0.01")
    codes = element_codes(vecs, "element")
    coded = join_codes(vecs, codes, "element").select("id", "code", "value")
    norms = vector_norms(coded)
    counts = {}
    for residual in (0.1, 0.5):
        index, rest = cosine_index(coded, norms, residual, codes.count())
        counts[residual] = cosine_scores(index, rest, coded, norms, 0.5).count()
    ids = norms.count()
    assert counts[0.1] < 0.25 * ids * (ids - 1) / 2 < counts[0.5]


def test_jaccard_candidates_are_few(spark):
    """Position and sketch leave little more than the true pairs of a dense universe."""
    from likeness.functions.encoding import element_codes, join_codes
    from likeness.operators.bitmaps import profiles
    from likeness.operators.exact import jaccard_candidates
    sets = T.nation_sets(spark, "/root/testdata/sf0.01")
    codes = element_codes(sets, "element")
    coded = join_codes(sets, codes, "element").select("id", "code")
    cand = jaccard_candidates(coded, profiles(coded, "code"), codes, 0.8).count()
    assert cand <= 1.05 * 12163  # true pairs, of two million


def test_equal_sets_are_one_class(spark):
    """A third of all sets are one set, more are another; pairs between and within."""
    rows = [(i, e) for i in range(40) for e in ("x", "y", "z")] + [(100 + i, e) for i in range(25) for e in ("x", "y", "z", "w")]
    rows += [(200 + i, f"u{i % 7}{k}") for i in range(30) for k in range(4)]
    sets = spark.createDataFrame(rows, "id long, element string")
    for block in (4, 1024):
        assert _d(exact_jaccard_join(sets, 0.7, block=block)) == pytest.approx(brute_jaccard(rows, 0.7))


def test_probes_restrict_the_join(spark):
    sets, rows = _skewed_sets(spark)
    want = {k: v for k, v in brute_jaccard(rows, 0.5).items() if k[0] % 20 == 0 or k[1] % 20 == 0}
    for block in (3, 1024):
        assert _d(exact_jaccard_join(sets, 0.5, block=block, probes="id % 20 = 0")) == pytest.approx(want)


def test_bitmaps(spark):
    from likeness.operators.bitmaps import intersections, profiles, set_words, sift
    import random
    rng = random.Random(2)
    sets = {i: {rng.randrange(-500, 3000) for _ in range(rng.choice([1, 5, 60, 800]))} for i in range(30)}
    coded = spark.createDataFrame([(i, c) for i, s in sets.items() for c in s], "id long, code long")
    pairs = spark.createDataFrame([(a, b, len(sets[a]), len(sets[b])) for a, b in itertools.combinations(sets, 2)], "id_1 long, id_2 long, n_1 long, n_2 long")
    got = {(r.id_1, r.id_2): r.common for r in intersections(pairs, set_words(coded)).collect()}
    assert got == {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(sets, 2) if {c >> 6 for c in sets[a]} & {c >> 6 for c in sets[b]}}
    for cell in ("code", "xxhash64(code)"):
        kept = {(r.id_1, r.id_2) for r in sift(pairs, profiles(coded, cell), 0.3).collect()}
        true = {(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.3 * len(sets[a] | sets[b])}
        assert true <= kept and len(kept) < len(sets) * (len(sets) - 1) / 2


def test_jaccard_of_reads_any_rows(spark):
    """Repeated rows, integral and string elements, ids without a partner, pairs without overlap."""
    for kind, name in ((int, "long"), (str, "string")):
        rows = [(1, kind(5)), (1, kind(5)), (1, kind(6)), (2, kind(6)), (3, kind(7)), (4, kind(1))]
        sets = spark.createDataFrame(rows, f"id long, element {name}")
        pairs = spark.createDataFrame([(1, 2), (1, 3)], "id_1 long, id_2 long")
        assert _d(jaccard_of(pairs, sets)) == {(1, 2): 0.5, (1, 3): 0.0}
        assert _d(jaccard_of(pairs, sets, min_similarity=0.5)) == {(1, 2): 0.5}


def test_verification_has_no_arrays_and_reads_candidates_only(spark):
    """One path: no element lists; only sets of ids in a pair go on."""
    sets = spark.createDataFrame([(i, f"e{k}") for i in range(50) for k in range(i % 7 + 1)], "id long, element string")
    pairs = spark.createDataFrame([(1, 2)], "id_1 long, id_2 long")
    plan = jaccard_of(pairs, sets, min_similarity=0.1)._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "array_intersect" not in plan and "bit_count" in plan


@pytest.mark.parametrize("bound", [1 << 20, 10])
def test_codes_are_dense_and_by_frequency(spark, bound):
    from likeness.functions.encoding import element_codes
    rows = [(f"w{k}",) for k in range(300) for _ in range(1 + 300 // (k + 1))]
    got = {r.element: (r.code, r.freq) for r in element_codes(spark.createDataFrame(rows, "element string"), "element", bound=bound).collect()}
    order = sorted(got, key=lambda w: (-got[w][1], w))
    assert [got[w][0] for w in order] == list(range(300)) and got["w0"] == (0, 301)


def test_prefix_sums_in_levels(spark):
    """Windows of two keys: the sums are right, and no window holds more than ``fan`` rows."""
    from likeness.functions.encoding import prefix_sums
    sizes = spark.createDataFrame([(k, k % 5 + 1) for k in range(37)], "p int, n long")
    for fan in (2, 3, 100):
        got = {r.p: r.offset for r in prefix_sums(sizes, "p", "n", 37, fan).collect()}
        assert got == {k: sum(j % 5 + 1 for j in range(k)) for k in range(37)}


@pytest.mark.parametrize("block", [2, 5, 1000])
def test_grid_join_equals_plain_join(spark, block):
    left = [(k, i) for k, n in (("hot", 40), ("a", 3), ("b", 1)) for i in range(n)]
    right = [(k, j) for k, n in (("hot", 23), ("a", 9), ("c", 2)) for j in range(n)]
    a, b = spark.createDataFrame(left, "k string, x int"), spark.createDataFrame(right, "k string, y int")
    got = sorted(map(tuple, grid_join(a, b, ["k"], block).collect()))
    assert got == sorted((k, x, y) for k, x in left for q, y in right if k == q)


def test_no_rows_are_dealt_by_a_hot_group_alone(spark):
    """With a hot group, members only travel with a salt or a block beside the group."""
    import re
    members = spark.createDataFrame([("hot", i) for i in range(50)] + [("x", 1), ("x", 2)], "g string, id int")
    plan = group_pairs(members, ["g"], "id", block=8)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert dealt and all(re.search("_s#|_bi#", d) for d in dealt)


def test_probes_of_hyperplanes(spark):
    """An id visits its own bucket, and those that its signs of smallest margin lead to."""
    from likeness.operators.lsh import hyperplane_probes
    vecs = T.event_vectors(spark, SF0001)
    own = {(r["id"], r["band"]): r["k0"] for r in hyperplane_bands(vecs, 3, 6, seed=5).collect()}
    seen = defaultdict(set)
    for r in hyperplane_probes(vecs, 3, 6, flips=2, seed=5).collect():
        seen[r["id"], r["band"]].add(r["k0"])
    assert all(len(v) == 4 and own[k] in v and max((x ^ own[k]).bit_count() for x in v) == 2 for k, v in seen.items()) and len(seen) == len(own)
    assert {(r["id"], r["band"]): r["k0"] for r in hyperplane_probes(vecs, 3, 6, flips=0, seed=5).collect()} == own


def test_multi_probe_recall(spark):
    vecs = T.event_vectors(spark, "/root/testdata/sf0.01")
    exact = _d(exact_cosine_join(vecs, 0.5, residual=0.1))
    plain = _d(lsh_cosine_join(vecs, 0.5))
    more = _d(lsh_cosine_join(vecs, 0.5, flips=6))
    assert set(plain) <= set(more) <= set(exact) and len(more) >= 0.9 * len(exact) > 10 * len(plain)


def _skewed_sets(spark):
    """One element in every set, one id holding most rows, many identical sets."""
    rows = []
    for i in range(40):
        rows.append((i, "hot"))
        rows += [(i, f"e{(i * 7 + k) % 23}") for k in range(3)]
    rows += [(100, f"e{k}") for k in range(23)] + [(100, "hot")] + [(100, f"big{k}") for k in range(300)]
    rows += [(200 + j, e) for j in range(30) for e in ("hot", "e1", "e2")]  # 30 identical sets
    return spark.createDataFrame(rows, "id long, element string"), rows


@pytest.mark.parametrize("block", [2, 1024])
def test_skewed_sets_exact_and_lsh(spark, block):
    sets, rows = _skewed_sets(spark)
    want = brute_jaccard(rows, 0.5)
    assert _d(exact_jaccard_join(sets, 0.5, block=block)) == pytest.approx(want)
    lsh = _d(lsh_jaccard_join(sets, 0.5, block=block))
    assert set(lsh) <= set(want) and lsh == pytest.approx({k: want[k] for k in lsh})
    assert len([k for k in want if want[k] == 1.0]) == sum(1 for k in lsh if lsh[k] == 1.0)


def test_hot_user_cf_matches_unskewed_formula(spark):
    # one user rates every item; predictions must equal the micro-fixture formula regardless of orientation
    from likeness.operators.cf import pearson_weights
    r = [("hot", f"i{k}", float(1 + k % 5)) for k in range(50)] + [("a", "i1", 2.0), ("a", "i2", 5.0), ("a", "i3", 1.0)]
    ratings = spark.createDataFrame(r, "user_id string, item_id string, rating double")
    pairs = spark.createDataFrame([("a", "hot")], "id_1 string, id_2 string")
    got = pearson_weights(pairs, ratings, "user_id", "item_id").first()["weight"]
    mh = sum(1 + k % 5 for k in range(50)) / 50
    ma = 8 / 3
    hot = {1: 2.0, 2: 3.0, 3: 4.0}
    a = {1: 2.0, 2: 5.0, 3: 1.0}
    num = sum((a[k] - ma) * (hot[k] - mh) for k in a)
    den = sum((a[k] - ma) ** 2 for k in a) ** 0.5 * sum((hot[k] - mh) ** 2 for k in a) ** 0.5
    assert got == pytest.approx(num / den)


def test_minhash_modulus_parameter(spark):
    sets = T.word_sets(spark, SF0001)
    small = {(r["id"], r["hash_idx"]): r["value"] for r in minhash_signatures(sets, 8, modulus=1009).collect()}
    assert all(0 <= v < 1009 for v in small.values())
    exact = _d(exact_jaccard_join(sets, 0.5))
    lsh = _d(lsh_jaccard_join(sets, 0.5, modulus=1009))
    assert set(lsh) <= set(exact)
    with pytest.raises(ValueError):
        minhash_signatures(sets, 4, modulus=2 ** 40)


def test_collapsed_candidates_equal_plain(spark):
    sets, _ = _skewed_sets(spark)
    for src in (sets, T.word_sets(spark, SF0001)):
        b = minhash_bands(src, 10, 2)
        plain = sorted(map(tuple, band_candidates(b, collapse=False).collect()))
        collapsed = sorted(map(tuple, band_candidates(b, collapse=True, block=2).collect()))
        assert plain == collapsed and len(collapsed) == len(set(collapsed))
    vb = hyperplane_bands(T.event_vectors(spark, SF0001), 10, 4)
    assert sorted(map(tuple, band_candidates(vb, collapse=False).collect())) == \
        sorted(map(tuple, band_candidates(vb).collect()))


def test_minhash_of_rows_that_stand_together(spark):
    """Rows of an id that stand together are reduced where they are: one exchange, the same values; any number of hashes."""
    rng = random.Random(4)
    rows = [(i, f"w{rng.randrange(30)}") for i in range(12) for _ in range(i + 1)] + [(3, None), (20, None)]
    sets = spark.createDataFrame(rows, "id long, element string")
    for n in (6, 7, 100, 31):
        found = minhash_signatures(sets, n, 5, together=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        got = {(r.id, r.hash_idx): r.value for r in found.collect()}
        assert got == {(r.id, r.hash_idx): r.value for r in minhash_signatures(sets, n, 5).collect()}
        keys = {w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % PRIME for _, w in rows if w}
        assert got == {
            (i, k): min(((keys[w] * a + b) % PRIME for j, w in rows if j == i and w), default=None)
            for i in {i for i, _ in rows} for k, (a, b) in enumerate(HashFamily(n, 5).params)}


def _dense_vectors(spark):
    rng = random.Random(3)
    rows = [(f"v{i}", f"e{k}", rng.choice([-1.0, 1.0, 2.0, 3.0])) for i in range(40) for k in rng.sample(range(25), 12)]
    rows += [("twin", e, 2 * v) for i, e, v in rows if i == "v7"] + [("zero", "e1", 0.0), ("lone", "other", 1.0)]
    return spark.createDataFrame(rows, "id string, element string, value double"), rows


@pytest.mark.parametrize("block", [7, 2048])
def test_dense_cosine_by_blocks(spark, monkeypatch, block):
    """Blocks of ids of any size, and columns and strips of any width, give every pair once."""
    from likeness.functions.encoding import with_codes
    from likeness.operators import blocks
    from likeness.operators.verify import vector_norms
    vecs, rows = _dense_vectors(spark)
    monkeypatch.setattr(blocks, "STRIP", 3)
    monkeypatch.setattr(blocks, "COLUMNS", 4)
    coded = with_codes(vecs, "element").select("id", "code", "value")
    got = [(r[0], r[1], r[2]) for r in blocks.dense_cosine(coded, vector_norms(coded), 0.3, block=block).collect()]
    want = brute_cosine(rows, 0.3)
    assert len(got) == len(want) and {(a, b): s for a, b, s in got} == pytest.approx(want)
    probed = _d(blocks.dense_cosine(coded, vector_norms(coded), 0.3, probes="id like '%1'", block=block))
    assert probed == pytest.approx({k: v for k, v in want.items() if k[0].endswith("1") or k[1].endswith("1")})


@pytest.mark.parametrize("bands,rows,flips", [(50, 2, 0), (9, 8, 0), (7, 20, 12), (3, 1, 0)])
def test_dense_candidates_equal_those_of_buckets(spark, bands, rows, flips):
    """A pair is told by packed signs exactly if its ids share a bucket, without a row for each meeting."""
    from likeness.operators.lsh import cosine_candidates, hyperplane_probes
    vecs, _ = _dense_vectors(spark)
    want = band_candidates(hyperplane_probes(vecs, bands, rows, flips, seed=5), collapse=False)
    cand = cosine_candidates(vecs, bands, rows, seed=5, flips=flips)
    got = [tuple(r) for r in cand.collect()]
    assert len(got) == len(set(got)) > 0 and set(got) == {tuple(r) for r in want.collect()}
    plan = cand._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id_1" not in plan and "Aggregate" not in plan


def test_dense_joins_make_rows_of_results_only(spark, monkeypatch):
    """Dense vectors are compared by blocks; where these are not used, results are the same."""
    from likeness.operators import exact, lsh
    vecs, rows = _dense_vectors(spark)
    joins = [lambda: exact_cosine_join(vecs, 0.5), lambda: lsh_cosine_join(vecs, 0.5, 20, 3), lambda: lsh_cosine_join(vecs, 0.5, 10, 8, flips=4)]
    dense = [j() for j in joins]
    for d in dense:
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan and "id_1" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    found = [_d(d) for d in dense]
    assert found[0] == pytest.approx(brute_cosine(rows, 0.5))
    monkeypatch.setattr(exact, "DENSE_CODES", 0)
    monkeypatch.setattr(lsh, "DENSE_CODES", 0)
    for d, j in zip(found, joins, strict=True):
        assert _d(j()) == pytest.approx(d)
    monkeypatch.setattr(lsh, "DENSE_SHARE", 1 << 30)
    for d, j in zip(found[1:], joins[1:], strict=True):
        assert _d(j()) == pytest.approx(d)


@pytest.mark.parametrize("block", [3, 4096])
def test_sets_of_few_elements_by_blocks(spark, block):
    """Bitmaps decide in the tasks; null ids and null elements take no part."""
    from likeness.operators.blocks import exact_words, set_bits, set_pairs
    rows = [(i, e) for i in range(30) for e in range(70) if (e * 7 + i * i) % (3 + i % 4)] + [(i, e) for i in (50, 51) for e in range(65)]
    sets = spark.createDataFrame([*rows, (None, 1), (7, None)], "id long, element long")
    known = sets.where("element is not null")
    sizes = known.groupBy("id").agg(F.count("*").alias("n"))
    for t in (0.3, 0.8, 1.0):
        found = set_pairs(set_bits(known, sizes, "element", exact_words(70)), t, exact=True, block=block)
        assert _d(found) == pytest.approx(brute_jaccard(rows, t))
        assert _d(exact_jaccard_join(sets, t)) == pytest.approx(brute_jaccard(rows, t))
    some = {k: v for k, v in brute_jaccard(rows, 0.3).items() if k[0] % 20 == 0 or k[1] % 20 == 0}
    assert _d(exact_jaccard_join(sets, 0.3, probes="id % 20 = 0")) == pytest.approx(some)


def test_dense_sets_make_rows_of_results_only(spark, monkeypatch):
    """Where sets share most of few elements, neither prefixes nor classes make rows."""
    from likeness.operators import exact
    for step in ("jaccard_prefix", "equal_sets", "_expanded"):
        monkeypatch.setattr(exact, step, lambda *a, **k: pytest.fail("a row for each meeting or pair of copies"))
    rows = [(f"u{i}", e) for i in range(40) for e in range(12) if (i // 2 + e) % 5]
    assert _d(exact_jaccard_join(spark.createDataFrame(rows, "id string, element int"), 0.5)) == pytest.approx(brute_jaccard(rows, 0.5))


def test_candidates_of_most_pairs_by_blocks(spark, monkeypatch):
    """Where most pairs share a bucket no row is made for a meeting (F12, F21); sketches are told with all 64 bits."""
    from likeness.operators import lsh
    monkeypatch.setattr(lsh, "group_pairs", lambda *a, **k: pytest.fail("a row for each meeting"))
    rng = random.Random(3)
    rows = [(i, e) for i in range(60) for e in {rng.randrange(4000 if k % 3 else 40 + i) for k in range(60 * (1 + i % 5))}]
    rows += [(100 + i, e) for i in range(6) for e in range(2000 - i)]
    sets = spark.createDataFrame([*rows, (None, 1), (8, None), (300, None)], "id long, element long")
    banded = minhash_bands(sets.where("id is not null"), 20, 2)
    found = {(r.id_1, r.id_2) for r in band_candidates(banded).collect()}
    monkeypatch.undo()
    assert found == {(r.id_1, r.id_2) for r in band_candidates(banded, collapse=False).collect()}
    want = {k: v for k, v in brute_jaccard(rows, 0.5).items() if k in found}
    assert len(want) >= 15
    assert _d(lsh_jaccard_join(sets, 0.5, 20, 2)) == pytest.approx(want)


def test_words_of_a_text_need_no_exchange(spark):
    """Texts are dealt by id, so distinct words and shingles of a text are told where they are made."""
    import re
    for sets in (T.word_sets, T.shingle_sets, T.shingle_vectors):
        plan = sets(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["doc_id"]


@pytest.mark.parametrize("rows_a_batch", [3, 10000])
def test_minima_in_batches(spark, rows_a_batch):
    """Rows that stand together are not exploded, whole ids not exchanged; null ids and elements, and any modulus."""
    from likeness.operators import lsh
    rng = random.Random(9)
    rows = [(i, f"w{rng.randrange(40)}") for i in range(15) for _ in range(i + 1)] + [(None, "w1"), (None, "w2"), (3, None), (20, None)]
    sets = spark.createDataFrame(rows, "id long, element string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_a_batch))
    try:
        for modulus in (PRIME, 1009):
            want = sorted(map(str, minhash_bands(sets, 4, 3, modulus=modulus).collect()))
            for hot in (1 << 16, 8):
                lsh.HOT_ID, kept = hot, lsh.HOT_ID
                dealt, whole = lsh.by_id(sets)
                lsh.HOT_ID = kept
                assert whole == (hot > 8)
                for told in {False, whole}:
                    found = minhash_bands(dealt, 4, 3, modulus=modulus, together=True, whole=told)
                    plan = found._jdf.queryExecution().executedPlan().toString()
                    assert "Generate explode" not in plan and plan.count("Exchange hashpartitioning") == (1 if told else 2)
                    assert sorted(map(str, found.collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ids_of_several_buckets_a_band_go_by_buckets(spark):
    """Multi-probe candidates are those of the buckets where a 64th of all pairs or more meet."""
    from likeness.operators.lsh import hyperplane_probes
    vecs, _ = _dense_vectors(spark)
    probes = hyperplane_probes(vecs, 10, 8, 4)
    want = {tuple(r) for r in band_candidates(probes, collapse=False).collect()}
    assert len(want) >= 43 * 42 / 2 / 64 and {tuple(r) for r in band_candidates(probes).collect()} == want


@pytest.mark.parametrize("size", [300, 1 << 25])
def test_blocks_of_sets_by_bytes(spark, monkeypatch, size):
    """Two 31-bit keys are one long, and blocks are as large as their bytes allow."""
    from likeness.operators import blocks, lsh
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    monkeypatch.setattr(blocks, "SET_STRIP", 4)
    rng = random.Random(7)
    rows = [(i, e) for i in range(50) for e in {rng.randrange(60 + 3 * i) for _ in range(5 + (i % 7) ** 3)}]
    sets = spark.createDataFrame(rows, "id long, element long")
    for k, longs in ((1, 1), (2, 1), (3, 2)):
        banded = minhash_bands(sets, 10, k)
        assert lsh._packed_keys(banded)[1] == longs
        packed = lsh._packed_keys(banded)[0].withColumn("n", F.lit(0).cast("long"))
        found = [tuple(r) for r in blocks.set_pairs(packed, keys=longs).collect()]
        assert len(found) == len(set(found)) and set(found) == {tuple(r) for r in band_candidates(banded, collapse=False).collect()}
    large = banded.withColumn("k0", F.col("k0") + (1 << 40))
    assert lsh._packed_keys(large)[1] == 3
    want = {k: v for k, v in brute_jaccard(rows, 0.4).items()}
    sizes = sets.groupBy("id").agg(F.count("*").alias("n"))
    allowed = [(r.id_1, r.id_2) for r in blocks.set_pairs(blocks.set_bits(sets, sizes, "xxhash64(element)"), 0.4).collect()]
    assert len(allowed) == len(set(allowed)) and set(want) <= set(allowed)


def _near_copies(spark):
    rng = random.Random(12)
    rows = []
    for g in range(12):
        base = [f"g{g}e{k}" for k in range(rng.choice([6, 30, 80]))]
        for c in range(4):
            own = base if c == 1 else base[: rng.randrange(2, len(base) + 1)]
            rows += [(g * 10 + c, e) for e in own] + [(g * 10 + c, f"only{g}.{c}.{k}") for k in range(0 if c == 1 else 5 * c)]
        rows += [(g * 10 + 7, e) for e in base]  # a copy of 1
    rows += [(i, "the") for i in {r[0] for r in rows if r[0] % 10 in (1, 7) or r[0] % 4 == 0}]
    return sorted(set(rows))


@pytest.mark.parametrize("heavy", [1024, 2])
def test_elements_of_the_same_holders_are_one(spark, monkeypatch, heavy):
    """Single elements go, those of the same ids are one code with a weight, and the joins are as exact (F1, F8)."""
    from likeness.operators import exact
    monkeypatch.setattr(exact, "LIST_ELEMENTS", 0)
    monkeypatch.setattr(exact, "LIST_SAMPLE", 1)
    monkeypatch.setattr(exact, "LIST_SHARE", 0)
    monkeypatch.setattr(exact, "HEAVY_SHARE", heavy)
    rows = _near_copies(spark)
    sets = spark.createDataFrame([*rows, (None, "g1e1"), (5, None)], "id long, element string")
    coded, codes = exact.element_lists(spark.createDataFrame(rows, "id long, element string"), ["id"])
    by = defaultdict(set)
    for i, e in rows:
        by[e].add(i)
    lists = {frozenset(v) for v in by.values() if len(v) > 1}
    assert codes.count() == len(lists) < sum(len(v) > 1 for v in by.values())
    assert coded.count() == sum(map(len, lists)) and coded.agg(F.sum("weight")).first()[0] == sum(len(v) for v in by.values() if len(v) > 1)
    for step in ("element_codes", "join_codes"):
        monkeypatch.setattr(exact, step, lambda *a, **k: pytest.fail("a code for every element"))
    for t in (0.3, 0.7, 1.0):
        assert _d(exact_jaccard_join(sets, t, block=4)) == pytest.approx(brute_jaccard(rows, t))
    some = {k: v for k, v in brute_jaccard(rows, 0.3).items() if k[0] % 20 == 0 or k[1] % 20 == 0}
    assert _d(exact_jaccard_join(sets, 0.3, probes="id % 20 = 0")) == pytest.approx(some)
    monkeypatch.setattr(exact, "DENSE_MEETINGS", 0)
    assert _d(exact_jaccard_join(sets, 0.3)) == pytest.approx(brute_jaccard(rows, 0.3))

    values = {e: random.Random(e).choice([-2.0, -1.0, 1.0, 3.0]) for _, e in rows}
    cells = [(i, e, values[e] * (2.0 if i % 10 == 2 else 1.0)) for i, e in rows] + [(500, "the", 0.0), (501, "the", 0.0), (502, "x", 0.0)]
    vecs = spark.createDataFrame([*cells, (5, None, 1.0), (5, "n", None)], "id long, element string, value double")
    for t in (0.3, 0.8, 1.0 - 1e-12):
        found = exact_cosine_join(vecs, t, block=4)
        assert _d(found) == pytest.approx(brute_cosine(cells, t)) and found.count() == len(_d(found))
    probed = {k: v for k, v in brute_cosine(cells, 0.3).items() if k[0] % 20 == 0 or k[1] % 20 == 0}
    assert _d(exact_cosine_join(vecs, 0.3, probes="id % 20 = 0")) == pytest.approx(probed)

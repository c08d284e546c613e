"""DuckDB SQL equivalents of ``likeness.plans.queries`` (the correctness oracle).

These are plain co-occurrence / brute-force formulations over the driver's
pre-registered views; they share no code path with the Spark plans except the
hash parameters, which are literals from the same seeded generator.
"""

from __future__ import annotations

from likeness.functions.hashing import PRIME, HashFamily, element_key_sql
from likeness.plans.queries import COSINE_SETTINGS, PARAMS

P = PRIME
D = PARAMS.DIGITS

# ------------------------------------------------------------- fixtures ----
WORDS = ("words AS (SELECT DISTINCT doc_id AS id, unnest(string_split(lower(text), ' ')) AS element "
         "FROM documents)")
RUNS = ("runs AS (SELECT id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) "
        "AS element FROM (SELECT doc_id AS id, string_split(lower(text), ' ') AS w FROM documents))")
SHG = RUNS + ",\nshg AS (SELECT DISTINCT id, element FROM runs)"
SHV = RUNS + ",\nshv AS (SELECT id, element, CAST(count(*) AS DOUBLE) AS value FROM runs GROUP BY id, element)"
DAYS = "days AS (SELECT DISTINCT user_id AS id, CAST(ts AS DATE) AS element FROM events)"
NAT = ("nat AS (SELECT DISTINCT l_partkey AS id, c_nationkey AS element FROM lineitem "
       "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)")
EVT = ("evt AS (SELECT user_id AS id, json_extract_string(props, '$.k') AS element, "
       "CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY user_id, json_extract_string(props, '$.k'))")
CF_RAW = ("cf_raw AS (SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating, "
          "l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey)")
CF = "cf AS (SELECT user_id, item_id, max(rating) AS rating FROM cf_raw GROUP BY user_id, item_id)"
TRAIN = ("train AS (SELECT user_id, item_id, rating FROM cf WHERE (user_id * 7 + item_id * 13) % 20 <> 0 "
         "AND user_id % 50 <> 0 AND item_id % 50 <> 0)")
TEST = ("test AS (SELECT user_id, item_id, rating FROM cf WHERE (user_id * 7 + item_id * 13) % 20 = 0 "
        "OR user_id % 50 = 0 OR item_id % 50 = 0)")
SPLIT = [CF_RAW, CF, TRAIN, TEST]
MEANS = [
    "um AS (SELECT user_id, avg(rating) AS mean FROM train GROUP BY user_id)",
    "im AS (SELECT item_id, avg(rating) AS mean FROM train GROUP BY item_id)",
    "base AS (SELECT b.user_id, b.item_id, um.mean AS m_user, im.mean AS m_item FROM "
    "(SELECT DISTINCT user_id, item_id FROM test) b LEFT JOIN um ON um.user_id = b.user_id "
    "LEFT JOIN im ON im.item_id = b.item_id)",
]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _params(n: int) -> str:
    return f"params(i, a, b) AS (VALUES {HashFamily(n, PARAMS.SEED).values_sql()})"


def _minhash_bands(src: str, bands: int, rows: int, name: str = "bands") -> list[str]:
    ks = ", ".join(f"min(CASE WHEN i % {rows} = {r} THEN h END) AS k{r}" for r in range(rows))
    return [
        _params(bands * rows),
        f"xs AS (SELECT id, {element_key_sql('element')} AS x FROM {src})",
        f"hs AS (SELECT id, i, (x * a + b) % {P} AS h FROM xs, params)",
        f"{name} AS (SELECT id, CAST(i // {rows} AS INTEGER) AS band, {ks} FROM hs GROUP BY id, i // {rows})",
    ]


def _plane_sums(src: str, n: int) -> list[str]:
    return [
        _params(n),
        f"xs AS (SELECT id, {element_key_sql('element')} AS x, value FROM {src})",
        f"ds AS (SELECT id, i AS plane, sum(value * ((((x * a + b) % {P}) % 2) * 2 - 1)) AS d "
        "FROM xs, params GROUP BY id, i)",
    ]


def _plane_bands(src: str, bands: int, rows: int) -> list[str]:
    return _plane_sums(src, bands * rows) + [
        f"bands AS (SELECT id, CAST(plane // {rows} AS INTEGER) AS band, "
        f"CAST(sum(CASE WHEN d >= 0 THEN CAST(1 AS BIGINT) << (plane % {rows}) ELSE 0 END) AS BIGINT) AS k0 "
        f"FROM ds GROUP BY id, plane // {rows})",
    ]


def _plane_probes(src: str, bands: int, rows: int, flips: int) -> list[str]:
    if not flips:
        return _plane_bands(src, bands, rows)
    own = _plane_bands(src, bands, rows)
    return own[:-1] + [
        own[-1].replace("bands AS", "own AS", 1),
        f"margins AS (SELECT id, CAST(plane // {rows} AS INTEGER) AS band, plane % {rows} AS r, "
        f"row_number() OVER (PARTITION BY id, plane // {rows} ORDER BY abs(d), plane) AS rn FROM ds)",
        f"low AS (SELECT id, band, list(CAST(1 AS BIGINT) << r ORDER BY rn) AS m FROM margins WHERE rn <= {flips} GROUP BY id, band)",
        "bands AS (SELECT DISTINCT id, band, xor(k0, CAST(list_sum(list_transform(m, lambda x, j: "
        f"CASE WHEN (s >> CAST(j - 1 AS INTEGER)) & 1 = 1 THEN x ELSE 0 END)) AS BIGINT)) AS k0 FROM own JOIN low USING (id, band), range({1 << flips}) t(s))",
    ]


def _cand(keys: list[str]) -> str:
    on = " AND ".join(f"x.{k} = y.{k}" for k in ["band", *keys])
    return f"cand AS (SELECT DISTINCT x.id AS id_1, y.id AS id_2 FROM bands x JOIN bands y ON {on} AND x.id < y.id)"


def _jaccard_of_cand(src: str) -> list[str]:
    return [
        f"sizes AS (SELECT id, count(*) AS n FROM {src} GROUP BY id)",
        f"inter AS (SELECT c.id_1, c.id_2, count(*) AS c FROM cand c JOIN {src} a ON a.id = c.id_1 "
        f"JOIN {src} b ON b.id = c.id_2 AND b.element = a.element GROUP BY c.id_1, c.id_2)",
        "jac AS (SELECT c.id_1, c.id_2, coalesce(i.c, 0) / (n1.n + n2.n - coalesce(i.c, 0)) AS similarity "
        "FROM cand c LEFT JOIN inter i ON i.id_1 = c.id_1 AND i.id_2 = c.id_2 "
        "JOIN sizes n1 ON n1.id = c.id_1 JOIN sizes n2 ON n2.id = c.id_2)",
    ]


def _exact_jaccard(src: str, t: float) -> list[str]:
    return [
        f"sizes AS (SELECT id, count(*) AS n FROM {src} GROUP BY id)",
        f"inter AS (SELECT a.id AS id_1, b.id AS id_2, count(*) AS c FROM {src} a JOIN {src} b "
        "ON a.element = b.element AND a.id < b.id GROUP BY a.id, b.id)",
        "jx AS (SELECT i.id_1, i.id_2, i.c / (n1.n + n2.n - i.c) AS similarity FROM inter i "
        f"JOIN sizes n1 ON n1.id = i.id_1 JOIN sizes n2 ON n2.id = i.id_2)",
    ]


def _cosine_of_cand(src: str) -> list[str]:
    return [
        f"norms AS (SELECT id, sum(value * value) AS nsq FROM {src} GROUP BY id)",
        f"dots AS (SELECT c.id_1, c.id_2, sum(a.value * b.value) AS dot FROM cand c JOIN {src} a ON a.id = c.id_1 "
        f"JOIN {src} b ON b.id = c.id_2 AND b.element = a.element GROUP BY c.id_1, c.id_2)",
        "cosv AS (SELECT c.id_1, c.id_2, CASE WHEN sqrt(n1.nsq) * sqrt(n2.nsq) = 0 THEN NULL ELSE "
        "coalesce(d.dot, 0) / (sqrt(n1.nsq) * sqrt(n2.nsq)) END AS similarity "
        "FROM cand c LEFT JOIN dots d ON d.id_1 = c.id_1 AND d.id_2 = c.id_2 "
        "JOIN norms n1 ON n1.id = c.id_1 JOIN norms n2 ON n2.id = c.id_2)",
    ]


def _lsh_jaccard_sql(fixture: str = WORDS, src: str = "words", b: int = PARAMS.MINHASH_BANDS,
                     r: int = PARAMS.MINHASH_ROWS) -> str:
    ctes = [fixture, *_minhash_bands(src, b, r), _cand([f"k{i}" for i in range(r)]), *_jaccard_of_cand(src)]
    return _with(*ctes) + f"SELECT id_1, id_2, similarity FROM jac WHERE similarity >= {PARAMS.JACCARD_THRESHOLD}"


def _exact_jaccard_sql(fixture: str, src: str, t: float) -> str:
    return _with(fixture, *_exact_jaccard(src, t)) + f"SELECT id_1, id_2, similarity FROM jx WHERE similarity >= {t}"


def _lsh_cosine_sql(bands: int, rows: int, flips: int = 0) -> str:
    ctes = [EVT, *_plane_probes("evt", bands, rows, flips), _cand(["k0"]), *_cosine_of_cand("evt")]
    return _with(*ctes) + f"SELECT id_1, id_2, similarity FROM cosv WHERE similarity >= {PARAMS.COSINE_THRESHOLD}"


def _exact_cosine_sql(fixture: str = EVT, src: str = "evt") -> str:
    t = PARAMS.COSINE_THRESHOLD
    ctes = [
        fixture,
        f"cand AS (SELECT DISTINCT a.id AS id_1, b.id AS id_2 FROM {src} a JOIN {src} b ON a.element = b.element AND a.id < b.id)",
        *_cosine_of_cand(src),
    ]
    return _with(*ctes) + f"SELECT id_1, id_2, similarity FROM cosv WHERE similarity >= {t}"


# ------------------------------------------------------------------ CF -----
def _centred(means: str, key: str) -> str:
    return f"c_{key} AS (SELECT t.user_id, t.item_id, t.rating - m.mean AS d FROM train t JOIN {means} m ON m.{key} = t.{key})"


def _weights(key: str, other: str, means: str) -> list[str]:
    return [
        _centred(means, key),
        f"wsum AS (SELECT n.id_1, n.id_2, sum(a.d * b.d) AS num, sum(a.d * a.d) AS s1, sum(b.d * b.d) AS s2 "
        f"FROM needed n JOIN c_{key} a ON a.{key} = n.id_1 JOIN c_{key} b ON b.{key} = n.id_2 AND b.{other} = a.{other} "
        "GROUP BY n.id_1, n.id_2)",
        "weights AS (SELECT n.id_1, n.id_2, coalesce(CASE WHEN sqrt(w.s1) * sqrt(w.s2) = 0 THEN 0.0 "
        "ELSE w.num / (sqrt(w.s1) * sqrt(w.s2)) END, 0.0) AS weight FROM needed n "
        "LEFT JOIN wsum w ON w.id_1 = n.id_1 AND w.id_2 = n.id_2)",
    ]


USER_NEIGH = (
    "neigh AS (SELECT w.user_id, w.item_id, w.m_user AS m_base, least(w.user_id, r.user_id) AS id_1, "
    "greatest(w.user_id, r.user_id) AS id_2, r.rating - mv.mean AS dev FROM base w "
    "JOIN train r ON r.item_id = w.item_id JOIN um mv ON mv.user_id = r.user_id "
    "WHERE w.m_user IS NOT NULL AND w.m_item IS NOT NULL)"
)


def _item_neigh(candidates: bool) -> str:
    cond = " AND r.item_id <> w.item_id" if candidates else ""
    return (
        "neigh0 AS (SELECT w.user_id, w.item_id, w.m_item AS m_base, least(w.item_id, r.item_id) AS id_1, "
        "greatest(w.item_id, r.item_id) AS id_2, r.rating - mj.mean AS dev FROM base w "
        "JOIN train r ON r.user_id = w.user_id JOIN im mj ON mj.item_id = r.item_id "
        f"WHERE w.m_user IS NOT NULL AND w.m_item IS NOT NULL{cond})"
    )


NEEDED = "needed AS (SELECT DISTINCT id_1, id_2 FROM neigh)"
CF_AGG = (
    "cfp AS (SELECT n.user_id, n.item_id, n.m_base, sum(coalesce(w.weight, 0.0) * n.dev) AS num, "
    "sum(abs(coalesce(w.weight, 0.0))) AS den FROM neigh n LEFT JOIN weights w ON w.id_1 = n.id_1 AND w.id_2 = n.id_2 "
    "GROUP BY n.user_id, n.item_id, n.m_base)"
)
def _cascade(base_col: str, digits: int | None = D) -> str:
    expr = (
        "CASE WHEN b.m_user IS NOT NULL AND b.m_item IS NOT NULL THEN "
        f"(CASE WHEN c.den IS NULL OR c.den = 0 THEN b.{base_col} ELSE c.m_base + c.num / c.den END) "
        "WHEN b.m_user IS NOT NULL THEN b.m_user WHEN b.m_item IS NOT NULL THEN b.m_item ELSE 0.0 END"
    )
    if digits is not None:
        expr = f"round({expr}, {digits})"
    return (f"SELECT b.user_id, b.item_id, {expr} AS prediction "
            "FROM base b LEFT JOIN cfp c ON c.user_id = b.user_id AND c.item_id = b.item_id")


def _user_cf_ctes() -> list[str]:
    return [*SPLIT, *MEANS, USER_NEIGH, NEEDED, *_weights("user_id", "item_id", "um"), CF_AGG]


def _item_cf_ctes(candidates: bool) -> list[str]:
    ctes = [*SPLIT, *MEANS, _item_neigh(candidates)]
    if candidates:
        b, r = PARAMS.MINHASH_BANDS, PARAMS.MINHASH_ROWS
        ctes += [
            "isets AS (SELECT item_id AS id, user_id AS element FROM train)",
            *_minhash_bands("isets", b, r),
            _cand([f"k{i}" for i in range(r)]),
            "neigh AS (SELECT n.* FROM neigh0 n SEMI JOIN cand c ON c.id_1 = n.id_1 AND c.id_2 = n.id_2)",
        ]
    else:
        ctes += ["neigh AS (SELECT * FROM neigh0)"]
    return ctes + [NEEDED, *_weights("item_id", "user_id", "im"), CF_AGG]


def _user_cf_sql() -> str:
    return _with(*_user_cf_ctes()) + _cascade("m_user")


def _quality_sql(found: str, true: str) -> str:
    return (
        f"WITH lsh AS ({found}), ex AS ({true}), "
        "j AS (SELECT lsh.id_1 AS a, ex.id_1 AS t FROM lsh FULL OUTER JOIN ex ON lsh.id_1 = ex.id_1 AND lsh.id_2 = ex.id_2), "
        "c AS (SELECT count(a) AS n_found, count(t) AS n_true, count(CASE WHEN a IS NOT NULL AND t IS NOT NULL THEN 1 END) AS n_hit FROM j) "
        f"SELECT n_found, n_true, n_hit, round(CASE WHEN n_found = 0 THEN 1.0 ELSE n_hit / n_found END, {D}) AS precision, "
        f"round(CASE WHEN n_true = 0 THEN 1.0 ELSE n_hit / n_true END, {D}) AS recall FROM c"
    )


TUNED = PARAMS.TUNED_BANDS, PARAMS.TUNED_ROWS
ISETS = ", ".join([*SPLIT, "isets AS (SELECT item_id AS id, user_id AS element FROM train)"])


def _jaccard_sql(fixture: str, src: str, t: float, b: int, r: int) -> str:
    ctes = [fixture, *_minhash_bands(src, b, r), _cand([f"k{i}" for i in range(r)]), *_jaccard_of_cand(src)]
    return _with(*ctes) + f"SELECT id_1, id_2, similarity FROM jac WHERE similarity >= {t}"


def _sampled_sql() -> str:
    """Quality over the pairs that have an id divisible by 20, for every approximate join."""
    some = "id_1 % 20 = 0 OR id_2 % 20 = 0"
    t, i = PARAMS.JACCARD_THRESHOLD, PARAMS.ITEM_THRESHOLD
    joins = {
        "jaccard 50x2": (_lsh_jaccard_sql(), _exact_jaccard_sql(WORDS, "words", t)),
        "jaccard tuned": (_lsh_jaccard_sql(SHG, "shg", *TUNED), _exact_jaccard_sql(SHG, "shg", t)),
        "item candidates": (
            _jaccard_sql(ISETS, "isets", i, PARAMS.MINHASH_BANDS, PARAMS.MINHASH_ROWS), _exact_jaccard_sql(ISETS, "isets", i)),
    } | {f"cosine {name}": (_lsh_cosine_sql(*setting), _exact_cosine_sql()) for name, setting in COSINE_SETTINGS.items()}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS join, * FROM ({_quality_sql(f'SELECT * FROM ({found}) WHERE {some}', f'SELECT * FROM ({true}) WHERE {some}')})"
        for name, (found, true) in joins.items())


def _lookup_sql() -> str:
    index = "{0} AS (SELECT {1}, row_number() OVER (ORDER BY {1}) - 1 AS idx FROM (SELECT DISTINCT {1} FROM train))"
    return _with(*SPLIT, index.format("ui", "user_id"), index.format("ii", "item_id")) + (
        "SELECT t.user_id, t.item_id, ui.idx AS user_idx, ii.idx AS item_idx, ui.user_id AS user_id_back, ii.item_id AS item_id_back "
        "FROM test t LEFT JOIN ui ON ui.user_id = t.user_id LEFT JOIN ii ON ii.item_id = t.item_id")

ORACLES: dict[str, str] = {
    "ratings_dedupe": _with(CF_RAW) + (
        "SELECT user_id, item_id, rating FROM (SELECT user_id, item_id, rating, row_number() OVER ("
        "PARTITION BY user_id, item_id ORDER BY l_orderkey DESC, l_linenumber DESC, rating DESC) AS rn "
        "FROM cf_raw) WHERE rn = 1"
    ),
    "distinct_users": _with(CF_RAW, CF) + "SELECT DISTINCT user_id FROM cf",
    "distinct_items": _with(CF_RAW, CF) + "SELECT DISTINCT item_id FROM cf",
    "user_means": _with(CF_RAW, CF) + "SELECT user_id, avg(rating) AS mean, count(*) AS n FROM cf GROUP BY user_id",
    "item_means": _with(CF_RAW, CF) + "SELECT item_id, avg(rating) AS mean, count(*) AS n FROM cf GROUP BY item_id",
    "baskets": _with(DAYS) + (
        "SELECT id, count(*) AS n_rows, count(DISTINCT element) AS n_elements, "
        "CAST(min(element) AS VARCHAR) AS first_element, CAST(max(element) AS VARCHAR) AS last_element "
        "FROM days GROUP BY id"
    ),
    "dense_user_ids": _with(CF_RAW, CF) + (
        "SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM (SELECT DISTINCT user_id FROM cf)"
    ),
    "minhash_signatures": _with(
        WORDS, _params(PARAMS.MINHASH_BANDS * PARAMS.MINHASH_ROWS),
        f"xs AS (SELECT id, {element_key_sql('element')} AS x FROM words)",
    ) + f"SELECT id, i AS hash_idx, min((x * a + b) % {P}) AS value FROM xs, params GROUP BY id, i",
    "minhash_buckets": _with(
        WORDS, *_minhash_bands("words", PARAMS.MINHASH_BANDS, PARAMS.MINHASH_ROWS),
        "bs AS (SELECT band, k0, k1, count(*) AS bucket_size FROM bands GROUP BY band, k0, k1 HAVING count(*) >= 2)",
    ) + "SELECT b.band, b.k0, b.k1, b.id, s.bucket_size FROM bands b JOIN bs s ON s.band = b.band AND s.k0 = b.k0 AND s.k1 = b.k1",
    "lsh_candidates": _with(
        WORDS, *_minhash_bands("words", PARAMS.MINHASH_BANDS, PARAMS.MINHASH_ROWS), _cand(["k0", "k1"])
    ) + "SELECT id_1, id_2 FROM cand",
    "lsh_jaccard_join": _lsh_jaccard_sql(),
    "exact_jaccard_join": _exact_jaccard_sql(WORDS, "words", PARAMS.JACCARD_THRESHOLD),
    "exact_jaccard_dense": _exact_jaccard_sql(NAT, "nat", PARAMS.DENSE_THRESHOLD),
    "exact_jaccard_days": _exact_jaccard_sql(DAYS, "days", PARAMS.JACCARD_THRESHOLD),
    "hyperplane_signatures": _with(EVT, *_plane_sums("evt", PARAMS.PLANES_BANDS * PARAMS.PLANES_ROWS))
    + "SELECT id, plane, CASE WHEN d >= 0 THEN 1 ELSE -1 END AS sign FROM ds",
    "hyperplane_buckets": _with(EVT, *_plane_bands("evt", PARAMS.PLANES_BANDS, PARAMS.PLANES_ROWS))
    + "SELECT id, band, k0 FROM bands",
    "lsh_cosine_join": _lsh_cosine_sql(PARAMS.COSINE_BANDS, PARAMS.COSINE_ROWS),
    "lsh_cosine_join_20x20": _lsh_cosine_sql(PARAMS.PLANES_BANDS, PARAMS.PLANES_ROWS),
    "exact_cosine_join": _exact_cosine_sql(),
    "exact_cosine_shingles": _exact_cosine_sql(SHV, "shv"),
    "lsh_candidates_tuned": _with(
        SHG, *_minhash_bands("shg", *TUNED), _cand([f"k{i}" for i in range(PARAMS.TUNED_ROWS)])
    ) + "SELECT id_1, id_2 FROM cand",
    "lsh_jaccard_tuned": _lsh_jaccard_sql(SHG, "shg", *TUNED),
    "exact_jaccard_shingles": _exact_jaccard_sql(SHG, "shg", PARAMS.JACCARD_THRESHOLD),
    "join_quality": _quality_sql(_lsh_jaccard_sql(), _exact_jaccard_sql(WORDS, "words", PARAMS.JACCARD_THRESHOLD)),
    "join_quality_tuned": _quality_sql(
        _lsh_jaccard_sql(SHG, "shg", *TUNED), _exact_jaccard_sql(SHG, "shg", PARAMS.JACCARD_THRESHOLD)
    ),
    "join_quality_cosine": _quality_sql(_lsh_cosine_sql(PARAMS.COSINE_BANDS, PARAMS.COSINE_ROWS), _exact_cosine_sql()),
    "user_pearson": _with(*SPLIT, *MEANS, USER_NEIGH, NEEDED, *_weights("user_id", "item_id", "um"))
    + f"SELECT id_1, id_2, round(weight, {D}) AS weight FROM weights",
    "item_pearson": _with(*_item_cf_ctes(False)[:-1])
    + f"SELECT id_1, id_2, round(weight, {D}) AS weight FROM weights",
    "user_cf": _user_cf_sql(),
    "item_cf": _with(*_item_cf_ctes(False)) + _cascade("m_item"),
    "item_cf_lsh": _with(*_item_cf_ctes(True)) + _cascade("m_item"),
    "cold_start": _with(*SPLIT, *MEANS) + (
        "SELECT user_id, item_id, round(CASE WHEN m_user IS NOT NULL THEN m_user WHEN m_item IS NOT NULL "
        f"THEN m_item ELSE 0.0 END, {D}) AS prediction FROM base WHERE m_user IS NULL OR m_item IS NULL"
    ),
    "rating_error": (
        f"WITH {','.join(_user_cf_ctes())}, pred AS ({_cascade('m_user', None)}), "
        "e AS (SELECT p.prediction - t.rating AS e FROM test t JOIN pred p ON p.user_id = t.user_id AND p.item_id = t.item_id) "
        f"SELECT count(*) AS n, round(avg(e * e), {D}) AS mse, round(sqrt(avg(e * e)), {D}) AS rmse, "
        f"round(avg(abs(e)), {D}) AS mae FROM e"
    ),
    "als_check": _with(*SPLIT, *MEANS) + (
        "SELECT (SELECT count(DISTINCT user_id) FROM train) AS n_users, (SELECT count(*) FROM train) AS n_ratings, true AS solved, "
        "(SELECT count(*) FROM base WHERE m_user IS NULL OR m_item IS NULL) AS n_cold, true AS cold_equal, "
        "(SELECT count(*) FROM base) AS n_predictions, true AS below_variance"
    ),
    "als_bundle": _with(*SPLIT) + (
        "SELECT DISTINCT 'user-' || user_id AS user_id, 'item-' || item_id AS item_id, true AS same FROM test"
    ),
    "lsh_cosine_multiprobe": _lsh_cosine_sql(PARAMS.PLANES_BANDS, PARAMS.PLANES_ROWS, PARAMS.FLIPS),
    "cosine_candidate_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS setting, count(*) AS n_candidates FROM ({_with(EVT, *_plane_probes('evt', *setting), _cand(['k0']))}SELECT * FROM cand)"
        for name, setting in COSINE_SETTINGS.items()),
    "sampled_recall": _sampled_sql(),
    "test_pairs_from_file": _with(*SPLIT) + "SELECT user_id, item_id, true AS unrated FROM test",
    "sorted_lines": (
        f"WITH p AS ({_lsh_jaccard_sql(SHG, 'shg', *TUNED)}) SELECT 0 AS line, 'business_id_1, business_id_2, similarity' AS value UNION ALL "
        "SELECT row_number() OVER (ORDER BY id_1, id_2) AS line, id_1 || ', ' || id_2 || ', ' || CAST(similarity AS VARCHAR) AS value FROM p"
    ),
    "table_counts": _with(CF_RAW, CF) + (
        "SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items FROM cf"
    ),
    "basket_members": (
        "SELECT user_id AS id, CAST(CAST(ts AS DATE) AS VARCHAR) AS element, count(*) AS n_rows FROM events GROUP BY user_id, CAST(ts AS DATE)"
    ),
    "id_lookup": _lookup_sql(),
    # als_predict: iterative and seeded per engine -- no SQL oracle (rows-only check)
}
# files written and read again give the tables they were written from
ORACLES |= {
    "ratings_from_file": ORACLES["ratings_dedupe"],
    "pairs_from_file": ORACLES["lsh_jaccard_tuned"],
    "predictions_from_file": ORACLES["item_cf"],
}

"""One callable per operator group of SURVEY §7.2: ``(spark, sf_dir) -> DataFrame``.

Every plan reads whole driver tables (through ``likeness.sources.tables``) and
returns a DataFrame with aliased columns matching the oracle SQL; intermediates
that several branches read are written while the plan is built.
Doubles that are order-dependent sums (CF weights and predictions, error
metrics) are rounded to 6 places here and in the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness.functions.encoding import numbered
from likeness.operators import cf as cfops
from likeness.operators.als import als_residuals, fit_als, load_als, predict_als
from likeness.operators.dedupe import (
    basket_members, baskets, dedupe_ratings, dense_ids, distinct_items, distinct_users, entity_means,
)
from likeness.operators.evaluate import join_quality, rating_error, sampled_quality
from likeness.operators.exact import exact_cosine_join, exact_jaccard_join
from likeness.operators.lsh import (
    band_candidates, band_parameters, bucket_members, by_id, cosine_candidates, hyperplane_bands, hyperplane_signatures, lsh_cosine_join,
    lsh_jaccard_join, minhash_bands, minhash_signatures,
)
from likeness.session import materialize, scratch
from likeness.sinks import write_predictions, write_similarity_pairs
from likeness.sources import read_ratings, read_similarity_pairs, read_test_pairs
from likeness.sources import tables as T
from likeness.sources.files import POSITION


class PARAMS:
    # The reference's banding (MinHash 50x2, hyperplanes 20x20)
    # and its similarity threshold; cosine joins at 0.5 use 50x8 bands.
    SEED = 42
    JACCARD_THRESHOLD = 0.5
    DENSE_THRESHOLD = 0.8
    ITEM_THRESHOLD = 0.1
    MINHASH_BANDS, MINHASH_ROWS = 50, 2
    PLANES_BANDS, PLANES_ROWS = 20, 20
    COSINE_BANDS, COSINE_ROWS = 50, 8
    COSINE_THRESHOLD = 0.5
    # signs that an id flips in a band of 20x20, norm that the cosine index may leave out
    FLIPS = 6
    RESIDUAL = 0.1
    SAMPLED = "id % 20 = 0"
    TUNED_RECALL = 0.98
    TUNED_BANDS, TUNED_ROWS = band_parameters(JACCARD_THRESHOLD, TUNED_RECALL)
    DIGITS = 6


def _r(c: str) -> F.Column:
    return F.round(F.col(c), PARAMS.DIGITS).alias(c)


# ---------------------------------------------------------------- ratings ---

def q_ratings_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    raw = T.raw_cf_ratings(spark, sf)
    return dedupe_ratings(raw, order_col=F.struct("l_orderkey", "l_linenumber", "rating"))


def q_distinct_users(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_users(T.cf_ratings(spark, sf))


def q_distinct_items(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_items(T.cf_ratings(spark, sf))


def q_user_means(spark: SparkSession, sf: str) -> DataFrame:
    return entity_means(T.cf_ratings(spark, sf), "user_id")


def q_item_means(spark: SparkSession, sf: str) -> DataFrame:
    return entity_means(T.cf_ratings(spark, sf), "item_id")


def q_baskets(spark: SparkSession, sf: str) -> DataFrame:
    b = baskets(T.day_sets(spark, sf))
    return b.select("id", "n_rows", "n_elements",
                    F.col("first_element").cast("string").alias("first_element"),
                    F.col("last_element").cast("string").alias("last_element"))


def q_dense_user_ids(spark: SparkSession, sf: str) -> DataFrame:
    return dense_ids(T.cf_ratings(spark, sf), "user_id", "idx")


# ------------------------------------------------------------ similarity ---
# MinHash takes rows as they stand, since a repeated element changes no minimum

def q_minhash_signatures(spark: SparkSession, sf: str) -> DataFrame:
    return minhash_signatures(T.words(spark, sf), PARAMS.MINHASH_BANDS * PARAMS.MINHASH_ROWS, PARAMS.SEED, together=True)


def _doc_bands(spark: SparkSession, sf: str) -> DataFrame:
    return minhash_bands(T.words(spark, sf), PARAMS.MINHASH_BANDS, PARAMS.MINHASH_ROWS, PARAMS.SEED, together=True)


def q_minhash_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return bucket_members(_doc_bands(spark, sf))


def q_lsh_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return band_candidates(_doc_bands(spark, sf))


def q_lsh_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return lsh_jaccard_join(T.words(spark, sf), PARAMS.JACCARD_THRESHOLD,
                            PARAMS.MINHASH_BANDS, PARAMS.MINHASH_ROWS, PARAMS.SEED, together=True)


def q_exact_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return exact_jaccard_join(T.word_sets(spark, sf), PARAMS.JACCARD_THRESHOLD)


def q_lsh_candidates_tuned(spark: SparkSession, sf: str) -> DataFrame:
    return band_candidates(minhash_bands(T.shingles(spark, sf), PARAMS.TUNED_BANDS, PARAMS.TUNED_ROWS, PARAMS.SEED, together=True))


def q_lsh_jaccard_tuned(spark: SparkSession, sf: str) -> DataFrame:
    return lsh_jaccard_join(T.shingles(spark, sf), PARAMS.JACCARD_THRESHOLD,
                            PARAMS.TUNED_BANDS, PARAMS.TUNED_ROWS, PARAMS.SEED, together=True)


def q_exact_jaccard_shingles(spark: SparkSession, sf: str) -> DataFrame:
    return exact_jaccard_join(T.shingle_sets(spark, sf), PARAMS.JACCARD_THRESHOLD)


def q_join_quality_tuned(spark: SparkSession, sf: str) -> DataFrame:
    q = join_quality(q_lsh_jaccard_tuned(spark, sf), q_exact_jaccard_shingles(spark, sf))
    return q.select("n_found", "n_true", "n_hit", _r("precision"), _r("recall"))


def q_exact_jaccard_dense(spark: SparkSession, sf: str) -> DataFrame:
    return exact_jaccard_join(T.nation_sets(spark, sf), PARAMS.DENSE_THRESHOLD)


def q_exact_jaccard_days(spark: SparkSession, sf: str) -> DataFrame:
    return exact_jaccard_join(T.day_sets(spark, sf), PARAMS.JACCARD_THRESHOLD)


def q_hyperplane_signatures(spark: SparkSession, sf: str) -> DataFrame:
    return hyperplane_signatures(T.event_vectors(spark, sf), PARAMS.PLANES_BANDS * PARAMS.PLANES_ROWS, PARAMS.SEED)


def q_hyperplane_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return hyperplane_bands(T.event_vectors(spark, sf), PARAMS.PLANES_BANDS, PARAMS.PLANES_ROWS, PARAMS.SEED)


def q_lsh_cosine_join(spark: SparkSession, sf: str) -> DataFrame:
    return lsh_cosine_join(T.event_vectors(spark, sf), PARAMS.COSINE_THRESHOLD,
                           PARAMS.COSINE_BANDS, PARAMS.COSINE_ROWS, PARAMS.SEED)


def q_lsh_cosine_join_20x20(spark: SparkSession, sf: str) -> DataFrame:
    return lsh_cosine_join(T.event_vectors(spark, sf), PARAMS.COSINE_THRESHOLD,
                           PARAMS.PLANES_BANDS, PARAMS.PLANES_ROWS, PARAMS.SEED)


def q_exact_cosine_join(spark: SparkSession, sf: str) -> DataFrame:
    return exact_cosine_join(T.event_vectors(spark, sf), PARAMS.COSINE_THRESHOLD, residual=PARAMS.RESIDUAL)


def q_lsh_cosine_multiprobe(spark: SparkSession, sf: str) -> DataFrame:
    return lsh_cosine_join(T.event_vectors(spark, sf), PARAMS.COSINE_THRESHOLD,
                           PARAMS.PLANES_BANDS, PARAMS.PLANES_ROWS, PARAMS.SEED, flips=PARAMS.FLIPS)


COSINE_SETTINGS = {
    "50x8": (PARAMS.COSINE_BANDS, PARAMS.COSINE_ROWS, 0),
    "20x20": (PARAMS.PLANES_BANDS, PARAMS.PLANES_ROWS, 0),
    "20x20 multi-probe": (PARAMS.PLANES_BANDS, PARAMS.PLANES_ROWS, PARAMS.FLIPS),
}


def q_cosine_candidate_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many pairs each banding would verify."""
    vectors, out = materialize(T.event_vectors(spark, sf)), None
    for name, (bands, rows, flips) in COSINE_SETTINGS.items():
        one = cosine_candidates(vectors, bands, rows, PARAMS.SEED, flips=flips).agg(F.count(F.lit(1)).alias("n_candidates"))
        one = one.select(F.lit(name).alias("setting"), "n_candidates")
        out = one if out is None else out.union(one)
    return out


def _item_sets(train: DataFrame) -> DataFrame:
    return train.select(F.col("item_id").alias("id"), F.col("user_id").alias("element"))


def q_sampled_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Precision and recall of every approximate join, from the pairs that have an
    id divisible by 20, which only the exact joins of these ids are needed for."""
    P = PARAMS
    words, runs, vectors = T.word_sets(spark, sf), T.shingle_sets(spark, sf), T.event_vectors(spark, sf)
    items = materialize(_item_sets(T.cf_split(spark, sf)[0]))
    exact_vectors = materialize(exact_cosine_join(vectors, P.COSINE_THRESHOLD, residual=P.RESIDUAL, probes=P.SAMPLED))
    joins = {
        "jaccard 50x2": (q_lsh_jaccard_join(spark, sf), exact_jaccard_join(words, P.JACCARD_THRESHOLD, probes=P.SAMPLED)),
        "jaccard tuned": (q_lsh_jaccard_tuned(spark, sf), exact_jaccard_join(runs, P.JACCARD_THRESHOLD, probes=P.SAMPLED)),
        "item candidates": (
            lsh_jaccard_join(by_id(items)[0], P.ITEM_THRESHOLD, P.MINHASH_BANDS, P.MINHASH_ROWS, P.SEED, together=True),
            exact_jaccard_join(items, P.ITEM_THRESHOLD, probes=P.SAMPLED)),
    }
    for name, (bands, rows, flips) in COSINE_SETTINGS.items():
        joins[f"cosine {name}"] = (lsh_cosine_join(vectors, P.COSINE_THRESHOLD, bands, rows, P.SEED, flips=flips), exact_vectors)
    out = None
    for name, (found, true) in joins.items():
        q = sampled_quality(found, true, P.SAMPLED).select(
            F.lit(name).alias("join"), "n_found", "n_true", "n_hit", _r("precision"), _r("recall"))
        out = q if out is None else out.union(q)
    return out


def q_exact_cosine_shingles(spark: SparkSession, sf: str) -> DataFrame:
    return exact_cosine_join(T.shingle_vectors(spark, sf), PARAMS.COSINE_THRESHOLD)


def q_join_quality_cosine(spark: SparkSession, sf: str) -> DataFrame:
    q = join_quality(q_lsh_cosine_join(spark, sf), q_exact_cosine_join(spark, sf))
    return q.select("n_found", "n_true", "n_hit", _r("precision"), _r("recall"))


def q_join_quality(spark: SparkSession, sf: str) -> DataFrame:
    q = join_quality(q_lsh_jaccard_join(spark, sf), q_exact_jaccard_join(spark, sf))
    return q.select("n_found", "n_true", "n_hit", _r("precision"), _r("recall"))


# ------------------------------------------------------------------- CF ----

def q_user_pearson(spark: SparkSession, sf: str) -> DataFrame:
    train, test = T.cf_split(spark, sf)
    train = materialize(train)
    w = cfops.pearson_weights(cfops.needed_pairs(train, test, "user"), train, "user_id", "item_id")
    return w.select("id_1", "id_2", _r("weight"))


def q_item_pearson(spark: SparkSession, sf: str) -> DataFrame:
    train, test = T.cf_split(spark, sf)
    train = materialize(train)
    w = cfops.pearson_weights(cfops.needed_pairs(train, test, "item"), train, "item_id", "user_id")
    return w.select("id_1", "id_2", _r("weight"))


def q_user_cf(spark: SparkSession, sf: str) -> DataFrame:
    train, test = T.cf_split(spark, sf)
    return cfops.predict_user_cf(train, test).select("user_id", "item_id", _r("prediction"))


def q_item_cf(spark: SparkSession, sf: str) -> DataFrame:
    train, test = T.cf_split(spark, sf)
    return cfops.predict_item_cf(train, test).select("user_id", "item_id", _r("prediction"))


def item_candidates(train: DataFrame) -> DataFrame:
    """MinHash 50x2 candidates among training items (item -> set of users)."""
    sets, whole = by_id(_item_sets(train))
    return band_candidates(minhash_bands(sets, PARAMS.MINHASH_BANDS, PARAMS.MINHASH_ROWS, PARAMS.SEED, together=True, whole=whole))


def q_item_cf_lsh(spark: SparkSession, sf: str) -> DataFrame:
    train, test = T.cf_split(spark, sf)
    train = materialize(train)
    pred = cfops.predict_item_cf(train, test, candidates=materialize(item_candidates(train)))
    return pred.select("user_id", "item_id", _r("prediction"))


def q_cold_start(spark: SparkSession, sf: str) -> DataFrame:
    """The cascade alone: test pairs whose user or item has no training rating."""
    return _cold(*T.cf_split(spark, sf))


def _cold(train: DataFrame, test: DataFrame) -> DataFrame:
    um = entity_means(train, "user_id").select("user_id", F.col("mean").alias("m_user"))
    im = entity_means(train, "item_id").select("item_id", F.col("mean").alias("m_item"))
    base = test.select("user_id", "item_id").distinct().join(um, "user_id", "left").join(im, "item_id", "left")
    cold = base.where(F.col("m_user").isNull() | F.col("m_item").isNull()).withColumn("cf", F.lit(None).cast("double"))
    return cfops.cold_start(cold).select("user_id", "item_id", _r("prediction"))


def q_rating_error(spark: SparkSession, sf: str) -> DataFrame:
    train, test = T.cf_split(spark, sf)
    pred = cfops.predict_user_cf(train, test)
    e = rating_error(test, pred, ["user_id", "item_id"])
    return e.select("n", _r("mse"), _r("rmse"), _r("mae"))


def q_als_check(spark: SparkSession, sf: str) -> DataFrame:
    """What every right ALS fit must show, whatever its seed: the user factors
    solve their normal equations, cold pairs get the cascade, and the fitted
    ratings are closer than their mean."""
    train, test = T.cf_split(spark, sf)
    fit = fit_als(train, seed=PARAMS.SEED, materialize=False)
    solved = als_residuals(fit, train).agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_ratings"),
        (F.max(F.col("residual") / F.col("size")) < 1e-3).alias("solved"))
    pred = materialize(predict_als(fit, test))
    cold = _cold(train, test).select("user_id", "item_id", F.col("prediction").alias("cold"))
    same = pred.join(cold, ["user_id", "item_id"]).agg(
        F.count(F.lit(1)).alias("n_cold"), F.max(F.abs(F.round("prediction", PARAMS.DIGITS) - F.col("cold"))).alias("_far")).select(
        "n_cold", (F.coalesce("_far", F.lit(0.0)) <= 1e-6).alias("cold_equal"))
    fitted = rating_error(train, predict_als(fit, train), ["user_id", "item_id"]).select("mse")
    spread = train.agg(F.var_pop("rating").alias("_var"))
    n = pred.agg(F.count(F.lit(1)).alias("n_predictions"))
    # five tables of one row
    return solved.join(same).join(n).join(fitted.join(spread).select((F.col("mse") < F.col("_var")).alias("below_variance")))


def q_als_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """A saved and loaded ALS predictor on string ids predicts as the first one."""
    def named(df: DataFrame) -> DataFrame:
        return df.withColumn("user_id", F.format_string("user-%d", "user_id")).withColumn("item_id", F.format_string("item-%d", "item_id"))

    train, test = (materialize(named(x)) for x in T.cf_split(spark, sf))
    fit = fit_als(train, seed=PARAMS.SEED, materialize=False)
    path = scratch(spark, "als")
    fit.save(path)
    first = predict_als(fit, test)
    again = predict_als(load_als(spark, path), test).withColumnRenamed("prediction", "loaded")
    return first.join(again, ["user_id", "item_id"], "full").select(
        "user_id", "item_id", F.col("prediction").eqNullSafe(F.col("loaded")).alias("same"))


# ----------------------------------------------------- files and lookups ---

def q_ratings_from_file(spark: SparkSession, sf: str) -> DataFrame:
    """Raw ratings written as CSV in the order of their lines, read with their
    places in the files, and de-duplicated: the last line wins."""
    path = scratch(spark, "ratings")
    raw = T.raw_cf_ratings(spark, sf).orderBy("l_orderkey", "l_linenumber", "rating")
    raw.select("user_id", F.col("item_id").alias("business_id"), F.col("rating").alias("stars")).write.option("header", True).csv(path)
    rows = read_ratings(spark, path, position=True)
    last = dedupe_ratings(rows, "user_id", "business_id", "stars", order_col=POSITION)
    return last.select(
        F.col("user_id").cast("long"), F.col("business_id").cast("long").alias("item_id"), F.col("stars").alias("rating"))


def q_test_pairs_from_file(spark: SparkSession, sf: str) -> DataFrame:
    """Test pairs written with two columns only, and read without a rating."""
    path = scratch(spark, "test")
    T.cf_split(spark, sf)[1].select("user_id", F.col("item_id").alias("business_id")).write.option("header", True).csv(path)
    rows = read_test_pairs(spark, path)
    return rows.select(
        F.col("user_id").cast("long"), F.col("business_id").cast("long").alias("item_id"), F.col("stars").isNull().alias("unrated"))


def q_pairs_from_file(spark: SparkSession, sf: str) -> DataFrame:
    """The tuned join's pairs, written sorted with a manifest, checked and read again."""
    path = scratch(spark, "pairs")
    write_similarity_pairs(q_lsh_jaccard_tuned(spark, sf), path)
    rows = read_similarity_pairs(spark, path, check=True)
    return rows.select(F.col("id_1").cast("long"), F.col("id_2").cast("long"), "similarity")


def q_sorted_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the original text form, in the order of the files."""
    path = scratch(spark, "lines")
    write_similarity_pairs(q_lsh_jaccard_tuned(spark, sf), path, exact_text=True)
    lines = spark.read.text(path).select(
        "value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("at"))
    return numbered(materialize(lines), [F.col("at")], "line").select("line", "value")


def q_predictions_from_file(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "predictions")
    write_predictions(q_item_cf(spark, sf), path, item_col="item_id")
    rows = spark.read.option("header", True).schema("user_id long, business_id long, prediction double").csv(path)
    return rows.withColumnRenamed("business_id", "item_id")


def q_table_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, users and items of the ratings (AGG1)."""
    r = materialize(T.cf_ratings(spark, sf))
    return r.agg(F.count(F.lit(1)).alias("n_ratings")).join(distinct_users(r).agg(F.count(F.lit(1)).alias("n_users"))).join(
        distinct_items(r).agg(F.count(F.lit(1)).alias("n_items")))


def q_basket_members(spark: SparkSession, sf: str) -> DataFrame:
    """Baskets with real repeats: how many events of a user fall on a day."""
    b = basket_members(T.event_days(spark, sf))
    return b.select("id", F.col("element").cast("string").alias("element"), "n_rows")


def q_id_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Test pairs with the dense numbers of the training ids, NULL for ids that are
    not in training, and the ids that the numbers stand for."""
    train, test = (materialize(x) for x in T.cf_split(spark, sf))
    out = test.select("user_id", "item_id")
    for col in ("user_id", "item_id"):
        index = materialize(dense_ids(train, col, col.replace("_id", "_idx")))
        out = out.join(index, col, "left").join(index.withColumnRenamed(col, f"{col}_back"), col.replace("_id", "_idx"), "left")
    return out.select("user_id", "item_id", "user_idx", "item_idx", "user_id_back", "item_id_back")


def q_als_predict(spark: SparkSession, sf: str) -> DataFrame:
    train, test = T.cf_split(spark, sf)
    fit = fit_als(train, seed=PARAMS.SEED, materialize=False)
    return predict_als(fit, test)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ratings_dedupe": q_ratings_dedupe,
    "distinct_users": q_distinct_users,
    "distinct_items": q_distinct_items,
    "user_means": q_user_means,
    "item_means": q_item_means,
    "baskets": q_baskets,
    "dense_user_ids": q_dense_user_ids,
    "minhash_signatures": q_minhash_signatures,
    "minhash_buckets": q_minhash_buckets,
    "lsh_candidates": q_lsh_candidates,
    "lsh_jaccard_join": q_lsh_jaccard_join,
    "exact_jaccard_join": q_exact_jaccard_join,
    "lsh_candidates_tuned": q_lsh_candidates_tuned,
    "lsh_jaccard_tuned": q_lsh_jaccard_tuned,
    "exact_jaccard_shingles": q_exact_jaccard_shingles,
    "join_quality_tuned": q_join_quality_tuned,
    "exact_jaccard_dense": q_exact_jaccard_dense,
    "exact_jaccard_days": q_exact_jaccard_days,
    "hyperplane_signatures": q_hyperplane_signatures,
    "hyperplane_buckets": q_hyperplane_buckets,
    "lsh_cosine_join": q_lsh_cosine_join,
    "lsh_cosine_join_20x20": q_lsh_cosine_join_20x20,
    "exact_cosine_join": q_exact_cosine_join,
    "exact_cosine_shingles": q_exact_cosine_shingles,
    "join_quality_cosine": q_join_quality_cosine,
    "join_quality": q_join_quality,
    "user_pearson": q_user_pearson,
    "item_pearson": q_item_pearson,
    "user_cf": q_user_cf,
    "item_cf": q_item_cf,
    "item_cf_lsh": q_item_cf_lsh,
    "cold_start": q_cold_start,
    "rating_error": q_rating_error,
    "als_predict": q_als_predict,
    "als_check": q_als_check,
    "als_bundle": q_als_bundle,
    "lsh_cosine_multiprobe": q_lsh_cosine_multiprobe,
    "cosine_candidate_counts": q_cosine_candidate_counts,
    "sampled_recall": q_sampled_recall,
    "ratings_from_file": q_ratings_from_file,
    "test_pairs_from_file": q_test_pairs_from_file,
    "pairs_from_file": q_pairs_from_file,
    "sorted_lines": q_sorted_lines,
    "predictions_from_file": q_predictions_from_file,
    "table_counts": q_table_counts,
    "basket_members": q_basket_members,
    "id_lookup": q_id_lookup,
}

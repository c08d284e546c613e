"""likeness: similarity joins and collaborative filtering as Spark DataFrame plans.

Every public function takes DataFrames and returns a DataFrame; intermediates
that several branches read are written to the shared checkpoint folder while the
plan is built.  Nothing is collected to the driver and no Python UDF runs.
"""

from likeness.functions.hashing import HashFamily
from likeness.operators.dedupe import (
    dedupe_ratings, distinct_users, distinct_items, entity_means, baskets, basket_members, dense_ids,
)
from likeness.operators.verify import jaccard_of, cosine_of
from likeness.operators.exact import exact_jaccard_join, exact_cosine_join
from likeness.operators.lsh import (
    minhash_signatures, minhash_bands, hyperplane_signatures, hyperplane_bands,
    hyperplane_probes, band_candidates, lsh_jaccard_join, lsh_cosine_join,
)
from likeness.operators.cf import (
    pearson_weights, predict_user_cf, predict_item_cf, cold_start, needed_pairs,
)
from likeness.operators.als import als_residuals, fit_als, load_als, predict_als
from likeness.operators.evaluate import rating_error, join_quality, sampled_quality

__all__ = [
    "HashFamily",
    "dedupe_ratings", "distinct_users", "distinct_items", "entity_means", "baskets", "basket_members", "dense_ids",
    "jaccard_of", "cosine_of", "exact_jaccard_join", "exact_cosine_join",
    "minhash_signatures", "minhash_bands", "hyperplane_signatures", "hyperplane_bands", "hyperplane_probes",
    "band_candidates", "lsh_jaccard_join", "lsh_cosine_join",
    "pearson_weights", "predict_user_cf", "predict_item_cf", "cold_start", "needed_pairs",
    "fit_als", "predict_als", "load_als", "als_residuals", "rating_error", "join_quality", "sampled_quality",
]

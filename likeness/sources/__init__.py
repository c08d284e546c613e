"""Readers: rating / test-pair / similarity-pair files and the driver tables."""

from likeness.sources.files import (
    RATINGS, TEST_PAIRS, SIM_PAIRS, read_ratings, read_test_pairs, read_similarity_pairs,
)

__all__ = ["RATINGS", "TEST_PAIRS", "SIM_PAIRS", "read_ratings", "read_test_pairs", "read_similarity_pairs"]

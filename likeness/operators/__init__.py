"""DataFrame operators: de-duplication, similarity joins, LSH, CF, ALS, evaluation."""

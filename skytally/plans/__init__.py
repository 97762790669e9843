"""The continuous queries, assembled from the operators."""

"""Operators of the inventory: validation, features, similarity, K-NN, splits, tuning, evaluation."""

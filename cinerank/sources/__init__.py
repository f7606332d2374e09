"""Ratings tables: derivations from the driver tables, file I/O, persistence, synthetic data."""

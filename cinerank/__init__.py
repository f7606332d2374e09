"""cinerank: explicit-feedback ratings analytics and user-based K-NN on Spark.

Subpackages: ``sources`` (derivations, files, persistence), ``operators``
(validation, features, similarity, K-NN, tuning, evaluation), ``functions``
(shared expressions and distributed ordering helpers), ``plans`` (registered
queries, oracles, end-to-end workflows), ``streaming`` (file-stream ingest).
"""

__version__ = "0.1.0"

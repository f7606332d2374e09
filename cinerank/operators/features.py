"""Features: the rating matrix in long (sparse) form and what is derived from it.

The reference builds a dense users x movies matrix with 0.0 for "unrated".
Here a matrix cell is a row; absence of a row is 0.  The wide matrix (F2) and
dense per-user vectors (F8) exist only as export operators.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import with_scalars
from ..functions.ranking import dense_index, maybe_broadcast, reliable_checkpoint, top_n_per_group, with_dense_index
from .similarity import (candidate_pairs, cosine_similarity, plan_layout, similarity_with_self,
                         top_neighbors)


def rating_cells(ratings: DataFrame) -> DataFrame:
    """one row per (user, movie); duplicate ratings are averaged (the
    pivot's default aggregate) and cells that average to 0 or null vanish
    (0 cannot be told from "unrated")."""
    return (ratings.groupBy("user_id", "movie_id").agg(F.avg("rating").alias("rating"))
            .where(F.col("rating").isNotNull() & (F.col("rating") != 0)))


def catalogue(cells: DataFrame) -> DataFrame:
    """Distinct movie ids of the matrix columns."""
    return cells.select("movie_id").distinct()


def user_index(cells: DataFrame) -> DataFrame:
    """(user_id, user_idx) — ascending ids to 0-based positions."""
    return with_dense_index(cells.select("user_id").distinct(), ["user_id"], "user_idx")


def movie_index(cells: DataFrame) -> DataFrame:
    """(movie_id, movie_idx)."""
    return with_dense_index(catalogue(cells), ["movie_id"], "movie_idx")


def rating_matrix(cells: DataFrame, movies: list[int] | None = None) -> DataFrame:
    """F2: the wide users x movies matrix, 0.0 where unrated.  Column names are
    the movie ids: the declared ``movies``, or the whole catalogue (a wide table's
    column names are driver metadata, so the ids are read).  A rated movie that
    isn't declared fails the job."""
    if movies is None:
        movies = [r[0] for r in catalogue(cells).orderBy("movie_id").collect()]
    listed = F.array(*[F.lit(m).cast("bigint") for m in movies])
    known = F.when(F.array_contains(listed, F.col("movie_id")), F.col("movie_id")).otherwise(
        F.raise_error(F.concat(F.lit("movie not in the declared list: "), F.col("movie_id").cast("string"))).cast("bigint"))
    wide = cells.withColumn("movie_id", known).groupBy("user_id").pivot("movie_id", movies).agg(F.first("rating"))
    return wide.na.fill(0.0)


def matrix_blocks(cells: DataFrame, block_users: int = 512, block_movies: int = 2048) -> tuple[DataFrame, DataFrame, DataFrame]:
    """F2 beyond the pivot's limit: (blocks, user index, movie index).

    The matrix as a table of compressed sparse row blocks, one row a block of
    ``block_users`` x ``block_movies``: user_block, movie_block, rows (indexes inside
    the block of the users that have ratings there), starts (where each one's
    entries begin, and the end), columns and ratings.  No list of ids leaves the
    cluster; a block holds at most block_users * block_movies entries.
    """
    users, _ = dense_index(cells.select("user_id").distinct(), ["user_id"], "user_idx")
    movies, _ = dense_index(catalogue(cells), ["movie_id"], "movie_idx")
    users, movies = (reliable_checkpoint(x) for x in (users, movies))
    at = (cells.join(users, "user_id").join(movies, "movie_id")
          .select(F.floor(F.col("user_idx") / block_users).alias("user_block"), F.floor(F.col("movie_idx") / block_movies).alias("movie_block"),
                  (F.col("user_idx") % block_users).cast("int").alias("row"), (F.col("movie_idx") % block_movies).cast("int").alias("column"), "rating"))
    lines = (at.groupBy("user_block", "movie_block", "row")
             .agg(F.sort_array(F.collect_list(F.struct("column", "rating"))).alias("entries")))
    blocks = lines.groupBy("user_block", "movie_block").agg(F.sort_array(F.collect_list(F.struct("row", "entries"))).alias("lines"))
    sizes = F.transform("lines", lambda x: F.size(x["entries"]))
    starts = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    entries = F.flatten(F.col("lines.entries"))
    return blocks.select("user_block", "movie_block", F.col("lines.row").alias("rows"), starts.alias("starts"),
                         F.transform(entries, lambda e: e["column"]).alias("columns"),
                         F.transform(entries, lambda e: e["rating"]).alias("ratings")), users, movies


def cells_of_blocks(blocks: DataFrame, users: DataFrame, movies: DataFrame, block_users: int = 512, block_movies: int = 2048) -> DataFrame:
    """The cells (user_id, movie_id, rating) that :func:`matrix_blocks` was made from."""
    line = blocks.select("user_block", "movie_block", "starts", "columns", "ratings", F.posexplode("rows").alias("nr", "row"))
    first = F.get("starts", F.col("nr"))
    size = F.get("starts", F.col("nr") + 1) - first
    pairs = F.arrays_zip(F.slice("columns", first + 1, size).alias("column"), F.slice("ratings", first + 1, size).alias("rating"))
    cells = line.select("user_block", "movie_block", "row", F.explode(pairs).alias("e")).select(
        (F.col("user_block") * block_users + F.col("row")).alias("user_idx"),
        (F.col("movie_block") * block_movies + F.col("e.column")).alias("movie_idx"), F.col("e.rating").alias("rating"))
    return cells.join(users, "user_idx").join(movies, "movie_idx").select("user_id", "movie_id", "rating")


def matrix_density(cells: DataFrame) -> DataFrame:
    """shape, non-zero cells, possible cells, density and sparsity."""
    s = cells.agg(F.count_distinct("user_id").cast("bigint").alias("n_users"),
                  F.count_distinct("movie_id").cast("bigint").alias("n_movies"),
                  F.count(F.lit(1)).cast("bigint").alias("n_ratings"))
    s = s.withColumn("max_possible", F.col("n_users") * F.col("n_movies"))
    dens = F.col("n_ratings") / F.col("max_possible")
    return s.select("*", dens.alias("density"), (1 - dens).alias("sparsity"))


def user_similarity(cells: DataFrame) -> DataFrame:
    """(user_id, neighbor_id, similarity) for every pair with similarity > 0;
    self pairs excluded (the reference zeroes the diagonal)."""
    return cosine_similarity(cells)


def user_similarity_full(cells: DataFrame) -> DataFrame:
    """as F5 plus (u, u, 1.0)."""
    return similarity_with_self(cells)


def similar_users(cells: DataFrame, n: int = 5) -> DataFrame:
    """each user's ``n`` most similar users (positive similarity only)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    return top_neighbors(cells, n)


def similar_users_pruned(cells: DataFrame, n: int = 5) -> DataFrame:
    """F7 with floors: the same rows as :func:`similar_users` to the bit, of pairs that
    reach the user's floor (``similarity.similarity_floors``), on the cheaper route."""
    if n < 1:
        raise ValueError("n must be >= 1")
    layout = plan_layout(cells.sparkSession, cells, None)
    return cosine_similarity(cells, top_k=n, layout=replace(layout, floors=True))


def pruning_counts(cells: DataFrame, n: int = 5) -> DataFrame:
    """What floors save in a top-``n``, one row: co_ratings (ordered pairs of ratings of
    one movie, which a self-join would make), candidates (pairs that reach the
    user's floor) and neighbours (pairs that are kept)."""
    passed = reliable_checkpoint(candidate_pairs(cells, n))
    co = cells.groupBy("movie_id").agg(F.count(F.lit(1)).alias("_n")).agg(F.coalesce(F.sum(F.col("_n") * (F.col("_n") - 1)), F.lit(0)).cast("bigint").alias("co_ratings"))
    kept = passed.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("candidates"),
        F.coalesce(F.sum(F.least("_n", F.lit(n))), F.lit(0)).cast("bigint").alias("neighbours"))
    return with_scalars(co, kept)


def similar_users_for(cells: DataFrame, requests: DataFrame, n: int = 5, max_n: int | None = None) -> DataFrame:
    """F7 for a request table (user_id): the ``n`` most similar users of just
    those users — a bipartite product of their vectors against all users, not
    the whole similarity matrix.  Unknown users give no rows (Q12).  ``max_n``
    is a service's bound on ``n`` (the serving endpoint has 20), if any."""
    if n < 1 or (max_n is not None and n > max_n):
        raise ValueError(f"n must be in [1, {max_n or '...'}]")
    asked = cells.join(requests.select("user_id").distinct(), "user_id", "left_semi")
    # one extra candidate: the user itself is in the right-hand side
    sims = cosine_similarity(asked, cells, top_k=n + 1)
    return top_n_per_group(sims.where(F.col("user_id") != F.col("neighbor_id")).drop("rank"),
                           ["user_id"], [F.col("similarity").desc(), F.col("neighbor_id").asc()], n)


def user_vector(cells: DataFrame, user_id: int) -> list[float]:
    """F8 for one user: the rating vector over the catalogue (0.0 unrated);
    an unknown user raises ``ValueError`` like the reference."""
    rows = user_vectors(cells).where(F.col("user_id") == user_id).collect()
    if not rows:
        raise ValueError(f"no ratings of user {user_id}")
    return list(rows[0]["ratings"])


def user_vectors(cells: DataFrame) -> DataFrame:
    """F8: (user_id, ratings) — each user's ratings over the whole catalogue in
    movie order, 0.0 where unrated.  Built from the user's own cells and the
    dense movie index (no users x movies join): the gaps between a user's sorted
    cells are filled with zeros, in time linear in the vector."""
    midx, n_movies = dense_index(catalogue(cells), ["movie_id"], "movie_idx")
    per_user = (cells.join(maybe_broadcast(midx, n_movies), "movie_id")
                .groupBy("user_id")
                .agg(F.sort_array(F.collect_list(F.struct("movie_idx", "rating"))).alias("_c")))
    at = F.transform("_c", lambda c: c["movie_idx"])
    zeros = lambda n: F.array_repeat(F.lit(0.0), n.cast("int"))
    before = F.concat(F.array(F.lit(-1).cast("bigint")), F.slice(at, F.lit(1), F.size("_c") - 1))
    filled = F.flatten(F.zip_with("_c", before, lambda c, b: F.concat(zeros(c["movie_idx"] - b - 1), F.array(c["rating"]))))
    return per_user.select("user_id", F.concat(filled, zeros(F.lit(n_movies - 1) - F.element_at(at, -1))).alias("ratings"))


def rating_stats(cells: DataFrame) -> DataFrame:
    """mean, population std, min, max and count of the rated cells (the
    documented intent; the reference's mask makes them NaN)."""
    r = F.col("rating")
    return cells.agg(F.avg(r).alias("mean_rating"),
                     F.stddev_pop(r).alias("std_rating"),
                     F.min(r).alias("min_rating"), F.max(r).alias("max_rating"),
                     F.count(r).cast("bigint").alias("n_rated"))


def user_profile(cells: DataFrame) -> DataFrame:
    """movies rated and average rating per user."""
    return cells.groupBy("user_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rated"),
        F.avg("rating").alias("avg_rating"))

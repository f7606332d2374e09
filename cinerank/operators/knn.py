"""User-based K-nearest-neighbour prediction and recommendation (M1-M7,
M10, M11).

The model is two tables: each user's ranked neighbours (from the similarity
engine) and the training ratings.  Prediction is a join of the requested
pairs with the neighbours (k rows per pair) and of that with the training
ratings on (neighbour, movie), then a grouped mean — no per-row loop, no
users x movies product.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import clip
from ..functions.ranking import BROADCAST_BYTES, dense_index, top_n_per_group
from ..schema import DEFAULT_RATING, RATING_CLIP
from .similarity import cosine_similarity, top_neighbors


N_BOUNDS = (1, 50)              # list lengths that a recommendation request may ask for
SLOT_SALTS = 64                 # copies of a catalogue that is too large to broadcast


@dataclass
class KNNModel:
    """M4 parameters + the two fitted tables."""
    k: int
    neighbors: DataFrame        # (user_id, neighbor_id, similarity, rank), rank <= k_max
    train: DataFrame            # (user_id, movie_id, rating), one row per pair
    use_similarity_weights: bool = False
    default_rating: float = DEFAULT_RATING

    def config(self) -> dict:
        return {"model_type": "KNNRecommendation", "k": self.k,
                "use_similarity_weights": self.use_similarity_weights,
                "default_rating": self.default_rating}

    def predict(self, pairs: DataFrame) -> DataFrame:
        return predict(pairs, self.neighbors, self.train, self.k,
                       weighted=self.use_similarity_weights, default=self.default_rating)


def fit(cells: DataFrame, train: DataFrame, k: int = 5, k_max: int | None = None,
        use_similarity_weights: bool = False) -> KNNModel:
    """Neighbours come from the feature cells (all ratings by default, as the
    reference fits similarity before splitting); votes come from ``train``."""
    if k < 1:
        raise ValueError("k must be >= 1")
    if train.isEmpty():
        raise ValueError("the training ratings have no rows")
    nbrs = top_neighbors(cells, max(k, k_max or k))
    return KNNModel(k, nbrs, train.select("user_id", "movie_id", "rating"),
                    use_similarity_weights)


def _votes(keys: DataFrame, nbrs: DataFrame, train: DataFrame, k: int) -> DataFrame:
    nb = nbrs.where(F.col("rank") <= k).select("user_id", "neighbor_id", "similarity", "rank")
    tr = train.select(F.col("user_id").alias("neighbor_id"), "movie_id",
                      F.col("rating").alias("_r"))
    return keys.join(nb, "user_id").join(tr, ["neighbor_id", "movie_id"])


def _mean(weighted: bool):
    if weighted:
        return F.sum(F.col("_r") * F.col("similarity")) / F.sum("similarity")
    return F.avg("_r")


def predict(pairs: DataFrame, nbrs: DataFrame, train: DataFrame, k: int,
            weighted: bool = False, default: float = DEFAULT_RATING,
            lo: float = RATING_CLIP[0], hi: float = RATING_CLIP[1],
            unique_pairs: bool = False) -> DataFrame:
    """M1/M2/M3: add ``prediction`` to every row of ``pairs`` (duplicates and
    extra columns kept).  The user's top-k neighbours are taken first, then
    those who rated the movie in training vote (plain or similarity-weighted
    mean, clipped); no vote -> ``default`` (not clipped).  ``unique_pairs``:
    the caller guarantees one row per (user, movie), which saves the
    de-duplicating aggregation of the request keys."""
    keys = pairs.select("user_id", "movie_id")
    if not unique_pairs:
        keys = keys.distinct()
    agg = (_votes(keys, nbrs, train, k).groupBy("user_id", "movie_id")
           .agg(_mean(weighted).alias("_p")))
    return (pairs.join(agg, ["user_id", "movie_id"], "left")
            .withColumn("prediction", F.coalesce(clip("_p", lo, hi), F.lit(default)))
            .drop("_p"))


def recommend(cells: DataFrame, nbrs: DataFrame, train: DataFrame, k: int, n: int = 5,
              requests: DataFrame | None = None, default: float = DEFAULT_RATING) -> DataFrame:
    """M5/M6: top-``n`` unseen movies per user: (user_id, movie_id,
    predicted_rating, rank), ties by movie_id ascending.

    Unseen = catalogue movies without a cell for the user.  A movie rated by a
    top-k neighbour gets a K-NN prediction; every other unseen movie has the
    default 3.0 and only the lowest ids of those can make the list, so per
    user just the first ``n + |rated| + |supported|`` catalogue positions are
    generated (never users x movies).  ``requests`` (user_id, n) restricts the
    users and sets per-user list lengths; what :func:`rejected_requests` names
    (lengths outside ``N_BOUNDS``, unknown users) gets no rows here.
    """
    users = cells.select("user_id").distinct()
    if requests is None:
        req = users.withColumn("n", F.lit(n))
        n_max = n
    else:
        req = (requests.select("user_id", F.col("n").cast("int"))
               .where(F.col("n").between(*N_BOUNDS)).join(users, "user_id", "left_semi"))
        n_max = N_BOUNDS[1]
    rated = cells.select("user_id", "movie_id")
    nb = (nbrs.where(F.col("rank") <= k).select("user_id", "neighbor_id")
          .join(req.select("user_id"), "user_id", "left_semi"))
    tr = train.select(F.col("user_id").alias("neighbor_id"), "movie_id", F.col("rating").alias("_r"))
    votes = nb.join(tr, "neighbor_id").join(
        rated.select("movie_id").distinct(), "movie_id", "left_semi")     # catalogue only
    unseen_votes = votes.join(rated, ["user_id", "movie_id"], "left_anti")
    supported = (unseen_votes.groupBy("user_id", "movie_id")
                 .agg(clip(_mean(False), *RATING_CLIP).alias("predicted_rating")))
    n_sup = supported.groupBy("user_id").agg(F.count(F.lit(1)).alias("_ns"))
    n_rat = rated.groupBy("user_id").agg(F.count(F.lit(1)).alias("_nr"))
    midx, n_movies = dense_index(rated.select("movie_id").distinct(), ["movie_id"], "movie_idx",
                                 start=1)
    span = F.least(F.col("n") + F.col("_nr") + F.coalesce(F.col("_ns"), F.lit(0)), F.lit(n_movies))
    slots = (req.join(n_rat, "user_id").join(n_sup, "user_id", "left")
             .select("user_id", F.explode(F.sequence(F.lit(1).cast("bigint"), span.cast("bigint")))
                     .alias("movie_idx")))
    taken = rated.unionByName(supported.select("user_id", "movie_id"))
    # Every user's slots start at position 1, so low positions are hot keys: look
    # positions up in a broadcast catalogue when its (exact) size allows, else
    # in copies of it, a salt of the user choosing the copy.
    if n_movies * 16 <= BROADCAST_BYTES:
        found = slots.join(F.broadcast(midx), "movie_idx")
    else:
        copies = midx.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SLOT_SALTS - 1))))
        found = slots.withColumn("_s", F.pmod(F.xxhash64("user_id"), F.lit(SLOT_SALTS)).cast("int")) \
            .join(copies, ["movie_idx", "_s"]).drop("_s")
    defaults = (found.drop("movie_idx")
                .join(taken, ["user_id", "movie_id"], "left_anti")
                .withColumn("predicted_rating", F.lit(default)))
    cands = supported.unionByName(defaults)
    ranked = top_n_per_group(cands, ["user_id"],
                             [F.col("predicted_rating").desc(), F.col("movie_id").asc()], n_max)
    if requests is not None:
        ranked = ranked.join(req, "user_id").where(F.col("rank") <= F.col("n")).drop("n")
    return ranked.select("user_id", "movie_id", "predicted_rating",
                         F.col("rank").cast("bigint").alias("rank"))


def rejected_requests(cells: DataFrame, requests: DataFrame) -> DataFrame:
    """The requests (user_id, n) that :func:`recommend` gives no rows for, with
    the reason."""
    known = cells.select("user_id").distinct().withColumn("_known", F.lit(True))
    reason = (F.when(~F.coalesce(F.col("n").between(*N_BOUNDS), F.lit(False)), f"n outside {N_BOUNDS[0]}..{N_BOUNDS[1]}")
              .when(F.col("_known").isNull(), "unknown user"))
    return requests.join(known, "user_id", "left").select("user_id", "n", reason.alias("reason")).where("reason IS NOT NULL")


def _smallest_ids(df: DataFrame, col: str, count: int) -> list[int]:
    """The ``count`` smallest ids — a bounded top-k, used as padding candidates."""
    return [r[0] for r in df.select(col).distinct().orderBy(col).limit(count).collect()]


def _pad_neighbors(users: DataFrame, pos: DataFrame, pool_ids: list[int], k: int,
                   include_self: bool) -> DataFrame:
    """Complete each user's neighbour list to exactly ``k`` entries with
    zero-similarity users (smallest ids first), as a brute-force k-NN over the
    full matrix would.  ``pos``: (user_id, neighbor_id, rank) positive ones.

    A user needing padding has fewer than ``k`` excluded ids (itself and its
    positive neighbours), so the ``2k`` smallest ids of the pool always hold
    enough candidates: the padding never needs more than that bounded list.
    """
    n_pos = pos.groupBy("user_id").agg(F.count(F.lit(1)).alias("_np"))
    need = (users.join(n_pos, "user_id", "left")
            .select("user_id", (F.lit(k) - F.coalesce(F.col("_np"), F.lit(0))
                                - (F.lit(1) if include_self else F.lit(0))).alias("_need"))
            .where(F.col("_need") > 0))
    excluded = pos.select("user_id", "neighbor_id")
    if include_self:
        excluded = excluded.unionByName(users.select("user_id", F.col("user_id").alias("neighbor_id")))
    cand = need.select("user_id", "_need",
                       F.explode(F.array(*[F.lit(i).cast("bigint") for i in pool_ids])).alias("neighbor_id"))
    cand = cand.join(excluded, ["user_id", "neighbor_id"], "left_anti")
    padded = top_n_per_group(cand, ["user_id"], [F.col("neighbor_id").asc()], k, "_pr")
    padded = padded.where(F.col("_pr") <= F.col("_need"))
    offset = n_pos.select("user_id", "_np")
    return (padded.join(offset, "user_id", "left")
            .select("user_id", "neighbor_id", F.lit(0.0).alias("similarity"),
                    (F.coalesce(F.col("_np"), F.lit(0)) + F.col("_pr")).alias("rank")))


def predict_zero_fill(requests: DataFrame, cells: DataFrame, k_cap: int = 5) -> DataFrame:
    """M7 (serving-style batch): skip unknown users/movies; for the rest take
    the k = min(5, n_users) nearest users over the full matrix *including the
    user itself* (first), then positive-similarity users, then zero-similarity
    users by id; predict the mean of their cells counting unrated as 0; no clip.
    Returns the known request rows with ``predicted_rating``."""
    users = cells.select("user_id").distinct()
    movies = cells.select("movie_id").distinct()
    known = requests.join(users, "user_id", "left_semi").join(movies, "movie_id", "left_semi")
    pool = _smallest_ids(users, "user_id", 2 * k_cap)   # fewer => all users
    k = min(k_cap, len(pool))
    req_users = known.select("user_id").distinct()
    asked = cells.join(req_users, "user_id", "left_semi")
    # one more: the user itself is on the right-hand side
    pos = cosine_similarity(asked, cells, top_k=max(k, 2)).where("user_id <> neighbor_id").drop("rank")
    pos = top_n_per_group(pos, ["user_id"], [F.col("similarity").desc(), F.col("neighbor_id").asc()], max(k - 1, 1)) \
        .where(F.col("rank") <= k - 1)
    pad = _pad_neighbors(req_users, pos, pool[:2 * k], k, True)
    me = req_users.select("user_id", F.col("user_id").alias("neighbor_id"))
    nb = me.unionByName(pos.select("user_id", "neighbor_id")).unionByName(
        pad.select("user_id", "neighbor_id"))
    keys = known.select("user_id", "movie_id").distinct()
    cv = cells.select(F.col("user_id").alias("neighbor_id"), "movie_id", F.col("rating").alias("_r"))
    agg = (keys.join(nb, "user_id").join(cv, ["neighbor_id", "movie_id"], "left")
           .groupBy("user_id", "movie_id")
           .agg((F.sum(F.coalesce(F.col("_r"), F.lit(0.0))) / F.lit(float(k))).alias("predicted_rating")))
    return known.join(agg, ["user_id", "movie_id"])


def user_mean_rating(ratings: DataFrame) -> DataFrame:
    """(user_id, target) = the user's mean rating."""
    return ratings.groupBy("user_id").agg(F.avg("rating").alias("target"))


def user_level_neighbors(cells: DataFrame, user_split: DataFrame,
                         k_max: int) -> tuple[DataFrame, int]:
    """M11 neighbours: for each held-out user the ``min(k_max, n_train)``
    nearest training users by cosine over full matrix rows, zero-similarity
    users filling up by id (a brute-force search always returns k).
    Returns ((user_id, neighbor_id, similarity, rank), min(2 k_max, n_train)).

    The 2·k_max smallest training ids are the padding pool; fewer of them
    means that is the whole training set, so no separate count is needed."""
    train_users = user_split.where(F.col("split") == "train").select("user_id")
    test_users = user_split.where(F.col("split") == "val").select("user_id")
    tr = cells.join(train_users, "user_id", "left_semi")
    te = cells.join(test_users, "user_id", "left_semi")
    pool = _smallest_ids(train_users, "user_id", 2 * k_max)
    k = min(k_max, len(pool))
    pos = cosine_similarity(te, tr, top_k=k)
    pad = _pad_neighbors(test_users, pos, pool[:2 * k], k, False)
    return pos.unionByName(pad), len(pool)


def user_knn_predict(cells: DataFrame, ratings: DataFrame, user_split: DataFrame,
                     k_values=(5,)) -> DataFrame:
    """M11 for several K in one job: (k, user_id, prediction, target) for every
    held-out user; prediction = mean target of its min(K, n_train) nearest
    training users."""
    k_max = max(k_values)
    nb, n_train_capped = user_level_neighbors(cells, user_split, k_max)
    y = user_mean_rating(ratings)
    votes = nb.join(y.select(F.col("user_id").alias("neighbor_id"), F.col("target").alias("_y")),
                    "neighbor_id")
    ks = F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("_pos"),
                                      F.lit(kv).cast("bigint").alias("k"),
                                      F.lit(min(kv, n_train_capped)).alias("_keff"))
                             for i, kv in enumerate(k_values)])).alias("_k")
    per_k = (votes.select("*", ks).select("*", "_k.*").drop("_k")
             .where(F.col("rank") <= F.col("_keff"))
             .groupBy("_pos", "k", "user_id").agg(F.avg("_y").alias("prediction")))
    return per_k.join(y, "user_id").select("_pos", "k", "user_id", "prediction", "target")

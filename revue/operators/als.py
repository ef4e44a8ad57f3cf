"""Explicit-feedback ALS on Spark ML, with a distributed key index.

``StringIndexer`` keeps every label in a driver-side array; at hundreds of
millions of users that does not fit. ``index_keys`` gives the same indices
(frequency descending, ties alphabetical) as a DataFrame via distributed dense
positions, and recommendations map back to ids with joins.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revue.conf import materialize
from revue.operators.fold_in import fold_in
from revue.operators.inner_product import top_n
from revue.operators.positions import dense_index

# Reference workloads (fixed values): batch fit and dashboard fit.
BATCH = {"rank": 10, "maxIter": 5, "regParam": 0.01}
DASHBOARD = {"rank": 10, "maxIter": 10, "regParam": 0.1, "alpha": 1.0}
#: Ratings that a block of factors holds at most on average. Building blocks takes some 60 bytes of heap a rating, in as many
#: tasks at once as an executor has cores, beside the factors sent to them.
BLOCK_RATINGS = 8_000_000
# The reference's tuning grid.
FULL_GRID = {"rank": [10, 50, 100], "regParam": [0.01, 0.1, 1.0], "maxIter": [5, 10]}


def index_keys(df: DataFrame, key: str, out: str) -> DataFrame:
    """(key, out, frequency): 0-based index by frequency desc, key asc (StringIndexer order)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("frequency"))
    idx = dense_index(counts, [F.desc("frequency"), F.asc(key)], out)
    return idx.select(key, F.col(out).cast("int").alias(out), "frequency")


def extend_index(index: DataFrame, df: DataFrame, key: str, out: str) -> DataFrame:
    """A stored index with the keys of ``df`` that it lacks, numbered after its own in the same order.

    Numbers once given stay, so factors of an earlier model and tables that hold its indices remain valid. ``frequency`` of
    an old key is the one at its time.
    """
    new = index_keys(df.join(index.select(key), key, "left_anti"), key, out)
    size = index.agg(F.coalesce(F.max(out) + 1, F.lit(0))).scalar()
    return index.select(key, out, "frequency").union(new.select(key, (F.col(out) + size).cast("int"), "frequency"))


class Indexed:
    """Reviews with integer user / item indices and the two lookup tables."""

    def __init__(self, reviews: DataFrame, user_col: str = "user_id", item_col: str = "product_id"):
        self.users = index_keys(reviews, user_col, "user_index")
        self.items = index_keys(reviews, item_col, "item_index")
        self.ratings = (reviews.join(self.users.select(user_col, "user_index"), user_col)
                               .join(self.items.select(item_col, "item_index"), item_col))


class LoadedIndex:
    """The two lookup tables of an index that was stored, or a part of one."""

    def __init__(self, users: DataFrame, items: DataFrame):
        self.users, self.items = users, items


def hash_bucket(user: str = "user_id", item: str = "product_id") -> F.Column:
    """0 to 99 by the md5 of the key pair, the same under any partitioning."""
    h = F.conv(F.substring(F.md5(F.concat(F.col(user), F.lit("#"), F.col(item))), 1, 8), 16, 10)
    return h.cast("long") % 100


def hash_split_flag(user: str = "user_id", item: str = "product_id", train_pct: int = 80) -> F.Column:
    """Stable split: whether the md5 bucket of the key pair is a training one."""
    return hash_bucket(user, item) < train_pct


def fit(ratings: DataFrame, rank: int = 10, maxIter: int = 5, regParam: float = 0.01,
        nonnegative: bool = True, implicitPrefs: bool = False, alpha: float = 1.0, seed: int = 42,
        checkpointInterval: int = 1, blocks: int | None = None):
    """ALS on (user_index, item_index, rating); cold-start rows are dropped at predict time.

    ``blocks`` is the number of user and of item blocks, hence of tasks that hold the
    factors. Each half of an iteration sends a factor to every block that has a rating of it, so more blocks
    shuffle more; by default there is one a core, and more only where a block would hold over ``BLOCK_RATINGS``
    ratings. ``ratings`` is read once to count them: pass a stored table.

    Every ``checkpointInterval`` iterations MLlib writes the item factors and deletes the shuffle files behind them, which
    does not change a factor. At 1 the factors sent in one iteration lie on disk at once; at MLlib's 10, those of all.
    """
    from pyspark.ml.recommendation import ALS
    from revue.conf import scratch_root
    scratch_root(ratings.sparkSession)  # ALS checkpoints its factor lineage here
    blocks = blocks or max(ratings.sparkSession.sparkContext.defaultParallelism, -(-ratings.count() // BLOCK_RATINGS))
    als = ALS(rank=rank, maxIter=maxIter, regParam=regParam, nonnegative=nonnegative,
              implicitPrefs=implicitPrefs, alpha=alpha, seed=seed, userCol="user_index",
              itemCol="item_index", ratingCol="rating", coldStartStrategy="drop",
              checkpointInterval=checkpointInterval,
              numUserBlocks=blocks, numItemBlocks=blocks)
    return als.fit(ratings)


def predict(model, ratings: DataFrame) -> DataFrame:
    return model.transform(ratings).where(F.col("prediction").isNotNull() & ~F.isnan("prediction"))


def recommend_users(model, idx: Indexed | LoadedIndex, n: int = 10, users: DataFrame | None = None,
                    seen: DataFrame | None = None, **limits) -> DataFrame:
    """(user_id, product_id, score, rank) for all users, or the ``users`` frame's user_id set.

    Exact, as scoring every product would be, by ``inner_product.top_n``. ``seen`` (user_id, product_id) leaves pairs out:
    a user then gets the best ``n`` of the rest. Unknown users drop out at the index join (there is nothing to
    score). Equal scores are ranked by the product's index.
    """
    factors = model.userFactors
    if users is not None:
        subset = users.select("user_id").distinct().join(idx.users, "user_id").select(F.col("user_index").alias("id"))
        factors = factors.join(subset, "id", "left_semi")
    known_users, known_items = idx.users.select("user_id", "user_index"), idx.items.select("product_id", "item_index")
    pairs = None
    if seen is not None:
        pairs = (seen.select("user_id", "product_id").distinct().join(known_users, "user_id").join(known_items, "product_id")
                 .select(F.col("user_index").alias("query"), F.col("item_index").alias("point")))
    best = top_n(factors, model.itemFactors, n, pairs, **limits)
    return (best.withColumnsRenamed({"query": "user_index", "point": "item_index"})
                .join(known_users, "user_index").join(known_items, "item_index")
                .select("user_id", "product_id", "score", "rank"))


def recommend_new_users(model, idx: Indexed | LoadedIndex, ratings: DataFrame, n: int = 10, reg: float = DASHBOARD["regParam"],
                        nonnegative: bool = True, seen: DataFrame | None = None, **limits) -> DataFrame:
    """(user_id, product_id, score, rank) for users whom the model does not know, from their ``ratings``.

    Their factors are those that ALS would give them with the model's item factors kept (``fold_in``). Users of
    the index, and those without a rating of a known product, have no rows. ``seen`` as in ``recommend_users``.
    """
    items = idx.items.select("product_id", "item_index")
    # Written before nulls are dropped: a filter would be pushed below the joins, where each mention of the rating is its whole parsing.
    new = materialize(ratings.join(idx.users.select("user_id"), "user_id", "left_anti").join(items, "product_id")
                      .select(F.col("user_id").alias("user"), F.col("item_index").alias("item"), "rating"), "new-ratings")
    factors = fold_in(new.where(F.col("rating").isNotNull() & ~F.isnan("rating")), model.itemFactors, model.rank, reg, nonnegative)
    pairs = None
    if seen is not None:
        pairs = seen.join(items, "product_id").select(F.col("user_id").alias("query"), F.col("item_index").alias("point"))
    best = top_n(factors, model.itemFactors, n, pairs, **limits)
    return (best.withColumnsRenamed({"query": "user_id", "point": "item_index"}).join(items, "item_index")
                .select("user_id", "product_id", "score", "rank"))


def recommend_items(model, idx: Indexed | LoadedIndex, n: int = 10, **limits) -> DataFrame:
    """(product_id, user_id, score, rank): best users for every item, exactly; equal scores by the user's index."""
    best = top_n(model.itemFactors, model.userFactors, n, **limits)
    return (best.withColumnsRenamed({"query": "item_index", "point": "user_index"})
                .join(idx.items.select("product_id", "item_index"), "item_index")
                .join(idx.users.select("user_id", "user_index"), "user_index")
                .select("product_id", "user_id", "score", "rank"))


def save(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(path: str):
    from pyspark.ml.recommendation import ALSModel
    return ALSModel.load(path)


def grid_settings(grid: dict[str, list]) -> list[dict]:
    """Every combination of the grid's values, as keyword arguments of ``fit``."""
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def _scored(setting: dict, train: DataFrame, valid: DataFrame, seed: int) -> tuple:
    """(rank, reg_param, max_iter, rmse, n_valid, error) of one setting; a failure is told, not hidden."""
    from revue.operators.evaluate import error_metrics
    head = setting["rank"], float(setting["regParam"]), setting["maxIter"]
    try:
        got = error_metrics(predict(fit(train, seed=seed, **setting), valid)).first()
    except Exception as failure:  # noqa: BLE001 - the row says why
        return *head, None, None, f"{type(failure).__name__}: {failure}"[:500]
    return *head, got["rmse"], got["n"], None


GRID_SCHEMA = "rank int, reg_param double, max_iter int, rmse double, n_valid long, error string"


def grid_search(train: DataFrame, valid: DataFrame, grid: dict | None = None, seed: int = 42, side_by_side: int = 4) -> DataFrame:
    """One row per setting (rank, reg_param, max_iter, rmse, n_valid, error), failing ones with their error.

    Each fit is a distributed job. ``side_by_side`` of them run at once from driver threads, so that the stages of
    one fill the tasks that another leaves idle; the result does not depend on it. ``train`` and
    ``valid`` are read once per setting: pass materialised tables.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    spark = train.sparkSession
    with ThreadPoolExecutor(side_by_side) as threads:
        rows = list(threads.map(inheritable_thread_target(spark)(lambda s: _scored(s, train, valid, seed)), grid_settings(grid or FULL_GRID)))
    return train.sparkSession.createDataFrame(rows, GRID_SCHEMA)


def tune(train: DataFrame, valid: DataFrame, test: DataFrame, grid: dict | None = None, seed: int = 42,
         save_path: str | None = None) -> DataFrame:
    """Grid search on (train, valid), then the best setting's RMSE / MAE on test, by the stored model if it is saved.

    One row: rank, reg_param, max_iter, valid_rmse, test_rmse, test_mae, n_test; none if no setting could be scored.
    """
    from revue.operators.evaluate import error_metrics
    best = (grid_search(train, valid, grid, seed).where("n_valid > 0")
            .orderBy("rmse", "rank", "reg_param", "max_iter").first())
    schema = ("rank int, reg_param double, max_iter int, valid_rmse double, test_rmse double, "
              "test_mae double, n_test long")
    if best is None:
        return train.sparkSession.createDataFrame([], schema)
    model = fit(train, seed=seed, rank=best["rank"], regParam=best["reg_param"], maxIter=best["max_iter"])
    if save_path:
        model = load(save(model, save_path))
    t = error_metrics(predict(model, test)).first()
    return train.sparkSession.createDataFrame(
        [(best["rank"], best["reg_param"], best["max_iter"], best["rmse"], t["rmse"], t["mae"], t["n"])], schema)

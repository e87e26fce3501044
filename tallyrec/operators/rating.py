"""Rating model: regularised baseline predictor (global mean + user and item biases),
optionally plus an ALS factor model of the residuals (ML10-ML15).

The baseline is plain aggregation, so it has an SQL oracle; ALS adds the
factor part.  Unseen users or items use the known terms only, which keeps
never-touched posts (routine candidates) scoreable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import hash_rank
from ..params import GRID_FOLDS, GRID_ITERATIONS, GRID_PENALTIES
from ..session import materialize


def _r() -> Column:
    return F.col("post_rating")


RATINGS_PER_BLOCK = 1_000_000


@dataclass
class BiasModel:
    mu: Column             # uncorrelated scalar subquery: the global mean rating
    items: DataFrame       # post_id, b_i
    users: DataFrame       # cim_id, b_u


def fit_bias(ratings: DataFrame, lambda_item: float = 10.0, lambda_user: float = 15.0) -> BiasModel:
    """b_i = sum(r - mu) / (lambda_i + n_i);  b_u = sum(r - mu - b_i) / (lambda_u + n_u)."""
    r = ratings.select("cim_id", "post_id", _r().cast("double").alias("r"))
    mu = r.select(F.avg("r")).scalar()
    items = r.groupBy("post_id").agg(F.sum("r").alias("s"), F.count(F.lit(1)).alias("n")).select(
        "post_id", ((F.col("s") - F.col("n") * mu) / (F.lit(lambda_item) + F.col("n"))).alias("b_i"))
    users = (r.join(items, "post_id", "left")
             .groupBy("cim_id").agg(F.sum(F.col("r") - F.coalesce("b_i", F.lit(0.0))).alias("s"),
                                    F.count(F.lit(1)).alias("n"))
             .select("cim_id", ((F.col("s") - F.col("n") * mu) / (F.lit(lambda_user) + F.col("n"))).alias("b_u")))
    return BiasModel(mu, items, users)


def baseline(pairs: DataFrame, model: BiasModel) -> DataFrame:
    """Adds ``base`` = mu + b_u + b_i (unknown parts count 0), unclipped."""
    j = pairs.join(model.users, "cim_id", "left").join(model.items, "post_id", "left")
    return j.withColumn("base", model.mu + F.coalesce("b_u", F.lit(0.0)) + F.coalesce("b_i", F.lit(0.0))).drop(
        "b_u", "b_i")


def clip_round(x: Column, lo: float = 1.0, hi: float = 4.0, digits: int = 6) -> Column:
    return F.round(F.least(F.lit(hi), F.greatest(F.lit(lo), x)), digits)


def predict_bias(pairs: DataFrame, model: BiasModel) -> DataFrame:
    """ML15 (baseline only): adds ``pred_rating`` clipped to the 1-4 scale, rounded to 6."""
    return baseline(pairs, model).withColumn("pred_rating", clip_round(F.col("base"))).drop("base")


def holdout_split(ratings: DataFrame, fraction: float = 0.85, seed: int = 14) -> DataFrame:
    """ML12: exactly floor(fraction * n) rows in 'train', the rest in 'test', by md5 order.

    The rank comes from ``hash_rank`` (bucketed, distributed), not from a
    global window that would pull every row into one task.
    """
    ranked = hash_rank(ratings, ["cim_id", "post_id"], salt=str(seed), out="_rank")
    n = ratings.select(F.count(F.lit(1))).scalar()
    cut = F.floor(F.lit(fraction) * n)
    return ranked.withColumn("part", F.when(F.col("_rank") <= cut, F.lit("train")).otherwise(F.lit("test"))).drop(
        "_rank")


def rmse(pred: DataFrame, label: str = "post_rating", prediction: str = "pred") -> Column:
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))


def bias_rmse(split: DataFrame, lambda_item: float = 10.0, lambda_user: float = 15.0) -> DataFrame:
    """ML13: RMSE of the baseline fitted on 'train', on 'train' and on 'test' (one row)."""
    train = split.filter(F.col("part") == "train")
    model = fit_bias(train, lambda_item, lambda_user)
    scored = baseline(split.select("cim_id", "post_id", "post_rating", "part"), model).withColumn(
        "pred", F.least(F.lit(4.0), F.greatest(F.lit(1.0), F.col("base"))))
    return scored.groupBy().agg(
        F.round(F.sqrt(F.avg(F.when(F.col("part") == "train", F.pow(_r() - F.col("pred"), 2)))), 6).alias("rmse_train"),
        F.round(F.sqrt(F.avg(F.when(F.col("part") == "test", F.pow(_r() - F.col("pred"), 2)))), 6).alias("rmse_test"),
        F.sum(F.when(F.col("part") == "train", 1).otherwise(0)).cast("long").alias("n_train"),
        F.sum(F.when(F.col("part") == "test", 1).otherwise(0)).cast("long").alias("n_test"),
    )


# --- factor part (ALS) ---------------------------------------------------------------------------

def dense_ids(values: DataFrame, col: str, out: str, salt: str = "ids") -> DataFrame:
    """Distinct ``col`` values -> dense int ids 1..n (distributed exact rank; ALS needs ints)."""
    d = values.select(F.col(col).cast("string").alias(col)).filter(F.col(col).isNotNull()).distinct()
    return hash_rank(d, [col], salt=salt, out=out).withColumn(out, F.col(out).cast("int"))


@dataclass
class FactorModel:
    bias: BiasModel
    users: DataFrame       # cim_id, uf: array<float>
    items: DataFrame       # post_id, vf: array<float>


@dataclass(frozen=True)
class Setting:
    """One point of the search grid."""

    max_iter: int
    reg: float


def _residuals(ratings: DataFrame, bias: BiasModel, user_ids: DataFrame, item_ids: DataFrame) -> DataFrame:
    b = baseline(ratings.select("cim_id", "post_id", "post_rating"), bias)
    return (b.join(user_ids, "cim_id").join(item_ids, "post_id")
            .select("uid", "iid", (_r() - F.col("base")).alias("residual")))


def _fit_als(residuals: DataFrame, setting: Setting, rank: int, seed: int, n_ratings: int):
    """``n_ratings`` sizes the blocks, so that one block's ratings and factors fit a task at any scale."""
    from pyspark.ml.recommendation import ALS

    blocks = max(2, -(-n_ratings // RATINGS_PER_BLOCK))
    return ALS(userCol="uid", itemCol="iid", ratingCol="residual", rank=rank, maxIter=setting.max_iter,
               regParam=setting.reg, seed=seed, numUserBlocks=blocks, numItemBlocks=blocks).fit(residuals)


def _factors(als, ids: DataFrame, side: str) -> DataFrame:
    """The learned vectors under the ids of the ratings: (cim_id, uf) or (post_id, vf)."""
    table, key, num, out = ((als.userFactors, "cim_id", "uid", "uf") if side == "user"
                            else (als.itemFactors, "post_id", "iid", "vf"))
    return ids.join(table.select(F.col("id").alias(num), F.col("features").alias(out)), num).select(key, out)


def fit_factors(ratings: DataFrame, lambda_item: float = 10.0, lambda_user: float = 15.0, rank: int = 10,
                max_iter: int = 10, reg: float = 0.05, seed: int = 14) -> FactorModel:
    """ML14: baseline + ALS on the residuals, fitted on all ``ratings``."""
    bias = fit_bias(ratings, lambda_item, lambda_user)
    uids = dense_ids(ratings, "cim_id", "uid", salt="users")
    iids = dense_ids(ratings, "post_id", "iid", salt="items")
    als = _fit_als(_residuals(ratings, bias, uids, iids), Setting(max_iter, reg), rank, seed, ratings.count())
    return FactorModel(bias, _factors(als, uids, "user"), _factors(als, iids, "item"))


def _with_factors(based: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Adds ``pred`` = clip(base + uf . vf) to rows that have ``base``; a side without a vector adds nothing.

    Plain left joins on the ids of the ratings: an unseen id simply finds no row, so unseen posts never
    share a key.
    """
    j = based.join(users, "cim_id", "left").join(items, "post_id", "left")
    dot = F.aggregate(F.zip_with("uf", "vf", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0),
                      lambda acc, x: acc + x)
    return j.withColumn("pred", F.least(F.lit(4.0), F.greatest(F.lit(1.0), F.col("base") + F.coalesce(
        dot, F.lit(0.0))))).drop("uf", "vf")


def predict_factors(pairs: DataFrame, model: FactorModel) -> DataFrame:
    """ML15: clip(mu + b_u + b_i + residual, 1, 4); an unseen user or post gets the known terms only."""
    scored = _with_factors(baseline(pairs, model.bias), model.users, model.items)
    return scored.withColumn("pred_rating", F.round("pred", 6)).drop("base", "pred")


def factor_rmse(split: DataFrame, setting: Setting, lambda_item: float = 10.0, lambda_user: float = 15.0,
                rank: int = 10, seed: int = 14) -> DataFrame:
    """ML13: RMSE of the factor model fitted on 'train' with ``setting``, on both parts (one row)."""
    model = fit_factors(split.filter(F.col("part") == "train"), lambda_item, lambda_user, rank, setting.max_iter,
                        setting.reg, seed)
    scored = _with_factors(baseline(split.select("cim_id", "post_id", "post_rating", "part"), model.bias),
                           model.users, model.items)
    error = F.pow(_r() - F.col("pred"), 2)
    return scored.groupBy().agg(
        F.round(F.sqrt(F.avg(F.when(F.col("part") == "train", error))), 6).alias("rmse_train"),
        F.round(F.sqrt(F.avg(F.when(F.col("part") == "test", error))), 6).alias("rmse_test"),
        F.lit(setting.max_iter).alias("max_iter"), F.lit(setting.reg).alias("reg_param"))


def als_grid_search(ratings: DataFrame, max_iters=GRID_ITERATIONS, regs=GRID_PENALTIES, folds: int = GRID_FOLDS,
                    rank: int = 10, seed: int = 14, lambda_item: float = 10.0, lambda_user: float = 15.0,
                    parallelism: int = 8) -> DataFrame:
    """ML11: cross-validated RMSE of the factor model for every grid point: max_iter, reg_param, rmse, best.

    ALS has no learning rate, so the grid is iterations x penalties.  A pair's fold follows from the md5 of
    its ids, so a recomputed task puts it in the same fold.  Every validation pair counts: where the fold's
    training part has not seen the user or the post, the baseline is the prediction.  The error is that of
    the clipped rating.  Ties go to fewer iterations, then to the smaller penalty.  Too few ratings for a
    fold to have a training or a validation part: that fold is not scored.
    """
    from multiprocessing.pool import ThreadPool

    spark = ratings.sparkSession
    key = F.concat_ws("|", F.lit(f"fold{seed}"), "cim_id", "post_id")
    data = materialize(ratings.select("cim_id", "post_id", "post_rating",
                                      (F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"),
                                              F.lit(folds)).alias("fold"))))
    grid = [Setting(i, r) for i in max_iters for r in regs]
    sizes = {row["fold"]: row["n"] for row in data.groupBy("fold").agg(F.count("*").alias("n")).collect()}  # <= folds
    errors: dict[Setting, list[float]] = {g: [] for g in grid}

    def prepare(fold: int) -> tuple:
        train = data.filter(F.col("fold") != fold)
        bias = fit_bias(train, lambda_item, lambda_user)
        uids = materialize(dense_ids(train, "cim_id", "uid", salt="users"))
        iids = materialize(dense_ids(train, "post_id", "iid", salt="items"))
        residuals = materialize(_residuals(train, bias, uids, iids))
        held = materialize(baseline(data.filter(F.col("fold") == fold), bias))
        return uids, iids, residuals, held, sum(sizes.values()) - sizes[fold]

    def score(task: tuple[tuple, Setting]) -> float:
        (uids, iids, residuals, held, n_train), setting = task
        als = _fit_als(residuals, setting, rank, seed, n_train)
        scored = _with_factors(held, _factors(als, uids, "user"), _factors(als, iids, "item"))
        return scored.agg(F.sqrt(F.avg(F.pow(_r() - F.col("pred"), 2)))).first()[0]

    if len(sizes) > 1:
        with ThreadPool(parallelism) as pool:  # no fold waits for the slowest fit of another one
            ready = pool.map(prepare, sorted(sizes), chunksize=1)
            tasks = [(fold, g) for fold in ready for g in sorted(grid, key=lambda g: -g.max_iter)]
            for (_, setting), error in zip(tasks, pool.map(score, tasks, chunksize=1)):
                errors[setting].append(error)
    rows = [(g.max_iter, g.reg, round(sum(e) / len(e), 6) if e else None) for g, e in errors.items()]
    best = min(rows, key=lambda r: (r[2] is None, r[2], r[0], r[1]))
    return spark.createDataFrame([(*r, r == best) for r in rows],
                                 "max_iter int, reg_param double, rmse double, best boolean")


def best_setting(searched: DataFrame) -> Setting:
    """The winner of ``als_grid_search``."""
    row = searched.filter("best").first()
    return Setting(row["max_iter"], row["reg_param"])

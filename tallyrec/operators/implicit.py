"""Second recommender (the hosted one, re-aimed): interaction and item exports (P18),
implicit-feedback ALS scored against unexpired items (ML18/ML20, P19), a popularity
fallback and ranking metrics on a time-based hold-out (ML19).

The hosted recipe is a black box, so only its contract is reproduced: top-n
unexpired items per user with a score.  Its expiry filter drops items flagged 1
and keeps items whose flag is NULL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import pipe_list
from ..functions.time import epoch_seconds_rounded, lookback_start, ntz
from ..params import EVENT_CLICK, EVENT_ORDER, EVENT_VIEW, GROUP_HOSTED
from ..session import materialize
from .rating import dense_ids
from .topk import top_products


def not_expired():
    """Drops items flagged 1 and keeps NULL, unlike ``is_expired = 0``."""
    return ~F.col("is_expired").eqNullSafe(1)


def event_type(rating):
    return (F.when(rating.isin(1, 2), F.lit(EVENT_VIEW)).when(rating == 3, F.lit(EVENT_CLICK))
            .when(rating == 4, F.lit(EVENT_ORDER)))


def event_export(interactions: DataFrame, meta: DataFrame, group: str = GROUP_HOSTED) -> DataFrame:
    """user_id, item_id, event_type, timestamp (epoch seconds, rounded)."""
    i = interactions.filter(F.col("rec_group") == group).join(meta.select("post_id"), "post_id", "left_semi")
    return i.select(
        F.col("cim_id").cast("string").alias("user_id"), F.col("post_id").cast("string").alias("item_id"),
        event_type(F.col("post_rating")).alias("event_type"),
        epoch_seconds_rounded(F.col("max_date")).alias("timestamp"), "max_date")


def item_export(meta: DataFrame, interactions: DataFrame, group: str = GROUP_HOSTED) -> DataFrame:
    """item_id, is_expired, slug_lst for items the group touched or that are unexpired."""
    touched = (interactions.filter(F.col("rec_group") == group).select("post_id").distinct()
               .withColumn("_t", F.lit(1)))
    m = meta.join(touched, "post_id", "left").filter(F.col("_t").isNotNull() | (F.col("is_expired") == 0))
    return m.select(F.col("post_id").alias("item_id"), "is_expired",
                    pipe_list(F.col("category_list"), F.col("store_list")).alias("slug_lst"))


def popular_unexpired(interactions: DataFrame, meta: DataFrame, group: str = GROUP_HOSTED, k: int = 20) -> DataFrame:
    """Fallback list: the ``k`` not-expired items with most interacting users (ties: post id)."""
    i = interactions.filter(F.col("rec_group") == group).join(meta.select("post_id"), "post_id", "left_semi")
    live = meta.filter(not_expired()).select("post_id")
    pop = i.groupBy("post_id").agg(F.countDistinct("cim_id").alias("n_users")).join(live, "post_id", "left_semi")
    top = pop.orderBy(F.desc("n_users"), F.asc("post_id")).limit(k)
    return top.withColumn("post_order", F.row_number().over(Window.orderBy(F.desc("n_users"), F.asc("post_id"))))


def _implicit_als(rank: int, max_iter: int, reg: float, alpha: float, seed: int):
    from pyspark.ml.recommendation import ALS

    return ALS(userCol="uid", itemCol="iid", ratingCol="strength", implicitPrefs=True, rank=rank,
               maxIter=max_iter, regParam=reg, alpha=alpha, seed=seed, coldStartStrategy="drop")


def _strength(events: DataFrame, weights: dict) -> DataFrame:
    w = F.lit(0.0)
    for name, val in weights.items():
        w = F.when(F.col("event_type") == name, F.lit(float(val))).otherwise(w)
    return events.withColumn("strength", w)


def fit_implicit(events: DataFrame, weights: dict, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
                 alpha: float = 1.0, seed: int = 14):
    """Implicit-feedback ALS on summed event strengths; returns (model, user ids, item ids)."""
    ev = _strength(events.select(F.col("user_id").alias("cim_id"), F.col("item_id").alias("post_id"),
                                 "event_type"), weights)
    uids = dense_ids(ev, "cim_id", "uid", salt="users")
    iids = dense_ids(ev, "post_id", "iid", salt="items")
    train = ev.join(uids, "cim_id").join(iids, "post_id").groupBy("uid", "iid").agg(
        F.sum("strength").alias("strength"))
    return _implicit_als(rank, max_iter, reg, alpha, seed).fit(train), uids, iids


def item_slugs(items: DataFrame) -> DataFrame:
    """(post_id, slug): the distinct slugs of every exported item."""
    slug = F.explode(F.array_distinct(F.split(F.coalesce("slug_lst", F.lit("")), "\\|")))
    return items.select(F.col("item_id").alias("post_id"), slug.alias("slug")).where("slug <> ''")


def slug_vectors(factors: DataFrame, items: DataFrame, max_slugs: int = 300, ridge: float = 1.0) -> DataFrame:
    """ML18, item side: (post_id, vector) of the exported items that are not in ``factors``.

    The known items' vectors are regressed on an intercept and their category and store slugs (ridge regression; the
    ``max_slugs`` commonest slugs of known items, a bound of the equations).  The normal equations are sums over items,
    formed by Spark; only they, at most (max_slugs + 1) ** 2 numbers, go to the driver.  ``factors``: (post_id, vector).
    """
    import numpy as np

    spark = factors.sparkSession
    slugs = materialize(item_slugs(items))
    known = materialize(slugs.join(factors.select("post_id"), "post_id", "left_semi"))
    names = [r["slug"] for r in known.groupBy("slug").count().orderBy(F.desc("count"), F.asc("slug")).limit(max_slugs).collect()]
    numbers = spark.createDataFrame([(s, i + 1) for i, s in enumerate(names)], "slug string, at int")
    warm = factors.join(items.select(F.col("item_id").alias("post_id")), "post_id", "left_semi").select("post_id", "vector")
    ones = warm.select("post_id", F.lit(0).alias("at"))
    x = materialize(known.join(F.broadcast(numbers), "slug").select("post_id", "at").unionByName(ones))
    sides = x.join(x.withColumnRenamed("at", "other"), "post_id").groupBy("at", "other").count().collect()
    right = (x.join(warm, "post_id").select("at", F.posexplode("vector").alias("f", "v"))
             .groupBy("at", "f").agg(F.sum(F.col("v").cast("double")).alias("v")).collect())
    rank = 1 + max((r["f"] for r in right), default=-1)
    gram, goal = np.zeros((len(names) + 1,) * 2), np.zeros((len(names) + 1, rank))
    for r in sides:
        gram[r["at"], r["other"]] = r["count"]
    for r in right:
        goal[r["at"], r["f"]] = r["v"]
    gram[range(1, len(gram)), range(1, len(gram))] += ridge
    weight = np.linalg.solve(gram, goal) if rank else goal
    table = spark.createDataFrame([(s, weight[i + 1].tolist()) for i, s in enumerate(names)], "slug string, w array<double>")
    cold = items.select(F.col("item_id").alias("post_id")).join(factors.select("post_id"), "post_id", "left_anti")
    parts = slugs.join(cold, "post_id", "left_semi").join(F.broadcast(table), "slug")
    sums = parts.groupBy("post_id").agg(F.array(*(F.sum(F.col("w")[i]) for i in range(rank))).alias("w"))
    start = F.array(*(F.lit(float(v)) for v in (weight[0] if rank else ())))
    vector = F.when(F.col("w").isNull(), start).otherwise(F.zip_with(start, F.col("w"), lambda a, b: a + b))
    return cold.join(sums, "post_id", "left").select("post_id", vector.alias("vector"))


def recommend_unexpired(model, uids: DataFrame, iids: DataFrame, meta: DataFrame, k: int = 20,
                        items: DataFrame | None = None) -> DataFrame:
    """ML20 / P19: cim_id, post_id, permalink, score, post_order for every user of the model.

    Expired items leave before any product is formed, so exactly ``k`` items a user are asked for; ties stand in the order
    of the post id.  With ``items`` (the item export) the items that nobody touched are scored too, by the vectors that their
    slugs predict.
    """
    expired = meta.filter(F.col("is_expired").eqNullSafe(1)).select("post_id")
    factors = model.itemFactors.join(iids, F.col("id") == F.col("iid")).select(
        "post_id", F.col("features").cast("array<double>").alias("vector"))
    if items is not None:
        factors = factors.unionByName(slug_vectors(materialize(factors), items))
    live = factors.join(expired, "post_id", "left_anti").select(F.col("post_id").alias("item"), "vector")
    users = model.userFactors.join(uids, F.col("id") == F.col("uid")).select(
        F.col("cim_id").alias("user"), F.col("features").cast("array<double>").alias("vector"))
    top = top_products(users, live, k).select(F.col("user").alias("cim_id"), F.col("item").alias("post_id"),
                                              F.round("score", 6).alias("score"), F.col("place").alias("post_order"))
    # The permalink comes from unexpired metadata only: an item whose flag is NULL stays in the
    # list (the exclusion rule only drops flag 1) but has no permalink, as in the original.
    links = meta.filter(F.col("is_expired") == 0).select("post_id", "permalink")
    return top.join(links, "post_id", "left").select("cim_id", "post_id", "permalink", "score", "post_order")


def implicit_recs(events: DataFrame, meta: DataFrame, weights: dict, k: int = 20, rank: int = 10,
                  max_iter: int = 10, reg: float = 0.1, alpha: float = 1.0, seed: int = 14,
                  items: DataFrame | None = None) -> DataFrame:
    """ML18 / ML20 / P19: fit the implicit model on the group's events, then top ``k`` unexpired of all ``items``."""
    model, uids, iids = fit_implicit(events, weights, rank, max_iter, reg, alpha, seed)
    return recommend_unexpired(model, uids, iids, meta, k, items)


def explain_hosted(recs: DataFrame, events: DataFrame, titles: DataFrame) -> DataFrame:
    """ML17 for the hosted group: what a user clicked or ordered next to what is recommended to the user, as rows.

    ``part`` is 'clicked or ordered' (the titles of those posts, newest first) or 'recommended' (the list in its order);
    ``position`` counts from 1 within the part.  ``titles``: post_id, post_title, permalink.  Users of ``recs`` only;
    a user's events are one row a post of the look-back window.
    """
    users = recs.select("cim_id").distinct()
    done = (events.filter(F.col("event_type").isin(EVENT_CLICK, EVENT_ORDER))
            .select(F.col("user_id").alias("cim_id"), F.col("item_id").alias("post_id"), "event_type", "timestamp")
            .join(users, "cim_id", "left_semi"))
    place = F.row_number().over(Window.partitionBy("cim_id").orderBy(F.desc("timestamp"), F.asc("post_id")))
    past = done.select("cim_id", F.lit("clicked or ordered").alias("part"), place.alias("position"), "post_id",
                       "event_type", F.lit(None).cast("double").alias("score"))
    listed = recs.select("cim_id", F.lit("recommended").alias("part"), F.col("post_order").alias("position"), "post_id",
                         F.lit(None).cast("string").alias("event_type"), F.col("score").cast("double").alias("score"))
    return past.unionByName(listed).join(titles.select("post_id", "post_title", "permalink"), "post_id", "left").select(
        "cim_id", "part", "position", "post_id", "event_type", "score", "post_title", "permalink")


def implicit_metrics(events: DataFrame, meta: DataFrame, weights: dict, as_of: dt.datetime, holdout_days: int = 7,
                     k: int = 20, rank: int = 10, max_iter: int = 10, reg: float = 0.1, alpha: float = 1.0,
                     seed: int = 14) -> DataFrame:
    """ML19: precision@k, NDCG@k and MAP of the implicit model on the last ``holdout_days``.

    Every held-out user and item counts: an item that the model has not seen is a miss, and a user
    that it has not seen gets no recommendation.
    """
    start = ntz(lookback_start(as_of, holdout_days))
    train_ev = events.filter(F.col("max_date") < start)
    test_ev = events.filter(F.col("max_date") >= start)
    ev = _strength(train_ev.select(F.col("user_id").alias("cim_id"), F.col("item_id").alias("post_id"),
                                   "event_type"), weights)
    known = events.select(F.col("user_id").alias("cim_id"), F.col("item_id").alias("post_id"))
    uids = dense_ids(known, "cim_id", "uid", salt="users")  # ids of both parts; only the first is trained on
    iids = dense_ids(known, "post_id", "iid", salt="items")
    train = ev.join(uids, "cim_id").join(iids, "post_id").groupBy("uid", "iid").agg(
        F.sum("strength").alias("strength"))
    model = _implicit_als(rank, max_iter, reg, alpha, seed).fit(train)
    truth = (test_ev.select(F.col("user_id").alias("cim_id"), F.col("item_id").alias("post_id"))
             .join(iids, "post_id").join(uids, "cim_id")
             .groupBy("uid").agg(F.collect_set(F.col("iid").cast("double")).alias("label")))
    recs = model.recommendForUserSubset(truth.select("uid"), k).select(
        "uid", F.transform("recommendations", lambda r: r["iid"].cast("double")).alias("prediction"))
    none = F.array().cast("array<double>")
    recs = truth.join(recs, "uid", "left").withColumn("prediction", F.coalesce("prediction", none))
    return ranking_metrics(recs, k)


def ranking_metrics(lists: DataFrame, k: int = 20) -> DataFrame:
    """ML19 from given lists: one row of precision@k, NDCG@k and MAP over the rows of ``lists`` (``prediction``: ranked
    items as doubles; ``label``: the relevant ones).  MAP looks at whole lists; without rows the metrics are NaN."""
    from pyspark.ml.evaluation import RankingEvaluator

    data = materialize(lists.select("prediction", "label"))  # three metrics read it; compute it once
    out = {}
    for metric in ("precisionAtK", "ndcgAtK", "meanAveragePrecision"):
        ev_ = RankingEvaluator(metricName=metric, k=k, predictionCol="prediction", labelCol="label")
        out[metric] = float(ev_.evaluate(data)) if data.take(1) else float("nan")
    n_users = data.count()
    return lists.sparkSession.createDataFrame(
        [(round(out["precisionAtK"], 6), round(out["ndcgAtK"], 6), round(out["meanAveragePrecision"], 6), k,
          int(n_users))],
        "precision_at_k double, ndcg_at_k double, map double, k int, n_users long")

"""Hybrid recommender: seeds per user (ML8), similar unexpired posts (ML9),
rating prediction and tiered re-ranking (ML16), a readable report (ML17) and
the seed log for the next day (P17).

One set-based plan for all users: no per-user loop; the driver only reads one
scalar (the largest converted count, for the exact early cut).  Top-k
per user is ``row_number() <= k``, which Spark plans as a partial
WindowGroupLimit before the shuffle, so a user with many rows is cut down
map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..params import GROUP_IN_HOUSE


def group_interactions(interactions: DataFrame, meta: DataFrame, group: str | None = GROUP_IN_HOUSE) -> DataFrame:
    """Interactions limited to posts present in the metadata (and to one test group)."""
    i = interactions.join(meta.select("post_id"), "post_id", "left_semi")
    return i if group is None else i.filter(F.col("rec_group") == group)


def user_seeds(interactions: DataFrame, k: int = 1) -> DataFrame:
    """ML8: (cim_id, seed_post_id, seed_rank): least-used-as-seed first, then the strongest interaction."""
    order = [F.asc("prev_rec"), F.desc("post_rating"), F.desc("order_count"), F.desc("outgoing_link_click_count"),
             F.desc("view_count"), F.desc("max_date"), F.asc("post_id")]
    w = Window.partitionBy("cim_id").orderBy(*order)
    return (interactions.withColumn("seed_rank", F.row_number().over(w)).filter(F.col("seed_rank") <= k)
            .select("cim_id", F.col("post_id").alias("seed_post_id"), "seed_rank"))


def converted(interactions: DataFrame) -> DataFrame:
    """Posts a user already converted on (rating 4)."""
    return interactions.filter(F.col("post_rating") == 4).select("cim_id", "post_id")


def user_converted(interactions: DataFrame) -> DataFrame:
    """AGG11 for inspection: the converted posts of each user as one sorted, comma-joined string."""
    return converted(interactions).groupBy("cim_id").agg(
        F.array_join(F.array_sort(F.collect_list("post_id")), ",").alias("converted_posts"),
        F.count(F.lit(1)).alias("n_converted"))


def list_depth(seeds: DataFrame, interactions: DataFrame, k: int = 42) -> int:
    """How deep a seed's list must be for every user's top ``k``: ``k`` + the largest number of converted posts of a user."""
    conv = converted(interactions).join(seeds.select("cim_id").distinct(), "cim_id", "left_semi")
    c = conv.groupBy("cim_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0  # one scalar
    return k + int(c)


def similar_posts(seeds: DataFrame, interactions: DataFrame, sim: DataFrame, meta: DataFrame, k: int = 42,
                  seeds_bounded: bool = False, depth: int | None = None, unexpired: bool = False) -> DataFrame:
    """ML9: (cim_id, post_id, sim_score): unexpired, not the seed, not converted; best seed
    per post (max); top ``k`` by similarity, ties by post id.

    Exact early cut: a user's top ``k`` can only come from the first ``depth`` posts of each seed's list (in the
    same order, see ``list_depth``), since only converted posts are removed per user.  So each seed list is cut to
    that depth (a partial WindowGroupLimit, before any shuffle) and only then fanned out to users.
    ``sim`` may be known to hold unexpired posts only, may carry ``is_expired`` (then it is a filter) or not (then a
    semi-join).
    """
    conv = converted(interactions)
    if unexpired:
        s = sim
    else:
        s = sim.filter(F.col("is_expired") == 0) if "is_expired" in sim.columns else sim.join(
            meta.filter(F.col("is_expired") == 0).select("post_id"), "post_id", "left_semi")
    depth = depth or list_depth(seeds, interactions, k)
    w_seed = Window.partitionBy("seed_post_id").orderBy(F.desc("sim_score"), F.asc("post_id"))
    s = s.withColumn("_d", F.row_number().over(w_seed)).filter(F.col("_d") <= depth).drop("_d")
    su = seeds.select("cim_id", "seed_post_id")
    su = F.broadcast(su) if seeds_bounded else su
    cand = (s.select("seed_post_id", "post_id", "sim_score").join(su, "seed_post_id")
            .join(conv, ["cim_id", "post_id"], "left_anti"))
    best = cand.groupBy("cim_id", "post_id").agg(F.max("sim_score").alias("sim_score"))
    w = Window.partitionBy("cim_id").orderBy(F.desc("sim_score"), F.asc("post_id"))
    return best.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def hybrid_recs(similar: DataFrame, predict, meta_text: DataFrame, explore: bool = True,
                threshold: float = 0.5, n_final: int = 20) -> DataFrame:
    """ML16 / P16: predicted rating for each candidate, exploration tier (similarity > threshold),
    re-rank by tier, prediction, similarity; keep ``n_final``; attach title and permalink.

    ``predict`` maps a (cim_id, post_id, ...) frame to the same frame plus ``pred_rating``.
    ``meta_text`` carries post_id, permalink and post_title.
    """
    scored = predict(similar)
    tier = F.when(F.col("sim_score") > F.lit(threshold), 2).otherwise(1) if explore else F.lit(1)
    scored = scored.withColumn("more_explore", tier)
    w = Window.partitionBy("cim_id").orderBy(F.desc("more_explore"), F.desc("pred_rating"), F.desc("sim_score"),
                                            F.asc("post_id"))
    top = scored.withColumn("post_order", F.row_number().over(w)).filter(F.col("post_order") <= n_final)
    return top.join(meta_text.select("post_id", "permalink", "post_title"), "post_id", "left").select(
        "post_id", "cim_id", "post_order", "post_title", "permalink", "sim_score", "pred_rating", "more_explore")


def explain_recs(recs: DataFrame, seeds: DataFrame, meta_text: DataFrame) -> DataFrame:
    """ML17: each recommendation next to the user's seed post(s) and their titles."""
    titles = meta_text.select(F.col("post_id").alias("seed_post_id"), F.col("post_title").alias("seed_title"))
    s = seeds.join(titles, "seed_post_id", "left")
    return recs.join(s, "cim_id").select(
        "cim_id", "seed_rank", "seed_post_id", "seed_title", "post_order", "post_id", "post_title",
        "sim_score", "pred_rating", "more_explore")


def seed_log_rows(seeds: DataFrame) -> DataFrame:
    """The seeds used today, one row per (user, seed), to be appended to the seed history."""
    return seeds.select("cim_id", F.col("seed_post_id").alias("post_id"))

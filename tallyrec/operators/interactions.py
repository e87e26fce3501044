"""Interactions: views, clicks and orders of the look-back window per (user, post),
the test-group sample, the seed history and the 1-4 rating (P3-P9)."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import md5_bucket100, smallest_hashes
from ..functions.time import lookback_start, ntz
from ..params import DUMMY_SEED_POST, GROUP_CONTROL, GROUP_EDGES, GROUP_HOSTED, GROUP_IN_HOUSE
from ..session import materialize
from .identity import anonymous_ids
from .joins import heavy_keys, join_owners

KEYS = ["cim_id", "post_id"]


def _union(sources: DataFrame | Sequence[DataFrame], cols: list[str]) -> DataFrame:
    if isinstance(sources, DataFrame):
        return sources.select(*cols)
    return reduce(lambda a, b: a.unionByName(b), [s.select(*cols) for s in sources])


def cohort_keys(identity: DataFrame, max_ids: int) -> DataFrame | None:
    """The cohort's anonymous ids as a broadcast key frame, if there are at most ``max_ids``
    (counted once); otherwise None and the events are not prefiltered."""
    keys = anonymous_ids(identity).select(F.col("alias_value").alias("anonymous_id")).distinct()
    return F.broadcast(keys) if keys.count() <= max_ids else None


def heavy_ids(identity: DataFrame, most: int, max_keys: int) -> DataFrame | None:
    """Anonymous ids that more than ``most`` alias rows share (T19: their events count for every user); None if none is."""
    return heavy_keys(anonymous_ids(identity).withColumnRenamed("alias_value", "anonymous_id"), "anonymous_id", most, max_keys)


def _events_per_user_post(identity: DataFrame, events: DataFrame, aggs: dict,
                          prefilter: DataFrame | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """Pre-aggregate per (anonymous id, post), then map to users and aggregate again.

    The first aggregate is partial per task (map-side combine), so a hot
    anonymous id or post never reaches the alias join as raw events.

    ``prefilter``: a small key frame from ``cohort_keys``; the events are
    semi-joined against it at the scan, before any aggregation or shuffle.
    ``heavy``: shared ids from ``heavy_ids``, whose users and posts are split over tasks.
    """
    ids = anonymous_ids(identity).withColumnRenamed("alias_value", "anonymous_id")
    if prefilter is not None:
        events = events.join(prefilter, "anonymous_id", "left_semi")
    first = events.groupBy("anonymous_id", "post_id").agg(*[f(c).alias(n) for n, (f, c, _) in aggs.items()])
    joined = join_owners(first, ids, "anonymous_id", heavy, "cim_id", "post_id")
    return joined.groupBy(*KEYS).agg(*[g(n).alias(n) for n, (_, _, g) in aggs.items()])


# What an event table adds up to per (anonymous id, post): (first aggregate, column), second aggregate, by result column.
MEASURES = {
    "views": {"max_date": (F.max, "received_at", F.max), "page_view_count": (F.count, "*", F.sum)},
    "clicks": {"outgoing_link_click_count": (F.count, "*", F.sum)},
    "commission": {"order_count": (F.sum, "order_count", F.sum)},
}
EVENT_TIME = {"views": "received_at", "clicks": "received_at", "commission": "commission_date"}


def _counted(kind: str, events: DataFrame) -> DataFrame:
    # null post ids are kept in the orders (they never join later)
    return events if kind == "commission" else events.filter(F.col("post_id").isNotNull())


def day_partials(kind: str, sources: DataFrame | Sequence[DataFrame], since: dt.date, until: dt.date | None = None) -> DataFrame:
    """Per (day, anonymous id, post) sums of the events from ``since`` on, up to ``until`` (exclusive): one row a group.

    The window starts at a midnight, so whole days add up to exactly what the raw events give.
    """
    cols = ["anonymous_id", "post_id", EVENT_TIME[kind]] + ["order_count"] * (kind == "commission")
    t = F.col(EVENT_TIME[kind])
    ev = _counted(kind, _union(sources, cols)).filter(t >= ntz(since))
    if until is not None:
        ev = ev.filter(t < ntz(until))
    return (ev.withColumn("day", F.to_date(t)).groupBy("day", "anonymous_id", "post_id")
            .agg(*[f(c).alias(n) for n, (f, c, _) in MEASURES[kind].items()]))


def merge_partials(kind: str, identity: DataFrame, partials: DataFrame, as_of: dt.datetime, lookback_days: int = 28,
                   prefilter: DataFrame | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """P3-P5 from the day partials of the look-back window instead of raw events."""
    days = partials.filter(F.col("day") >= F.lit(lookback_start(as_of, lookback_days).date()))
    merged = {n: (g, n, g) for n, (_, _, g) in MEASURES[kind].items()}
    return _events_per_user_post(identity, days, merged, prefilter, heavy).select(*KEYS, *MEASURES[kind])


def _from_events(kind: str, identity: DataFrame, sources, as_of: dt.datetime, lookback_days: int,
                 prefilter: DataFrame | None, heavy: DataFrame | None) -> DataFrame:
    cols = ["anonymous_id", "post_id", EVENT_TIME[kind]] + ["order_count"] * (kind == "commission")
    ev = _counted(kind, _union(sources, cols).filter(F.col(EVENT_TIME[kind]) >= ntz(lookback_start(as_of, lookback_days))))
    return _events_per_user_post(identity, ev, MEASURES[kind], prefilter, heavy).select(*KEYS, *MEASURES[kind])


def page_views(identity: DataFrame, sources: DataFrame | Sequence[DataFrame], as_of: dt.datetime,
               lookback_days: int = 28, prefilter: DataFrame | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """cim_id, post_id, max_date, page_view_count over all channels."""
    return _from_events("views", identity, sources, as_of, lookback_days, prefilter, heavy)


def link_clicks(identity: DataFrame, sources: DataFrame | Sequence[DataFrame], as_of: dt.datetime,
                lookback_days: int = 28, prefilter: DataFrame | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """cim_id, post_id, outgoing_link_click_count."""
    return _from_events("clicks", identity, sources, as_of, lookback_days, prefilter, heavy)


def orders(identity: DataFrame, commission: DataFrame | Sequence[DataFrame], as_of: dt.datetime, lookback_days: int = 28,
           prefilter: DataFrame | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """P5: cim_id, post_id, order_count.  Null post ids are kept here (they never join later)."""
    return _from_events("commission", identity, commission, as_of, lookback_days, prefilter, heavy)


def group_of(bucket) -> "F.Column":
    lo, hi = GROUP_EDGES
    return (F.when(bucket <= lo, F.lit(GROUP_IN_HOUSE))
            .when((bucket > lo) & (bucket <= hi), F.lit(GROUP_HOSTED))
            .otherwise(F.lit(GROUP_CONTROL)))


def sample_groups(views: DataFrame, n: int = 3000, salt: str = "sample") -> DataFrame:
    """A repeatable sample of exactly ``n`` users, split into three groups by an md5 bucket.

    The limit is the feature (a fixed-size sample); see ``smallest_hashes`` for how it stays distributed.
    """
    users = materialize(views.select("cim_id").distinct())  # counted, then cut
    picked = smallest_hashes(users, n, ["cim_id"], salt)
    b = md5_bucket100(F.col("cim_id"))
    return picked.select("cim_id", b.alias("rand_int"), group_of(b).alias("rec_group"))


def seed_history_init(views: DataFrame, dummy_post: str = DUMMY_SEED_POST) -> DataFrame:
    """One dummy seed row per user with views, so day one counts 0 for every real post."""
    return views.select(F.col("cim_id").cast("string").alias("cim_id")).distinct().select(
        "cim_id", F.lit(dummy_post).alias("post_id"))


def rated_interactions(views: DataFrame, clicks: DataFrame, orders_: DataFrame, groups: DataFrame,
                       seed_log: DataFrame) -> DataFrame:
    """Views drive; clicks, orders, group and seed count are left-joined on (user, post).

    All (user, post) inputs are aggregated on the same keys, so the joins reuse
    one hash partitioning instead of re-shuffling per join.
    """
    prev = seed_log.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("prev_rec"))
    g = groups.select("cim_id", "rec_group").distinct()
    j = (views.join(clicks, KEYS, "left").join(orders_, KEYS, "left").join(prev, KEYS, "left")
         .join(g, "cim_id", "left"))
    o = F.coalesce(F.col("order_count"), F.lit(0))
    c = F.coalesce(F.col("outgoing_link_click_count"), F.lit(0))
    rating = (F.when(o > 0, 4).when(c > 0, 3).when(F.col("page_view_count") > 1, 2).otherwise(1))
    return j.select(
        "cim_id", "rec_group", "post_id",
        F.col("page_view_count").alias("view_count"),
        c.alias("outgoing_link_click_count"),
        o.alias("order_count"),
        rating.alias("post_rating"),
        "max_date",
        F.coalesce(F.col("prev_rec"), F.lit(0)).alias("prev_rec"),
    )


def cohort_interactions(rated: DataFrame, groups: DataFrame) -> DataFrame:
    """P9 (initial set-up): rated pairs of the sampled users with their group."""
    return rated.drop("rec_group").join(groups.select("cim_id", "rec_group"), "cim_id").select(
        "cim_id", "post_id", "view_count", "outgoing_link_click_count", "order_count", "prev_rec",
        "post_rating", "rec_group")

"""Delivery: production batch with identities and images (P22), the current feed
and the outbound feed with one subscriber per e-mail (P24)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import cdn_url
from ..functions.time import local_midnight, local_time, ntz
from ..params import FEED_POST_TYPE, NEVER_USED
from .joins import keep_keys


def production_batch(staging: DataFrame, subscribers: DataFrame, images: DataFrame, titles: DataFrame,
                     now: dt.datetime, tz: str = "America/Denver") -> DataFrame:
    """Recommendations with e-mail, subscriber, newest title, image and batch time.

    ``staging`` needs cim_id, post_id, permalink, post_order plus any score
    columns (sim_score / pred_rating / more_explore or score); they pass through.
    """
    local_now = local_time(ntz(now), tz)
    extra = [c for c in ("post_title", "sim_score", "pred_rating", "more_explore", "score") if c in staging.columns]
    s = staging.select("cim_id", "post_id", "permalink", "post_order", *extra)
    if "post_title" in extra:
        s = s.withColumnRenamed("post_title", "post_title_mod")
    j = (s.join(subscribers.select("cim_id", "email", "subscriber_id"), "cim_id", "left")
         .join(images.select("post_id", F.col("guid").alias("image_url")), "post_id", "left")
         .join(titles.select("post_id", "post_title"), "post_id", "left"))
    cols = ["cim_id", "email", "subscriber_id", "post_id", "permalink"]
    cols += ["post_title_mod"] if "post_title" in extra else []
    cols += ["post_title", "image_url", "post_order"]
    cols += [c for c in ("sim_score", "pred_rating", "more_explore", "score") if c in extra]
    return j.select(*cols, local_midnight(local_now).alias("send_date"),
                    local_now.alias("import_time_stamp"))


def current_feed(history: DataFrame, label: str) -> DataFrame:
    """Rows of the newest import with a subscriber, in the feed layout."""
    newest = history.select(F.max("import_time_stamp")).scalar()
    h = history.filter((F.col("import_time_stamp") == newest) & F.col("subscriber_id").isNotNull())
    return h.select(
        "email", "post_title", F.lit(1).alias("valid"), "send_date", "image_url",
        F.col("permalink").alias("url"), F.lit(None).cast("string").alias("slugs"),
        F.col("post_order").alias("position"), F.lit(label).alias("test_group"),
        F.lit(FEED_POST_TYPE).alias("post_type"), "post_id", "subscriber_id",
        F.lit(None).cast("string").alias("received"))


def outbound_feed(feed: DataFrame, alias: DataFrame, post_type: str, cdn_marker: str, cdn_prefix: str,
                  max_keys: int | None = None) -> DataFrame:
    """Per e-mail keep the rows whose subscriber alias was used last (NULL counts as
    2000-01-01; ties all stay), rewrite the image to the CDN, test group = last two chars.

    The alias table covers every user; ``max_keys`` lets the feed's subscriber ids
    (a cohort-sized set, counted) filter it where it is read (see ``joins.keep_keys``).
    """
    a = alias.select(F.col("alias_value").alias("subscriber_id"), "last_used_datetime")
    a = keep_keys(a, feed.select("subscriber_id").filter(F.col("subscriber_id").isNotNull()), "subscriber_id",
                  max_keys)
    j = feed.join(a, "subscriber_id", "left").filter(F.col("email").isNotNull())
    used = F.coalesce(F.col("last_used_datetime"), F.expr(f"TIMESTAMP_NTZ'{NEVER_USED}'"))
    j = j.withColumn("_u", used).withColumn("_m", F.max("_u").over(Window.partitionBy("email")))
    return j.filter(F.col("_u") == F.col("_m")).select(
        "email", "post_title", "valid", "send_date",
        cdn_url(F.col("image_url"), cdn_marker, cdn_prefix).alias("image_url"),
        "url", "slugs", "position", F.expr("right(subscriber_id, 2)").alias("test_group"),
        F.lit(post_type).alias("post_type"), "post_id", "subscriber_id", "last_used_datetime", "received")

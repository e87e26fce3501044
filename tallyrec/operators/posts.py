"""Post metadata: expiry (P10), base rows (P11), content (P12), permalink (P13),
categories and stores (P14), the metadata table (P15) and the post image (P21).

Ids leave every operator as strings; the CMS tables may key posts by number.
``max_keys`` (see ``joins.keep_keys``): the base post ids are counted and, within
the bound, broadcast, so the CMS tables (revisions with full text included) are
filtered where they are read instead of being shuffled for the semi-join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import from_epoch_seconds, local_time, ntz
from .joins import keep_keys


def _sid(c: str = "id"):
    return F.col(c).cast("string")


def post_expiry(postmeta: DataFrame, posts: DataFrame, now: dt.datetime, tz: str = "America/Denver",
                grace_hours: int = 8) -> DataFrame:
    """P10: newest non-empty expiry per published post and the 0/1 expired flag.

    ``max_by`` over meta_id replaces ``row_number() ... = 1``: it aggregates
    partially per task, so a post with many meta versions never lands whole in
    one sort.  Unparseable epoch text becomes NULL and so counts as expired.
    """
    live = posts.filter((F.col("post_type") == "post") & (F.col("post_status") == "publish")).select("id")
    pm = postmeta.filter(
        (F.col("meta_key") == "expiry_date") & F.col("meta_value").isNotNull() & (F.col("meta_value") != ""))
    pm = pm.join(live, pm.post_id == live.id, "left_semi")
    newest = pm.groupBy("post_id").agg(F.max_by("meta_value", "meta_id").alias("v"))
    expire = from_epoch_seconds(F.expr("try_cast(v AS BIGINT)"))
    local_now = local_time(ntz(now), tz)
    expired = (F.timestamp_add("HOUR", F.lit(-grace_hours), expire) < local_now) | expire.isNull()
    return newest.select(
        _sid("post_id").alias("post_id"),
        expire.alias("post_expire_date"),
        F.when(expired, 1).otherwise(0).alias("is_expired"),
    )


def post_base(posts: DataFrame, expiry: DataFrame, interactions: DataFrame, now: dt.datetime,
              tz: str = "America/Denver") -> DataFrame:
    """Posts of type 'post' that had interactions or are not expired, with days till expiry.

    ``is_expired`` stays NULL for a post without an expiry row (it survives only
    through ``in_int``).  The day count is a calendar-day difference in local time.
    """
    touched = interactions.select("post_id").distinct().withColumn("in_int", F.lit(1))
    p = posts.filter(F.col("post_type") == "post").select(_sid().alias("post_id"), "post_type")
    j = p.join(expiry, "post_id", "left").join(touched, "post_id", "left")
    in_int = F.coalesce(F.col("in_int"), F.lit(0))
    j = j.filter((in_int == 1) | (F.col("is_expired") == 0))
    local_now = local_time(ntz(now), tz)
    return j.select(
        "post_id", "post_type", "post_expire_date",
        F.datediff(F.to_date("post_expire_date"), F.to_date(local_now)).alias("days_till_expire"),
        "is_expired", in_int.alias("in_int"),
    ).distinct()


def post_content(post_versions: DataFrame, base: DataFrame, max_keys: int | None = None) -> DataFrame:
    """Distinct content versions joined by ' ', oldest first (by max(date, modified)).

    Versions are told apart by the digest of their text: rows are grouped by (post, digest), so no text is a
    shuffle key and equal texts are combined before the shuffle.  Each distinct text travels once; then the
    versions of a post are ordered by their earliest date.
    """
    v = post_versions.select(_sid().alias("post_id"), "post_content", "post_date", "post_modified")
    v = keep_keys(v, base.select("post_id"), "post_id", max_keys).filter(F.col("post_content").isNotNull())
    per = v.withColumn("digest", F.unhex(F.sha2("post_content", 256))).groupBy("post_id", "digest").agg(
        F.min(F.greatest("post_date", "post_modified")).alias("k"), F.any_value("post_content").alias("post_content"))
    ordered = F.array_sort(F.collect_list(F.struct("k", "post_content")))
    return per.groupBy("post_id").agg(
        F.array_join(F.transform(ordered, lambda s: s["post_content"]), " ").alias("post_content"))


def post_permalink(posts: DataFrame, postmeta: DataFrame, options: DataFrame, base: DataFrame,
                   max_keys: int | None = None) -> DataFrame:
    """Permalink from the site URL and the permalink template, plus the stored
    permalinks of tips and brags; restricted to the base posts.

    The two option values are uncorrelated scalar subqueries (one row each), not a cross join.
    """
    site = options.filter(F.col("option_name") == "siteurl").select("option_value").scalar()
    tmpl = options.filter(F.col("option_name") == "permalink_structure").select("option_value").scalar()
    d = F.col("post_date")
    path = F.replace(tmpl, F.lit("%year%"), F.date_format(d, "yyyy"))
    path = F.replace(path, F.lit("%monthnum%"), F.date_format(d, "MM"))
    path = F.replace(path, F.lit("%day%"), F.date_format(d, "dd"))
    path = F.replace(path, F.lit("%postname%"), F.col("post_name"))
    published = F.col("post_status") == "publish"
    a = posts.filter((F.col("post_type") == "post") & published).select(
        _sid().alias("post_id"), "post_date", F.concat(site, path).alias("permalink"), "post_type")
    tips = posts.filter(F.col("post_type").isin("tip", "brag") & published).select("id", "post_date", "post_type")
    pm = postmeta.filter(F.col("meta_key") == "published_permalink")
    b = pm.join(tips, pm.post_id == tips.id).select(
        _sid("post_id").alias("post_id"), "post_date",
        F.btrim(F.replace(F.col("meta_value"), F.lit("http:"), F.lit("https:")), F.lit("/")).alias("permalink"),
        "post_type")
    u = keep_keys(a.unionByName(b), base.select("post_id"), "post_id", max_keys)
    # One row a post, so that metadata and recommendations do not multiply; the newest date, then the last link
    return u.groupBy("post_id").agg(
        F.max_by("permalink", F.struct("post_date", "permalink")).alias("permalink"))


def post_categories(categories: DataFrame, base: DataFrame, exclude_pattern: str,
                    max_keys: int | None = None) -> DataFrame:
    """Slugs of each post's newest category date, both lists in one pass.

    ``category_list`` / ``store_list`` are the sorted slugs joined by ' ', NULL
    when the post has none of that taxonomy.
    """
    c = categories.select(_sid("post_id").alias("post_id"), "taxonomy", "slug", "post_date")
    c = keep_keys(c, base.select("post_id"), "post_id", max_keys)
    newest = c.groupBy("post_id").agg(F.max("post_date").alias("post_date"))
    kept = (c.join(newest, ["post_id", "post_date"])
            .filter(F.col("taxonomy").isin("store", "category") & ~F.col("slug").rlike(exclude_pattern))
            .select("post_id", "taxonomy", "slug").distinct())

    def slugs(tax: str):
        arr = F.array_sort(F.collect_list(F.when(F.col("taxonomy") == tax, F.col("slug"))))
        return F.when(F.size(arr) > 0, F.array_join(arr, " "))

    return kept.groupBy("post_id").agg(slugs("category").alias("category_list"), slugs("store").alias("store_list"))


def post_meta(base: DataFrame, permalink: DataFrame, content: DataFrame, cats: DataFrame) -> DataFrame:
    """One row per post with empty strings for missing text parts."""
    j = base.join(permalink, "post_id", "left").join(content, "post_id", "left").join(cats, "post_id", "left")
    e = F.lit("")
    return j.select(
        "post_id", "post_type", "post_expire_date", "days_till_expire", "is_expired", "in_int",
        F.coalesce("permalink", e).alias("permalink"),
        F.coalesce("post_content", e).alias("post_content"),
        F.coalesce("category_list", e).alias("category_list"),
        F.coalesce("store_list", e).alias("store_list"),
    )


def post_image(posts: DataFrame, postmeta: DataFrame, wanted: DataFrame | None = None,
               max_keys: int | None = None) -> DataFrame:
    """Image URL of a post's thumbnail (the attachment's guid); of the ``wanted`` post ids only, if given.

    The thumbnail id is text; ``try_cast`` keeps junk such as 'none' from
    failing the job and simply finds no attachment.
    """
    pl = posts.filter(F.col("post_type").isin("post", "tip") & (F.col("post_status") == "publish")).select(
        F.col("id").alias("pl_id"))
    pm = postmeta.filter(F.col("meta_key") == "_thumbnail_id").select(
        F.col("post_id").alias("pl_id"), F.expr("try_cast(meta_value AS BIGINT)").alias("thumb_id"))
    if wanted is not None:
        ids = wanted.select(F.col("post_id").cast("string").alias("_id"))
        pl = keep_keys(pl.withColumn("_id", _sid("pl_id")), ids, "_id", max_keys).drop("_id")
        pm = keep_keys(pm.withColumn("_id", _sid("pl_id")), ids, "_id", max_keys).drop("_id")
    att = posts.filter(F.col("guid").isNotNull()).select(F.col("id").alias("thumb_id"), "guid")
    j = pl.join(pm, "pl_id").join(att, "thumb_id")
    return j.groupBy("pl_id").agg(F.max("guid").alias("guid")).select(_sid("pl_id").alias("post_id"), "guid")


def newest_title(post_versions: DataFrame, wanted: DataFrame | None = None, max_keys: int | None = None) -> DataFrame:
    """JN12: the title of each post's newest version (``max_by`` instead of a correlated LIMIT 1), of the ``wanted``
    post ids only, if given."""
    v = post_versions.select(_sid().alias("post_id"), "post_title", "post_date")
    if wanted is not None:
        v = keep_keys(v, wanted.select(F.col("post_id").cast("string").alias("post_id")), "post_id", max_keys)
    return v.groupBy("post_id").agg(
        F.max_by("post_title", F.struct("post_date", "post_title")).alias("post_title"))

"""Identity: alias map with employee flag (P2), eligible e-mail cohort (P1),
newest e-mail and newest subscriber per user (P20)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import lookback_start, ntz
from ..params import HEAVY_ALIAS
from .joins import heavy_keys, join_owners, keep_keys


def employee_flags(alias: DataFrame, alias_type: DataFrame, pattern: str) -> DataFrame:
    """cim_id -> 1 if any e-mail alias matches ``pattern`` (after trim/lower), else 0."""
    email_ids = alias_type.filter(F.col("alias_type") == "email_address").select("alias_type_id")
    emails = alias.join(F.broadcast(email_ids), "alias_type_id")  # alias types: a handful of rows
    hit = F.trim(F.lower(F.col("alias_value"))).rlike(pattern).cast("int")
    return emails.groupBy("cim_id").agg(F.max(hit).alias("is_employee"))


def identity_map(alias: DataFrame, alias_type: DataFrame, employee_pattern: str,
                 cohort: DataFrame | None = None) -> DataFrame:
    """cim_id, alias_value, alias_type, is_employee, last_used_datetime, first_used_datetime.

    ``cohort`` (a frame with ``cim_id``) restricts the users by a semi-join; the
    flag is still computed over all of a user's e-mail aliases.
    """
    if cohort is not None:  # a user's flag only needs that user's aliases, so restrict first
        alias = alias.join(cohort.select("cim_id"), "cim_id", "left_semi")
    a = alias.join(F.broadcast(alias_type), "alias_type_id", "left")
    flags = employee_flags(alias, alias_type, employee_pattern)
    return a.join(flags, "cim_id", "left").select(
        "cim_id", "alias_value", "alias_type",
        F.coalesce(F.col("is_employee"), F.lit(0)).alias("is_employee"),
        "last_used_datetime", "first_used_datetime",
    )


def anonymous_ids(identity: DataFrame) -> DataFrame:
    return identity.filter(F.col("alias_type") == "anonymous_id").select("cim_id", "alias_value")


def eligible_cohort(engagement: DataFrame, sessions: DataFrame, identity: DataFrame,
                    orders_as_of: dt.datetime, lookback_days: int = 28, heavy_alias: int = HEAVY_ALIAS,
                    max_keys: int | None = None) -> DataFrame:
    """Latest e-mail file, most likely clickers, not employees, commission > 0 in the window.

    Sessions are pre-aggregated per anonymous id before they meet the alias
    map, so a hot anonymous id costs one row per task, not one per session.  An alias of more than
    ``heavy_alias`` users is split (``joins.join_owners``).
    """
    start = ntz(lookback_start(orders_as_of, lookback_days))
    per_anon = (sessions.filter(F.col("session_start_at") >= start)
                .groupBy("anonymous_id").agg(F.sum("total_commission").alias("total_commission")))
    ids = identity.select("cim_id", F.col("alias_value").alias("anonymous_id"))
    heavy = heavy_keys(ids, "anonymous_id", heavy_alias, max_keys)
    commission = (join_owners(per_anon, ids, "anonymous_id", heavy, "cim_id")
                  .groupBy("cim_id").agg(F.sum("total_commission").alias("total_commission")))
    latest = engagement.select(F.max("file_name_date")).scalar()
    e = engagement.filter(
        (F.col("file_name_date") == latest)
        & (F.col("email_click_likelihood") == "Most Likely")
        & F.col("cim_id").isNotNull()
        & (F.col("is_employee") == 0)
    )
    return e.join(commission, "cim_id").filter(F.col("total_commission") > 0).select(
        "lower_email_address", "cim_id", "is_employee", "email_click_likelihood", "total_commission")


def latest_email(engagement: DataFrame, users: DataFrame, max_keys: int | None = None) -> DataFrame:
    """Each user's rows of the newest extract (ties kept).  ``max_keys``: see ``joins.keep_keys``."""
    e = keep_keys(engagement, users.select("cim_id"), "cim_id", max_keys).filter(
        F.col("extract_timestamp").isNotNull())
    newest = e.groupBy("cim_id").agg(F.max("extract_timestamp").alias("extract_timestamp"))
    return e.join(newest, ["cim_id", "extract_timestamp"]).select(
        "lower_email_address", "cim_id", "extract_timestamp")


def latest_subscriber(subscribers: DataFrame, emails: DataFrame, active_only: bool = True,
                      max_keys: int | None = None) -> DataFrame:
    """Newest subscriber row per *raw* address, joined on the normalised address.

    One user can keep several subscriber ids (one per raw spelling); the
    outbound feed narrows that later.  ``active_only`` applies inside the
    "newest" search only, as in the in-house path.  ``max_keys``: see ``joins.keep_keys``.
    """
    wanted = emails.select(F.col("lower_email_address").alias("_e"))
    s = keep_keys(subscribers.withColumn("_e", F.lower(F.trim(F.col("email_address")))), wanted, "_e", max_keys)
    cand = s.filter(F.col("status") == "Active") if active_only else s
    newest = cand.filter(F.col("email_address").isNotNull() & F.col("date_created").isNotNull()).groupBy(
        "email_address").agg(F.max("date_created").alias("date_created"))
    rows = s.join(newest, ["email_address", "date_created"])
    return (rows.join(emails.select("cim_id", F.col("lower_email_address").alias("_e")), "_e")
            .select("cim_id", F.col("_e").alias("email"), "subscriber_id").distinct())

"""The reference's input tables, derived from the driver's TESTDATA parquet.

Each view is a deterministic projection of the raw tables (see FIXTURES.md);
the DuckDB oracle carries the same mapping as SQL CTEs.  Every function takes
``(spark, sf_dir)`` and returns a lazily planned DataFrame, so Catalyst prunes
columns and pushes filters down to the parquet scans.
"""

from __future__ import annotations

import calendar
import datetime as dt
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(text: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def _plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("int"), ts)


@lru_cache(maxsize=16)
def _run_dates(sf_dir: str, spark_id: int, spark: SparkSession) -> tuple[dt.datetime, dt.datetime]:
    row = raw(spark, sf_dir, "events").agg(F.max("ts").alias("m")).first()
    orow = raw(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("m")).first()
    day = lambda t: dt.datetime(t.year, t.month, t.day)
    return day(row["m"]), day(orow["m"])


def as_of(spark: SparkSession, sf_dir: str) -> dt.datetime:
    """Run date of the fixtures: midnight of the newest event (one scalar)."""
    return _run_dates(sf_dir, id(spark), spark)[0]


def orders_as_of(spark: SparkSession, sf_dir: str) -> dt.datetime:
    """The session table keeps its own clock: midnight of the newest order."""
    return _run_dates(sf_dir, id(spark), spark)[1]


def epoch_seconds(t: dt.datetime) -> int:
    return calendar.timegm(t.timetuple())


# --- identity -------------------------------------------------------------------------------------

def alias_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(1, "anonymous_id"), (2, "email_address"), (3, "subscriber_id")],
        "alias_type_id int, alias_type string",
    )


def _email_alias(c: Column) -> Column:
    return F.concat(
        F.lit("user"), c.cast("string"),
        F.when(c % 29 == 0, F.lit("@Staff.example.com ")).otherwise(F.lit("@example.com")),
    )


def alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cim_id, alias_value, alias_type_id, first_used_datetime, last_used_datetime."""
    ev = raw(spark, sf_dir, "events")
    cust = raw(spark, sf_dir, "customer")
    span = ev.groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    ids = cust.select(F.col("c_custkey").alias("uid")).union(ev.select(F.col("user_id").alias("uid"))).distinct()
    anon = ids.join(span, ids.uid == span.user_id, "left").select(
        F.col("uid").cast("string").alias("cim_id"),
        F.concat(F.lit("anon-"), F.col("uid").cast("string")).alias("alias_value"),
        F.lit(1).alias("alias_type_id"),
        F.col("first_ts").alias("first_used_datetime"),
        F.col("last_ts").alias("last_used_datetime"),
    )
    c = F.col("c_custkey")
    email = cust.select(
        c.cast("string").alias("cim_id"),
        _email_alias(c).alias("alias_value"),
        F.lit(2).alias("alias_type_id"),
        F.lit(None).cast("timestamp_ntz").alias("first_used_datetime"),
        F.lit(None).cast("timestamp_ntz").alias("last_used_datetime"),
    )
    n = F.col("n")
    sub = cust.select("c_custkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("n")).select(
        c.cast("string").alias("cim_id"),
        F.concat(F.lit("S-"), c.cast("string"), F.lit("-"), n.cast("string")).alias("alias_value"),
        F.lit(3).alias("alias_type_id"),
        F.lit(None).cast("timestamp_ntz").alias("first_used_datetime"),
        F.when((c + n) % 5 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(_plus_days(_ntz("2024-01-01 00:00:00"), c % 40 + n * (c % 3)))
        .alias("last_used_datetime"),
    )
    return anon.unionByName(email).unionByName(sub)


def email_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily files per customer: the run date and the day before."""
    a = as_of(spark, sf_dir)
    c = F.col("c_custkey")
    cust = raw(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("back"))
    file_date = F.date_sub(F.lit(a.date()), F.col("back"))
    return cust.select(
        F.lower(F.trim(_email_alias(c))).alias("lower_email_address"),
        F.when(c % 31 == 0, F.lit(None).cast("string")).otherwise(c.cast("string")).alias("cim_id"),
        F.when(c % 29 == 0, 1).otherwise(0).alias("is_employee"),
        F.when(c % 3 != 1, F.lit("Most Likely")).otherwise(F.lit("Unlikely")).alias("email_click_likelihood"),
        file_date.alias("file_name_date"),
        F.timestamp_add("HOUR", F.lit(6), file_date.cast("timestamp_ntz")).alias("extract_timestamp"),
    )


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = F.col("c_custkey"), F.col("n")
    base = F.lower(F.trim(_email_alias(c)))
    cust = raw(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    return cust.select(
        F.when(n == 1, base).otherwise(F.concat(F.lit("  "), F.upper(base), F.lit(" "))).alias("email_address"),
        F.concat(F.lit("S-"), c.cast("string"), F.lit("-"), n.cast("string")).alias("subscriber_id"),
        _plus_days(_ntz("2023-01-01 00:00:00"), c % 300 + n).alias("date_created"),
        F.when((c + n) % 4 != 0, F.lit("Active")).otherwise(F.lit("Unsubscribed")).alias("status"),
    )


# --- events ---------------------------------------------------------------------------------------

def _channel_events(spark: SparkSession, sf_dir: str, event_type: str) -> list[DataFrame]:
    ev = raw(spark, sf_dir, "events").filter(F.col("event_type") == event_type)
    post = F.when(F.col("event_id") % 211 == 0, F.lit(None).cast("string")).otherwise(
        F.get_json_object("props", "$.k"))
    out = []
    for ch in range(3):  # web, android, ios
        out.append(
            ev.filter(F.col("event_id") % 3 == ch).select(
                F.concat(F.lit("anon-"), F.col("user_id").cast("string")).alias("anonymous_id"),
                post.alias("post_id"),
                F.col("ts").alias("received_at"),
            )
        )
    return out


def views(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Page views / app screens, one DataFrame per channel."""
    return _channel_events(spark, sf_dir, "view")


def clicks(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Outgoing link clicks, one DataFrame per channel."""
    return _channel_events(spark, sf_dir, "click")


def commission(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = raw(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return ev.select(
        F.concat(F.lit("anon-"), F.col("user_id").cast("string")).alias("anonymous_id"),
        F.when(F.col("event_id") % 211 == 0, F.lit(None).cast("string"))
        .otherwise(F.get_json_object("props", "$.k")).alias("post_id"),
        F.lit(1).cast("long").alias("order_count"),
        F.col("ts").alias("commission_date"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One session per order; ten customers share one of the event users, who are a tenth of the customers."""
    o = raw(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("anon-"), F.expr("o_custkey div 10").cast("string")).alias("anonymous_id"),
        (F.col("o_totalprice") * F.lit(0.04)).alias("total_commission"),
        F.col("o_orderdate").alias("session_start_at"),
    )


# --- content --------------------------------------------------------------------------------------

def _post_cols(d: DataFrame) -> DataFrame:
    i = F.col("doc_id")
    post_date = _plus_days(_ntz("2023-06-01 00:00:00"), i % 240)
    return d.select(
        i.alias("id"),
        F.when(i % 11 == 0, F.when(i % 2 == 0, F.lit("tip")).otherwise(F.lit("brag")))
        .otherwise(F.lit("post")).alias("post_type"),
        F.when(i % 17 == 0, F.lit("draft")).otherwise(F.lit("publish")).alias("post_status"),
        F.col("text").alias("post_content"),
        post_date.alias("post_date"),
        _plus_days(post_date, i % 5).alias("post_modified"),
        F.concat(F.lit("item-"), i.cast("string")).alias("post_name"),
        F.concat(F.lit("Item "), i.cast("string")).alias("post_title"),
        F.concat(F.lit("http://origin.example.com/x/wp-content/"), i.cast("string"), F.lit(".png")).alias("guid"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _post_cols(raw(spark, sf_dir, "documents"))


def post_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts plus a changed second version (doc_id % 9 = 0) and an exact copy (doc_id % 9 = 1)."""
    base = posts(spark, sf_dir)
    changed = base.filter(F.col("id") % 9 == 0).select(
        "id", "post_type", "post_status",
        F.concat(F.col("post_content"), F.lit(" updated")).alias("post_content"),
        _plus_days(F.col("post_date"), F.lit(1)).alias("post_date"),
        _plus_days(F.col("post_modified"), F.lit(1)).alias("post_modified"),
        "post_name", "post_title", "guid",
    )
    copy = base.filter(F.col("id") % 9 == 1)
    return base.unionByName(changed).unionByName(copy)


def postmeta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """post_id, meta_id, meta_key, meta_value: expiry versions, thumbnails, published permalinks."""
    a = epoch_seconds(as_of(spark, sf_dir))
    d = raw(spark, sf_dir, "documents").select("doc_id")
    i, n = F.col("doc_id"), F.col("n")
    exp = d.filter(i % 7 != 0).select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("n")).select(
        i.alias("post_id"),
        (i * 10 + n).alias("meta_id"),
        F.lit("expiry_date").alias("meta_key"),
        F.when((i + n) % 23 == 0, F.lit(""))
        .when((i + n) % 19 == 0, F.lit(None).cast("string"))
        .otherwise((F.lit(a) + F.lit(86400) * ((i * 37) % 61 - 20 + n)).cast("string"))
        .alias("meta_value"),
    )
    thumb = d.filter(i % 4 != 0).select(
        i.alias("post_id"),
        (i * 10 + 3).alias("meta_id"),
        F.lit("_thumbnail_id").alias("meta_key"),
        F.when(i % 13 == 0, F.lit("none")).otherwise(((i * 3) % 200).cast("string")).alias("meta_value"),
    )
    link = d.filter(i % 11 == 0).select(
        i.alias("post_id"),
        (i * 10 + 4).alias("meta_id"),
        F.lit("published_permalink").alias("meta_key"),
        F.concat(F.lit("http://posts.example.com/tips/item-"), i.cast("string"), F.lit("/")).alias("meta_value"),
    )
    return exp.unionByName(thumb).unionByName(link)


def options(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("siteurl", "https://posts.example.com"), ("permalink_structure", "/%year%/%monthnum%/%day%/%postname%/")],
        "option_name string, option_value string",
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """post_id, taxonomy, slug, post_date (the post's date; 'stale' rows are 30 days older)."""
    d = raw(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    i = F.col("doc_id")
    post_date = _plus_days(_ntz("2023-06-01 00:00:00"), i % 240)
    slugs = F.array(
        F.struct(F.lit("category").alias("taxonomy"), F.col("lang").alias("slug"), F.lit(0).alias("age")),
        F.struct(F.lit("category").alias("taxonomy"), F.col("source").alias("slug"), F.lit(0).alias("age")),
        F.struct(F.lit("store").alias("taxonomy"), F.concat(F.lit("store-"), (i % 7).cast("string")).alias("slug"),
                 F.lit(0).alias("age")),
    )
    extra = F.filter(
        F.array(
            F.when(i % 5 == 0, F.struct(F.lit("category").alias("taxonomy"), F.lit("online-deals").alias("slug"),
                                        F.lit(0).alias("age"))),
            F.when(i % 6 == 0, F.struct(F.lit("category").alias("taxonomy"), F.lit("stale").alias("slug"),
                                        F.lit(30).alias("age"))),
        ),
        lambda x: x.isNotNull(),
    )
    rows = d.select(i, post_date.alias("pd"), F.explode(F.concat(slugs, extra)).alias("s"))
    return rows.select(
        F.col("doc_id").alias("post_id"),
        F.col("s.taxonomy").alias("taxonomy"),
        F.col("s.slug").alias("slug"),
        F.timestamp_add("DAY", -F.col("s.age"), F.col("pd")).alias("post_date"),
    )


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "pages").select("page_id", "url", "html")


def seed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed history: the day-one dummy row per user plus (u, k) where (u + k) % 10 = 0."""
    users = raw(spark, sf_dir, "events").select("user_id").distinct()
    u = F.col("user_id")
    dummy = users.select(u.cast("string").alias("cim_id"), F.lit("1111111").alias("post_id"))
    first = (F.lit(10) - u % 10) % 10
    past = users.select(u, F.explode(F.sequence(F.lit(0), F.lit(9))).alias("j")).select(
        u.cast("string").alias("cim_id"), (first + F.col("j") * 10).cast("string").alias("post_id"))
    return dummy.unionByName(past)

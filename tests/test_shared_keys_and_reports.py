"""Aliases of very many users, the lemma dictionary, one metadata row a post, the hosted report, ranking metrics."""

import datetime as dt
import math
import random
from dataclasses import replace

from pyspark.sql import functions as F

from conftest import SMALL
from tallyrec.operators import identity, implicit, interactions, joins, posts
from tallyrec.params import DEFAULT
from tallyrec.plans.daily import DailyRun
from tallyrec.session import scratch_path

NOW = dt.datetime(2024, 1, 30)


def _crowd(spark):
    """300 users with an alias of their own; half of them also share one, and one alias value is null."""
    alias = [(f"u{i}", f"own{i}", "anonymous_id") for i in range(300)]
    alias += [(f"u{i}", "shared", "anonymous_id") for i in range(0, 300, 2)] + [("u1", None, "anonymous_id")]
    rng = random.Random(3)
    events = [("shared", f"p{rng.randrange(40)}", dt.datetime(2024, 1, 20, rng.randrange(24))) for _ in range(500)]
    events += [(f"own{rng.randrange(320)}", f"p{rng.randrange(40)}", dt.datetime(2024, 1, 21)) for _ in range(500)]
    events += [(None, "p1", dt.datetime(2024, 1, 21))]
    return (spark.createDataFrame(alias, "cim_id string, alias_value string, alias_type string"),
            spark.createDataFrame(events, "anonymous_id string, post_id string, received_at timestamp_ntz"), alias, events)


def test_views_of_an_alias_of_half_the_users_are_the_same_when_it_is_split(spark):
    ident, ev, alias, events = _crowd(spark)
    want = {}
    for user, value, _ in alias:
        for anon, post, at in events:
            if value is not None and anon == value:
                n, last = want.get((user, post), (0, at))
                want[user, post] = (n + 1, max(last, at))
    for max_keys in (10, 0):  # heavy keys broadcast, or joined like any table
        heavy = interactions.heavy_ids(ident, 20, max_keys)
        assert [tuple(r) for r in heavy.collect()] == [("shared", 8)]
        got = interactions.page_views(ident, [ev], NOW, heavy=heavy).collect()
        assert {(r.cim_id, r.post_id): (r.page_view_count, r.max_date) for r in got} == want and len(got) == len(want)
    assert interactions.heavy_ids(ident, 150, 10) is None  # 150 users are not more than 150


def test_no_task_holds_a_whole_heavy_key(spark):
    rows = spark.range(4000).select(F.lit("k").alias("key"), F.col("id").cast("string").alias("post"))
    owners = spark.range(4000).select(F.lit("k").alias("key"), F.col("id").cast("string").alias("owner"))
    heavy = joins.heavy_keys(owners, "key", 500, 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = joins.join_owners(rows, owners, "key", heavy, "owner", "post")
        per = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(per) == 4000 * 4000
    assert len(per) > 20 and max(per) < 4000 * 4000 / 8


def test_commission_of_a_shared_alias_is_the_same_when_it_is_split(spark):
    ident, _, alias, _ = _crowd(spark)
    sessions = spark.createDataFrame([("shared", 2.0, NOW), ("own2", 3.0, NOW), ("own1", 1.0, NOW)],
                                     "anonymous_id string, total_commission double, session_start_at timestamp_ntz")
    mail = spark.createDataFrame([(f"u{i}@x", f"u{i}", 0, "Most Likely", dt.date(2024, 1, 29)) for i in range(300)],
                                 "lower_email_address string, cim_id string, is_employee int, email_click_likelihood string, file_name_date date")
    want = {f"u{i}": 2.0 + 3.0 * (i == 2) for i in range(0, 300, 2)} | {"u1": 1.0}
    for most in (20, 1000):
        got = identity.eligible_cohort(mail, sessions, ident, NOW, heavy_alias=most, max_keys=10).collect()
        assert {r.cim_id: r.total_commission for r in got} == want


def test_lemma_dictionary_reaches_the_run(spark, run):
    terms = [r.term for r in run.tokens.groupBy("term").agg(F.sum("tf").alias("n")).orderBy(F.desc("n"), "term").limit(2).collect()]
    path = scratch_path(spark, "lemmas")
    rows = [(terms[0], "zzlemma"), (terms[0], "zzother"), (terms[1], None), (None, "zznone")]
    spark.createDataFrame(rows, "token string, lemma string").write.parquet(path)
    before = {(r.post_id, r.term): r.tf for r in run.tokens.collect()}
    want = {(p, "zzlemma" if t == terms[0] else t): n for (p, t), n in before.items()}
    for bound in (DEFAULT.max_broadcast_rows, 0):
        other = DailyRun(spark, SMALL, replace(DEFAULT, lemma_path=path))
        other.__dict__["meta"] = run.meta
        other.p = replace(other.p, max_broadcast_rows=bound)
        assert {(r.post_id, r.term): r.tf for r in other.tokens.collect()} == want


def test_a_post_with_two_published_rows_has_one_metadata_row(spark):
    posts_ = spark.createDataFrame(
        [(1, "post", "publish", dt.datetime(2024, 1, 1), "old"), (1, "post", "publish", dt.datetime(2024, 1, 2), "new"),
         (2, "tip", "publish", dt.datetime(2024, 1, 3), "t")],
        "id long, post_type string, post_status string, post_date timestamp_ntz, post_name string")
    meta = spark.createDataFrame([(2, 1, "published_permalink", "http://a/b/"), (2, 2, "published_permalink", "http://a/c/")],
                                 "post_id long, meta_id long, meta_key string, meta_value string")
    options = spark.createDataFrame([("siteurl", "https://s"), ("permalink_structure", "/%year%/%monthnum%/%day%/%postname%/")],
                                    "option_name string, option_value string")
    base = spark.createDataFrame([("1", "post"), ("2", "tip")], "post_id string, post_type string")
    got = {r.post_id: r.permalink for r in posts.post_permalink(posts_, meta, options, base, 10).collect()}
    assert got == {"1": "https://s/2024/01/02/new/", "2": "https://a/c"}
    assert posts.post_permalink(posts_, meta, options, base).count() == 2


def test_images_and_titles_of_the_wanted_posts_are_those_of_all(run):
    every = {r.post_id: r.guid for r in run.images.collect()}
    titles = {r.post_id: r.post_title for r in posts.newest_title(run.post_versions).collect()}
    wanted = run.recs.select("post_id").distinct()
    ids = {r.post_id for r in wanted.collect()}
    for bound in (None, 0, 10 ** 6):
        some = {r.post_id: r.guid for r in posts.post_image(run.posts, run.postmeta, wanted, bound).collect()}
        assert some == {k: v for k, v in every.items() if k in ids} and some
        some = {r.post_id: r.post_title for r in posts.newest_title(run.post_versions, wanted, bound).collect()}
        assert some == {k: v for k, v in titles.items() if k in ids} and some


def test_hosted_report_shows_past_clicks_and_the_list(spark):
    recs = spark.createDataFrame([("u", "p1", "l1", 0.5, 1), ("u", "p2", None, 0.4, 2), ("w", "p1", "l1", 0.1, 1)],
                                 "cim_id string, post_id string, permalink string, score double, post_order int")
    events = spark.createDataFrame([("u", "p3", "click", 10), ("u", "p4", "order", 20), ("u", "p5", "view", 30), ("x", "p3", "click", 1)],
                                   "user_id string, item_id string, event_type string, timestamp long")
    titles = spark.createDataFrame([("p1", "one", "l1"), ("p3", "three", "l3"), ("p4", "four", "l4")],
                                   "post_id string, post_title string, permalink string")
    got = {tuple(r) for r in implicit.explain_hosted(recs, events, titles).collect()}
    assert got == {("u", "clicked or ordered", 1, "p4", "order", None, "four", "l4"),
                   ("u", "clicked or ordered", 2, "p3", "click", None, "three", "l3"),
                   ("u", "recommended", 1, "p1", None, 0.5, "one", "l1"), ("u", "recommended", 2, "p2", None, 0.4, None, None),
                   ("w", "recommended", 1, "p1", None, 0.1, "one", "l1")}


def test_ranking_metrics_equal_brute_force(spark):
    rng = random.Random(7)
    lists = [([float(x) for x in rng.sample(range(30), rng.choice([0, 3, 5, 8]))],
              [float(x) for x in rng.sample(range(30), rng.randint(1, 9))]) for _ in range(60)]
    k = 5
    prec, ndcg, avg = [], [], []
    for guess, label in lists:
        hit = [g in label for g in guess]
        prec.append(sum(hit[:k]) / k)
        gain = sum(h / math.log2(i + 2) for i, h in enumerate(hit[:k]))
        ndcg.append(gain / sum(1 / math.log2(i + 2) for i in range(min(len(label), k))))
        avg.append(sum(sum(hit[:i + 1]) / (i + 1) for i, h in enumerate(hit) if h) / len(label))
    df = spark.createDataFrame(lists, "prediction array<double>, label array<double>")
    r = implicit.ranking_metrics(df, k).first()
    mean = lambda xs: sum(xs) / len(xs)
    assert abs(r.precision_at_k - mean(prec)) < 2e-6 and abs(r.map - mean(avg)) < 2e-6
    assert abs(r.ndcg_at_k - mean(ndcg)) < 2e-6 and r.n_users == 60
    assert math.isnan(implicit.ranking_metrics(df.limit(0), k).first().map)

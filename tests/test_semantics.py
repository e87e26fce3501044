"""Hand-made rows for the rules the fixture tables cannot show (FIXTURES section 5)."""

import datetime as dt

from pyspark.sql import functions as F

from tallyrec.functions import text as T


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_markup_is_greedy_per_line_and_cr_is_not_a_line_end(spark):
    # Python's dot stops only at \n: a \r inside markup is swallowed with it.
    assert _one(spark, T.clean_text(F.lit("a<b\rc>d"))) == "a d"
    assert _one(spark, T.clean_text(F.lit("x<a> keep <b>z\nY<i>W"))) == "x z y w"
    assert _one(spark, T.clean_text(F.lit("Café 50% OFF!!  now"))) == "caf off now"


def test_title_from_url(spark):
    t = T.title_from_url(F.lit("https://posts.example.com/2023/06/01/item-5-best-deal/"),
                         "https://posts.example.com/..../../../")
    assert _one(spark, t) == "item best deal"


def test_pipe_list(spark):
    assert _one(spark, T.pipe_list(F.lit("a b"), F.lit("s"))) == "a|b|s"
    assert _one(spark, T.pipe_list(F.lit(""), F.lit("s t"))) == "s|t"
    assert _one(spark, T.pipe_list(F.lit(""), F.lit(""))) == ""


def test_duplicate_text_does_not_displace_a_candidate(spark):
    # The seed's twin (similarity 1.0) stays a candidate; only the seed itself is excluded.
    from tallyrec.operators.similarity import seed_similarity

    w = spark.createDataFrame([("s", "a", 1.0), ("twin", "a", 1.0), ("o", "a", 0.6), ("o", "b", 0.8)],
                              "post_id string, term string, weight double")
    seeds = spark.createDataFrame([("s",)], "seed_post_id string")
    got = {(r.post_id, r.sim_score) for r in seed_similarity(w, seeds, seed_bound_rows=10).collect()}
    assert got == {("twin", 1.0), ("o", 0.6)}


def test_two_seeds_sharing_a_candidate_take_the_max(spark):
    # T10 and the early per-seed cut: the result must equal the uncut definition.
    from tallyrec.operators.hybrid import similar_posts

    seeds = spark.createDataFrame([("u", "s1", 1), ("u", "s2", 2)], "cim_id string, seed_post_id string, seed_rank int")
    sim = spark.createDataFrame(
        [("s1", "p", 0.2), ("s2", "p", 0.9), ("s1", "q", 0.5), ("s1", "s2", 0.7), ("s2", "c", 0.95)],
        "seed_post_id string, post_id string, sim_score double")
    meta = spark.createDataFrame([(p, 0) for p in ["p", "q", "s2", "c", "s1"]], "post_id string, is_expired int")
    inter = spark.createDataFrame([("u", "c", 4)], "cim_id string, post_id string, post_rating int")
    got = [(r.post_id, r.sim_score) for r in similar_posts(seeds, inter, sim, meta, k=2).orderBy(
        F.desc("sim_score")).collect()]
    assert got == [("p", 0.9), ("s2", 0.7)]  # c converted; s2 is suggested through s1


def test_expiry_boundary_and_calendar_days(spark):
    # Expired iff expiry - 8h < local(now), or expiry unknown; T27: calendar-day difference.
    from tallyrec.operators.posts import post_base, post_expiry

    now = dt.datetime(2024, 1, 30)  # local (Denver) = 2024-01-29 17:00
    edge = int(dt.datetime(2024, 1, 30, 1, 0, tzinfo=dt.timezone.utc).timestamp())  # 17:00 + 8h, local
    posts = spark.createDataFrame([(i, "post", "publish") for i in (1, 2, 3, 4)],
                                  "id long, post_type string, post_status string")
    meta = spark.createDataFrame(
        [(1, 10, "expiry_date", str(edge)), (2, 20, "expiry_date", str(edge - 1)),
         (3, 30, "expiry_date", "junk"), (3, 29, "expiry_date", str(edge))],
        "post_id long, meta_id long, meta_key string, meta_value string")
    e = {r.post_id: r.is_expired for r in post_expiry(meta, posts, now).collect()}
    assert e == {"1": 0, "2": 1, "3": 1}
    inter = spark.createDataFrame([("u", "4")], "cim_id string, post_id string")
    base = {r.post_id: (r.is_expired, r.days_till_expire, r.in_int) for r in
            post_base(posts, post_expiry(meta, posts, now), inter, now).collect()}
    # post 1 expires 2024-01-30 01:00 UTC-wall-clock: one calendar day after 2024-01-29 local.
    assert base == {"1": (0, 1, 0), "4": (None, None, 1)}


def test_alias_shared_by_two_users_counts_for_both(spark):
    # No de-duplication of aliases.
    from tallyrec.operators.interactions import page_views

    ident = spark.createDataFrame([("u1", "anon-x", "anonymous_id"), ("u2", "anon-x", "anonymous_id")],
                                  "cim_id string, alias_value string, alias_type string")
    ev = spark.createDataFrame([("anon-x", "p", dt.datetime(2024, 1, 20)), ("anon-x", "p", dt.datetime(2024, 1, 21)),
                                ("anon-x", None, dt.datetime(2024, 1, 21)), ("anon-x", "p", dt.datetime(2023, 1, 1))],
                               "anonymous_id string, post_id string, received_at timestamp_ntz")
    got = {(r.cim_id, r.page_view_count) for r in page_views(ident, [ev], dt.datetime(2024, 1, 30)).collect()}
    assert got == {("u1", 2), ("u2", 2)}


def test_rating_rule(spark):
    # Views drive; an order without a view gives no row.
    from tallyrec.operators.interactions import rated_interactions

    v = spark.createDataFrame([("u", "a", None, 1), ("u", "b", None, 3), ("u", "c", None, 1), ("u", "d", None, 1)],
                              "cim_id string, post_id string, max_date timestamp_ntz, page_view_count long")
    c = spark.createDataFrame([("u", "c", 1)], "cim_id string, post_id string, outgoing_link_click_count long")
    o = spark.createDataFrame([("u", "d", 2), ("u", "z", 1)], "cim_id string, post_id string, order_count long")
    g = spark.createDataFrame([("u", "in_house_test")], "cim_id string, rec_group string")
    log = spark.createDataFrame([("u", "a"), ("u", "a")], "cim_id string, post_id string")
    got = {r.post_id: (r.post_rating, r.prev_rec) for r in rated_interactions(v, c, o, g, log).collect()}
    assert got == {"a": (1, 2), "b": (2, 0), "c": (3, 0), "d": (4, 0)}


def test_unseen_item_gets_a_prediction(spark):
    # An item nobody rated is scored from the known terms.
    from tallyrec.operators.rating import fit_bias, predict_bias

    r = spark.createDataFrame([("u", "a", 4), ("u", "b", 2), ("v", "a", 3)], "cim_id string, post_id string, post_rating int")
    m = fit_bias(r)
    p = predict_bias(spark.createDataFrame([("u", "new"), ("w", "new")], "cim_id string, post_id string"), m)
    got = {row.cim_id: row.pred_rating for row in p.collect()}
    mu = 3.0
    bu = ((4 - mu - (4 - mu + 3 - mu) / 12) + (2 - mu - (2 - mu) / 11)) / 17
    assert abs(got["u"] - round(mu + bu, 6)) < 1e-9 and got["w"] == 3.0


def test_latest_subscriber_ties_all_survive(spark):
    # Per e-mail keep every row used at the latest time (NULL = 2000-01-01).
    from tallyrec.operators.feed import outbound_feed

    feed = spark.createDataFrame(
        [("e1", "S-1-1", "http://h/x/wp-content/1.png", 1), ("e1", "S-1-2", None, 1), ("e2", "S-2-1", None, 1),
         ("e2", "S-2-2", None, 1)],
        "email string, subscriber_id string, image_url string, position int").withColumn(
        "post_title", F.lit("t")).withColumn("valid", F.lit(1)).withColumn("send_date", F.lit(None).cast(
            "timestamp_ntz")).withColumn("url", F.lit("u")).withColumn("slugs", F.lit(None).cast("string")).withColumn(
        "post_id", F.lit("p")).withColumn("received", F.lit(None).cast("string"))
    t = dt.datetime(2024, 1, 5)
    alias = spark.createDataFrame([("S-1-1", t), ("S-1-2", t), ("S-2-1", None), ("S-2-2", dt.datetime(1999, 1, 1))],
                                  "alias_value string, last_used_datetime timestamp_ntz")
    out = outbound_feed(feed, alias, "in_house_daily", "/wp-content", "https://cdn/wp-content")
    got = sorted((r.email, r.subscriber_id, r.test_group, r.image_url) for r in out.collect())
    assert got == [("e1", "S-1-1", "-1", "https://cdn/wp-content/1.png"), ("e1", "S-1-2", "-2", None),
                   ("e2", "S-2-1", "-1", None)]


def test_thumbnail_junk_finds_no_image(spark):
    # JN8: 'none' is not a number; the job must not fail.
    from tallyrec.operators.posts import post_image

    posts = spark.createDataFrame([(1, "post", "publish", None), (2, "post", "publish", None), (7, "attachment", "inherit", "g7")],
                                  "id long, post_type string, post_status string, guid string")
    meta = spark.createDataFrame([(1, 13, "_thumbnail_id", "none"), (2, 23, "_thumbnail_id", "7")],
                                 "post_id long, meta_id long, meta_key string, meta_value string")
    assert [(r.post_id, r.guid) for r in post_image(posts, meta).collect()] == [("2", "g7")]


def test_csv_round_trip_keeps_awkward_values(spark):
    from tallyrec.schemas import OUTBOUND
    from tallyrec.session import scratch_path
    from tallyrec.sources import io

    rows = [("a@x", 'Title, with "quotes"\nand a newline', 1, dt.datetime(2024, 1, 29), None, "", None, 1, "-1",
             "in_house_daily", "5", "S-1-1", None),
            ("b@x", "  padded  ", 1, dt.datetime(2024, 1, 29, 0, 0, 0, 123456), "img", "u", None, 2, "-2", "d", "6",
             "S-2-1", None)]
    df = spark.createDataFrame(rows, OUTBOUND)
    path = scratch_path(spark, "test-csv")
    io.write_csv(df, path, order_by=["email"])
    back = io.read_csv(spark, path, OUTBOUND)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_lemma_dictionary_maps_tokens_and_stop_words(spark):
    # ML2 re-aimed: a broadcast (token, lemma) dictionary; stop words are mapped the same way.
    from tallyrec.operators.tfidf import doc_tokens

    docs = spark.createDataFrame([("p", "deals deal was are src3 home-decor")], "post_id string, soup string")
    lem = spark.createDataFrame([("deals", "deal"), ("was", "wa")], "token string, lemma string")
    got = {(r.term, r.tf) for r in doc_tokens(docs, spark, (), lemmas=lem).collect()}
    # 'was' -> 'wa' is dropped because the stop word 'was' is mapped to 'wa' too; 'are' is a stop word.
    assert got == {("deal", 2), ("src3", 1), ("homedecor", 1)}


def test_null_expiry_differs_by_path(spark):
    # The content path needs is_expired = 0 (NULL is out); the hosted path drops only flag 1 (NULL stays).
    from tallyrec.operators.hybrid import similar_posts
    from tallyrec.operators.implicit import not_expired

    meta = spark.createDataFrame([("a", 0), ("b", None), ("c", 1)], "post_id string, is_expired int")
    assert sorted(r.post_id for r in meta.filter(not_expired()).collect()) == ["a", "b"]
    seeds = spark.createDataFrame([("u", "s", 1)], "cim_id string, seed_post_id string, seed_rank int")
    sim = spark.createDataFrame([("s", p, 0.5) for p in "abc"], "seed_post_id string, post_id string, sim_score double")
    inter = spark.createDataFrame([], "cim_id string, post_id string, post_rating int")
    assert [r.post_id for r in similar_posts(seeds, inter, sim, meta, k=5).collect()] == ["a"]

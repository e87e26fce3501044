"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query runs the real chain over the whole fixture tables; doubles are
rounded to 6 places so that Spark and the SQL oracle agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import hybrid, rating
from ..params import DEFAULT
from ..sources import fixtures as fx
from .daily import DailyRun


_RUNS: dict[tuple, DailyRun] = {}
FRESH = {"value": False}


def _run(spark: SparkSession, sf_dir: str) -> DailyRun:
    """One daily run per (session, data folder): its step tables are materialised once and
    shared by every query, as the original's persistent tables are.  ``FRESH`` forces a
    rebuild (the benchmark times every query from the raw tables)."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if FRESH["value"] or key not in _RUNS:
        _RUNS[key] = DailyRun(spark, sf_dir, DEFAULT)
    return _RUNS[key]


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.round(c, 6))
    return df


def q_alias_employee_flag(s, d):
    return _run(s, d).identity


def q_eligible_cohort(s, d):
    return _run(s, d).eligible


def q_page_views_by_post(s, d):
    return _run(s, d).activity[0]


def q_link_clicks_by_post(s, d):
    return _run(s, d).activity[1]


def q_orders_by_post(s, d):
    return _run(s, d).activity[2]


def q_cohort_sample_groups(s, d):
    return _run(s, d).groups


def q_cohort_sample_bound(s, d):
    """P6 with a bound that binds: 20 of the users with views."""
    from ..operators.interactions import sample_groups

    return sample_groups(_run(s, d).activity_all[0], 20)


def q_daily_interactions_from_partials(s, d):
    """P3-P5, P8 from stored day partials: the same rows as ``daily_interactions``."""
    from ..operators.interactions import rated_interactions
    from ..session import scratch_path
    from .daily import store_partials

    r = _run(s, d)
    partials = store_partials(r.src, scratch_path(s, "event-days"), DEFAULT.lookback_days)
    again = DailyRun(s, d, DEFAULT, setup=r.setup, partials=partials)
    return rated_interactions(*again.activity, again.cohort, r.seed_log)


def q_seed_history_init(s, d):
    return _run(s, d).seed_init


def q_rated_interactions(s, d):
    r = _run(s, d)
    v, c, o = r.activity_all
    from ..operators.interactions import rated_interactions

    return rated_interactions(v, c, o, r.groups, r.seed_log)


def q_cohort_interactions(s, d):
    return _run(s, d).setup


def q_daily_interactions(s, d):
    return _run(s, d).interactions


def q_post_expiry(s, d):
    return _run(s, d).expiry


def q_post_base(s, d):
    return _run(s, d).base


def q_post_content_agg(s, d):
    return _run(s, d).content


def q_post_permalink(s, d):
    return _run(s, d).permalink


def q_post_categories(s, d):
    return _run(s, d).categories


def q_post_meta(s, d):
    return _run(s, d).meta


def q_clean_text(s, d):
    p = fx.raw_pages(s, d)
    return p.select("page_id", T.clean_text(F.col("html")).alias("clean_html"))


def q_title_from_url(s, d):
    p = fx.raw_pages(s, d)
    return p.select("page_id", T.title_from_url(F.col("url"), DEFAULT.title_prefix_pattern).alias("title"))


def q_doc_soup(s, d):
    return _run(s, d).meta_text.select("post_id", "post_title", "soup")


def q_doc_tokens(s, d):
    return _run(s, d).tokens


def q_vocabulary_top500(s, d):
    return _run(s, d).vocab.select("term", "term_count")


def q_tfidf_weights(s, d):
    return _r6(_run(s, d).weights.select("post_id", "term", "tf", "weight"), "weight")


def q_count_cosine(s, d):
    r = _run(s, d)
    return r.similarity(r.count_weights, live_only=False)


def q_seed_similarity(s, d):
    r = _run(s, d)
    return r.similarity(r.weights, live_only=False)


def q_user_seeds(s, d):
    return _run(s, d).seeds


def q_user_converted(s, d):
    return hybrid.user_converted(_run(s, d).house)


def q_similar_posts(s, d):
    return _run(s, d).similar


def q_bias_ratings(s, d):
    r = _run(s, d)
    return rating.predict_bias(r.rated_all.select("cim_id", "post_id", "post_rating"), r.bias)


def q_holdout_split(s, d):
    return _run(s, d).split


def q_bias_rmse(s, d):
    return rating.bias_rmse(_run(s, d).split, DEFAULT.lambda_item, DEFAULT.lambda_user)


def q_hybrid_recs(s, d):
    return _run(s, d).recs


def q_explain_recs(s, d):
    r = _run(s, d)
    return hybrid.explain_recs(r.recs, r.seeds, r.meta_text)


def q_hybrid_recs_als(s, d):
    return _run(s, d).factor_recs


def q_als_grid_search(s, d):
    return _run(s, d).searched


def q_factor_rmse(s, d):
    return _run(s, d).factor_rmse()


def q_seed_log(s, d):
    return hybrid.seed_log_rows(_run(s, d).seeds)


def q_event_export(s, d):
    return _run(s, d).event_export


def q_item_export(s, d):
    return _run(s, d).item_export


def q_implicit_recs(s, d):
    return _run(s, d).implicit_recs()


def q_hosted_report(s, d):
    """ML17 for the hosted group: past clicks and orders next to the recommended posts (rows-only check, as ALS)."""
    return _run(s, d).hosted_report()


def q_popular_unexpired(s, d):
    from ..operators.implicit import popular_unexpired

    r = _run(s, d)
    return popular_unexpired(r.interactions, r.meta, k=DEFAULT.hosted_recs)


def q_implicit_metrics(s, d):
    return _run(s, d).implicit_metrics()


def q_latest_email(s, d):
    from ..operators.identity import latest_email

    r = _run(s, d)
    return latest_email(fx.email_engagement(s, d), r.recs.select("cim_id"))


def q_latest_subscriber(s, d):
    r = _run(s, d)
    return r.subscribers_for(r.recs, True)


def q_post_image(s, d):
    return _run(s, d).images


def q_production_batch(s, d):
    return _run(s, d).production


def q_current_feed(s, d):
    return _run(s, d).current_feed


def q_outbound_feed(s, d):
    return _run(s, d).outbound


def q_hosted_outbound_feed(s, d):
    """P22-P24 for the hosted group (its recommendations come from ALS: rows-only check)."""
    return _run(s, d).hosted_outbound


def q_csv_round_trip(s, d):
    """Write the outbound feed as one CSV and read it back through the declared schema."""
    from ..schemas import OUTBOUND
    from ..session import scratch_path
    from ..sources import io

    out = _run(s, d).outbound.drop("last_used_datetime")
    path = scratch_path(s, "feed-csv")
    io.write_csv(out, path, order_by=["email", "subscriber_id", "position"])
    return io.read_csv(s, path, OUTBOUND)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}

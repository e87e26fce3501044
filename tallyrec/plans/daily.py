"""The daily run as one lazily built graph of DataFrames.

Order of the original jobs: initial set-up (cohort, groups, seed history) ->
daily tables (interactions, post metadata) -> hybrid recommender -> push to
production -> hosted recommender -> outbound export.  Every property below is
a DataFrame (nothing is executed until an action); shared inputs are the same
DataFrame objects, so repeated sub-plans can reuse exchanges.

``run_daily`` materialises the persistent tables the way a scheduler would:
written tables cut the lineage between steps, and the seed history is
appended idempotently per run date.
"""

from __future__ import annotations

from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import feed, hybrid, identity, implicit, interactions, posts, rating, similarity, tfidf
from ..params import (DEFAULT, FEED_LABEL_HOSTED, FEED_LABEL_IN_HOUSE, GROUP_HOSTED, GROUP_IN_HOUSE,
                      OUTBOUND_POST_TYPE_HOSTED, OUTBOUND_POST_TYPE_IN_HOUSE, RunParams)
from ..functions.time import lookback_start
from ..session import drop_step_tables, materialize, step_tables
from ..sources import versions
from ..sources.named import Sources, fixture_sources


class DailyRun:
    """``setup`` / ``seed_history``: optional frames written by earlier runs (the set-up table and the
    seed history); without them the run derives the set-up itself and uses the sources' seed log.
    ``sources``: the named inputs and run dates (default: the fixtures in ``sf_dir``).  ``partials``: stored day
    partials by kind of event; with them the daily activity reads no raw events."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: RunParams = DEFAULT,
                 setup: DataFrame | None = None, seed_history: DataFrame | None = None,
                 sources: Sources | None = None, partials: dict[str, DataFrame] | None = None):
        self.spark, self.p = spark, params
        self.src = sources or fixture_sources(spark, sf_dir)
        self.as_of, self.orders_as_of = self.src.as_of, self.src.orders_as_of
        self.partials = partials
        if setup is not None:
            self.__dict__["setup"] = setup
            self.__dict__["groups"] = setup.select("cim_id", "rec_group").distinct()
        if seed_history is not None:
            self.__dict__["seed_log"] = seed_history.select("cim_id", "post_id")

    # --- inputs -----------------------------------------------------------------------------------
    @cached_property
    def alias(self) -> DataFrame:
        return self.src.table("alias")

    @cached_property
    def alias_type(self) -> DataFrame:
        return self.src.table("alias_type")

    @cached_property
    def posts(self) -> DataFrame:
        return self.src.table("posts")

    @cached_property
    def postmeta(self) -> DataFrame:
        return self.src.table("postmeta")

    # --- initial set-up ---------------------------------------------------------------------------
    @cached_property
    def identity_all(self) -> DataFrame:
        return identity.identity_map(self.alias, self.alias_type, self.p.employee_pattern)

    @cached_property
    def eligible(self) -> DataFrame:
        e = identity.eligible_cohort(self.src.table("email_engagement"), self.src.table("sessions"),
                                     self.alias, self.orders_as_of, self.p.lookback_days, self.p.heavy_alias,
                                     self.p.max_broadcast_rows)
        return materialize(e.withColumn("total_commission", F.round("total_commission", 6)))

    @cached_property
    def identity_setup(self) -> DataFrame:
        """The set-up's alias map: eligible users only, so groups, seed history and ratings are theirs."""
        return materialize(identity.identity_map(self.alias, self.alias_type, self.p.employee_pattern,
                                                 cohort=self.eligible.select("cim_id").distinct()))

    def _activity(self, ident: DataFrame, prefilter: bool = False):
        lb = self.p.lookback_days
        keys = interactions.cohort_keys(ident, self.p.max_broadcast_rows) if prefilter else None
        heavy = interactions.heavy_ids(ident, self.p.heavy_alias, self.p.max_broadcast_rows)
        if prefilter and self.partials is not None:
            return tuple(interactions.merge_partials(k, ident, self.partials[k], self.as_of, lb, keys, heavy)
                         for k in interactions.MEASURES)
        v = interactions.page_views(ident, self.src.parts("views"), self.as_of, lb, keys, heavy)
        c = interactions.link_clicks(ident, self.src.parts("clicks"), self.as_of, lb, keys, heavy)
        o = interactions.orders(ident, self.src.parts("commission"), self.as_of, lb, keys, heavy)
        return v, c, o

    @cached_property
    def activity_all(self):
        return self._activity(self.identity_setup)

    @cached_property
    def groups(self) -> DataFrame:
        return materialize(interactions.sample_groups(self.activity_all[0], self.p.sample_users))

    @cached_property
    def seed_init(self) -> DataFrame:
        return interactions.seed_history_init(self.activity_all[0])

    @cached_property
    def setup(self) -> DataFrame:
        """groups_interactions_setup: the cohort's rated pairs with their group."""
        v, c, o = self.activity_all
        rated = interactions.rated_interactions(v, c, o, self.groups, self.seed_init)
        return materialize(interactions.cohort_interactions(rated, self.groups))

    # --- daily tables -----------------------------------------------------------------------------
    @cached_property
    def identity(self) -> DataFrame:
        return materialize(identity.identity_map(self.alias, self.alias_type, self.p.employee_pattern,
                                                 cohort=self.cohort.select("cim_id")))

    @property
    def cohort(self) -> DataFrame:
        """Users and groups of the set-up table.  The sample is drawn from users with page views
        and the set-up rows are view-driven, so its (cim_id, rec_group) pairs are exactly the
        sample groups; reading those skips the set-up's click and order work.  The sample has
        at most ``sample_users`` rows (a limit), so it is broadcast when that bound allows."""
        c = self.groups.select("cim_id", "rec_group")
        return F.broadcast(c) if self.p.sample_users <= self.p.max_broadcast_rows else c

    @cached_property
    def activity(self):
        # The daily cohort is a sample: prefilter the events by its anonymous ids (size-checked).
        return self._activity(self.identity, prefilter=True)

    @cached_property
    def seed_log(self) -> DataFrame:
        return self.src.table("seed_log")

    @cached_property
    def interactions(self) -> DataFrame:
        v, c, o = self.activity
        return materialize(
            interactions.rated_interactions(v, c, o, self.cohort, self.seed_log))

    @cached_property
    def expiry(self) -> DataFrame:
        return posts.post_expiry(self.postmeta, self.posts, self.as_of, self.p.local_tz, self.p.grace_hours)

    @cached_property
    def base(self) -> DataFrame:
        return materialize(posts.post_base(self.posts, self.expiry, self.interactions, self.as_of, self.p.local_tz))

    @cached_property
    def post_versions(self) -> DataFrame:
        return self.src.table("post_versions")

    @cached_property
    def content(self) -> DataFrame:
        return posts.post_content(self.post_versions, self.base, self.p.max_broadcast_rows)

    @cached_property
    def permalink(self) -> DataFrame:
        return posts.post_permalink(self.posts, self.postmeta, self.src.table("options"), self.base,
                                    self.p.max_broadcast_rows)

    @cached_property
    def categories(self) -> DataFrame:
        return posts.post_categories(self.src.table("categories"), self.base, self.p.category_exclude_pattern,
                                     self.p.max_broadcast_rows)

    @cached_property
    def meta(self) -> DataFrame:
        return materialize(posts.post_meta(self.base, self.permalink, self.content, self.categories))

    # --- text features ----------------------------------------------------------------------------
    @cached_property
    def meta_text(self) -> DataFrame:
        return tfidf.with_text(self.meta, self.p.title_prefix_pattern)

    @cached_property
    def tokens(self) -> DataFrame:
        lemmas = self.spark.read.parquet(self.p.lemma_path) if self.p.lemma_path else None
        return materialize(tfidf.doc_tokens(self.meta_text, self.spark, self.p.extra_stop_words, lemmas,
                                            max_keys=self.p.max_broadcast_rows))

    @cached_property
    def vocab(self) -> DataFrame:
        return materialize(tfidf.vocabulary(self.tokens, self.p.vocabulary_size))

    @cached_property
    def weights(self) -> DataFrame:
        n_docs = self.meta.select(F.count(F.lit(1))).scalar()
        w = tfidf.tfidf(self.tokens, self.vocab, n_docs)
        # Carry the expiry flag (one value per post) so the candidate side is a filter, not a join.
        return materialize(w.join(self.meta.select("post_id", "is_expired"), "post_id", "left"))

    @cached_property
    def count_weights(self) -> DataFrame:
        return materialize(tfidf.count_weights(self.tokens, self.vocab))

    # --- hybrid recommender -----------------------------------------------------------------------
    @cached_property
    def rated_all(self) -> DataFrame:
        """All groups' interactions with posts in the metadata (the model trains on every group)."""
        return materialize(hybrid.group_interactions(self.interactions, self.meta, None))

    @cached_property
    def house(self) -> DataFrame:
        return self.rated_all.filter(F.col("rec_group") == GROUP_IN_HOUSE)

    @cached_property
    def seeds(self) -> DataFrame:
        return materialize(hybrid.user_seeds(self.house, self.p.seeds_per_user))

    @cached_property
    def seed_bound_rows(self) -> int:
        # Counted seed rows (a stored table), each with at most the vocabulary's terms.
        return self.seeds.count() * self.p.vocabulary_size

    @property
    def seeds_bounded(self) -> bool:
        return self.seed_bound_rows <= self.p.max_broadcast_rows

    def similarity(self, weights: DataFrame, live_only: bool = True) -> DataFrame:
        live = F.col("is_expired") == 0
        return similarity.seed_similarity(weights, self.seeds, live if live_only else None, self.seed_bound_rows,
                                          self.p.max_broadcast_rows, keep=("is_expired",) if live_only else ())

    @cached_property
    def similar(self) -> DataFrame:
        """Pruned lists where the seeds fit every task (counted); above that, all pairs that share a term."""
        k, depth = self.p.content_candidates, hybrid.list_depth(self.seeds, self.house, self.p.content_candidates)
        if not self.seeds_bounded:
            return hybrid.similar_posts(self.seeds, self.house, self.similarity(self.weights), self.meta, k, depth=depth)
        top = similarity.seed_top(self.weights, self.seeds, depth, F.col("is_expired") == 0)
        return hybrid.similar_posts(self.seeds, self.house, top, self.meta, k, True, depth, unexpired=True)

    @cached_property
    def split(self) -> DataFrame:
        """ML12: the exact train/test split of all rated pairs (used by fit, score and RMSE)."""
        return materialize(rating.holdout_split(self.rated_all.select("cim_id", "post_id", "post_rating"),
                                                self.p.train_fraction, self.p.split_seed))

    @cached_property
    def bias(self) -> rating.BiasModel:
        return rating.fit_bias(self.rated_all, self.p.lambda_item, self.p.lambda_user)

    def _hybrid(self, predict) -> DataFrame:
        return hybrid.hybrid_recs(self.similar, predict, self.meta_text, self.p.explore, self.p.explore_threshold,
                                  self.p.final_recs)

    @cached_property
    def recs(self) -> DataFrame:
        return materialize(self._hybrid(lambda df: rating.predict_bias(df, self.bias)))

    @cached_property
    def searched(self) -> DataFrame:
        """ML11: the grid scored by cross-validation on the 85 % part."""
        return rating.als_grid_search(self.split.filter(F.col("part") == "train"), self.p.grid_iterations,
                                      self.p.grid_penalties, self.p.grid_folds, seed=self.p.split_seed,
                                      lambda_item=self.p.lambda_item, lambda_user=self.p.lambda_user)

    def factor_rmse(self) -> DataFrame:
        return rating.factor_rmse(self.split, rating.best_setting(self.searched), self.p.lambda_item,
                                  self.p.lambda_user, seed=self.p.split_seed)

    @cached_property
    def factor_recs(self) -> DataFrame:
        """The daily job's recommendations: refit on all ratings with the searched setting."""
        best = rating.best_setting(self.searched)
        model = rating.fit_factors(self.rated_all, self.p.lambda_item, self.p.lambda_user, max_iter=best.max_iter,
                                   reg=best.reg, seed=self.p.split_seed)
        return materialize(self._hybrid(lambda df: rating.predict_factors(df, model)))

    # --- production and feeds ---------------------------------------------------------------------
    def subscribers_for(self, staging: DataFrame, active_only: bool) -> DataFrame:
        cap = self.p.max_broadcast_rows  # staging users come from the sample: counted, then broadcast
        # stored: its addresses are counted and joined
        emails = materialize(identity.latest_email(self.src.table("email_engagement"), staging.select("cim_id"), cap))
        return identity.latest_subscriber(self.src.table("subscribers"), emails, active_only, cap)

    @cached_property
    def images(self) -> DataFrame:
        return posts.post_image(self.posts, self.postmeta)

    def batch(self, staging: DataFrame, active_only: bool) -> DataFrame:
        """Images and titles are looked up for the recommended posts only (counted, see ``joins.keep_keys``)."""
        ids = materialize(staging.select("post_id").distinct())
        cap = self.p.max_broadcast_rows
        return feed.production_batch(staging, self.subscribers_for(staging, active_only),
                                     posts.post_image(self.posts, self.postmeta, ids, cap),
                                     posts.newest_title(self.post_versions, ids, cap), self.as_of, self.p.local_tz)

    @cached_property
    def production(self) -> DataFrame:
        return materialize(self.batch(self.recs, True))

    @cached_property
    def current_feed(self) -> DataFrame:
        return materialize(feed.current_feed(self.production, FEED_LABEL_IN_HOUSE))

    @cached_property
    def outbound(self) -> DataFrame:
        return feed.outbound_feed(self.current_feed, self.alias, OUTBOUND_POST_TYPE_IN_HOUSE, self.p.cdn_marker,
                                  self.p.cdn_prefix, self.p.max_broadcast_rows)

    # --- hosted-style recommender -----------------------------------------------------------------
    @cached_property
    def event_export(self) -> DataFrame:
        return implicit.event_export(self.interactions, self.meta, GROUP_HOSTED)

    @cached_property
    def item_export(self) -> DataFrame:
        return implicit.item_export(self.meta, self.interactions, GROUP_HOSTED)

    @cached_property
    def hosted_recs(self) -> DataFrame:
        return materialize(implicit.implicit_recs(self.event_export, self.meta, self.p.implicit_weights,
                                                  self.p.hosted_recs, seed=self.p.split_seed, items=self.item_export))

    def implicit_recs(self) -> DataFrame:
        return self.hosted_recs

    @cached_property
    def hosted_production(self) -> DataFrame:
        """P22 for the hosted group: any subscriber status counts when finding the newest."""
        return materialize(self.batch(self.hosted_recs, False))

    @cached_property
    def hosted_current_feed(self) -> DataFrame:
        return materialize(feed.current_feed(self.hosted_production, FEED_LABEL_HOSTED))

    @cached_property
    def hosted_outbound(self) -> DataFrame:
        return feed.outbound_feed(self.hosted_current_feed, self.alias, OUTBOUND_POST_TYPE_HOSTED, self.p.cdn_marker,
                                  self.p.cdn_prefix, self.p.max_broadcast_rows)

    def hosted_report(self) -> DataFrame:
        return implicit.explain_hosted(self.hosted_recs, self.event_export, self.meta_text)

    def implicit_metrics(self) -> DataFrame:
        return implicit.implicit_metrics(self.event_export, self.meta, self.p.implicit_weights, self.as_of,
                                         k=self.p.hosted_recs, seed=self.p.split_seed)


def store_partials(sources: Sources, path: str, lookback_days: int, late_days: int = 1, again: tuple = ()) -> dict[str, DataFrame]:
    """Day partials of views, clicks and orders, kept from run to run (one published part a day); returned by kind.

    A run reads the raw events of days that are not stored yet, of the run day and the ``late_days`` before it, whose
    events may still come in, and of the days in ``again`` (older days of which late events are known); their
    partials are replaced.  All other days of the window come from the stored partials.
    """
    spark, end = sources.spark, sources.as_of.date()
    start = lookback_start(sources.as_of, lookback_days).date()
    out = {}
    for kind in interactions.MEASURES:
        base = f"{path.rstrip('/')}/{kind}"
        known = {d for d in versions.current(spark, base) or {} if d >= str(start)}
        days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
        need = [d for d in days if str(d) not in known or (end - d).days <= late_days or d in again]
        for first, last in _ranges(need):  # neighbouring days are read in one scan
            part = interactions.day_partials(kind, sources.parts(kind), first, None if last == end else last + timedelta(days=1))
            names = [str(first + timedelta(days=i)) for i in range((last - first).days + 1)]
            # the run day's part also takes what is dated later
            versions.publish_parts(part, base, F.least(F.col("day"), F.lit(end)).cast("string"), names)
        stored = versions.read_published(spark, base)
        out[kind] = stored if stored is not None else interactions.day_partials(kind, sources.parts(kind), end).limit(0)
    return out


def _ranges(days: list) -> list[tuple]:
    """First and last of each run of neighbouring days."""
    out: list[list] = []
    for d in days:
        if out and (d - out[-1][1]).days == 1:
            out[-1][1] = d
        else:
            out.append([d, d])
    return [tuple(r) for r in out]


def run_initial_setup(spark: SparkSession, sf_dir: str, out_dir: str, params: RunParams = DEFAULT,
                      sources: Sources | None = None) -> dict[str, str]:
    """The one-off set-up: sampled groups with their rated pairs, the day-one seed history
    (a dummy row per user) and the empty, typed production tables."""
    from ..schemas import HOSTED_PRODUCTION, PRODUCTION
    from ..sources import io

    run = DailyRun(spark, sf_dir, params, sources=sources)
    paths = {k: f"{out_dir.rstrip('/')}/{k}" for k in
             ("groups_interactions_setup", "post_prev_rec", "daily_rec_production", "hosted_rec_production")}
    versions.publish(run.setup, paths["groups_interactions_setup"])
    day_one = run.as_of - timedelta(days=366)  # sorts before every run date
    io.append_seed_log(run.seed_init, paths["post_prev_rec"], day_one)
    io.append_batch(io.empty_table(spark, PRODUCTION), paths["daily_rec_production"], day_one)
    io.append_batch(io.empty_table(spark, HOSTED_PRODUCTION), paths["hosted_rec_production"], day_one)
    return paths


def run_daily(spark: SparkSession, sf_dir: str, out_dir: str, params: RunParams = DEFAULT, sources: Sources | None = None,
              again: tuple = ()) -> dict[str, str]:
    """Materialise the day's tables under ``out_dir`` (a shared folder) and return their paths.

    The hand-offs follow the original jobs: recommendations leave as a staging
    CSV and come back through its declared schema; the production batch is
    published in a history by send date (a re-run replaces that
    day); the current feed is the newest import of that history; the seed
    history is published the same way.  Readers of published tables (``versions.read_published``) see them whole.
    Events are read by day: only days without stored partials, late days and ``again`` are read from the raw tables.
    """
    from ..params import HOSTED_STAGING_COLUMNS, STAGING_COLUMNS
    from ..schemas import EVENT_EXPORT, HOSTED_STAGING, ITEM_EXPORT, STAGING
    from ..sources import io

    steps_before = step_tables()
    base_dir = out_dir.rstrip("/")
    sources = sources or fixture_sources(spark, sf_dir)
    as_of = sources.as_of
    # strictly before the run date, so re-running a day never counts its own seeds
    history = versions.read_published(spark, f"{base_dir}/post_prev_rec", before=str(as_of)[:10])
    setup = versions.read_published(spark, f"{base_dir}/groups_interactions_setup")  # none: derived in this run
    partials = store_partials(sources, f"{base_dir}/event_days", params.lookback_days, params.late_days, again)
    run = DailyRun(spark, sf_dir, params, setup=setup, seed_history=history, sources=sources, partials=partials)
    names = ("interactions_daily", "rec_post_meta", "daily_rec_staging_csv", "post_prev_rec", "daily_rec_production",
             "final_feed", "outbound_feed_csv", "interactions_export_csv", "item_export_csv",
             "hosted_rec_staging_csv", "hosted_rec_production", "hosted_final_feed", "hosted_outbound_feed_csv")
    paths = {k: f"{out_dir.rstrip('/')}/{k}" for k in names}
    versions.publish(run.interactions, paths["interactions_daily"])
    run.__dict__["interactions"] = versions.read_published(spark, paths["interactions_daily"])
    versions.publish(run.meta, paths["rec_post_meta"])
    run.__dict__["meta"] = versions.read_published(spark, paths["rec_post_meta"])

    # In-house path: staging CSV -> production history -> current feed -> outbound CSV.
    io.write_csv(run.factor_recs.select(*STAGING_COLUMNS), paths["daily_rec_staging_csv"], order_by=["cim_id", "post_order"])
    staging = io.read_csv(spark, paths["daily_rec_staging_csv"], STAGING)
    io.append_seed_log(hybrid.seed_log_rows(run.seeds), paths["post_prev_rec"], run.as_of)
    io.append_batch(run.batch(staging, True), paths["daily_rec_production"], run.as_of)
    current = feed.current_feed(versions.read_published(spark, paths["daily_rec_production"]), FEED_LABEL_IN_HOUSE)
    versions.publish(current, paths["final_feed"])
    out = feed.outbound_feed(versions.read_published(spark, paths["final_feed"]), run.alias, OUTBOUND_POST_TYPE_IN_HOUSE,
                             params.cdn_marker, params.cdn_prefix, params.max_broadcast_rows)
    io.write_csv(out.drop("last_used_datetime"), paths["outbound_feed_csv"], order_by=["email", "subscriber_id", "position"])

    # Hosted-style path: exports (P18), recommendations (P19), the same delivery.
    events = run.event_export.select(*(F.col(f.name).cast(f.dataType) for f in EVENT_EXPORT))
    items = run.item_export.select(*(F.col(f.name).cast(f.dataType) for f in ITEM_EXPORT))
    io.write_csv(events, paths["interactions_export_csv"], order_by=["user_id", "item_id"],
                 single_file=False)  # (user, item) is unique: no further tie-break needed
    io.write_csv(items, paths["item_export_csv"], order_by=["item_id"], single_file=False)
    io.write_csv(run.hosted_recs.select(*HOSTED_STAGING_COLUMNS), paths["hosted_rec_staging_csv"],
                 order_by=["cim_id", "post_order"])
    hstaging = io.read_csv(spark, paths["hosted_rec_staging_csv"], HOSTED_STAGING)
    io.append_batch(run.batch(hstaging, False), paths["hosted_rec_production"], run.as_of)
    hcurrent = feed.current_feed(versions.read_published(spark, paths["hosted_rec_production"]), FEED_LABEL_HOSTED)
    versions.publish(hcurrent, paths["hosted_final_feed"])
    hout = feed.outbound_feed(versions.read_published(spark, paths["hosted_final_feed"]), run.alias, OUTBOUND_POST_TYPE_HOSTED,
                              params.cdn_marker, params.cdn_prefix, params.max_broadcast_rows)
    io.write_csv(hout.drop("last_used_datetime"), paths["hosted_outbound_feed_csv"],
                 order_by=["email", "subscriber_id", "position"])
    drop_step_tables(spark, steps_before)
    return paths

"""Invariants of the recommendation outputs."""

from pyspark.sql import functions as F


def test_recs_shape(run):
    recs = run.recs
    per_user = recs.groupBy("cim_id").agg(F.count("*").alias("n"), F.max("post_order").alias("mx"),
                                          F.min("post_order").alias("mn"))
    assert per_user.filter((F.col("n") > 20) | (F.col("mx") != F.col("n")) | (F.col("mn") != 1)).count() == 0
    assert recs.filter((F.col("pred_rating") < 1) | (F.col("pred_rating") > 4)).count() == 0
    assert recs.filter((F.col("sim_score") < 0) | (F.col("sim_score") > 1.000001)).count() == 0
    assert recs.groupBy("cim_id", "post_id").count().filter("count > 1").count() == 0


def test_no_expired_converted_or_seed(run):
    recs = run.recs
    expired = run.meta.filter(~(F.col("is_expired") == 0).eqNullSafe(True)).select("post_id")
    assert recs.join(expired, "post_id", "left_semi").count() == 0
    conv = run.house.filter(F.col("post_rating") == 4).select("cim_id", "post_id")
    assert recs.join(conv, ["cim_id", "post_id"], "left_semi").count() == 0
    seeds = run.seeds.select("cim_id", F.col("seed_post_id").alias("post_id"))
    assert recs.join(seeds, ["cim_id", "post_id"], "left_semi").count() == 0


def test_seed_log_one_row_per_user(run):
    from tallyrec.operators.hybrid import seed_log_rows

    log = seed_log_rows(run.seeds)
    assert log.count() == log.select("cim_id").distinct().count()
    assert log.count() == run.house.select("cim_id").distinct().count()


def test_meta_one_row_per_post(run):
    assert run.meta.count() == run.meta.select("post_id").distinct().count()


def test_tier_rule(run):
    bad = run.recs.filter(((F.col("sim_score") > 0.5) & (F.col("more_explore") != 2))
                          | ((F.col("sim_score") <= 0.5) & (F.col("more_explore") != 1)))
    assert bad.count() == 0


def test_daily_cohort_equals_setup_groups(run):
    a = run.setup.select("cim_id", "rec_group").distinct()
    b = run.cohort
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

"""Feedback loop (T5): a seed used today counts as used tomorrow, so the seed rotates."""

from pyspark.sql import functions as F

from tallyrec.operators.hybrid import seed_log_rows, user_seeds
from tallyrec.operators.interactions import rated_interactions


def test_seed_rotates_on_day_two(run):
    v, c, o = run.activity
    groups = run.cohort
    day1 = rated_interactions(v, c, o, groups, run.seed_log)
    seeds1 = user_seeds(day1.filter(F.col("rec_group") == "in_house_test"))
    log2 = run.seed_log.unionByName(seed_log_rows(seeds1))
    day2 = rated_interactions(v, c, o, groups, log2)
    seeds2 = user_seeds(day2.filter(F.col("rec_group") == "in_house_test"))
    multi = (day1.filter(F.col("rec_group") == "in_house_test").groupBy("cim_id").count()
             .filter("count >= 2").select("cim_id"))
    both = seeds1.alias("a").join(seeds2.alias("b"), "cim_id").join(multi, "cim_id", "left_semi")
    assert both.count() > 0
    assert both.filter(F.col("a.seed_post_id") == F.col("b.seed_post_id")).count() == 0

"""Set-up once, then the daily run: tables land in a shared folder, and re-running a day
replaces its own rows (seed history, production history) instead of doubling them."""

import os
from dataclasses import replace

from tallyrec.params import DEFAULT
from tallyrec.plans.daily import run_daily, run_initial_setup
from tallyrec.session import scratch_path
from tallyrec.sources.versions import read_published

from conftest import SMALL


def test_setup_then_daily_is_idempotent(spark):
    out = scratch_path(spark, "daily")
    params = replace(DEFAULT, grid_iterations=(5, 10))  # the whole grid runs in test_models_brute_force

    def recommended(path):
        return sorted(map(tuple, spark.read.csv(path, header=True).select("cim_id", "post_id").collect()))

    run_initial_setup(spark, SMALL, out, params)
    paths = run_daily(spark, SMALL, out, params)
    recs1 = recommended(paths["daily_rec_staging_csv"])
    hist1 = read_published(spark, paths["post_prev_rec"])
    days = hist1.select("send_date").distinct().count()
    n1 = hist1.count()
    run_daily(spark, SMALL, out, params)
    recs2 = recommended(paths["daily_rec_staging_csv"])
    hist2 = read_published(spark, paths["post_prev_rec"])
    assert days == 2 and hist2.count() == n1 > 0       # day one + the run date, not doubled
    assert recs1 == recs2 and len(recs1) > 0           # the re-run sees the same history
    prod = read_published(spark, paths["daily_rec_production"])
    assert prod.select("send_date").distinct().count() == 1
    csv_files = [f for f in os.listdir(paths["outbound_feed_csv"].replace("file:", "")) if f.endswith(".csv")]
    assert len(csv_files) == 1
    assert read_published(spark, paths["final_feed"]).count() > 0
    assert read_published(spark, paths["hosted_final_feed"]).count() > 0

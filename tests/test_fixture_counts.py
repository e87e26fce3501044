"""The derived views reproduce the counts published in FIXTURES.md section 4 (independent DuckDB runs)."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallyrec.params import DEFAULT
from tallyrec.plans.daily import DailyRun

EXPECTED = {
    "0.001": dict(ratings={1: 71, 2: 6, 3: 3, 4: 12}, groups=(5, 2, 1), expired={0: 97, 1: 48, None: 36},
                  employees=6, eligible=8),
    "0.01": dict(ratings={1: 554, 2: 45, 3: 71, 4: 106}, groups=(21, 22, 22), expired={0: 500, 1: 231, None: 178},
                 employees=52, eligible=65),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_fixture_counts(spark, sf):
    exp = EXPECTED[sf]
    r = DailyRun(spark, f"/root/testdata/sf{sf}")
    ratings = {x.post_rating: x["count"] for x in r.interactions.groupBy("post_rating").count().collect()}
    assert ratings == exp["ratings"]
    g = {x.rec_group: x["count"] for x in r.groups.groupBy("rec_group").count().collect()}
    assert (g.get("in_house_test"), g.get("amz_personalize_test"), g.get("control")) == exp["groups"]
    p = r.posts.filter(F.col("post_type") == "post").select(F.col("id").cast("string").alias("post_id"))
    e = {x.is_expired: x["count"] for x in p.join(r.expiry, "post_id", "left").groupBy("is_expired").count().collect()}
    assert e == exp["expired"]
    assert r.identity_all.filter("alias_type = 'email_address' AND is_employee = 1").count() == exp["employees"]
    assert r.eligible.count() == exp["eligible"]


def test_the_set_up_knows_eligible_users_only(spark):
    r = DailyRun(spark, "/root/testdata/sf0.01")
    eligible = {x.cim_id for x in r.eligible.select("cim_id").collect()}
    for frame in (r.groups, r.seed_init, r.setup, r.interactions):
        assert {x.cim_id for x in frame.select("cim_id").distinct().collect()} <= eligible


def test_a_sample_below_the_user_count_binds_and_repeats(spark):
    params = replace(DEFAULT, sample_users=3)
    picks = [{(x.cim_id, x.rec_group) for x in DailyRun(spark, "/root/testdata/sf0.001", params).groups.collect()}
             for _ in range(2)]
    assert len(picks[0]) == 3 and picks[0] == picks[1]

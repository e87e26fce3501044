"""The ALS-based queries have no SQL oracle; check them against brute force on the small fixture."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tallyrec.operators import implicit, rating
from tallyrec.params import GRID_ITERATIONS, GRID_PENALTIES


def _factors(df, key):
    return {r[key]: np.array(r["features"], dtype=np.float64) for r in df.collect()}


def test_implicit_recs_equal_brute_force_top_k(run):
    model, uids, iids = implicit.fit_implicit(run.event_export, run.p.implicit_weights, seed=14)
    got = implicit.recommend_unexpired(model, uids, iids, run.meta, k=5)
    u = _factors(model.userFactors.withColumnRenamed("id", "uid"), "uid")
    v = _factors(model.itemFactors.withColumnRenamed("id", "iid"), "iid")
    uid = {r.uid: r.cim_id for r in uids.collect()}
    iid = {r.iid: r.post_id for r in iids.collect()}
    expired = {r.post_id for r in run.meta.filter(F.col("is_expired").eqNullSafe(1)).collect()}
    want = {}
    for ui, uvec in u.items():
        scored = [(float(uvec @ vvec), iid[ii]) for ii, vvec in v.items() if iid[ii] not in expired]
        want[uid[ui]] = dict((p, x) for x, p in scored)
    have = {}
    for r in got.orderBy("cim_id", "post_order").collect():
        have.setdefault(r.cim_id, []).append(r.post_id)
    assert have.keys() == want.keys()
    for c, posts in have.items():
        # Items with the same events have the same vector, so which of them stand at the cut is open: the
        # scores must be the best ones (float32 factors: to 1e-5), of different unexpired items.
        assert len(set(posts)) == len(posts) and set(posts) <= set(want[c])
        best = sorted(want[c].values(), reverse=True)[:5]
        assert np.allclose(sorted((want[c][p] for p in posts), reverse=True), best, atol=1e-5)


def test_factor_prediction_equals_brute_force(run):
    ratings = run.rated_all
    m = rating.fit_factors(ratings, seed=14, max_iter=5)
    pairs = run.similar.select("cim_id", "post_id").limit(200)
    got = {(r.cim_id, r.post_id): r.pred_rating for r in rating.predict_factors(pairs, m).collect()}
    base = {(r.cim_id, r.post_id): r.base for r in rating.baseline(pairs, m.bias).collect()}
    u = {r.cim_id: np.array(r.uf, dtype=np.float64) for r in m.users.collect()}
    v = {r.post_id: np.array(r.vf, dtype=np.float64) for r in m.items.collect()}
    for (c, p), pred in got.items():
        resid = float(u[c] @ v[p]) if c in u and p in v else 0.0
        want = round(min(4.0, max(1.0, base[(c, p)] + resid)), 6)
        assert abs(pred - want) <= 2e-6, (c, p, pred, want)


def test_cold_validation_pairs_count_with_the_baseline(spark):
    rows = [(f"u{i}", f"p{i}", 1 + i % 4) for i in range(24)]  # every user and post is seen once
    ratings = spark.createDataFrame(rows, "cim_id string, post_id string, post_rating int")
    got = rating.als_grid_search(ratings, max_iters=(2,), regs=(0.01,), folds=3, seed=14).first()
    fold = {r: int(hashlib.md5(f"fold14|{r[0]}|{r[1]}".encode()).hexdigest()[:8], 16) % 3 for r in rows}
    errors = []
    for f in range(3):
        mu = np.mean([r[2] for r in rows if fold[r] != f])
        errors.append(np.sqrt(np.mean([(r[2] - mu) ** 2 for r in rows if fold[r] == f])))
    assert abs(got.rmse - np.mean(errors)) < 1e-6 and got.best


def test_the_whole_grid_is_searched(run):
    rows = run.searched.collect()
    assert {(r.max_iter, r.reg_param) for r in rows} == {(i, g) for i in GRID_ITERATIONS for g in GRID_PENALTIES}
    assert sum(r.best for r in rows) == 1
    assert all(np.isfinite(r.rmse) for r in rows)

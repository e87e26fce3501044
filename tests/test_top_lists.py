"""Pruned top lists (seed similarity, factor products, untouched items) against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrec.operators import hybrid, implicit, similarity, topk


def _weights(run):
    w = {}
    for r in run.weights.select("post_id", "term", "weight", "is_expired").collect():
        w.setdefault(r.post_id, ({}, r.is_expired))[0][r.term] = r.weight
    return w


def _same(got, want):
    assert [p for _, p in got] == [p for _, p in want]
    assert [x for x, _ in got] == pytest.approx([x for x, _ in want], abs=1e-9)


@pytest.mark.parametrize("depth,batch", [(3, 7), (50, 2048)])
def test_seed_top_equals_all_pairs(run, monkeypatch, depth, batch):
    monkeypatch.setattr(similarity, "BATCH", batch)
    w = _weights(run)
    got = similarity.seed_top(run.weights.repartition(4), run.seeds, depth, F.col("is_expired") == 0)
    parts = got.rdd.getNumPartitions()
    lists = {}
    rows = got.collect()
    for r in rows:
        lists.setdefault(r.seed_post_id, []).append((-r.sim_score, r.post_id))
    seeds = {r.seed_post_id for r in run.seeds.collect()} & set(w)
    assert len(rows) <= len(seeds) * depth * parts
    for s in seeds:
        want = []
        for post, (v, expired) in w.items():
            x = math.floor(sum(a * v[t] for t, a in w[s][0].items() if t in v) * 1e6 + 0.5) / 1e6
            if post != s and expired == 0 and any(t in v for t in w[s][0]):
                want.append((-x, post))
        _same(sorted(lists.get(s, []))[:depth], sorted(want)[:depth])


def test_pruning_skips_pairs():
    rng = np.random.default_rng(3)
    terms = [rng.choice(60, 12, replace=False).tolist() for _ in range(500)]
    unit = lambda x: (x / np.linalg.norm(x)).tolist()
    weights = [unit(rng.random(12) ** 4) for _ in terms]
    lists = similarity._Lists([f"s{i}" for i in range(20)], terms[:20], weights[:20], np.ones(60), 5)
    for i, (t, w) in enumerate(zip(terms, weights, strict=True)):
        lists.add(f"p{i}", np.array(t), np.array(w))
        if i % 50 == 49:
            for j in range(20):
                lists.cut(j)
            lists.renew()
    assert 0 < lists.scored < 0.8 * 20 * 500  # most pairs share a term, many are never multiplied
    dense = np.zeros((500, 60))
    for i, (t, w) in enumerate(zip(terms, weights, strict=True)):
        dense[i, t] = w
    for j in range(20):
        lists.cut(j)
        want = sorted((-math.floor(x * 1e6 + 0.5) / 1e6, f"p{i}") for i, x in enumerate(dense @ dense[j]))[:5]
        _same(lists.lists[j], want)


def test_pruned_lists_and_all_pairs_give_the_same_recommendations(run):
    pairs = run.similarity(run.weights)
    want = hybrid.similar_posts(run.seeds, run.house, pairs, run.meta, 10)
    top = similarity.seed_top(run.weights, run.seeds, hybrid.list_depth(run.seeds, run.house, 10), F.col("is_expired") == 0)
    got = hybrid.similar_posts(run.seeds, run.house, top, run.meta, 10, True, unexpired=True)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def _vectors(spark, name, matrix):
    return spark.createDataFrame([(f"{name}{i:04d}", row.tolist()) for i, row in enumerate(matrix)], f"{name} string, vector array<double>")


@pytest.mark.parametrize("items,users,k", [(16, 8, 5), (64, 1000, 20), (4096, 8192, 3)])
def test_top_products_by_brute_force(spark, monkeypatch, items, users, k):
    monkeypatch.setattr(topk, "ITEMS", items)
    monkeypatch.setattr(topk, "USERS", users)
    rng = np.random.default_rng(items)
    v = rng.standard_normal((300, 6)) * rng.pareto(1.2, (300, 1))
    v[200:260] = v[100]  # ties
    u = rng.standard_normal((40, 6))
    u[7] = 0
    got = topk.top_products(_vectors(spark, "user", u), _vectors(spark, "item", v), k)
    have = {}
    for r in got.orderBy("user", "place").collect():
        have.setdefault(r.user, []).append((r.item, r.score))
    score = np.floor(u @ v.T * 1e6 + 0.5) / 1e6
    for i in range(len(u)):
        want = sorted(range(len(v)), key=lambda j: (-score[i, j], j))[:k]
        assert [x for x, _ in have[f"user{i:04d}"]] == [f"item{j:04d}" for j in want]
    assert topk.top_products(_vectors(spark, "user", u), _vectors(spark, "item", v[:0]), k).count() == 0


def test_blocks_of_small_norm_are_not_multiplied(spark, monkeypatch):
    monkeypatch.setattr(topk, "ITEMS", 16)
    asked = []
    products = topk._products
    monkeypatch.setattr(topk, "_products", lambda u, i, k: asked.append(u.count()) or products(u, i, k))
    rng = np.random.default_rng(1)
    v = np.abs(rng.standard_normal((320, 4))) * np.repeat([100.0, 1.0], [32, 288])[:, None]
    u = np.abs(rng.standard_normal((30, 4)))
    topk.top_products(_vectors(spark, "user", u), _vectors(spark, "item", v), 5).collect()
    assert asked[0] == 30 and asked[1] <= 60  # of 19 further blocks a user meets at most two


def test_half_the_items_expired(run):
    model, uids, iids = implicit.fit_implicit(run.event_export, run.p.implicit_weights, seed=14)
    meta = run.meta.withColumn("is_expired", F.pmod(F.xxhash64("post_id"), F.lit(2)).cast("int"))
    got = implicit.recommend_unexpired(model, uids, iids, meta, k=20)
    u = {r.cim_id: np.array(r.features, float) for r in model.userFactors.join(uids, F.col("id") == F.col("uid")).collect()}
    live = {r.post_id for r in meta.where("is_expired = 0").collect()}
    v = {r.post_id: np.array(r.features, float) for r in model.itemFactors.join(iids, F.col("id") == F.col("iid")).collect()}
    dead = {r.post_id for r in meta.where("is_expired = 1").collect()}
    assert dead & set(v) and live & set(v)
    have = {}
    for r in got.orderBy("cim_id", "post_order").collect():
        have.setdefault(r.cim_id, []).append(r.post_id)
    for c, vec in u.items():
        score = {p: math.floor(float(vec @ x) * 1e6 + 0.5) / 1e6 for p, x in v.items() if p not in dead}
        assert have[c] == sorted(score, key=lambda p: (-score[p], p))[:20]


def test_untouched_items_by_numpy(spark):
    rng = np.random.default_rng(5)
    slugs = ["toys", "books", "food", "shop|a", "rare"]
    lists = [sorted(set(rng.choice(slugs[:4], rng.integers(0, 4)).tolist())) for _ in range(40)]
    vectors = rng.standard_normal((40, 3))
    factors = spark.createDataFrame([(f"p{i}", vectors[i].tolist()) for i in range(30)], "post_id string, vector array<double>")
    items = spark.createDataFrame([(f"p{i}", 0, "|".join(s) or None) for i, s in enumerate(lists)], "item_id string, is_expired int, slug_lst string")
    flat = [sorted({x for s in one for x in s.split("|")}) for one in lists]
    names = sorted({x for one in flat[:30] for x in one})
    x = np.array([[1.0] + [float(n in one) for n in names] for one in flat])
    penalty = np.diag([0.0] + [1.0] * len(names))
    weight = np.linalg.solve(x[:30].T @ x[:30] + penalty, x[:30].T @ vectors[:30])
    got = {r.post_id: r.vector for r in implicit.slug_vectors(factors, items).collect()}
    assert got.keys() == {f"p{i}" for i in range(30, 40)}
    for i in range(30, 40):
        assert np.allclose(got[f"p{i}"], x[i] @ weight)


def test_an_untouched_item_reaches_a_list(run):
    touched = {r.item_id for r in run.event_export.select("item_id").distinct().collect()}
    live = {r.item_id for r in run.item_export.where("is_expired = 0").collect()}
    got = {r.post_id for r in implicit.implicit_recs(run.event_export, run.meta, run.p.implicit_weights, 20, seed=14,
                                                     items=run.item_export).collect()}
    assert live - touched and (live - touched) & got

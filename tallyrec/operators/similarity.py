"""ML7: similarity of seed posts to candidate posts over shared terms.

Only seeds sit on the left, so the work is (seeds x posts sharing a term),
never all pairs of posts.  The seed side is at most
``distinct seeds x vocabulary`` rows; with a proven bound below
``max_broadcast_rows`` it is broadcast (and so is the seed-id list used to
pick those rows), so the big weights table is read once and never shuffled
before the pair sums.  Without such a bound both joins fall back to shuffles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLACK = 1e-6   # scores are ranked after rounding: a bound must miss by more than that
BATCH = 2048   # candidates between two renewals of the prefixes


def seed_similarity(weights: DataFrame, seeds: DataFrame, candidate_filter: Column | None = None,
                    seed_bound_rows: int | None = None, max_broadcast_rows: int = 5_000_000,
                    digits: int = 6, keep: tuple[str, ...] = ()) -> DataFrame:
    """(seed_post_id, post_id, sim_score, *keep) for every other post sharing at least one term.

    ``weights``: (post_id, term, weight, ...) with unit rows, so the dot product is the cosine.
    ``seeds``: frame with ``seed_post_id``.  ``candidate_filter``: a predicate on ``weights``
    rows that restricts the candidate side (e.g. ``is_expired = 0``).  ``keep``: candidate
    columns carried to the output (constant per post).
    """
    sid = seeds.select("seed_post_id").distinct()
    bounded = seed_bound_rows is not None and seed_bound_rows <= max_broadcast_rows
    if bounded:
        sid = F.broadcast(sid)
    left = weights.join(sid, weights.post_id == sid.seed_post_id, "left_semi").select(
        F.col("post_id").alias("seed_post_id"), "term", F.col("weight").alias("ws"))
    right = weights if candidate_filter is None else weights.filter(candidate_filter)
    right = right.select("post_id", "term", F.col("weight").alias("wo"), *keep)
    if bounded:
        left = F.broadcast(left)
    pairs = right.join(left, "term").filter(F.col("post_id") != F.col("seed_post_id"))
    aggs = [F.round(F.sum(F.col("ws") * F.col("wo")), digits).alias("sim_score")]
    aggs += [F.first(c).alias(c) for c in keep]
    return pairs.groupBy("seed_post_id", "post_id").agg(*aggs)


class _Lists:
    """The best ``depth`` candidates of every seed among those that one task has seen.

    A seed's terms stand in the order of their bounds (its weight times the largest weight of any candidate).  Once a
    seed's list is full, a candidate must beat its last score: the terms with the smallest bounds whose sum stays below that
    score cannot do so alone, so only the others, the prefix, lead from a candidate to the seed.
    """

    def __init__(self, ids: list[str], terms: list[list[int]], weights: list[list[float]], most: np.ndarray, depth: int):
        self.ids, self.depth, self.scored = ids, depth, 0
        self.w = np.zeros((len(ids), len(most)))
        for i, (t, w) in enumerate(zip(terms, weights, strict=True)):
            self.w[i, t] = w
        bound = self.w * most
        self.order = np.argsort(bound, axis=1)
        self.total = np.cumsum(np.take_along_axis(bound, self.order, axis=1), axis=1)
        self.number = {s: i for i, s in enumerate(ids)}
        self.least = np.zeros(len(ids))
        self.lists: list[list[tuple[float, str]]] = [[] for _ in ids]
        self.renew()

    def renew(self) -> None:
        seed, at = np.nonzero(self.total >= np.maximum(self.least - SLACK, 0)[:, None])
        term = self.order[seed, at]
        used = self.w[seed, term] > 0
        seed, term = seed[used], term[used]
        by = np.argsort(term, kind="stable")
        self.seeds, self.begin = seed[by], np.searchsorted(term[by], np.arange(self.w.shape[1] + 1))

    def add(self, post: str, terms: np.ndarray, weights: np.ndarray) -> None:
        met = [self.seeds[self.begin[t]:self.begin[t + 1]] for t in terms]
        met = np.unique(np.concatenate(met)) if met else np.zeros(0, int)
        if not len(met):
            return
        self.scored += len(met)
        score = np.floor(self.w[met[:, None], terms] @ weights * 1e6 + 0.5) / 1e6
        good = score >= self.least[met]
        for i, x in zip(met[good].tolist(), score[good].tolist(), strict=True):
            if self.ids[i] != post:
                self.lists[i].append((-x, post))
                if len(self.lists[i]) >= 2 * self.depth + 16:
                    self.cut(i)

    def cut(self, i: int) -> None:
        self.lists[i].sort()
        del self.lists[i][self.depth:]
        if len(self.lists[i]) == self.depth:
            self.least[i] = -self.lists[i][-1][0]


def seed_top(weights: DataFrame, seeds: DataFrame, depth: int, candidate_filter: Column | None = None) -> DataFrame:
    """(seed_post_id, post_id, sim_score): each task's ``depth`` best candidates of each seed, by score, then post id.

    Exact: the first ``depth`` of a seed over all rows are among them.  At most seeds x depth rows leave a task, however many
    pairs share a term; pairs that cannot enter a list are not multiplied.  The caller bounds the number of seeds (their
    vectors go to every task) and makes the final cut.
    """
    def vectors(df: DataFrame) -> DataFrame:
        return df.groupBy("post_id").agg(F.collect_list(F.struct("term", "weight")).alias("v")).select(
            "post_id", F.col("v.term").alias("terms"), F.col("v.weight").alias("weights"))

    candidates = weights if candidate_filter is None else weights.filter(candidate_filter)
    own = weights.join(seeds.select(F.col("seed_post_id").alias("post_id")).distinct(), "post_id", "left_semi")
    seed_rows = sorted(vectors(own).collect())  # bounded by the caller
    most = dict(map(tuple, candidates.groupBy("term").agg(F.max("weight")).collect()))  # at most the vocabulary
    names = {t: i for i, t in enumerate(sorted(set(most).union(*(r["terms"] for r in seed_rows))))}
    shared = weights.sparkSession.sparkContext.broadcast((
        [r["post_id"] for r in seed_rows], [[names[t] for t in r["terms"]] for r in seed_rows], [r["weights"] for r in seed_rows],
        np.array([most.get(t, 0.0) for t in names]), names))

    def run(batches):
        *index, names = shared.value
        lists, seen = _Lists(*index, depth), 0
        for batch in batches:
            for post, terms, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lists.add(post, np.array([names[t] for t in terms], int), np.array(w))
                seen += 1
                if seen % BATCH == 0:
                    lists.renew()
        rows = []
        for i, seed in enumerate(lists.ids):
            lists.cut(i)
            rows += [(seed, post, -x) for x, post in lists.lists[i]]
        if rows:
            cols = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["seed_post_id", "post_id", "sim_score"])

    return vectors(candidates).mapInArrow(run, "seed_post_id string, post_id string, sim_score double")

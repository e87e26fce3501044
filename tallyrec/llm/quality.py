"""Quality classifier with supervised subword embeddings (operator 7).

A document is the average of learned vectors of its words, of pairs of neighbouring words and of the
character n-grams of its words (hashed to ``2**bits`` rows); a softmax layer turns that into two class probabilities.
Vectors and layer are trained by stochastic gradient descent in numpy, a document a
step.  As everything behind the average is linear, scoring needs one number a row:
its vector times the difference of the two output columns.

Texts count whole.  A null or empty text, or one of blanks alone, has no features and gets the score of
the bias.  Rows with null labels are not learned from; with no labelled row of either class the
score is 0.5 for all.  Repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm import flat
from tallyrec.llm.common import LONGEST, doc_hash, filter_texts, lowest, map_slices

SIZES = (3, 4, 5)


def rows_of(texts: list[str | None], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed rows of the texts' features: for words and each n-gram length, the rows and each text's first one."""
    codes, begin = flat.code_points(texts)
    codes = np.where((codes < 32) | (codes == 0x85) | (codes == 0xA0), np.uint32(32), codes)
    codes, begin = flat.squeeze(codes, begin)
    shift = np.uint64(64 - bits)
    h, start = flat.words(codes, begin)
    out = [((h >> shift).astype(np.int64), start)]
    # pairs of neighbouring words; a word said twice is one feature, whatever the word
    pair = flat.mix(h[:-1] * flat.M + h[1:])
    pair[h[:-1] == h[1:]] = np.uint64(0)
    good = np.ones(len(pair), bool)
    good[start[1:-1][(start[1:-1] > 0) & (start[1:-1] <= len(pair))] - 1] = False  # not across two texts
    kept = np.concatenate([[0], np.cumsum(good)])
    out.append(((pair[good] >> shift).astype(np.int64), kept[np.minimum(start, len(pair))]))
    blank = np.concatenate([[0], np.cumsum(codes == 32)])
    for n in SIZES:
        h = flat.grams(codes, n)
        at = np.arange(len(h))
        # inside a word, or with its first or last blank: no blank between the outer two
        good = blank[at + n - 1] == blank[at + 1]
        kept = np.concatenate([[0], np.cumsum(good)])
        out.append((((h[good] + np.uint64(n)) >> shift).astype(np.int64), kept[np.minimum(begin, len(h))]))
    return out


class Model:
    def __init__(self, bits: int, row: np.ndarray, bias: float):
        self.bits, self.row, self.bias = bits, row, bias

    def score(self, texts: list[str | None]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for rows, start in rows_of(texts, self.bits):
            total += flat.sums(self.row[rows], start)
            count += np.diff(start)
        return 1 / (1 + np.exp(-(total / np.maximum(count, 1) + self.bias)))


def train(texts: list[str], labels: list[int], bits: int = 18, dim: int = 16, epochs: int = 6, rate: float = 0.4,
          seed: int = 7) -> Model:
    """SGD over the documents in random order with a falling rate."""
    if len(set(labels)) < 2:
        return Model(bits, np.zeros(1 << bits, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    docs = []
    for t in texts:
        rows, times = np.unique(np.concatenate([r for r, _ in rows_of([t], bits)]), return_counts=True)
        docs.append((rows.astype(np.int32), (times / max(times.sum(), 1)).astype(np.float32)))
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            lr = rate * (1 - done / steps)
            done += 1
            rows, share = docs[i]
            mean = share @ vectors[rows]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1  # now the gradient of the cross-entropy
            back = layer @ p
            layer -= lr * np.outer(mean, p)
            bias -= lr * 0.1 * p
            # a row's part of the average is its share; rows learn as if each were alone, scaled like the average
            vectors[rows] -= (lr * len(rows) ** 0.5) * share[:, None] * back[None, :]
    diff = layer[:, 1] - layer[:, 0]
    return Model(bits, (vectors @ diff).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, sample: int = 3000) -> Model:
    """Train on the ``sample`` labelled documents with the smallest salted hash, outside the held-out fold.

    ``sample`` is the bound of what the driver gets, at every input size; a chosen text of over 100,000 characters is left out.
    """
    able = F.expr("doc_id is not null and quality in (0, 1)") & (doc_hash() % folds != held_out)
    rank = F.xxhash64("doc_id", F.lit("quality"))
    # ids are chosen before any text is read
    known = lowest(labels.select("doc_id", "quality"), rank, sample, able, "doc_id").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = known.withColumn("rank", rank).orderBy("rank", "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").where(F.length("text").between(1, LONGEST)).join(F.broadcast(chosen), "doc_id")
    got = rows.select("doc_id", "rank", "text", "quality").orderBy("rank", "doc_id", "text").limit(2 * sample).collect()
    return train([r["text"] for r in got], [int(r["quality"]) for r in got])


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bits, model.row, model.bias))

    def make():
        m = Model(*shared.value)

        def run(doc_ids, texts):
            s = m.score(texts)
            return [doc_ids, s, (s >= threshold).astype(np.int32)]

        return run

    return map_slices(docs.select("doc_id", "text"), make, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows that score at least ``threshold``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bits, model.row, model.bias))

    def make():
        m = Model(*shared.value)
        return lambda texts: m.score(texts) >= threshold

    return filter_texts(docs, make)

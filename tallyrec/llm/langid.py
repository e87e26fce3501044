"""Language identification by interpolated Kneser-Ney character models (operator 3).

One model per language over lower-cased letters, other characters counting as blanks.  All
languages share one sorted array of hashed n-grams per order, with a column of
log-probabilities per language, so a position of a text costs one binary search unless its
n-gram is new.  A document gets the language of the lowest cross-entropy per character; its score is
the calibrated probability of that language, and it is rejected if its cross-entropy is far
above what held-back training documents of that language have at its length.

A text that is null or has no letter gives ``und``, score 0, rejected.  Rows with null lang
are not learned from; with nothing to learn from every row is ``und``.  Ties go to the
language that comes first in order.  Repeated rows are judged each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyrec.llm import flat
from tallyrec.llm.common import LONGEST, below, doc_hash, filter_texts, map_slices

PIECE = 200  # characters of the pieces on which rejection is calibrated
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """Lower-case letter of each code point of the basic plane; others are blanks."""
    out = np.full(0x10000, 32, np.uint32)
    for i in range(0x10000):
        c = chr(i)
        if c.isalpha():
            out[i] = ord(c.lower()[0])
    return out


_table: list[np.ndarray] = []


def prepared(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, first index of each text and its count of letters."""
    if not _table:
        _table.append(_letters())
    codes, begin = flat.code_points(texts, order - 1, 1)
    far = codes >= 0x10000
    if far.any():
        kinds, which = np.unique(codes[far], return_inverse=True)
        codes = _table[0][np.where(far, 32, codes)]
        codes[far] = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 32 for c in kinds.tolist()], np.uint32)[which]
    else:
        codes = _table[0][codes]
    letters = flat.sums((codes != 32).astype(np.float32), begin)
    codes, begin = flat.squeeze(codes, begin, order - 1)
    return codes, begin, letters


def _rows(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key, -1 where it is absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


class Models:
    """Sorted hash arrays of all languages.

    keys[k], logp[k]: k-grams and the log-probability of their last character, by language.
    contexts[k], gamma[k]: the (k-1)-grams before it and the log weight of the shorter order.
    """

    def __init__(self, langs: list[str], order: int):
        self.langs, self.order = langs, order
        self.keys, self.logp, self.contexts, self.gamma = {}, {}, {}, {}
        self.unknown = np.zeros(len(langs), np.float32)
        self.sharpness, self.typical, self.spread = 1.0, np.zeros(len(langs)), np.ones(len(langs))

    def fit(self, texts: list[list[str]]) -> None:
        n, size = self.order, len(self.langs)
        data = []
        for one in texts:
            codes, begin, _ = prepared(one, n)
            inside = np.ones(max(len(codes) - n + 1, 0), bool)
            for i in range(1, n):  # no window across two texts
                inside[begin[1:-1] - i] = False
            data.append((codes, np.flatnonzero(inside)))
        types: list[tuple[np.ndarray, np.ndarray]] = []  # by language: first positions and counts of the n-grams
        for codes, at in data:
            _, first, times = np.unique(flat.grams(codes, n)[at], return_index=True, return_counts=True)
            types.append((at[first], times))
        by_order = {n: types}
        for k in range(n - 1, 0, -1):  # continuation counts: how many characters come before a k-gram
            lower = []
            for (codes, _), (first, _) in zip(data, by_order[k + 1], strict=True):
                _, i, times = np.unique(flat.grams(codes, k)[first + 1], return_index=True, return_counts=True)
                lower.append((first[i] + 1, times))
            by_order[k] = lower
        for k in range(1, n + 1):
            grams = [flat.grams(codes, k)[first] for (codes, _), (first, _) in zip(data, by_order[k], strict=True)]
            self.keys[k], where = np.unique(np.concatenate(grams), return_index=True)
            count = np.zeros((len(self.keys[k]), size))
            for j, g in enumerate(grams):
                count[np.searchsorted(self.keys[k], g), j] = by_order[k][j][1]
            once, twice = (count == 1).sum(0), (count == 2).sum(0)
            discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.95)
            if k == 1:
                total, kinds = count.sum(0), (count > 0).sum(0)
                spare = discount * kinds / np.maximum(total, 1)
                uniform = 1 / (len(self.keys[1]) + 1)
                p = np.maximum(count - discount, 0) / np.maximum(total, 1) + spare * uniform
                self.unknown = np.log(np.maximum(spare * uniform, 1e-9)).astype(np.float32)
            else:
                contexts = np.concatenate([flat.grams(c, k - 1)[f] for (c, _), (f, _) in zip(data, by_order[k], strict=True)])[where]
                shorter = np.concatenate([flat.grams(c, k - 1)[f + 1] for (c, _), (f, _) in zip(data, by_order[k], strict=True)])[where]
                self.contexts[k], of = np.unique(contexts, return_inverse=True)
                total, kinds = np.zeros((len(self.contexts[k]), size)), np.zeros((len(self.contexts[k]), size))
                np.add.at(total, of, count)
                np.add.at(kinds, of, count > 0)
                gamma = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
                below = np.exp(self.logp[k - 1][_rows(self.keys[k - 1], shorter)])
                p = np.maximum(count - discount, 0) / np.maximum(total, 1)[of] + gamma[of] * below
                self.gamma[k] = np.log(gamma).astype(np.float32)
            self.logp[k] = np.log(np.maximum(p, 1e-12)).astype(np.float32)

    def _position_scores(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability by language of the character at the end of the n-gram at each index."""
        n = self.order
        row = _rows(self.keys[n], flat.grams(codes, n)[at])
        out = self.logp[n][np.maximum(row, 0)]
        left = np.flatnonzero(row < 0)
        if len(left):
            out[left] = 0
        for k in range(n, 1, -1):
            if not len(left):
                return out
            start = at[left] + n - k
            ctx = _rows(self.contexts[k], flat.grams(codes, k - 1)[start])
            out[left[ctx >= 0]] += self.gamma[k][ctx[ctx >= 0]]
            row = _rows(self.keys[k - 1], flat.grams(codes, k - 1)[start + 1])
            out[left[row >= 0]] += self.logp[k - 1][row[row >= 0]]
            left = left[row < 0]
        out[left] += self.unknown
        return out

    def entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per character by text and language, characters and letters of each text."""
        n = self.order
        codes, begin, letters = prepared(texts, n)
        inside = np.ones(max(len(codes) - n + 1, 0), bool)
        for i in range(1, n):
            inside[begin[1:-1] - i] = False
        at = np.flatnonzero(inside)
        start = np.searchsorted(at, begin)
        size = np.diff(start)
        total = flat.sums(self._position_scores(codes, at), start)
        return -total / np.maximum(size, 1)[:, None], size, letters

    def calibrate(self, texts: list[list[str]]) -> None:
        """Sharpness of the posterior, and usual cross-entropy of pieces, from texts not trained on."""
        right, scaled = [], []
        for j, one in enumerate(texts):
            pieces = [t[i:i + PIECE] for t in one for i in range(0, max(len(t) - PIECE // 2, 1), PIECE)]
            x, size, letters = self.entropy(pieces)
            ok = letters > 0
            if ok.any():
                self.typical[j], self.spread[j] = x[ok, j].mean(), max(x[ok, j].std(), 0.02)
                right.append(np.full(int(ok.sum()), j))
                scaled.append(x[ok])
        if not scaled:
            return
        x, y = np.concatenate(scaled), np.concatenate(right)
        best = np.inf
        for s in np.geomspace(0.5, 64, 22):
            z = -s * (x - x.min(1, keepdims=True))
            loss = -(z[np.arange(len(y)), y] - np.log(np.exp(z).sum(1))).mean()
            if loss < best:
                best, self.sharpness = loss, float(s)

    def judge(self, texts: list[str | None], reject: float) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each text; ``reject``: allowed spreads above the usual."""
        if not self.langs:
            zero = np.zeros(len(texts))
            return [UNKNOWN] * len(texts), zero, zero, np.ones(len(texts), bool)
        x, size, letters = self.entropy(texts)
        best = x.argmin(1)
        low = x[np.arange(len(x)), best]
        score = 1 / np.exp(-self.sharpness * (x - low[:, None])).sum(1)
        limit = self.typical[best] + reject * self.spread[best] * np.sqrt(np.maximum(1, PIECE / np.maximum(size, 1)))
        none = letters == 0
        score[none], low[none] = 0, 0
        return [UNKNOWN if no else self.langs[i] for no, i in zip(none, best, strict=True)], score, low, none | (low > limit)


def near_ranks(docs: DataFrame, rank, per_lang: int, folds: int, held_out: int) -> DataFrame | None:
    """Documents to learn from that include the ``per_lang`` of the lowest rank of each language; None if no lang is known."""
    sizes = {r["lang"]: r["count"] for r in docs.where("lang is not null").groupBy("lang").count().collect()}
    if not sizes:
        return None
    able = F.expr("doc_id is not null and lang is not null") & (doc_hash() % folds != held_out) & F.length("text").between(1, LONGEST)
    want = (per_lang + 4 * per_lang ** 0.5 + 16) * folds / max(folds - 1, 1)
    share = {g: min(1.0, want / n) for g, n in sizes.items()}
    while True:
        cut = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
        near = docs.where("lang is not null").where(below(rank, cut[F.col("lang")]) | (cut[F.col("lang")] >= 1)).where(able)
        found = {r["lang"]: r["count"] for r in near.groupBy("lang").count().collect()}
        few = [g for g, s in share.items() if s < 1 and found.get(g, 0) < per_lang]
        if not few:
            return near
        for g in few:
            share[g] = min(1.0, share[g] * max(2.0, min(100.0, 1.2 * per_lang / max(found.get(g, 0), 1))))


def fit(docs: DataFrame, folds: int = 3, held_out: int = 1, per_lang: int = 500, order: int = 5) -> Models:
    """Train on at most ``per_lang`` documents of each language (smallest salted hash), one in five of them for calibration.

    Only documents outside the held-out fold are read.  The driver gets per_lang texts a language at every input size, none of
    over 100,000 characters.  Each language has a cutoff on the hash, so no task sees more than a small multiple of per_lang ids.
    """
    rank = F.xxhash64("doc_id", F.lit("language"))
    known = near_ranks(docs.select("doc_id", "text", "lang"), rank, per_lang, folds, held_out)
    if known is None:
        return Models([], order)
    order_by = Window.partitionBy("lang").orderBy("rank", "doc_id")
    # ids first: texts are read for the chosen rows only
    chosen = known.select("doc_id", "lang", rank.alias("rank")).withColumn("at", F.row_number().over(order_by)).where(F.col("at") <= per_lang)
    rows = known.join(F.broadcast(chosen), ["doc_id", "lang"]).dropDuplicates(["doc_id", "lang"])
    got = sorted(rows.select("lang", "at", "text").collect(), key=lambda r: (r["lang"], r["at"]))
    langs = sorted({r["lang"] for r in got})
    models = Models(langs, order)
    if langs:
        models.fit([[r["text"] for r in got if r["lang"] == g and r["at"] % 5] or [r["text"] for r in got if r["lang"] == g] for g in langs])
        models.calibrate([[r["text"] for r in got if r["lang"] == g and r["at"] % 5 == 0] for g in langs])
    return models


def predict(docs: DataFrame, models: Models, reject: float = 8.0) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, rejected of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def make():
        def run(doc_ids, texts):
            return [doc_ids, *shared.value.judge(texts, reject)]

        return run

    return map_slices(docs.select("doc_id", "text"), make,
                      "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def keep_known(docs: DataFrame, models: Models, reject: float = 8.0) -> DataFrame:
    """The rows that are not rejected, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    return filter_texts(docs, lambda: lambda texts: ~shared.value.judge(texts, reject)[3])

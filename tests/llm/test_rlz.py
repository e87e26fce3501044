"""Substring dedup against all windows of all documents."""

import hashlib
import random

import numpy as np
import pytest

from tallyrec.llm import rlz

SMALL = "/root/testdata/sf0.001"


def by_windows(rows):
    """(doc_id, n_words, n_removed, kept_sha256) by comparing every window with those of smaller ids."""
    least = {}
    cut = [(d, (t or "").encode("utf-8", "surrogatepass").split()) for d, t in rows]
    for d, w in cut:
        if d is not None:
            for i in range(len(w) - 49):
                k = tuple(w[i:i + 50])
                least[k] = min(d, least.get(k, d))
    out = []
    for d, w in cut:
        gone = set()
        for i in range(len(w) - 49 if d is not None else 0):
            if least[tuple(w[i:i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def corpus(seed, n, vocabulary):
    """Texts made of shared passages of every length, single changed words, periodic stretches and copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.randint(20, 400))] for _ in range(12)]
    period = [word() for _ in range(rng.randint(1, 30))] * 20
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            p = list(rng.choice(passages)) if kind < 0.6 else list(period) if kind < 0.7 else [word() for _ in range(rng.randint(1, 80))]
            if kind < 0.6 and rng.random() < 0.5:
                a = rng.randrange(len(p))
                p = p[a:a + rng.randint(1, 200)]
            for _ in range(rng.randint(0, 2) if p else 0):
                p[rng.randrange(len(p))] = word()
            parts += p
        texts.append(rng.choice([" ", "\n", " \t "]).join(parts))
        if texts and rng.random() < 0.1:
            texts.append(rng.choice(texts))
    return texts


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(d, t, 1, b"x") for d, t in rows], "doc_id long, text string, key int, spans binary").repartition(parts)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,vocabulary,block", [(1, 5000, 256), (2, 5000, 40), (3, 3, 256), (4, 40, 256), (5, 2, 64)])
def test_by_all_windows(spark, monkeypatch, seed, vocabulary, block):
    monkeypatch.setattr(rlz, "BLOCK", block)
    rows = list(enumerate(corpus(seed, 70, vocabulary)))
    random.Random(seed).shuffle(rows)
    want = by_windows(rows)
    assert sum(r[2] for r in want) > 1000
    assert got(rlz.without_repeats(frame(spark, rows))) == sorted(want, key=str)


def test_odd_rows(spark):
    rng = random.Random(8)
    long = " ".join(f"v{rng.randrange(9000)}" for _ in range(30_000))
    a, b = " ".join(map(str, range(120))), " ".join(map(str, range(60, 200)))
    rows = [(5, a), (5, b), (5, a), (None, a), (7, b + " " + a), (-3, None), (2, ""), (2, " \n"), (9, long), (8, long + "\x85x"), (None, None),
            (10, "é\x1f " * 100), (11, "é\x1f\x0b" * 100), (12, "🎉 " * 49), (13, "🎉 " * 50), (14, "🎉 " * 50)]
    assert got(rlz.without_repeats(frame(spark, rows))) == sorted(by_windows(rows), key=str)
    texts = {r["doc_id"]: r["kept_text"] for r in rlz.without_repeats(frame(spark, rows), with_text=True).where("doc_id in (7, 9)").collect()}
    assert texts[9] == long.split()[-1] and len(texts[7].split()) < 260
    assert rlz.without_repeats(frame(spark, [])).count() == 0


def test_query_over_the_table(spark):
    from tallyrec.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    out = QUERIES["op11_relative_lempel_ziv"](spark, SMALL)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert got(out) == sorted(by_windows(rows), key=str)


def test_grams_and_anchors():
    rng = random.Random(3)
    texts = [" ".join(f"q{rng.randrange(30)}" for _ in range(n)) for n in (0, 10, 49, 50, 51, 300)]
    h, first = rlz.words_of(texts)
    g = rlz.grams(h)
    assert first.tolist() == np.cumsum([0, *(len(t.split()) for t in texts)]).tolist()
    words = " ".join(texts).split()
    seen = {}
    for i in range(len(g)):
        assert seen.setdefault(tuple(words[i:i + 25]), g[i]) == g[i]
    assert len(set(seen.values())) == len(seen)
    text, gram, pos, low, high = rlz.anchors_of(texts)
    covered = {(t, s) for t, a, b in zip(text, low, high, strict=True) for s in range(a, b + 1)}
    assert covered == {(t, s) for t, x in enumerate(texts) for s in range(len(x.split()) - 49)}
    for t, k, p, a, b in zip(text, gram, pos, low, high, strict=True):
        assert b - 25 <= p - 0 <= a + 25 and p >= b and g[first[t] + p] == k

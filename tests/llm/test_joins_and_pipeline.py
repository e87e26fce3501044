"""Near-duplicate operators against brute force, and the pipeline's stages."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyrec.llm import common, embed_dedup, minhash
from tallyrec.llm.components import components


def roots(n, links):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return [top(i) for i in range(n)]


def shingle_set(text):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_by_brute_force(texts):
    sets = [shingle_set(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    return sets, roots(len(sets), links)


def corpus(seed, families, copies):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(40)]
    out = []
    for _ in range(families):
        base = passage * rng.randint(0, 1) + [word() for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            out.append(" ".join(text))
    return out + ["A b C d", "a B\tc\nd", None, "", "  ", "é", "É"]


@pytest.mark.parametrize("seed,families,copies", [(1, 60, 4), (2, 2, 120)])
def test_minhash_by_brute_force(spark, seed, families, copies, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)  # long lists are cut into many blocks
    texts = corpus(seed, families, copies)
    sets, want = near_by_brute_force(texts)
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, signature string, key int")
    got = {r["doc_id"]: r for r in minhash.near_duplicates(df).collect()}
    assert len(got) == len(texts)
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert all(got[i]["kept"] == (want[i] == i) for i in got)


def test_minhash_pairs_of_few_agreeing_coordinates(spark):
    def pair(seed):  # 56 shingles each, 48 of them common: similarity exactly 0.75
        rng = random.Random(seed)
        words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
        return " ".join(words), " ".join(words[:52] + ["".join(rng.choice("klmnopq") for _ in range(6)) for _ in range(8)])

    # these agree in 33 to 35 of 64 coordinates
    texts = [t for seed in (991, 5803, 6161, 24485) for t in pair(seed)]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i in range(8)}
    miss = sum(math.comb(64, k) * 0.75 ** k * 0.25 ** (64 - k) for k in range(minhash.MATCHES))
    assert minhash.COORDINATES == 64 and miss < 1e-6


def test_minhash_odd_tables(spark):
    schema = "doc_id long, text string"
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (None, None), (7, "a b c d e f"), (7, "a b c d e f"), (9, "w " * 30_000)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] for r in got) and [r["component_id"] for r in got if r["doc_id"] == 7] == [7, 7]


def vectors(seed, kinds, dim=24):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(kinds):
        centre = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 40))):
            out.append(centre + rng.normal(size=dim) * rng.choice([0, 0.05, 0.2, 0.25]))
    return np.array(out)


@pytest.mark.parametrize("block", [512, 8])
def test_embeddings_by_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    x = vectors(3, 30)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    n = len(x)
    want = roots(n, np.argwhere(near).tolist())
    rows = [(i, v.tolist(), "k", 3) for i, v in enumerate(x)]
    bad = [(n, None, "k", 1), (n + 1, [0.0] * 24, "k", 1), (n + 2, [None] + [1.0] * 23, "k", 1), (n + 3, [float("nan")] * 24, "k", 1),
           (n + 4, [float("inf")] * 24, "k", 1), (n + 5, [], "k", 1), (n + 6, [1.0, 2.0], "k", 1), (None, x[0].tolist(), "k", 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, keys string, weight int")
    got = {r["vec_id"]: r for r in embed_dedup.near_vectors(df).collect()}
    assert [got[i]["n_links"] for i in range(n)] == near.sum(1).tolist()
    assert [got[i]["component_id"] for i in range(n)] == want
    for i in range(n, n + 7):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert len(got) == n + 8


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    dim = 48
    turn = embed_dedup.rotations(dim)
    x, y = embed_dedup.unit(rng.normal(size=(4000, dim))), embed_dedup.unit(rng.normal(size=(4000, dim)))
    y = embed_dedup.unit(3 * x + y)
    tx, ty = x @ turn, y @ turn
    s = np.where(tx >= 0, 1.0, -1.0) / np.sqrt(tx.shape[1])
    c = (s * tx).sum(1)
    inside = s @ turn.T
    o = np.sqrt((inside * inside).sum(1) - c * c)
    true = (x * y).sum(1)
    error = (s * ty).sum(1) / c - true
    allowed = np.sqrt(1 - true ** 2) * o / c / np.sqrt(dim - 1)
    assert abs(error.mean()) < 0.005
    assert 0.8 < (error / allowed).std() < 1.2 and np.abs(error / allowed).max() < embed_dedup.EPSILON


def test_pairs_at_the_threshold_meet_in_a_table(spark):
    rng = np.random.default_rng(8)
    x, y = embed_dedup.unit(rng.normal(size=(10_000, 64))), rng.normal(size=(10_000, 64))
    y = embed_dedup.unit(y - (x * y).sum(1, keepdims=True) * x)
    pairs = np.stack([x, 0.95 * x + np.sqrt(1 - 0.95 ** 2) * y], axis=1).reshape(-1, 64)  # cosine 0.95
    bits, count = embed_dedup.tables(10 ** 8, 0.95)
    import pyarrow as pa

    table = pa.table({"id": pa.array(range(len(pairs))), "weight": pa.array(np.ones(len(pairs), np.int64)), "embedding": pa.array(list(pairs), pa.list_(pa.float64()))})
    got = embed_dedup.codes(spark.createDataFrame(table), bits, count).select("id", "keys").toArrow().sort_by("id")
    keys = got["keys"].combine_chunks().flatten().to_numpy().reshape(-1, 2, count)
    assert (~(keys[:, 0] == keys[:, 1]).any(1)).sum() == 0


def test_table_keys_do_not_depend_on_the_matrix():
    x = embed_dedup.unit(np.random.default_rng(2).normal(size=(3000, 64)))
    bits, count = embed_dedup.tables(50_000, 0.95)
    keys = embed_dedup.table_keys(x, bits, count)
    assert (keys[7:9] == embed_dedup.table_keys(x[7:9], bits, count)).all()
    assert (keys[1000:, :5] == embed_dedup.table_keys(x[1000:], bits, count, 5)).all()


def test_embeddings_empty_and_equal(spark):
    schema = "vec_id long, embedding array<float>"
    assert embed_dedup.near_vectors(spark.createDataFrame([], schema)).count() == 0
    got = embed_dedup.near_vectors(spark.createDataFrame([(5, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (8, [0.0, 1.0])], schema)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == [(3, 2, 3, True), (3, 2, 3, True), (5, 2, 3, False), (8, 0, 8, True)]


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(5).shuffle(order)
    links = spark.createDataFrame(list(zip(order[:150], order[1:151], strict=True)), "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert set(got) == set(order[:151]) and set(got.values()) == {min(order[:151])}
    assert components(links.limit(0)).count() == 0


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, before, sf), "test-stage")
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        kept[name] = after.count()
        if name == "MinHash near-dedup":
            rows = before.orderBy("doc_id").collect()
            _, want = near_by_brute_force([r["text"] for r in rows])
            assert {r["doc_id"] for r in after.collect()} == {rows[i]["doc_id"] for i in set(want)}
        else:
            assert {r["doc_id"] for r in after.collect()} <= {r["doc_id"] for r in before.collect()}
        before = after
    assert kept["language ID"] >= 0.97 * docs.count() and kept["PII"] == kept["MinHash near-dedup"]
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in before.collect()}


def test_pipeline_odd_rows(spark):
    rows = [(None, None, "en", "s", 0), (1, "", "en", "s", 0), (2, "The same words are here again and again.", "en", "s", 3),
            (2, "The same words are here again and again.", "en", "s", 3), (3, "the SAME words are here again and again.", None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            out.collect()
    near = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, schema), "").collect()
    assert sorted(r["doc_id"] or 0 for r in near) == [0, 1, 2]


def test_key_filter_leaves_out_no_row(spark):
    ids = list(range(-3000, 60_000, 7)) + [2 ** 62, -2 ** 63, None]
    keys = spark.createDataFrame([(i,) for i in ids], "id long")
    rows = spark.createDataFrame([(i, str(i)) for i in list(range(-3000, 60_000)) + [2 ** 62, -2 ** 63, None, 5, 5]], "id long, text string")
    got = common.maybe_among(rows, keys, "id", "maybe").collect()
    assert len(got) == rows.count() and all(r["maybe"] for r in got if r["id"] in ids and r["id"] is not None)
    assert sum(r["maybe"] for r in got) < 1.6 * len(ids) and not any(r["maybe"] for r in got if r["id"] is None)
    assert sorted(r["id"] for r in common.only_among(rows, keys, "id").collect()) == sorted(i for i in ids if i is not None)
    narrow = rows.where("id between 0 and 100").select(F.col("id").cast("int").alias("id"))
    assert common.only_among(narrow, keys, "id").count() == sum(i is not None and 0 <= i <= 100 for i in ids)
    none = common.maybe_among(rows, keys.where("false"), "id", "maybe")
    assert none.count() == rows.count() and none.where("maybe").count() == 0


def test_near_duplicate_stage_shuffles_few_texts(spark, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(str(rng.randrange(10 ** 9)) for _ in range(1000)) for _ in range(300)]
    texts += [f"{texts[i]} once more" for i in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        files = [files.apply(i) for i in range(files.size())]
        return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}

    written = shuffled()
    before = sum(written.values())

    def held(df, name):  # the files are counted at each step, as Spark may clean them up
        out = common.stored(df, name)
        written.update(shuffled())
        return out

    monkeypatch.setattr(minhash, "stored", held)
    monkeypatch.setattr(corpus_pipeline, "stored", held)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables that are too large for it
    try:
        got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
        written.update(shuffled())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted(r["doc_id"] for r in got) == list(range(300))
    assert sum(written.values()) - before < 0.4 * sum(map(len, texts))


def test_near_duplicate_stage_with_repeated_ids(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    own = [" ".join(word() for _ in range(40)) for _ in range(30)]
    # 3 is a copy of 1; 5 comes twice alike, 6 with two texts, 8 with an own text and with that of 2; rows without id all stay
    rows = [(i, own[i]) for i in range(30) if i != 3] + [(3, own[1]), (5, own[5]), (6, own[1] + " a"), (8, own[2]), (None, own[1]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    flat = minhash.near_duplicates(docs).where("kept and doc_id is not null").groupBy("doc_id").count().collect()
    want = []
    for r in flat:
        want += [r["doc_id"]] * (1 if r["count"] > 1 else sum(i == r["doc_id"] for i, _ in rows))
    got = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert got.count(None) == 2 and sorted(i for i in got if i is not None) == sorted(want)
    assert 3 not in got and got.count(5) == 1

"""doc_tokens counts the words of a document where its row is read: no map of all (post, term) groups in a task."""

from __future__ import annotations

from collections import Counter

from tallyrec.operators import tfidf


def plain(rows: list[tuple]) -> dict:
    out: Counter = Counter()
    for post, text in rows:
        out.update((post, w) for w in (text or "").split(" ") if w)
    return dict(out)


def test_counts_equal_plain_counts_with_nulls_empty_and_repeated_posts(spark):
    rows = [("1", "pan pot pan"), ("2", ""), ("3", None), ("4", "  pot  "), ("1", "pot lid"), (None, "pan"),
            (None, "pan pan"), ("5", "word " * 3000), ("6", "été été")]
    docs = spark.createDataFrame(rows, "post_id string, soup string").repartition(2)
    got = tfidf.doc_tokens(docs, spark, ()).collect()
    assert len({(r.post_id, r.term) for r in got}) == len(got)
    assert {(r.post_id, r.term): r.tf for r in got} == plain(rows)


def test_texts_over_a_slice_are_counted_whole(spark, monkeypatch):
    monkeypatch.setattr(tfidf, "SLICE", 64)
    rows = [(str(i), f"w{i % 7} " * (i % 40)) for i in range(300)]
    got = tfidf.doc_tokens(spark.createDataFrame(rows, "post_id string, soup string"), spark, ()).collect()
    assert {(r.post_id, r.term): r.tf for r in got} == plain(rows)


def test_words_of_different_posts_are_not_aggregated_or_shuffled(spark):
    rows = [(str(i), "pan pot pan") for i in range(20)]
    docs = spark.createDataFrame(rows, "post_id string, soup string")
    plan = tfidf.doc_tokens(docs, spark, ())._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("MapInArrow")[0]  # what comes after the count; the stop words are the only other side
    assert "MapInArrow" in plan and "Aggregate" not in above.split("Join LeftAnti")[0]


def test_vocabulary_carries_the_number_of_posts_that_tfidf_would_count(spark):
    tokens = spark.createDataFrame([("1", "pan", 2), ("1", "pot", 1), ("2", "pan", 3), ("3", "lid", 1)],
                                   "post_id string, term string, tf long")
    vocab = tfidf.vocabulary(tokens, 2)
    assert {(r.term, r.term_count, r.df) for r in vocab.collect()} == {("pan", 5, 2), ("lid", 1, 1)}
    one = {tuple(r) for r in tfidf.tfidf(tokens, vocab, 3).collect()}
    assert one == {tuple(r) for r in tfidf.tfidf(tokens, vocab.select("term"), 3).collect()}

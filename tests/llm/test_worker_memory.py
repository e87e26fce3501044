"""A worker serves the tasks of all stages: a batch of texts stays small, whatever the session allows."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tallyrec.llm import common, packing


def test_batches_of_texts_are_small_and_rows_stay(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        docs = spark.range(7000).selectExpr("id as doc_id", "cast(id as string) as text").coalesce(1)
        sizes = common.map_arrow(docs, lambda batches: (b.slice(0, 1) for b in batches if b.num_rows <= common.BATCH_ROWS), docs.schema)
        assert sizes.count() == 4
        assert common.filter_texts(docs, lambda: lambda texts: [t.endswith("7") for t in texts]).count() == 700
        spark.conf.set(key, "100")  # a smaller setting of the session stays
        common.filter_texts(docs, lambda: lambda texts: [True] * len(texts))
        assert spark.conf.get(key) == "100"
    finally:
        spark.conf.set(key, before)


def test_batches_of_long_texts_are_bounded_in_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(1500).selectExpr("id as doc_id", "repeat('abcd ', 2000) as text").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], ["rows", "size"])

    try:
        spark.conf.unset(key)
        got = common.map_arrow(docs, sizes, "rows long, size long").collect()
        assert sum(r["rows"] for r in got) == 1500
        assert max(r["size"] for r in got) < 1.1 * common.BATCH_BYTES  # 15 MB in one batch before
        spark.conf.set(key, "200000")  # a session's own setting stays
        common.map_arrow(docs, sizes, "rows long, size long")
        assert spark.conf.get(key) == "200000"
    finally:
        spark.conf.set(key, before)


def test_a_look_up_needs_no_table_of_all_known_words():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words = packing.Words(t)
    many = [f"w{i}" for i in range(400_000)]  # known without learning them: only the look-up counts here
    words.known = pa.concat_arrays([words.known, pa.array(many)])
    words.begin, words.size = np.zeros(len(many) + 1, np.int32), np.ones(len(many) + 1, np.int32)
    words.flat = np.zeros(1, "<u4")
    usual = pa.default_memory_pool()
    pool = pa.proxy_memory_pool(usual)
    pa.set_memory_pool(pool)
    try:
        at = words._numbers(pa.array(["w399999", "", "w7"]))
    finally:
        pa.set_memory_pool(usual)
    assert at.tolist() == [400_000, 0, 8]
    assert pool.max_memory() < 5_000_000  # over 12 MB before


def test_words_share_the_model_and_keep_added_tokens():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words = packing.Words(t)
    assert words.merges.get_added_tokens_decoder().keys() == t.get_added_tokens_decoder().keys()
    assert words.merges.get_vocab_size() == t.get_vocab_size()
    assert t.normalizer is not None and t.encode("A b", add_special_tokens=False).ids == t.encode("a b", add_special_tokens=False).ids
    texts = ["one two, three.", "", None, "Ünder one two <|endoftext|> x", "one " * 40_000, "a1 b2 c3"]
    got = words.ids(pa.array(texts, pa.string()))
    assert got == [np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert words.ids(pa.array([], pa.string())) == []

"""Registered queries of the training-data operators: opN_<name> over whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyrec.llm import (bpe, embed_dedup, langid, minhash, packing, pii, quality, rlz, secret_scan, simhash, token_counts,
                          turns, whitening)
from tallyrec.llm.common import doc_hash, table

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op3_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (langid.predict(docs, langid.fit(docs))
            .withColumn("held_out", doc_hash() % 3 == 1))


def op4_lstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op5_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = token_counts.three_edits(table(spark, sf_dir, "documents"))
    return token_counts.edited_counts(docs, public_tokenizers.path(BYTE_BPE))


def op7_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
            .withColumn("held_out", doc_hash() % 5 == 0))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op11_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.without_repeats(table(spark, sf_dir, "documents"))


def op12_four_russians_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.report(turns.damaged(table(spark, sf_dir, "conversations"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_golub_kahan_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


QUERIES = {f.__name__: f for f in (
    op1_rotated_codes, op2_markov_secrets, op3_kneser_ney_language, op4_lstm_crf_pii, op5_minhash_near_duplicates,
    op6_edit_token_counts, op7_subword_quality, op8_simhash, op9_sum_of_squares_packing, op10_prefix_bpe,
    op11_relative_lempel_ziv, op12_four_russians_repair, op13_golub_kahan_whitening,
)}

# All pairs that share a shingle are compared on their full sets; labels fall along the links until none changes.
OP5_SQL = r"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') as w
    from documents
), shingle as (
    select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from words
), size as (
    select d.doc_id, count(s.s) as n from documents d left join shingle s using (doc_id) group by all
), common as (
    select a.doc_id as x, b.doc_id as y, count(*) as c
    from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id group by all
), link as (
    select x, y from common join size p on p.doc_id = x join size q on q.doc_id = y where 100 * c >= 75 * (p.n + q.n - c)
), reach as (
    select doc_id, doc_id as other from documents
    union
    select reach.doc_id, link.y from reach join link on link.x = reach.other
)
select size.doc_id, size.n as n_shingles, min(reach.other) as component_id, size.doc_id = min(reach.other) as kept
from size join reach using (doc_id) group by size.doc_id, size.n
"""

OP1_SQL = """
with recursive v as (
    select vec_id, embedding::double[] as e from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), link as (
    select a.vec_id as x, b.vec_id as y from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.95
), reach as (
    select vec_id, vec_id as other from embeddings
    union
    select reach.vec_id, link.y from reach join link on link.x = reach.other
), count_of as (select x, count(*) as n from link group by x)
select r.vec_id, coalesce(any_value(c.n), 0)::bigint as n_links, min(r.other) as component_id, r.vec_id = min(r.other) as kept
from reach r left join count_of c on c.x = r.vec_id group by r.vec_id
"""

ORACLE_SQL: dict[str, str] = {"op1_rotated_codes": OP1_SQL, "op5_minhash_near_duplicates": OP5_SQL}

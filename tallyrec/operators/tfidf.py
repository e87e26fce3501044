"""Text features: cleaned text, soup, tokens, vocabulary, TF-IDF and count weights (ML1-ML6).

Everything is long-format DataFrames ``(post_id, term, value)``; the only
broadcasts are the stop-word list, the optional lemma dictionary and the
vocabulary, all bounded by construction (a language's word list, ``max_terms``).
"""

from __future__ import annotations

import glob
import os
import zipfile
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions import text as T
from ..session import materialize

SLICE = 2_000_000  # bytes of text whose words are counted at a time


@lru_cache(maxsize=1)
def default_stop_words() -> tuple[str, ...]:
    """Spark ML's built-in English stop-word list (read from the MLlib jar, no JVM needed)."""
    import pyspark

    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    for jar in glob.glob(os.path.join(home, "jars", "spark-mllib_*.jar")):
        with zipfile.ZipFile(jar) as z:
            name = "org/apache/spark/ml/feature/stopwords/english.txt"
            if name in z.namelist():
                return tuple(w.strip() for w in z.read(name).decode("utf-8").splitlines() if w.strip())
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def stop_words(extra: tuple[str, ...] | list[str] = ()) -> list[str]:
    seen, out = set(), []
    for w in list(default_stop_words()) + list(extra):
        if w not in seen:
            seen.add(w)
            out.append(w)
    return out


def with_text(meta: DataFrame, title_prefix_pattern: str) -> DataFrame:
    """Adds post_title (from the permalink), cleaned post_content and the soup (FN24-FN26)."""
    title = T.title_from_url(F.col("permalink"), title_prefix_pattern)
    content = T.clean_text(F.col("post_content"))
    return (meta.withColumn("post_title", title).withColumn("clean_content", content)
            .withColumn("soup", T.soup(F.col("category_list"), F.col("post_title"), F.col("clean_content"))))


def _slices(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """An Arrow batch (post_id, text) in slices of about ``SLICE`` bytes of text."""
    load = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    cuts = np.flatnonzero(np.diff(load // SLICE)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def word_counts(docs: DataFrame) -> DataFrame:
    """(post_id, term, tf) of every row of ``docs`` (post_id, text), split on spaces; empty words do not count.

    A document's words are counted where its row is read, a slice of documents at a time, so no task keeps the groups
    of all its documents and nothing is shuffled.
    """
    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                lists = pc.split_pattern(part.column(1), " ")
                row = pc.list_parent_indices(lists).to_numpy()
                words = lists.flatten().dictionary_encode()
                names, code = words.dictionary, words.indices.to_numpy().astype(np.int64)
                used = pc.not_equal(names, "").to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
                group, n = np.unique(row[used] * len(names) + code[used], return_counts=True)
                if len(group):
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(group // len(names))), names.take(pa.array(group % len(names))),
                         pa.array(n, pa.int64())], ["post_id", "term", "tf"])

    return docs.mapInArrow(run, ST.StructType([docs.schema["post_id"], ST.StructField("term", ST.StringType()),
                                               ST.StructField("tf", ST.LongType())]))


def doc_tokens(docs: DataFrame, spark: SparkSession, extra_stop_words=(), lemmas: DataFrame | None = None,
               text_col: str = "soup", max_keys: int | None = None) -> DataFrame:
    """ML1-ML3: (post_id, term, tf).  Split on spaces, strip punctuation inside tokens,
    map through the lemma dictionary (if any), drop stop words, count per post.

    ``lemmas``: (token, lemma); of several lemmas of a token the first in order is taken, null ones do not count.  The
    dictionary is counted and broadcast only within ``max_keys``.  Counts of single rows are added up only for the post
    ids of several rows, or where several tokens may have one lemma.
    """
    # Space is not punctuation, so stripping punctuation from the whole text before the split
    # gives exactly the per-token result with one regex call per document instead of per token.
    texts = docs.select("post_id", T.strip_punctuation(F.col(text_col)).alias("text"))
    tok = word_counts(texts)
    sw = spark.createDataFrame([(w,) for w in stop_words(extra_stop_words)], "term string")
    if lemmas is not None:
        lem = (lemmas.filter(F.col("token").isNotNull() & F.col("lemma").isNotNull())
               .groupBy(F.col("token").alias("term")).agg(F.min("lemma").alias("lemma")))
        if max_keys is not None and lem.count() <= max_keys:
            lem = F.broadcast(lem)
        tok = tok.join(lem, "term", "left").select("post_id", F.coalesce("lemma", "term").alias("term"), "tf")
        sw = sw.join(lem, "term", "left").select(F.coalesce("lemma", "term").alias("term"))
    tok = tok.join(F.broadcast(sw.distinct()), "term", "left_anti").select("post_id", "term", "tf")

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy("post_id", "term").agg(F.sum("tf").alias("tf"))

    if lemmas is not None:
        return added(tok)
    again = materialize(docs.groupBy("post_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
                        .select(F.col("post_id").alias("_again")))
    found = again.count()
    if not found:
        return tok
    again = F.broadcast(again) if max_keys is not None and found <= max_keys else again
    same = tok["post_id"].eqNullSafe(again["_again"])
    return tok.join(again, same, "left_anti").unionByName(added(tok.join(again, same, "left_semi")))


def vocabulary(tokens: DataFrame, max_terms: int = 500) -> DataFrame:
    """ML4: the ``max_terms`` terms with the highest corpus count (ties: term ascending), and their number of posts, df."""
    totals = tokens.groupBy("term").agg(F.sum("tf").alias("term_count"), F.count(F.lit(1)).alias("df"))
    return totals.orderBy(F.desc("term_count"), F.asc("term")).limit(max_terms)


def tfidf(tokens: DataFrame, vocab: DataFrame, n_docs) -> DataFrame:
    """ML5: (post_id, term, tf, weight) with smooth idf ``ln((1+N)/(1+df)) + 1`` and L2 rows.

    ``n_docs`` counts every document, empty ones included (a Column or a number).
    The vocabulary is at most ``max_terms`` rows, hence the broadcast.  Its ``df``, if it has one, is taken, else counted.
    """
    if "df" in vocab.columns:
        tv = tokens.join(F.broadcast(vocab.select("term", "df")), "term")
    else:
        known = tokens.join(F.broadcast(vocab.select("term")), "term")
        tv = known.join(F.broadcast(known.groupBy("term").agg(F.count(F.lit(1)).alias("df"))), "term")
    n = n_docs if not isinstance(n_docs, (int, float)) else F.lit(n_docs)
    raw = tv.withColumn(
        "w", F.col("tf") * (F.log((F.lit(1) + n) / (F.lit(1) + F.col("df"))) + F.lit(1)))
    return _l2(raw, "w").select("post_id", "term", "tf", F.col("w_unit").alias("weight"))


def count_weights(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """ML6: count vectors over the vocabulary, L2-normalised (their dot product is the cosine)."""
    tv = tokens.join(F.broadcast(vocab.select("term")), "term").withColumn("w", F.col("tf").cast("double"))
    return _l2(tv, "w").select("post_id", "term", "tf", F.col("w_unit").alias("weight"))


def _l2(df: DataFrame, col: str) -> DataFrame:
    """Divide by the row norm; each post has at most ``max_terms`` rows, so the window group is bounded."""
    norm = F.sqrt(F.sum(F.col(col) * F.col(col)).over(Window.partitionBy("post_id")))
    return df.withColumn(f"{col}_unit", F.col(col) / norm)

"""SimHash document fingerprints and search within a Hamming radius (operator 8).

Terms are runs of three words (a shorter text is one term); every occurrence votes, so a term weighs
its frequency.  Each of the 128 bits of a term's hash votes up or down, and the sign of the sum is
the fingerprint's bit.  All fingerprints within radius r of each other share at least one of r + 1
blocks of bits: one table per block, keyed by it (the permutations of Manku, Jain and Das Sarma 2007).
Copies with a changed word differ in some bits, fewer the longer the text is: ``RADIUS`` is the widest whose
blocks (16 bits) keep buckets small.  Rows near a row are counted inside the tasks that compare two
blocks of a bucket, so a group of copies gives one row a fingerprint and never its pairs.

A null or empty text, or one of blanks alone, has no terms and the fingerprint 0.  Texts count whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyrec.llm import flat
from tallyrec.llm.common import stored
from tallyrec.llm.minhash import groups

BITS, TERM, RADIUS = 128, 3, 7
BLOCK = 2048  # fingerprints of a bucket's block
LANE = np.uint64(0x0001000100010001)  # four 16-bit counters in a word
LOWEST = -(1 << 63)


def term_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    codes, begin = flat.code_points(texts)
    codes = np.where((codes < 32) | (codes == 0x85) | (codes == 0xA0), np.uint32(32), codes)
    h, start = flat.words(codes, begin)
    size = np.diff(start)
    terms = np.maximum(size - TERM + 1, np.minimum(size, 1))
    first = np.concatenate([[0], np.cumsum(terms)])
    at = np.repeat(start[:-1] - first[:-1], terms) + np.arange(first[-1])
    end = np.repeat(start[1:], terms)
    out = np.zeros(len(at), np.uint64)
    for i in range(TERM):
        inside = at + i < end
        out[inside] = flat.mix(out[inside] * flat.M + h[at[inside] + i])
    return out, first


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """Two unsigned 64-bit words per text."""
    h, first = term_hashes(texts)
    n = np.diff(first)
    # 16-bit counters overflow: longer texts are counted in parts
    cuts = np.unique(np.concatenate([first[:-1][n > 0], *[np.arange(b, e, 60_000) for b, e in zip(first[:-1], first[1:], strict=True) if e - b > 60_000]]).astype(np.int64))
    owner = np.searchsorted(first, cuts, side="right") - 1
    out = np.zeros((len(texts), 2), np.uint64)
    if not len(cuts):
        return out
    for word in range(2):
        x = h if word == 0 else flat.mix(h + flat.M)
        for i in range(16):
            ones = np.add.reduceat((x >> np.uint64(i)) & LANE, cuts)
            for lane in range(4):
                bit = 16 * lane + i
                votes = np.zeros(len(texts), np.int64)
                np.add.at(votes, owner, ((ones >> np.uint64(16 * lane)) & np.uint64(0xFFFF)).astype(np.int64))
                out[:, word] |= (2 * votes > n).astype(np.uint64) << np.uint64(bit)
    return out


def hexed(fp: np.ndarray) -> list[str]:
    return [f"{int(a):016x}{int(b):016x}" for a, b in fp]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(a ^ b).sum(1) / BITS


def _follow(batches, out_schema, budget: int = 1_000_000):
    """Rows (bucket, extra, doc_id, text) in order: each real row with the text of the next one of its bucket."""
    chain, load, bucket = [], 0, None  # rows of one bucket whose next row is the one behind, and the last still open

    def emit(rows, after):
        texts = [t or "" for _, t in rows]
        behind = texts[1:] + [after or ""]
        edited = [t[:len(t) - len(t) // 3] + b[:len(t) // 3] for t, b in zip(texts, behind, strict=True)]
        own = fingerprints(texts + [after])
        other = fingerprints(edited)
        cols = [[d for d, _ in rows], [len(t) for t in texts],
                [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in edited],
                hexed(own[:-1]), hexed(other), likeness(own[:-1], other), likeness(own[:-1], own[1:])]
        return pa.RecordBatch.from_arrays([pa.array(c, type=out_schema.field(i).type) for i, c in enumerate(cols)], schema=out_schema)

    for batch in batches:
        for b, extra, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if b != bucket:
                bucket = b
            if extra:
                if chain:
                    yield emit(chain, text)
                chain, load = [], 0
            elif load > budget:
                yield emit(chain, text)
                chain, load = [(doc, text)], len(text or "")
            else:
                chain.append((doc, text))
                load += len(text or "")


def with_next(docs: DataFrame, rows_per_bucket: int = 2000, max_buckets: int = 10_000) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    Rows follow each other in descending doc_id (equal ids: by text; null ids last).  They are dealt to
    ranges of ids, and the first row of a range also goes, marked as extra, to the range before
    it: one shuffle of the texts and no task with more than a range.  Where the ranges lie is an array
    of at most ``max_buckets`` ids.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(LOWEST)).alias("_key"))
    n = rows.count()
    buckets = max(1, min(max_buckets, -(-n // rows_per_bucket)))
    bounds = []
    if buckets > 1:
        at = [i / buckets for i in range(1, buckets)]
        bounds = sorted(set(rows.agg(F.percentile_approx("_key", at, 100_000)).first()[0]))
    low = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<bigint>")
    rows = rows.withColumn("_bucket", F.size(F.filter(low, lambda b: b < F.col("_key"))))
    heads = sorted(((r[0], r[1]) for r in rows.groupBy("_bucket").agg(F.max("_key")).collect()), reverse=True)
    extra = [(heads[i][1], heads[i - 1][0]) for i in range(1, len(heads))] + [(heads[0][1], heads[-1][0])] if heads else []
    ends = spark.createDataFrame(extra, "_head bigint, _to int")
    rows = rows.join(F.broadcast(ends), F.col("_key") == F.col("_head"), "left")
    place = lambda b, e: F.struct(b.alias("bucket"), F.lit(e).alias("extra"))
    here = place(F.col("_bucket"), 0)
    dealt = rows.select("doc_id", "text", "_key", F.explode(
        F.when(F.col("_to").isNull(), F.array(here)).otherwise(F.array(here, place(F.col("_to"), 1)))).alias("_at"))
    dealt = (dealt.select("_at.bucket", "_at.extra", "doc_id", "text", "_key").repartition(buckets, "bucket")
             .sortWithinPartitions("bucket", "extra", F.desc("_key"), "text").drop("_key"))
    schema = T._parse_datatype_string("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                      "edited_fingerprint string, near_edited double, near_next double")

    def run(batches):
        yield from _follow(batches, to_arrow_schema(schema))

    return dealt.mapInArrow(run, schema)


def posted(own: DataFrame, radius: int, heavy: int) -> DataFrame:
    """(fp, t, k, many, k2, ...): each row of ``own`` (fp, ...) under its blocks; buckets of one are left out.

    One table per block of 128 / (radius + 1) bits.  In a bucket of more than ``heavy`` fingerprints the
    other bits are cut into radius + 1 blocks again, of which one must be equal too, so a
    frequent block costs a longer key and not a larger join.
    """
    blocks = radius + 1
    if 32 % blocks:
        raise ValueError("radius + 1 must divide 32")
    width = 32 // blocks
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.substring("fp", 1 + i * width, width).alias("k")) for i in range(blocks)])
    posts = own.select("*", F.explode(keys).alias("p")).select(*own.columns, "p.t", "p.k")
    crowd = posts.groupBy("t", "k").count().where(F.col("count") > 1).select("t", "k", (F.col("count") > heavy).alias("many"))
    posts = posts.join(crowd, ["t", "k"])
    rest = F.concat(F.expr(f"substring(fp, 1, t * {width})"), F.expr(f"substring(fp, 1 + (t + 1) * {width}, 32)"))
    part = (32 - width) // blocks
    longer = F.array(*[F.concat(F.lit(f"{i}:"), F.substring(rest, 1 + i * part, part if i < blocks - 1 else 32)) for i in range(blocks)])
    return posts.select(*own.columns, "t", "k", "many", F.explode(F.when(F.col("many"), longer).otherwise(F.array(F.lit("")))).alias("k2"))


def near_fingerprints(fps: DataFrame, radius: int = 3, heavy: int = 256) -> DataFrame:
    """All pairs a < b of distinct fingerprints (32 hex digits) at most ``radius`` bits apart.  Null fingerprints are left out."""
    own = stored(fps.where("fingerprint is not null").select("fingerprint").distinct(), "fingerprints")
    posts = posted(own.select(F.col("fingerprint").alias("fp")), radius, heavy).drop("many")
    a, b = posts.withColumnRenamed("fp", "a"), posts.withColumnRenamed("fp", "b")
    word = lambda c, i: F.conv(F.substring(c, 1 + 8 * i, 8), 16, 10).cast("long")
    apart = sum((F.bit_count(word("a", i).bitwiseXOR(word("b", i))) for i in range(1, 4)), F.bit_count(word("a", 0).bitwiseXOR(word("b", 0))))
    return a.join(b, ["t", "k", "k2"]).where("a < b").where(apart <= radius).select("a", "b").distinct()


def near_counts(fps: DataFrame, radius: int = RADIUS, heavy: int = 256) -> DataFrame:
    """fingerprint, n_near: for each distinct fingerprint, how many rows besides one of its own lie within ``radius`` bits.

    A pair is counted in the first table where it meets.  Null fingerprints are left out.
    """
    own = fps.where("fingerprint is not null").groupBy(F.col("fingerprint").alias("fp")).agg(F.count("*").alias("weight"))
    own = stored(own, "fingerprints")
    posts = posted(own, radius, heavy)
    place = ["t", "k", "k2"]
    crowd = (posts.groupBy(*place).count().where(F.col("count") > 1)
             .select(*place, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    posts = posts.join(crowd, place).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    two = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
        F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")))
    second = F.when(F.col("many"), F.substring_index("k2", ":", 1).cast("int")).otherwise(F.lit(-1))
    rows = posts.withColumn("at", F.explode(two)).select(
        F.xxhash64(*place, "at.i", "at.j").alias("g"), "block", "t", second.alias("second"), "weight",
        (F.col("at.i") == F.col("at.j")).cast("int").alias("within"), "fp")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "g").sortWithinPartitions("g", "block", "fp")
    width = 32 // (radius + 1)
    part = (32 - width) // (radius + 1)

    def columns(batch):
        digits = np.frombuffer("".join(batch.column(6).to_pylist()).encode(), np.uint8).reshape(-1, 32)
        return [batch.column(i).to_numpy() for i in range(6)] + [digits]

    def compare(g):
        _, block, t, second, weight, within, digits = g
        t, second = int(t[0]), int(second[0])
        fp = np.frombuffer(bytes.fromhex(digits.tobytes().decode()), np.uint64).reshape(-1, 2)
        x, y = np.flatnonzero(block == block[0]), np.flatnonzero(block == block[-1])
        count = np.zeros(len(fp), np.int64)
        for s in range(0, len(x), 256):
            rows = x[s:s + 256]
            near = np.bitwise_count(fp[rows, 0][:, None] ^ fp[y, 0]) + np.bitwise_count(fp[rows, 1][:, None] ^ fp[y, 1]) <= radius
            if within[0]:
                near &= rows[:, None] < y[None, :]
            r, c = np.nonzero(near)
            for b in range(0, len(r), 50_000):
                p, q = rows[r[b:b + 50_000]], y[c[b:b + 50_000]]
                same = digits[p] == digits[q]
                new = np.ones(len(p), bool)
                for i in range(t):
                    new &= ~same[:, i * width:(i + 1) * width].all(1)
                rest = np.delete(same, np.s_[t * width:(t + 1) * width], axis=1)
                for i in range(second):
                    new &= ~rest[:, i * part:(i + 1) * part].all(1)
                np.add.at(count, p[new], weight[q[new]])
                np.add.at(count, q[new], weight[p[new]])
        return count

    def run(batches):
        for group in groups(batches, columns):
            if len(group[0]) > 1 and (group[5][0] or group[1][0] != group[1][-1]):  # a block may be empty
                count = compare(group)
                has = np.flatnonzero(count)
                if len(has):
                    names = [bytes(d).decode() for d in group[6][has]]
                    yield pa.RecordBatch.from_pydict({"fp": pa.array(names, pa.string()), "n": pa.array(count[has], pa.int64())})

    found = rows.mapInArrow(run, "fp string, n long")
    # rows of an equal fingerprint are near too
    every = found.unionByName(own.where("weight > 1").select("fp", (F.col("weight") - 1).alias("n")))
    return every.groupBy(F.col("fp").alias("fingerprint")).agg(F.sum("n").alias("n_near"))


def fingerprint_documents(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``with_next`` and n_near: how many other rows of the table have a fingerprint within the radius (equal ones too)."""
    rows = stored(with_next(docs), "simhash")
    near = stored(near_counts(rows, radius), "simhash-near")
    return rows.join(near, "fingerprint", "left").select(*rows.columns, F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))

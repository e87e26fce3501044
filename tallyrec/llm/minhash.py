"""MinHash near-duplicates by an inverted join on signature coordinates (operator 5).

A document's set is its distinct five-word shingles.  Documents of equal sets are one class with the smallest
id as its representative.  Representatives are posted under each (coordinate, value) pair of
a signature of ``COORDINATES`` minima.  A pair must agree in ``MATCHES`` coordinates, so it must meet in the
``COORDINATES - MATCHES + 1`` rarest of either one's pairs: only those lists are merged, the longer ones are
skipped, and values that occur once drop out.  Met pairs count all agreeing coordinates, and those with
enough are confirmed on the full sets.

Lists may be long (a large group of near copies).  So first each list is dealt into blocks and every member is
compared with its block's leader, which joins such groups; then lists whose members are still in
several components are compared in full, block against block, inside the tasks.  What comes out is one row a
member of two blocks with its partners, never a row a pair; it meets the member's text once, and the task that has all texts
of the two blocks confirms the pairs there, best first, leaving out those that its links have joined already.
So no link that joins anything is left out by the size of a list, and no list is expanded into all its pairs.

At similarity 0.75 the number of agreeing coordinates is binomial (64, 0.75): the threshold 30 misses
4 pairs in 10 million there, and fewer above.  Null texts count as empty; empty texts and texts of blanks have an empty set and link
with nothing.  Rows of one doc_id are one document, linked to itself only; null ids link with nothing and are their own component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm import flat
from tallyrec.llm.common import map_arrow, map_slices, only_among, slices, stored
from tallyrec.llm.components import components

SHINGLE, COORDINATES, MATCHES = 5, 64, 30
LEADERS, BLOCK = 64, 1024  # members of a leader's block; members of a block compared in full
BLOCK_SHINGLES = 1 << 21  # shingles of such a block, so that a task can hold the sets of two (32 MB)
_random = np.random.default_rng(20070)
FACTOR = _random.integers(1 << 62, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts in order (with repeats), and the first of each text.

    Words are runs without blanks (0x20, 0x09 to 0x0D), A-Z in lower case; fewer than five words are one shingle.
    """
    codes, begin = flat.code_points(texts)
    codes = np.where((codes >= 9) & (codes <= 13), np.uint32(32), codes)
    codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)
    h, start = flat.words(codes, begin)
    size = np.diff(start)
    count = np.maximum(size - SHINGLE + 1, np.minimum(size, 1))
    first = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(start[:-1] - first[:-1], count) + np.arange(first[-1])
    end = np.repeat(start[1:], count)
    out = np.zeros(len(at), np.uint64)
    for i in range(SHINGLE):
        inside = at + i < end
        out[inside] = flat.mix(out[inside] * flat.M + h[at[inside] + i])
    return out, first


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two digests of the set, signature (null for an empty set)."""

    def make():
        def run(doc_ids, texts):
            h, first = shingles(texts)
            parts = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            sizes = np.array([len(p) for p in parts], np.int64)
            sets = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            begin = np.concatenate([[0], np.cumsum(sizes)])
            full = np.flatnonzero(sizes)
            sig = np.zeros((len(parts), COORDINATES), np.int32)
            d1, d2 = np.zeros(len(parts), np.uint64), np.zeros(len(parts), np.uint64)
            if len(full):
                cut = begin[:-1][full]
                for k in range(COORDINATES):
                    low = np.minimum.reduceat(sets * FACTOR[k] + SHIFT[k], cut)
                    sig[full, k] = (flat.mix(low) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                d1[full] = np.add.reduceat(sets, cut)
                d2[full] = np.add.reduceat(flat.mix(sets + flat.M), cut)
            listed = [s if n else None for s, n in zip(sig, sizes, strict=True)]
            return [doc_ids, sizes, d1.view(np.int64), d2.view(np.int64), listed]

        return run

    return map_slices(docs.select("doc_id", "text"), make,
                      "doc_id long, n_shingles long, d1 long, d2 long, signature array<int>")


def postings(reps: DataFrame) -> DataFrame:
    """(key, id, df, rank, back, mask): each representative under the rarest of its pairs, those that occur once left out.

    rank, back: place of the pair among the representative's kept ones, from the rarest and from the most frequent
    (equal counts: by pair); mask: the coordinates of the kept ones as bits.
    """
    value = F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    all_ = reps.select("id", F.posexplode("signature").alias("c", "v")).select(
        "id", (F.shiftleft(F.col("c").cast("long"), 32) + value).alias("key"))
    often = all_.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    # a pair needs MATCHES values that others have too; the rest of a signature are values of df 1, which come first
    mine = (all_.join(often, "key").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("own"))
            .where(F.size("own") >= MATCHES))
    alone = F.lit(COORDINATES) - F.size("own")
    kept = F.slice("own", F.lit(1), F.lit(COORDINATES - MATCHES + 1) - alone)
    mask = F.aggregate("kept", F.lit(0).cast("long"), lambda m, p: m.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(p["key"], 32).cast("int"))))
    mine = mine.select("id", kept.alias("kept")).withColumn("mask", mask)
    return (mine.select("id", "mask", F.size("kept").alias("n"), F.posexplode("kept").alias("rank", "p"))
            .select("p.key", "id", "p.df", "rank", (F.col("n") - 1 - F.col("rank")).alias("back"), "mask"))


def agreeing(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def jaccard_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= 75 * union."""
    rows = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb"))

    def run(batches):
        last_id, last = None, None
        for batch in batches:
            for a, b, ta, tb in slices(batch, 3, 1_000_000):
                h, first = shingles(tb)
                out_a, out_b = [], []
                for i in range(len(a)):
                    if a[i] != last_id:  # rows of one a follow each other after a sort-merge join
                        last_id, last = a[i], np.unique(shingles([ta[i]])[0])
                    other = np.unique(h[first[i]:first[i + 1]])
                    common = len(np.intersect1d(last, other, assume_unique=True))
                    if 100 * common >= 75 * (len(last) + len(other) - common):
                        out_a.append(a[i])
                        out_b.append(b[i])
                yield pa.RecordBatch.from_pydict({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return map_arrow(rows, run, "a long, b long")


def leader_pairs(posts: DataFrame, seed: int) -> DataFrame:
    """Each member of a list with the leader of its block (of about LEADERS members)."""
    blocks = F.ceil(F.col("df") / LEADERS)
    block = F.pmod(F.xxhash64("key", "id", F.lit(seed)), blocks)
    group = posts.select("key", "id", block.alias("block"), F.struct(F.xxhash64("id", F.lit(seed)).alias("h"), "id").alias("o"))
    lead = group.groupBy("key", "block").agg(F.min("o").alias("lead")).select("key", "block", F.col("lead.id").alias("lead"))
    met = group.join(lead, ["key", "block"]).where("lead <> id")
    return met.select(F.least("lead", "id").alias("a"), F.greatest("lead", "id").alias("b")).distinct()


def partners(posts: DataFrame, signed: DataFrame, labels: DataFrame) -> DataFrame:
    """(g, id, component, other, agree): members of two blocks with those of other components in them that agree in
    MATCHES coordinates and may be similar by size; members that are only named by others have no partners.

    Lists with one component left are done.  The others are dealt into blocks of about BLOCK members or BLOCK_SHINGLES
    shingles; a task compares two blocks.  A pair comes out of the first list only in which both are posted.
    """
    named = (posts.select("key", "id", "mask").join(labels, "id", "left")
             .withColumn("component", F.coalesce("component", "id")).join(signed.select("id", "d1", "n_shingles"), "id"))
    open_ = (named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"),
                                      F.sum("n_shingles").alias("load")).where("lo < hi")
             .select("key", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("load") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    named = named.join(open_, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    i = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
        F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j"))))
    dealt = named.withColumn("at", i).select(
        F.xxhash64("key", "at.i", "at.j").alias("g"), "id", "d1", "component", "block", "n_shingles", "mask",
        F.shiftright("key", 32).alias("coordinate"))
    # signatures join what is left: they are the longest column
    dealt = dealt.join(signed.select("id", "d1", "signature"), ["id", "d1"]).select(
        "g", "id", "component", "block", "n_shingles", "signature", "mask", "coordinate")
    n = int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "g").sortWithinPartitions("g", "block", "id")

    def compare(g):
        _, ids, comp, block, size, sig, mask, coordinate = g
        posted = (mask[:, None] >> np.arange(COORDINATES) & 1).astype(bool)
        x, y = np.flatnonzero(block == block[0]), np.flatnonzero(block == block[-1])
        found = []
        for s in range(0, len(x), 64):
            rows = x[s:s + 64]
            agree = np.zeros((len(rows), len(y)), np.int16)
            for k in range(COORDINATES):
                agree += sig[rows, k][:, None] == sig[y, k][None, :]
            good = (agree >= MATCHES) & (comp[rows][:, None] != comp[y][None, :])
            if block[0] == block[-1]:
                good &= rows[:, None] < y[None, :]  # one block with itself: each pair once
            good &= 100 * np.minimum(size[rows][:, None], size[y][None, :]) >= 75 * np.maximum(size[rows][:, None], size[y][None, :])
            r, c = np.nonzero(good)
            for b in range(0, len(r), 20_000):
                p, q, like = rows[r[b:b + 20_000]], y[c[b:b + 20_000]], agree[r[b:b + 20_000], c[b:b + 20_000]]
                both = (sig[p] == sig[q]) & posted[p] & posted[q]
                first = both.argmax(1) == coordinate[0]
                found.append(np.stack([p[first], q[first], like[first]]))
        if not found:
            return None
        p, q, like = np.concatenate(found, axis=1)
        order = np.argsort(p, kind="stable")
        p, q, like = p[order], q[order], like[order]
        rows = np.union1d(p, q)
        cut = np.concatenate([np.searchsorted(p, rows), [len(p)]]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(cut, pa.array(v)) for v in (ids[q], like.astype(np.int16))]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in (g[0][rows], ids[rows], comp[rows])] + lists, names=["g", "id", "component", "other", "agree"])

    def columns(batch):
        sig = batch.column(5)
        flat_sig = sig.flatten().to_numpy().reshape(-1, COORDINATES)
        return [batch.column(i).to_numpy() for i in range(5)] + [flat_sig] + [batch.column(i).to_numpy() for i in (6, 7)]

    def run(batches):
        for group in groups(batches, columns):
            got = compare(group) if len(group[0]) > 1 else None
            if got is not None:
                yield got

    return map_arrow(dealt, run, "g long, id long, component long, other array<long>, agree array<short>")


def groups(batches, columns):
    """The rows of each value of the first column, as arrays, of batches sorted by it."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = columns(batch)
        if held is not None:
            now = [np.concatenate([h, c]) for h, c in zip(held, now, strict=True)]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(now[0])) + 1])
        for b, e in zip(cuts[:-1], cuts[1:], strict=True):
            yield [c[b:e] for c in now]
        held = [c[cuts[-1]:] for c in now]
    if held is not None:
        yield held


def confirmed(met: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) among the partners of each g: the full sets have 100 * intersection >= 75 * union.

    Pairs are tried from the most agreeing on; those whose components are joined by links of the same g already are left out,
    as they join nothing.
    """
    n = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = met.join(texts, "id").select("g", "id", "component", "other", "agree", "text")
    rows = rows.repartition(n, "g").sortWithinPartitions("g", "id")

    def columns(batch):
        # a text is turned into its set at once: what is held of a group are the sets
        sets = np.empty(batch.num_rows, object)
        done = 0
        for texts_ in slices(batch.select(["text"]), 0, 1_000_000):
            h, first = shingles(texts_[0])
            for i in range(len(first) - 1):
                sets[done + i] = np.unique(h[first[i]:first[i + 1]])
            done += len(first) - 1
        lists = [[x.values.to_numpy() for x in batch.column(i)] for i in (3, 4)]
        return [batch.column(i).to_numpy() for i in range(3)] + [objects_of(v) for v in lists] + [sets]

    def objects_of(values):
        out = np.empty(len(values), object)
        for i, v in enumerate(values):
            out[i] = v
        return out

    def run(batches):
        for _, ids, component, other, agree, sets in groups(batches, columns):
            size = np.array([len(x) for x in other])
            p = np.repeat(np.arange(len(ids)), size)
            q = np.searchsorted(ids, np.concatenate(other).astype(np.int64))
            top = dict.fromkeys(component.tolist())  # a joined component points to another one

            def root(c):
                while top[c] is not None:
                    if top[top[c]] is not None:
                        top[c] = top[top[c]]
                    c = top[c]
                return c

            comp, out_a, out_b = component.tolist(), [], []
            for k in np.argsort(-np.concatenate(agree).astype(np.int64), kind="stable").tolist():
                i, j = int(p[k]), int(q[k])
                x, y = root(comp[i]), root(comp[j])
                if x == y:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    top[max(x, y)] = min(x, y)
                    out_a.append(min(ids[i], ids[j]))
                    out_b.append(max(ids[i], ids[j]))
            if out_a:
                yield pa.RecordBatch.from_pydict({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return map_arrow(rows, run, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    base = stored(signatures(docs), "minhash-signatures")
    whole = base.where("n_shingles > 0 and doc_id is not null")
    # equal sets have equal signatures
    classes = whole.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"))
    classes = stored(classes, "minhash-classes")
    # sets of one or two shingles are similar only if equal
    signed = classes.where("n_shingles >= 3").select("id", "d1", "n_shingles", "signature")
    posts = stored(postings(signed), "minhash-postings")
    members = stored(posts.select("id").distinct(), "minhash-ids")
    signed = stored(only_among(signed, members, "id"), "minhash-members")
    texts = only_among(docs.select(F.col("doc_id").alias("id"), "text"), members, "id").dropDuplicates(["id"])
    texts = stored(texts, "minhash-texts")

    def near(pairs: DataFrame) -> DataFrame:
        a = signed.select(F.col("id").alias("a"), F.col("signature").alias("sa"), F.col("n_shingles").alias("na"))
        b = signed.select(F.col("id").alias("b"), F.col("signature").alias("sb"), F.col("n_shingles").alias("nb"))
        like = pairs.join(b, "b").join(a, "a").where(100 * F.least("na", "nb") >= 75 * F.greatest("na", "nb"))
        return like.where(agreeing(F.col("sa"), F.col("sb")) >= MATCHES).select("a", "b")

    def renamed(pairs: DataFrame) -> DataFrame:
        """Pairs of components, from pairs of ids."""
        for c in "ab":
            pairs = pairs.join(labels.select(F.col("id").alias(c), F.col("component").alias("c" + c)), c, "left")
        return pairs.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")).where("ca <> cb")

    def merged(links: DataFrame) -> DataFrame:
        """Labels after more links: components of the present components."""
        over = components(renamed(links).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
        over = over.select(F.col("id").alias("component"), F.col("component").alias("top"))
        return stored(labels.join(over, "component", "left").select("id", F.coalesce("top", "component").alias("component")), "minhash-labels")

    labels = members.select("id", F.col("id").alias("component"))
    # the most frequent kept list first, as it joins large groups with one pair a member; then a few more for what is still apart
    for seed, chosen in enumerate(["back = 0", "back between 1 and 3 or rank < 2"]):
        pairs = leader_pairs(posts.where(chosen), seed)
        if seed:
            pairs = renamed(pairs).select("a", "b")
        labels = merged(stored(jaccard_links(near(pairs), texts), "minhash-links"))
    labels = merged(stored(confirmed(partners(posts, signed, labels), texts), "minhash-links"))
    named = classes.join(labels, "id", "left").select("d1", "d2", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    of_row = base.select("doc_id", "d1", "d2", "n_shingles").join(named, ["d1", "d2", "n_shingles"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return of_row.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

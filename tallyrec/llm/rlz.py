"""Substring dedup: relative Lempel-Ziv parsing against indexed reference blocks.

A window is 50 consecutive words.  Every window has one anchor, the 25-word gram of least hash in it (the leftmost
of equals): equal windows have equal anchors at the same offset.  The collection is its own reference: of each
gram that anchors windows in two documents, the first occurrence (least doc_id, then position) is kept.
``BLOCK`` consecutive word positions of a document make a reference block, cut down to the stretch around its first
occurrences; the index leads from gram to document, position and so to the block.

Every other occurrence sends a stretch of its document to the block it is indexed in.  There the stretch is factored
greedily from left to right: at the next word not yet in a factor where the index knows a gram, the longest match that
holds it, to both sides.  A factor of 50 words or more against a document with a smaller doc_id is a duplicate span.
Windows that reach over the end of a factor are checked at factor boundaries: a window that its block does not hold can
still be equal to one of another document that its block does not hold either, so these windows alone, few at
each end of a factor, meet by their digests (128 bits of their words) over all documents.

Nothing is compared pair by pair: an occurrence meets one block, however many documents share it, and a block is a
bounded stretch.  Hot grams, blocks and windows meet in joins that Spark splits, after sums that are formed before
the shuffle.  Texts travel compressed.

Nulls: a null text has no words.  Documents of null doc_id lose nothing and are no reference.  Empty and short texts
(under 50 words) lose nothing.  Ties: rows of one doc_id are no reference to each other (none is smaller).
Repeated rows give repeated result rows.  Very long texts are cut into stretches.  An empty table has no rows.  Columns
other than doc_id and text are left aside, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.common import map_slices, stored
from tallyrec.llm.flat import M, code_points, mix
from tallyrec.llm.flat import words as word_hashes

WINDOW, GRAM = 50, 25
BLOCK = 256             # word positions of a reference block
GAP = 100               # anchors of a document further apart than this lie in different stretches
ORDER = (1 << 28) - 1   # low bits of a gram's rank: its place, so that the leftmost of equals comes first


def grams(text_words: np.ndarray) -> np.ndarray:
    """Hash of the GRAM words from each word on (the last have none)."""
    sums, power, n = {1: text_words}, {1: int(M)}, 1
    while 2 * n <= GRAM:
        p = sums[n]
        sums[2 * n] = p[:max(len(p) - n, 0)] * np.uint64(power[n]) + p[n:]
        power[2 * n] = power[n] * power[n] % (1 << 64)
        n *= 2
    total, at = sums[n], n
    while at < GRAM:
        n //= 2
        if at + n <= GRAM:
            tail = sums[n][at:]
            total = total[:len(tail)] * np.uint64(power[n]) + tail[:len(total)]
            at += n
    return mix(total)


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the first word of each text (with the total at the end)."""
    codes, begin = code_points(texts)
    codes = np.where((codes >= 9) & (codes <= 13), np.uint32(32), codes)
    h, first = word_hashes(codes, begin)
    return h, np.append(first[:-1], len(h))


def anchors_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, gram, position, first window, last window) of every anchor; positions within the text."""
    h, first = words_of(texts)
    count = np.maximum(first[1:] - first[:-1] - WINDOW + 1, 0)  # windows of each text
    total = int(count.sum())
    text = np.repeat(np.arange(len(texts)), count)
    starts = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + first[:-1][text]
    if not total:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 4)
    g = grams(h)
    rank = (g & ~np.uint64(ORDER)) | (np.arange(len(g), dtype=np.uint64) & np.uint64(ORDER))
    least, width, reach = rank, 1, WINDOW - GRAM + 1
    while 2 * width <= reach:
        least, width = np.minimum(least[:len(least) - width], least[width:]), 2 * width
    least = np.minimum(least[:len(least) - (reach - width)], least[reach - width:])
    place = (least[starts] & np.uint64(ORDER)).astype(np.int64)
    place += (starts - place + ORDER // 2) // (ORDER + 1) * (ORDER + 1)  # places beyond 2**28
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    last = np.append(head[1:], total) - 1
    base = first[:-1][text[head]]
    return text[head], g[place[head]], place[head] - base, starts[head] - base, starts[last] - base


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, key, body): compressed UTF-8 texts; ``key`` tells texts of one doc_id apart."""
    def make():
        pack = zstandard.ZstdCompressor(level=1)

        def f(ids, keys, texts):
            return ids, keys, [pack.compress(t.encode("utf-8", "surrogatepass")) for t in texts]
        return f

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("key"), text.alias("text"))
    return map_slices(rows, make, "doc_id long, key long, body binary")


def unpack(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)


def anchors(docs: DataFrame) -> DataFrame:
    """(g, doc_id, pos, run): run = first window's distance to pos * 32 + length of the run of windows - 1."""
    def make():
        def f(ids, texts):
            text, g, pos, first, last = anchors_of(texts)
            return g.view(np.int64), np.array(ids, np.int64)[text], pos, ((pos - first) * 32 + last - first).astype(np.int32)
        return f

    rows = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    return map_slices(rows, make, "g long, doc_id long, pos long, run int")


def stretches(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """Cut texts around their hits: (r, block, ref, doc_id, key, base, words, marks).

    ``hits``: (g, doc_id, pos, run, r, q).  ``base`` is the position of the first word, ``marks`` holds (pos, q, first
    window, last window) of every hit, one after the other.
    """
    asks = hits.groupBy("doc_id").agg(F.collect_list(F.struct("g", "pos", "run", "r", "q")).alias("asks"))
    schema = ("r long, block long, ref boolean, doc_id long, key long, base long, words binary, marks array<long>")

    def make():
        def f(ids, keys, bodies, all_asks):
            out = []
            for doc, key, body, asks in zip(ids, keys, bodies, all_asks, strict=True):
                raw = unpack(body)
                text = raw.split()
                if len(text) < WINDOW:
                    continue
                g = grams(words_of([raw.decode("utf-8", "surrogatepass")])[0]).view(np.int64)
                open_, ready = {}, []  # stretches that may go on, by block
                for a in sorted(asks, key=lambda a: (a["pos"], a["q"])):
                    pos, q, r = a["pos"], a["q"], a["r"]
                    if pos >= len(g) or g[pos] != a["g"]:
                        continue  # of another text with this doc_id
                    to = r, q // BLOCK, r == doc and q == pos
                    if to in open_ and (to[2] or pos - open_[to][-4] <= GAP):
                        marks = open_[to]
                    else:
                        marks = open_[to] = []
                        ready.append((to, marks))
                    first = pos - a["run"] // 32
                    marks += [pos, q, first, first + a["run"] % 32]
                for (r, block, ref), marks in ready:
                    base, end = max(0, marks[0] - GRAM), min(len(text), marks[-4] + WINDOW)
                    out.append((r, block, ref, doc, key, base, b" ".join(text[base:end]), marks))
            return list(zip(*out, strict=True)) if out else [[]] * 8
        return f

    rows = documents(docs.where("doc_id is not null and text is not null")).join(asks, "doc_id")
    return map_slices(rows, make, schema, text="body", budget=1_000_000)


def factors(d: np.ndarray, r: np.ndarray, seeds: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Greedy factors (begin, end, place in the reference) of words d against words r, from seeds (place in d, in r)."""
    out, reached = [], {}
    for p, q in seeds:
        shift = p - q
        if p < reached.get(shift, 0):
            continue  # inside a factor of this alignment
        left = min(p, q)
        apart = d[p - left:p][::-1] != r[q - left:q][::-1]
        left = int(apart.argmax()) if apart.any() else left
        right = min(len(d) - p, len(r) - q)
        apart = d[p:p + right] != r[q:q + right]
        right = int(apart.argmax()) if apart.any() else right
        reached[shift] = p + right
        out.append((p - left, p + right, q - left))
    return out


def parse(cut: DataFrame) -> DataFrame:
    """Factor every stretch against its block: (doc_id, key, spans, starts, digests).

    ``spans``: begin and end of the words that lie in duplicate windows.  ``starts``, ``digests``: windows over the ends of
    factors, to be checked over all documents.
    """
    ref = cut.where("ref").select("r", "block", F.col("base").alias("ref_base"), F.col("words").alias("ref_words"))
    pairs = (cut.where("not ref").join(ref, ["r", "block"])
             .select("r", "doc_id", "key", "base", "words", "marks", "ref_base", "ref_words"))

    def make():
        last = [None, {}, None]

        def f(rs, ids, keys, bases, words, marks, ref_bases, ref_words):
            out = []
            for r, doc, key, base, w, m, ref_base, ref in zip(rs, ids, keys, bases, words, marks, ref_bases, ref_words, strict=True):
                if last[0] != ref:
                    number = {}
                    last[:] = [ref, number, np.array([number.setdefault(x, len(number)) for x in ref.split(b" ")])]
                text = w.split(b" ")
                d = np.array([last[1].get(x, -1) for x in text])
                seeds = [(m[i] - base, m[i + 1] - ref_base) for i in range(0, len(m), 4)]
                known = [(p, q) for p, q in seeds if 0 <= q < len(last[2])]
                found = [x for x in factors(d, last[2], known) if x[1] - x[0] >= WINDOW]
                spans, starts, digests = [], [], []
                for i, (p, q) in enumerate(seeds):
                    first, end = m[4 * i + 2] - base, m[4 * i + 3] - base + 1
                    mine = [(b, e) for b, e, at in found if b - at == p - q and b <= p < e]
                    low = max([first, *(b for b, _ in mine)])
                    high = min([end, *(e - WINDOW + 1 for _, e in mine)])
                    if not mine or low >= high:
                        low = high = end
                    elif r < doc:
                        spans += [base + low, base + high - 1 + WINDOW]
                    for s in (*range(first, low), *range(high, end)):
                        starts.append(base + s)
                        digests.append(hashlib.blake2b(b" ".join(text[s:s + WINDOW]), digest_size=16).digest())
                if spans or starts:
                    out.append((doc, key, spans, starts, digests))
            return list(zip(*out, strict=True)) if out else [[]] * 5
        return f

    return map_slices(pairs, make, "doc_id long, key long, spans array<long>, starts array<long>, digests array<binary>",
                      text="words", budget=500_000)


def duplicate_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, spans): begin and end, in words, of all duplicate windows of a text; they may overlap."""
    every = stored(anchors(docs), "lz-anchors")
    index = (every.groupBy("g").agg(F.min(F.struct("doc_id", "pos")).alias("at"), F.max("doc_id").alias("last"))
             .where("at.doc_id < last").select("g", F.col("at.doc_id").alias("r"), F.col("at.pos").alias("q")))
    index = stored(index, "lz-index")  # joined as a table: Spark splits a hot gram where both sides are plain shuffles
    cut = stored(stretches(docs, every.join(index, "g")), "lz-stretches")
    parsed = stored(parse(cut), "lz-factors")
    over = (parsed.select("doc_id", "key", F.explode(F.arrays_zip("starts", "digests")).alias("w"))
            .select("doc_id", "key", F.col("w.starts").alias("start"), F.col("w.digests").alias("digest")))
    held = (over.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"))
            .where("least < last").select("digest", "least"))
    held = stored(held, "lz-windows")
    also = (over.join(held, "digest").where("doc_id > least")
            .select("doc_id", "key", F.array("start", F.col("start") + WINDOW).alias("spans")))
    return (parsed.where("size(spans) > 0").select("doc_id", "key", "spans").unionByName(also)
            .groupBy("doc_id", "key").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def without_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document; ``with_text`` adds the kept words as ``kept_text``."""
    def make():
        def f(ids, _keys, bodies, all_spans):
            n, gone, digests, texts = [], [], [], []
            for body, spans in zip(bodies, all_spans, strict=True):
                words = unpack(body).split()
                n.append(len(words))
                if spans:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, spans[::2], 1)
                    np.add.at(edge, spans[1::2], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                gone.append(n[-1] - len(words))
                kept = b" ".join(words)
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode("utf-8", "surrogatepass") if with_text else None)
            return [ids, n, gone, digests, texts][:5 if with_text else 4]
        return f

    rows = documents(docs).join(duplicate_spans(docs), ["doc_id", "key"], "left").select("doc_id", "key", "body", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return map_slices(rows, make, schema, text="body", budget=1_000_000)

"""Edit-aware token counts (operator 6).

Every document's pre-tokens stand in a segment tree: a leaf is a block of up to
``block`` neighbouring pre-tokens with its characters and tokens, an inner node the sums of its
two children.  An edit re-encodes from a boundary before its first character (far
enough back that no earlier pre-token can have looked at it) until the new
boundaries meet an old one behind its last character; the leaves between get the new
pre-tokens and the sums on their paths to the root are renewed.  The documents of a slice go through
their edits side by side, so that the new pre-tokens of a round are encoded together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.bpe import Codec, codec
from tallyrec.llm.common import map_slices

LOOK = 3  # a pre-token's end depends on at most two characters behind it (the contractions 're, 've, 'll)


class CountTree:
    """Pre-token counts of one text."""

    def __init__(self, c: Codec, text: str, counts, block: int = 32, tokens: list[str] | None = None):
        self.c, self.text, self.block, self.counts = c, text, block, counts
        self.reencoded = 0
        self.marked = self._has_marks(text)
        tokens = c.pre_tokens(text) if tokens is None else tokens
        self._build(tokens, counts(tokens))

    def _has_marks(self, text: str) -> bool:
        return any(s in text for s in self.c.v.special)

    def _build(self, tokens: list[str], got: list[int]) -> None:
        lens, b = list(map(len, tokens)), self.block
        self.leaves = [(lens[i:i + b], got[i:i + b]) for i in range(0, len(tokens), b)] or [([], [])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars = np.zeros(2 * self.size, np.int64)
        self.tokens = np.zeros(2 * self.size, np.int64)
        n = len(self.leaves)
        self.chars[self.size:self.size + n] = [sum(x[0]) for x in self.leaves]
        self.tokens[self.size:self.size + n] = [sum(x[1]) for x in self.leaves]
        half = self.size
        while half > 1:
            for tree in (self.chars, self.tokens):
                tree[half // 2:half] = tree[half:2 * half:2] + tree[half + 1:2 * half:2]
            half //= 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def _set(self, leaf: int, lens: list[int], toks: list[int]) -> None:
        self.leaves[leaf] = (lens, toks)
        node = self.size + leaf
        self.chars[node], self.tokens[node] = sum(lens), sum(toks)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf with character ``at`` and the leaf's first character, going down the sums."""
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            if at >= begin + self.chars[node] and self.chars[node + 1]:
                begin += int(self.chars[node])
                node += 1
        return min(node - self.size, len(self.leaves) - 1), begin

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace characters [start, stop) by ``new``; bounds beyond the text are cut to it."""
        self.close(self.counts(self.open(start, stop, new)))

    def open(self, start: int, stop: int, new: str) -> list[str]:
        """First half of an edit: the pre-tokens that it makes; ``close`` takes their counts.

        Many trees can so have their new pre-tokens encoded together.
        """
        start = min(max(start, 0), len(self.text))
        stop = min(max(stop, start), len(self.text))
        self.text = self.text[:start] + new + self.text[stop:]
        marked, self.marked = self.marked, self._has_marks(self.text)
        if marked or self.marked:
            # a special token cuts the text before pre-tokens are found: such a text is encoded anew as a whole
            self.pending = None, self.c.pre_tokens(self.text)
            return self.pending[1]
        shift = len(new) - (stop - start)
        first, begin = self._leaf(max(start - LOOK, 0))
        lens, toks = self.leaves[first]
        keep, pos = 0, begin
        while keep < len(lens) and pos + lens[keep] <= start - LOOK:
            pos += lens[keep]
            keep += 1
        lens, toks = lens[:keep], toks[:keep]
        # old boundaries behind the edit, leaf by leaf
        leaf, old_at, inside = first, begin, 0
        fresh, scan, met = [], pos, None
        for m in self.c.pattern.finditer(self.text, pos):
            scan = m.end()
            fresh.append(m.group())
            if scan < start + len(new):
                continue
            old = scan - shift
            while leaf < len(self.leaves) and (old_at < old or inside < len(self.leaves[leaf][0])):
                if inside == len(self.leaves[leaf][0]):
                    leaf, inside = leaf + 1, 0
                elif old_at < old:
                    old_at += self.leaves[leaf][0][inside]
                    inside += 1
                else:
                    break
            if old_at == old and old >= stop:
                met = (leaf, inside)
                break
        if met is None:
            met = (len(self.leaves), 0)
        self.pending = (first, lens, toks, met), fresh
        return fresh

    def close(self, got: list[int]) -> None:
        """Second half of an edit: the counts of the pre-tokens that ``open`` gave."""
        place, fresh = self.pending
        self.reencoded += sum(map(len, fresh))
        if place is None:
            self._build(fresh, got)
            return
        first, lens, toks, met = place
        lens, toks = lens + list(map(len, fresh)), toks + got
        leaf, inside = met
        if leaf < len(self.leaves):
            rest = self.leaves[leaf]
            lens, toks = lens + rest[0][inside:], toks + rest[1][inside:]
        last = min(leaf, len(self.leaves) - 1)
        spread = -(-len(lens) // (last - first + 1)) if last >= first else 0
        for i in range(first, last + 1):
            k = (i - first) * spread
            self._set(i, lens[k:k + spread], toks[k:k + spread])


def edited_counts(docs: DataFrame, vocabulary_path: str, block: int = 32) -> DataFrame:
    """Token counts before and after edits.

    ``docs``: doc_id, text, edits (array of struct start, stop, new; code points of the text as it is
    after the edits before).  Returns doc_id, n_tokens, n_pre_tokens, edited_tokens, reencoded_chars.
    Null text: empty; null edits or fields: no edit, bound 0, nothing new.  Repeated rows count each.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def make():
        c = codec(shared.value, "count")

        special = c.v.special

        def learn(lists):
            known = set()
            for x in lists:
                known.update(x)
            c.learn(known.difference(special), len)

        def counts(tokens):
            try:
                return list(map(c.words.__getitem__, tokens))
            except KeyError:  # special tokens are not in the cache
                return [1 if t in special else c.words[t] for t in tokens]

        def run(doc_ids, texts, edits):
            c.words.trim()
            lists = [c.pre_tokens(t) if t else [] for t in texts]
            learn(lists)  # all pre-tokens of the slice are encoded together; the trees then look them up
            trees = [CountTree(c, t or "", counts, block, x) for t, x in zip(texts, lists, strict=True)]
            out = [doc_ids, [tree.total for tree in trees], list(map(len, lists))]
            todo = [(tree, [x for x in e if x is not None]) for tree, e in zip(trees, edits, strict=True) if e]
            at = 0
            while todo := [(tree, e) for tree, e in todo if len(e) > at]:  # the next edit of every document
                fresh = [tree.open(e[at]["start"] or 0, e[at]["stop"] or 0, e[at]["new"] or "") for tree, e in todo]
                c.words.trim()
                learn(fresh)
                for (tree, _), x in zip(todo, fresh, strict=True):
                    tree.close(counts(x))
                at += 1
            return out + [[tree.total for tree in trees], [tree.reencoded for tree in trees]]

        return run

    return map_slices(docs.select("doc_id", "text", "edits"), make,
                      "doc_id long, n_tokens long, n_pre_tokens long, edited_tokens long, reencoded_chars long")


def three_edits(docs: DataFrame) -> DataFrame:
    """The registered query's edits: delete 20 characters at a quarter, insert the first 30 at the
    middle, replace 25 at three quarters by the last 25."""
    n = F.char_length("text")

    def one(start, size, new):
        at = F.floor(start).cast("long")
        return F.struct(at.alias("start"), (at + size).alias("stop"), new.alias("new"))

    return docs.select("doc_id", "text", F.array(
        one(n / 4, 20, F.lit("")), one(n / 2, 0, F.substring("text", 1, 30)), one(n * 3 / 4, 25, F.expr("right(text, 25)")),
    ).alias("edits"))

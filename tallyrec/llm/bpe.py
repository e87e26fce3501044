"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding (operator 10).

For every prefix of a pre-token there is exactly one token that its encoding
can end with.  The tokens that are suffixes of a prefix come from an automaton
over the reversed vocabulary; a candidate ``t`` is the one if the boundary between
``t`` and the last token of the prefix before it is stable, i.e. no merge of BPE
crosses it.  Following the back-pointers from the end gives the ids.  Distinct
pre-tokens of a slice are solved together as numpy columns and remembered in a
bounded cache.

Null texts count as empty; an empty text has no ids.  Special tokens of the
vocabulary file found in a text become their own id, as in the tokenizers library.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import regex
from pyspark.sql import DataFrame

from tallyrec.llm.common import Recent, map_slices

# Fixed value: the pre-token pattern of byte-level BPE vocabularies of this family.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FREE = np.int64(1) << 40  # "never merged"


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files: itself if printable Latin-1, else 256 upwards."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Arrays of a vocabulary; internal numbers are 0-255 for bytes and 256 + rank for merges."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, letters = spec["model"], byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in model["vocab"]}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        number = {bytes([b]): b for b in range(256)}
        for rank, (a, b) in enumerate(pairs):
            joined = raw[a] + raw[b]
            if joined in number:
                raise ValueError("two merges make the same token")
            number[joined] = 256 + rank
        n = 256 + len(pairs)
        self.bytes = [b""] * n
        for token, i in number.items():
            self.bytes[i] = token
        self.ids = np.zeros(n, np.int64)
        for t, i in model["vocab"].items():
            if raw[t] in number:
                self.ids[number[raw[t]]] = i
        self.shown = [str(i) for i in self.ids.tolist()]
        self.length = np.array([len(b) for b in self.bytes], np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        for rank, (a, b) in enumerate(pairs):
            self.left[256 + rank], self.right[256 + rank] = number[raw[a]], number[raw[b]]
        key = self.left[256:] << 20 | self.right[256:]
        order = np.argsort(key)
        self.pair_key, self.pair_to = key[order], 256 + order
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self._automaton(self._own_encoding())

    def _own_encoding(self) -> np.ndarray:
        """Tokens whose own bytes encode to themselves; others can never occur in a result."""
        ok = np.ones(len(self.bytes), bool)
        ok[256:] = stable(self, self.left[256:], self.right[256:], np.arange(256, len(self.bytes)))
        for i in range(256, len(ok)):  # parts come before the whole
            ok[i] &= ok[self.left[i]] and ok[self.right[i]]
        return ok

    def _automaton(self, usable: np.ndarray) -> None:
        """Trie of the reversed tokens: sorted (state, byte) keys, next states, the token that ends there."""
        step: dict[int, int] = {}
        token = [-1]
        for i, word in enumerate(self.bytes):
            if not usable[i]:
                continue
            state = 0
            for b in reversed(word):
                key = state << 8 | b
                state = step.get(key) or step.setdefault(key, len(step) + 1)
                if state == len(token):
                    token.append(-1)
            token[state] = i
        key = np.fromiter(step, np.int64, len(step))
        order = np.argsort(key)
        self.step_key, self.step_to = key[order], np.fromiter(step.values(), np.int64, len(step))[order]
        self.state_token = np.array(token, np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def stable(v: Vocabulary, a: np.ndarray, b: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
    """Whether no merge crosses the boundary between tokens a and b (columns of numbers).

    Goes back in time from the finished tokens: the later made of the two parts
    at the boundary is undone, and every pair that stood at the boundary at some
    time is looked up.  A merge of rank m crosses if it came before the left part was
    used up, and not after the right part was (equal ranks are applied from the left).
    ``own``: the merge that joins the two on purpose and is no crossing.
    """
    ok = np.ones(len(a), bool)
    at = np.arange(len(a))
    x, y = a.copy(), b.copy()
    until_x, until_y = np.full(len(a), FREE), np.full(len(a), FREE)
    while len(at):
        pos, hit = _find(v.pair_key, x << 20 | y)
        made = np.where(hit, v.pair_to[pos], FREE)
        if own is not None:
            made = np.where(made == own[at], FREE, made)
            crossing = (made < until_x) & (made <= until_y) & (made < own[at])
        else:
            crossing = (made < until_x) & (made <= until_y)
        ok[at[crossing]] = False
        go = ~crossing & ((x >= 256) | (y >= 256))
        at, x, y, until_x, until_y = at[go], x[go], y[go], until_x[go], until_y[go]
        undo = x > y
        until_x, until_y = np.where(undo, x, until_x), np.where(undo, until_y, y)
        x, y = np.where(undo, v.right[x], x), np.where(undo, y, v.left[y])
    return ok


class Codec:
    """Encodes pre-tokens; remembers boundary tests in a direct-mapped table."""

    BITS = 20

    def __init__(self, text: str, cache: int = 150_000):
        self.v = Vocabulary(text)
        self.pattern = regex.compile(PRE_TOKEN)
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.v.special)) + ")") if self.v.special else None
        self.seen_key = np.full(1 << self.BITS, -1, np.int64)
        self.seen_ok = np.zeros(1 << self.BITS, bool)
        self.words = Recent(cache)

    def _stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        slot = ((key * np.int64(0x9E3779B97F4A7C1 | 1)) >> np.int64(33)) & ((1 << self.BITS) - 1)
        ok = self.seen_ok[slot]
        miss = np.flatnonzero(self.seen_key[slot] != key)
        if len(miss):
            fresh = stable(self.v, a[miss], b[miss])
            ok[miss] = fresh
            # one writer per slot: key and answer must belong together
            s, first = np.unique(slot[miss], return_index=True)
            self.seen_key[s], self.seen_ok[s] = key[miss][first], fresh[first]
        return ok

    def solve(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words' tokens, one after the other, and the count of each word."""
        sizes = np.array([len(w) for w in words], np.int64)
        order = np.argsort(sizes, kind="stable")
        groups, begin = [], 0
        while begin < len(order):  # words of like length share a matrix
            top = max(16, 2 * int(sizes[order[begin]]))
            end = int(np.searchsorted(sizes[order], top, side="right"))
            end = min(end, begin + max(1, 2_000_000 // top))
            groups.append(order[begin:end])
            begin = end
        count = np.zeros(len(words), np.int64)
        parts = []
        for g in groups:
            owner, tokens = self._group([words[i] for i in g], sizes[g])
            count[g] = np.bincount(owner, minlength=len(g))
            parts.append((g[owner], tokens))
        owner = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
        tokens = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
        return tokens[np.argsort(owner, kind="stable")], count

    def _group(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v, n, width = self.v, len(words), int(sizes.max(initial=0))
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        word = np.repeat(np.arange(n), sizes)
        end = np.arange(len(flat)) - begin[word] + 1
        # every vocabulary token that is a suffix of a prefix: walk back from all ends at once
        at, state = np.arange(len(flat)), np.zeros(len(flat), np.int64)
        found = []
        depth = 0
        while len(at):
            pos, hit = _find(v.step_key, state << 8 | flat[at - depth])
            at, state = at[hit], v.step_to[pos[hit]]
            depth += 1
            token = v.state_token[state]
            good = token >= 0
            found.append(np.stack([at[good], token[good]]))
            more = end[at] > depth
            at, state = at[more], state[more]
        at, token = np.concatenate(found, axis=1)
        by_end = np.argsort(end[at], kind="stable")
        at, token = at[by_end], token[by_end]
        cut = np.searchsorted(end[at], np.arange(1, width + 2))
        last = np.full((n, width + 1), -1, np.int64)
        for e in range(1, width + 1):
            w, t = word[at[cut[e - 1]:cut[e]]], token[cut[e - 1]:cut[e]]
            before = e - v.length[t]
            ok = before == 0
            test = np.flatnonzero(~ok)
            ok[test] = self._stable(last[w[test], before[test]], t[test])
            last[w[ok], e] = t[ok]
        owner, out = [], []
        live, pos = np.flatnonzero(sizes > 0), sizes[sizes > 0]
        while len(live):
            t = last[live, pos]
            owner.append(live)
            out.append(t)
            pos = pos - v.length[t]
            live, pos = live[pos > 0], pos[pos > 0]
        if not owner:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, out = np.concatenate(owner)[::-1], np.concatenate(out)[::-1]
        keep = np.argsort(owner, kind="stable")
        return owner[keep], out[keep]

    def learn(self, tokens: set, make) -> None:
        """Encode the pre-tokens that the cache lacks; ``make(numbers)`` gives what is remembered of each."""
        lacking = self.words.lacking(tokens)
        if lacking:
            numbers, count = self.solve([t.encode("utf-8", "replace") for t in lacking])
            numbers, begin = numbers.tolist(), 0
            for t, c in zip(lacking, count.tolist(), strict=True):
                self.words[t] = make(numbers[begin:begin + c])
                begin += c

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens; special tokens stand as themselves."""
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text)
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else self.pattern.findall(part)
        return out


_codecs: dict[str, Codec] = {}


def codec(text: str, kind: str) -> Codec:
    """One codec per worker process, vocabulary and use."""
    key = f"{kind}:{hashlib.sha256(text.encode()).hexdigest()}"
    if key not in _codecs:
        _codecs[key] = Codec(text)
    return _codecs[key]


def encode_decode(docs: DataFrame, vocabulary_path: str, with_ids: bool = False) -> DataFrame:
    """ids and decoded text of every document: doc_id, n_tokens, digests, and the ids and text if asked for.

    The vocabulary file is read once by the driver and broadcast (its size does not grow with the data).
    Nulls: a null text is the empty text; a null doc_id is kept.  Repeated rows give repeated results.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def make():
        c = codec(shared.value, "encode")

        shown, raw_of = c.v.shown, c.v.bytes

        def remember(numbers):
            return ",".join([shown[i] for i in numbers]), len(numbers), b"".join([raw_of[i] for i in numbers])

        def run(doc_ids, texts):
            lists = [c.pre_tokens(t) if t else [] for t in texts]
            c.words.trim()
            known = set()
            for x in lists:
                known.update(x)
            for s, i in c.v.special.items():
                if s in known:
                    c.words[s] = (str(i), 1, s.encode())
            c.learn(known, remember)
            get = c.words.__getitem__
            rows = [[], [], [], []] + ([[], []] if with_ids else [])
            for doc, x in zip(doc_ids, lists, strict=True):
                got = [get(t) for t in x]
                ids = ",".join([g[0] for g in got])
                raw = b"".join([g[2] for g in got]).decode("utf-8", "replace")
                row = [doc, sum([g[1] for g in got]), hashlib.sha256(ids.encode()).hexdigest(),
                       hashlib.sha256(raw.encode("utf-8", "replace")).hexdigest()]
                if with_ids:
                    row += [[int(i) for i in ids.split(",")] if ids else [], raw]
                for col, value in zip(rows, row, strict=True):
                    col.append(value)
            return rows

        return run

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_slices(docs.select("doc_id", "text"), make, schema + (", ids array<int>, decoded string" if with_ids else ""))

"""Sum-of-squares online packing of tokenised documents into windows (operator 9).

Every task packs the rows of its own input split in one pass, so nothing is
shuffled: a document's whole windows go out at once, its rest goes to the fill level
that leaves the smallest sum over levels of squared counts of partly filled windows
(ties: the fullest).  The counts are a level array of ``length`` numbers.  When
``max_open`` windows are open, or at the end of the split, the open windows are poured
together: their tokens, in order, fill windows to the brim by cutting documents.
What then remains is cut into windows of power-of-two lengths, so no id is padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallyrec.llm.common import map_slices

BLANKS = " \t\n\r"
BLOCK = 1 << 14  # chunks learned or put together at a time


class Levels:
    """The windows of one task.  Pieces are [doc_id, start, bytes, doc_tokens, sequence_id, offset]."""

    def __init__(self, length: int, max_open: int, first_id: int):
        self.length, self.max_open, self.next_id = length, max_open, first_id
        self.count = np.zeros(length + 1, np.int64)  # open windows by fill level; level 0 is "a new window"
        self.windows: dict[int, list[list]] = {}  # fill level: stacks of pieces
        self.open = 0
        self.done: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.done.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def add(self, doc, ids: bytes) -> None:
        total, whole = len(ids) // 4, len(ids) // 4 // self.length * self.length
        for start in range(0, whole, self.length):
            self._close([(doc, start, ids[4 * start:4 * (start + self.length)], total)])
        size = total - whole
        if not size:
            return
        level = self._level(size)
        piece = (doc, whole, ids[4 * whole:], total)
        pieces = []
        if level:
            pieces = self.windows[level].pop()
            self.count[level] -= 1
            self.open -= 1
        pieces.append(piece)
        if level + size == self.length:
            self._close(pieces)
        else:
            self.windows.setdefault(level + size, []).append(pieces)
            self.count[level + size] += 1
            self.open += 1
            if self.open >= self.max_open:
                self.pour(False)

    def _level(self, size: int) -> int:
        """The level that an item joins: least growth of the sum of squares over the partly filled levels."""
        top = self.length - size
        old, new = self.count[:top + 1], self.count[size:]
        grow = 2 * (new - old) + 2  # from level h to h + size
        grow[0] = 2 * self.count[size] + 1  # a new window
        grow[top] = 1 - 2 * old[top] if top else 0  # a window that becomes full counts no more
        grow[1:][old[1:] == 0] = np.iinfo(np.int64).max
        return int(top - np.argmin(grow[::-1]))

    def pour(self, last: bool) -> None:
        """Run the open windows' pieces together, emptiest first, and cut at the window length."""
        pieces = [p for level in sorted(self.windows) for w in self.windows[level] for p in w]
        self.windows, self.open = {}, 0
        self.count[:] = 0
        now, room = [], self.length
        for doc, start, ids, total in pieces:
            while len(ids) // 4 >= room:
                now.append((doc, start, ids[:4 * room], total))
                self._close(now)
                start, ids, now, room = start + room, ids[4 * room:], [], self.length
            if ids:
                now.append((doc, start, ids, total))
                room -= len(ids) // 4
        if not now:
            return
        if last:
            self._powers(now)
        else:
            level = self.length - room
            self.windows[level] = [now]
            self.count[level] = self.open = 1

    def _powers(self, pieces: list[tuple]) -> None:
        left = sum(len(p[2]) // 4 for p in pieces)
        while left:
            room, now = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                doc, start, ids, total = pieces[0]
                n = min(room, len(ids) // 4)
                now.append((doc, start, ids[:4 * n], total))
                room -= n
                pieces = ([(doc, start + n, ids[4 * n:], total)] if n < len(ids) // 4 else []) + pieces[1:]
            self._close(now)


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class Words:
    """Ids of a text as little-endian bytes, remembered by blank-separated chunk.

    Blanks are dropped by this vocabulary's own pre-tokeniser and no pre-token spans
    one, so the chunks' ids one after the other are the text's.  Arrow cuts the texts of a slice, numbers their chunks and
    finds the known ones among them; Python sees a chunk once, when it is new, and numpy puts the ids together.  At
    ``limit`` known chunks those of earlier slices are forgotten.

    What a slice needs for a while grows with the slice, not with what is known: the hash table is of the slice's chunks, and
    new chunks are learned and ids put together ``BLOCK`` at a time.
    """

    def __init__(self, tokenizer, limit: int = 1_000_000):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.t, self.limit = tokenizer, limit
        # the same merges (one model in memory) for words that the normaliser would leave as they are and the pre-tokeniser whole
        self.merges = Tokenizer(tokenizer.model)
        for _, added in sorted(tokenizer.get_added_tokens_decoder().items()):
            (self.merges.add_special_tokens if added.special else self.merges.add_tokens)([added])
        self.merges.normalizer, self.merges.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        self.letters = byte_letters()
        last = self.merges.model.end_of_word_suffix
        self.ends = np.zeros(self.merges.get_vocab_size(), bool)  # tokens that end a word
        for token, number in self.merges.get_vocab(with_added_tokens=False).items():
            self.ends[number] = bool(last) and token.endswith(last)
        self.known = pa.array([""], pa.string())
        self.begin, self.size, self.flat = np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros(0, "<u4")

    @staticmethod
    def _chunks(texts: pa.Array) -> pa.ListArray:
        texts = pc.fill_null(texts, "")
        # the vocabulary is of lower case; a text that may name a special token is left to the tokeniser
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        for blank in BLANKS[1:]:
            texts = pc.replace_substring(texts, blank, " ")
        return pc.split_pattern(texts, " ")

    def _merge(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, encoded joined by blanks, some thousands at a time; a word goes up to its last token."""
        out = []
        for i in range(0, len(words), 2000):
            part = words[i:i + 2000]
            ids = np.array(self.merges.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stop = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(stop) != len(part):  # no mark at the end of a word in this vocabulary
                return [np.array(self.merges.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *stop], stop, strict=False)]
        return out

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, encoded joined by blanks; a token belongs to the chunk that its offset lies in."""
        out = []
        for i in range(0, len(chunks), 2000):
            part = chunks[i:i + 2000]
            e = self.t.encode(" ".join(part), add_special_tokens=False)
            begin = np.cumsum([0] + [len(c) + 1 for c in part])
            at = np.searchsorted(np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids)), begin).tolist()
            ids = np.array(e.ids, "<u4").tobytes()
            out += [ids[4 * a:4 * b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return out

    def _learn(self, chunks: list[str]) -> list[bytes]:
        # letters with a full stop or comma behind: both parts are pre-tokens of their own
        parted, plain, other = [], {}, set()
        for c in chunks:
            core = c.rstrip(".,;:!?")
            if not (len(core) < len(c) and core.isalpha()):
                core = c
            parted.append((core, c[len(core):]))
            if core.isascii() and core.isalpha() and core.islower():
                plain[core] = core
            elif core.isalpha() and max(core) < "\u0100" and core == core.lower():
                plain[core] = core.encode().decode("latin-1").translate(self.letters)
            else:
                other.add(core)
            if len(core) < len(c):
                other.add(c[len(core):])
        ids = dict(zip(plain, self._merge(list(plain.values())), strict=True))
        other = list(other)
        ids.update(zip(other, self._encode(other), strict=True))
        ids[""] = b""
        return [ids[core] + ids[end] for core, end in parted]

    def _places(self, chunks: pa.Array) -> np.ndarray:
        """Places of the chunks among the known ones, -1 for new ones.

        The known ones, by far the more, are looked up among the chunks: a table of theirs would be built for every slice.
        """
        out = np.full(len(chunks), -1, np.int32)
        met = pc.index_in(self.known, value_set=chunks)
        out[met.drop_null().to_numpy()] = np.flatnonzero(met.is_valid().to_numpy(zero_copy_only=False))
        return out

    def _numbers(self, chunks: pa.Array) -> np.ndarray:
        """Places of the chunks among the known ones; new ones are learned."""
        at = self._places(chunks)
        new = np.flatnonzero(at < 0)
        if len(self.known) + len(new) > self.limit:
            self.known = self.known[:1]
            self.begin, self.size, self.flat = self.begin[:1], self.size[:1], self.flat[:0]
            at = self._places(chunks)
            new = np.flatnonzero(at < 0)
        if not len(new):
            return at
        at[new] = len(self.known) + np.arange(len(new), dtype=np.int32)
        fresh, sizes, flats = chunks.take(pa.array(new)), [], []
        for i in range(0, len(fresh), BLOCK):
            ids = self._learn(fresh.slice(i, BLOCK).to_pylist())
            sizes.append(np.fromiter(map(len, ids), np.int32, len(ids)) // 4)
            flats.append(np.frombuffer(b"".join(ids), "<u4"))
        size = np.concatenate(sizes)
        self.begin = np.concatenate([self.begin, (len(self.flat) + np.cumsum(size) - size).astype(np.int32)])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, *flats])
        self.known = pa.concat_arrays([self.known, fresh])
        return at

    def ids(self, texts: pa.Array) -> list[bytes]:
        lists = self._chunks(texts)
        coded = lists.flatten().dictionary_encode()
        at = self._numbers(coded.dictionary)[coded.indices.to_numpy()]
        n = self.size[at]
        total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        ids = np.empty(total[-1], "<u4")
        for i in range(0, len(at), BLOCK):
            to = slice(i, min(i + BLOCK, len(at)))
            first, last = total[to.start], total[to.stop]
            ids[first:last] = self.flat[np.arange(first, last) + np.repeat(self.begin[at[to]] - total[to], n[to])]
        edge = total[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        return [ids[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]


_words: dict[str, Words] = {}  # of this worker, some tens of MB: words learned for one task serve the next


def pack(docs: DataFrame, vocabulary_path: str, length: int = 2048, end_id: int = 1, max_open: int = 4096) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone; a null doc_id is kept; repeated rows are packed each on its own.
    A sequence id is the task's partition number (upper bits) and a running number; a task run again
    reads the same split and gives the same rows.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if vocabulary_path not in _words:
            t = Tokenizer.from_str(shared.value)
            t.no_truncation()
            t.no_padding()
            _words[vocabulary_path] = Words(t)
        words = _words[vocabulary_path]
        levels = Levels(length, max_open, TaskContext.get().partitionId() << 40)

        def run(doc_ids, texts):
            for doc, ids in zip(doc_ids.to_pylist(), words.ids(texts), strict=True):
                levels.add(doc, ids + end)
            return flush()

        def flush():
            rows, levels.done = levels.done, []
            return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(7)]

        def finish():
            levels.pour(True)
            return flush()

        run.finish = finish
        return run

    return map_slices(docs.select("doc_id", "text"), make,
                      "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
                      budget=1_000_000, lists=False)

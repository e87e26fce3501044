"""Conversation structure repair: least-cost edits by Four-Russians block tables.

A conversation is a string of symbols (one a row: initial of its role and fault).  Its repair is the cheapest string of
edits after which the initials read ``(s?(ua)+)?``: a walk through four states (start, after s, after u, after a).
``Tables`` holds what is the same for all conversations.  Cost-to-go vectors over the four states differ only by a
few bounded offsets, so all normalised vectors that can occur are numbered, and for every vector and every block of
``BLOCK`` symbols the vector before the block and the cost added are looked up.  A conversation is run through
from its end block by block; then each block, first to last, is expanded backward from the vector on its right
into a vector a row, and the least edit that keeps the cost is taken, which makes ties safe: the edits are the
ASCII-least of all cheapest ones.

In Spark: rows are sorted by conversation and turn over ranges, so that a conversation of any length is spread over many
tasks, and cut into chunks.  A conversation wholly inside one chunk is done where it lies.  A chunk of a longer one (or
at the edge of a range) is a function from the vector on its right to the vector on its left and from start
state to end state, for every vector; these small functions alone meet, one row a chunk, and hand every chunk its
right vector and its start state.  Then the chunks are edited, each by itself.

Nulls: a null role or text is one space; null conversations are one conversation; null turns come first.  Empty texts
are blank.  Ties: rows of one turn are in the order of role, then of the digest of the text; repeated rows are
duplicates after the first.  Very long texts are cut into chunks of few rows; long conversations into many chunks.
An empty table has no rows.  Columns other than conv_id, turn, role and text are left aside, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyrec.llm.common import stored

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; to keep a row is free
BLOCK = 4                                       # symbols of a table block
ROWS, CHARS = 4096, 4_000_000                   # bounds of a chunk
SPACE = " \t\n\x0b\x0c\r"
STATES = 4                                      # start, after s, after u, after a
KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state and initial: next state
NEXT = (2, 2, 3, 2)                             # state after the role that is wanted now
WANTED = ("user", "user", "assistant", "user")
DROP = 0                                        # symbol of a row that must go; 1-4: s, u, a, other; 5-8: these, truncated
INITIALS = ("s", "u", "a", None)
SYMBOLS = 9
LEGAL = ("su", "ua", "au")


class Tables:
    """Numbered cost vectors, block transitions and least edits."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = [0, 2 * INSERT, INSERT, 0]
        self.vectors, number, todo = [], {}, [self.normal(end)[0]]
        steps = {}
        number[todo[0]] = 0
        while todo:
            v = todo.pop()
            while len(self.vectors) <= number[v]:
                self.vectors.append(None)
            self.vectors[number[v]] = v
            for s in range(SYMBOLS):
                to, add = self.normal(self.before(v, s))
                if to not in number:
                    number[to] = len(number)
                    todo.append(to)
                steps[number[v], s] = number[to], add
        n = len(self.vectors)
        self.one = [[steps[v, s] for s in range(SYMBOLS)] for v in range(n)]
        # the row's edits (inserted rows before it, then its own) and the state after, by vector on its right, symbol and state
        self.edit = [[[self.least(v, s, q) for q in range(STATES)] for s in range(SYMBOLS)] for v in self.vectors]
        self.tail = [self.inserts(end, q)[0] for q in range(STATES)]
        # blocks, grown at the front: code = sum of symbol * 9 ** (distance from the block's end)
        to, add = np.arange(n)[:, None], np.zeros((n, 1), np.int64)
        one_to = np.array([[x[0] for x in row] for row in self.one])
        one_add = np.array([[x[1] for x in row] for row in self.one])
        for _ in range(block):
            add = np.concatenate([add + one_add[to, s] for s in range(SYMBOLS)], axis=1)
            to = np.concatenate([one_to[to, s] for s in range(SYMBOLS)], axis=1)
        self.to, self.add = to.tolist(), add.tolist()

    @staticmethod
    def normal(v) -> tuple[tuple[int, ...], int]:
        return tuple(x - min(v) for x in v), min(v)

    @staticmethod
    def own(v, s: int, q: int) -> list[tuple[str, int, int]]:
        """Edits of a row itself in state q: (edit, cost with what follows, next state)."""
        out = [("D", DELETE + v[q], q)]
        if s != DROP:
            more, initial = (TRUNCATED if s > 4 else 0), INITIALS[(s - 1) % 4]
            if initial in KEEP[q]:
                out.append(("K", more + v[KEEP[q][initial]], KEEP[q][initial]))
            out.append(("R", more + REROLE + v[NEXT[q]], NEXT[q]))
        return out

    def before(self, v, s: int) -> list[int]:
        cost = [min(c for _, c, _ in self.own(v, s, q)) for q in range(STATES)]
        for _ in range(STATES):
            cost = [min(cost[q], INSERT + cost[NEXT[q]]) for q in range(STATES)]
        return cost

    def least(self, v, s: int, q: int) -> tuple[str, int]:
        cost, edits = self.before(v, s), ""
        while True:
            choice = min([e for e in self.own(v, s, q) if e[1] == cost[q]] + [("I", 0, 0)] * (cost[q] == INSERT + cost[NEXT[q]]))
            edits += choice[0]
            if choice[0] != "I":
                return edits, choice[2]
            q = NEXT[q]

    @staticmethod
    def inserts(end, q: int) -> tuple[str, int]:
        edits = ""
        while end[q]:
            edits, q = edits + "I", NEXT[q]
        return edits, q

    def backward(self, symbols: bytes, v: int) -> tuple[int, int, list[int]]:
        """Vector before ``symbols``, the cost added, and the vector on the right of each block (first block first)."""
        head, cost, rights = len(symbols) % self.block, 0, []
        for i in range(len(symbols) - self.block, head - 1, -self.block):
            rights.append(v)
            code = 0
            for s in symbols[i:i + self.block]:
                code = code * SYMBOLS + s
            cost += self.add[v][code]
            v = self.to[v][code]
        if head:
            rights.append(v)
            for s in reversed(symbols[:head]):
                v, add = self.one[v][s]
                cost += add
        return v, cost, rights[::-1]

    def forward(self, symbols: bytes, rights: list[int], q: int) -> tuple[list[str], int]:
        """Edits of each row from state q on, and the state after; every block is expanded from its right vector."""
        out, at, to = [], 0, len(symbols) % self.block or self.block
        for v in rights:
            part, vectors = symbols[at:to], []
            for s in reversed(part):
                vectors.append(v)
                v = self.one[v][s][0]
            for s, right in zip(part, reversed(vectors), strict=True):
                edits, q = self.edit[right][s][q]
                out.append(edits)
            at, to = to, to + self.block
        return out, q

    def function(self, symbols: bytes) -> tuple[list[int], list[int], list[int]]:
        """What a chunk does with every right vector: vector on the left, cost added, and end state by start state.

        All that lies before the last block depends on the vector on its left alone, and few vectors occur there.
        """
        rest, end = symbols[:-self.block], symbols[-self.block:]
        to, add, ends, known = [], [], [], {}
        for v in range(len(self.vectors)):
            middle, cost, last = self.backward(end, v)
            if middle not in known:
                left, more, rights = self.backward(rest, middle)
                known[middle] = left, more, [self.forward(rest, rights, q)[1] for q in range(STATES)]
            left, more, states = known[middle]
            to.append(left)
            add.append(cost + more)
            ends += [self.forward(end, last, q)[1] for q in states]
        return to, add, ends


@cache
def tables() -> Tables:
    return Tables()


def apply_edits(edits: list[str], roles: list[str], texts: list[str], q: int) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired rows."""
    new_roles, new_texts = [], []
    for e, role, text in zip(edits, [*roles, ""], [*texts, ""], strict=False):
        for c in e:
            if c == "D":
                continue
            new_roles.append(role if c == "K" else WANTED[q])
            new_texts.append("" if c == "I" else text)
            q = KEEP[q][role[:1]] if c == "K" else NEXT[q]
    return new_roles, new_texts


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, present) with faults put in by crc32(conv_id:turn) % 20; dropped rows are not present."""
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn")))
    kind = (F.crc32(key.cast("binary")) % 20).alias("kind")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), kind)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                        text.alias("text"), (F.col("kind") != 0).alias("present"), F.explode(copies).alias("copy")).drop("copy"))


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present, row, digest, fault): fault 1 blank, 2 duplicate, 3 truncated, 0 none."""
    end = F.rtrim("text", F.lit(SPACE))
    rows = rows.select("conv_id", "turn", "role", "text", "present", F.unhex(F.sha2("text", 256)).alias("digest"),
                       F.when(end == "", 1).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0).alias("fault"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "turns")  # row numbers stay: they are written
    first = (rows.where("present and fault <> 1").groupBy("conv_id", "role", "digest")
             .agg(F.min(F.struct("turn", "row"))["row"].alias("first"), F.count("*").alias("n")).where("n > 1"))
    f = first.select(*(F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "digest")), "first")
    same = F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role")) & (F.col("digest") == F.col("f_digest"))
    again = F.col("present") & (F.col("fault") != 1) & (F.col("row") != F.col("first"))
    return rows.join(f, same, "left").select(
        "conv_id", "turn", "role", "text", "present", "row", "digest",
        F.when(again, 2).otherwise(F.col("fault")).alias("fault"))


def chunk_schema(rows: DataFrame) -> T.StructType:
    turn, conv = rows.schema["turn"].dataType.simpleString(), rows.schema["conv_id"].dataType.simpleString()
    return T._parse_datatype_string(
        f"conv_id {conv}, place long, whole boolean, symbols binary, roles array<string>, texts array<string>, "
        f"blank long, duplicate long, truncated long, illegal long, first string, last string, lo {turn}, hi {turn}, turns long, "
        "to array<int>, add array<long>, ends array<int>")


def record(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else ([] for _ in arrow)
    return pa.RecordBatch.from_arrays([pa.array(c, arrow.field(i).type) for i, c in enumerate(cols)], schema=arrow)


class Chunk:
    """Rows of one conversation, in order, that lie together."""

    def __init__(self, conv):
        self.conv, self.symbols, self.roles, self.texts, self.size = conv, bytearray(), [], [], 0
        self.faults, self.illegal, self.first, self.last = [0, 0, 0, 0], 0, None, None
        self.lo = self.hi = None
        self.turns = 0

    def add(self, turn, role, text, fault) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        self.faults[fault] += 1
        if turn is not None and turn != self.hi:
            self.lo = turn if self.lo is None else self.lo
            self.hi = turn
            self.turns += 1
        known = {"s": 1, "u": 2, "a": 3}.get(initial, 4)
        self.symbols.append(DROP if fault in (1, 2) else known + 4 * (fault == 3))
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)


def chunks(rows: DataFrame) -> DataFrame:
    """Sorted rows as chunks.  ``place`` orders the chunks of a conversation; ``whole``: nothing of it lies elsewhere."""
    schema = chunk_schema(rows)
    keys = ["conv_id", "turn", "role", "digest", "row"]

    def build(batches):
        arrow, base, done = to_arrow_schema(schema), TaskContext.get().partitionId() << 32, 0

        def rows_of(items, whole):
            nonlocal done
            out = []
            for c in items:
                function = (None, None, None) if whole else tables().function(bytes(c.symbols))
                out.append((c.conv, base + done, whole, bytes(c.symbols), c.roles, c.texts, *c.faults[1:], c.illegal, c.first, c.last,
                            c.lo, c.hi, c.turns, *function))
                done += 1
            return record(out, arrow)

        c, ready, load = None, [], 0  # the chunk that is being read; whole conversations to be put out together
        edge = True                   # the conversation may have rows in a chunk before this one
        for batch in batches:
            for conv, turn, role, text, present, fault in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if c is None:
                    c = Chunk(conv)
                elif c.conv != conv:
                    if edge:
                        yield rows_of([c], False)
                    else:
                        ready.append(c)
                        load += c.size + 200
                    if load > CHARS:
                        yield rows_of(ready, True)
                        ready, load = [], 0
                    c, edge = Chunk(conv), False
                elif len(c.roles) >= ROWS or c.size >= CHARS:
                    yield rows_of([c], False)
                    c, edge = Chunk(conv), True
                if present:
                    c.add(turn, role, text, fault)
        if ready:
            yield rows_of(ready, True)
        if c is not None:
            yield rows_of([c], False)

    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(ordered.select("conv_id", "turn", "role", "text", "present", "fault").mapInArrow(build, schema), "turn-chunks")


STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def totals(parts: list[dict]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal) of a conversation from its chunks, in order."""
    turns, lo, hi, last, illegal = 0, None, None, None, 0
    for p in parts:
        if p["lo"] is not None:
            turns += p["turns"] - (hi is not None and hi == p["lo"])
            lo, hi = (p["lo"] if lo is None else lo), p["hi"]
        if p["first"] is not None:
            illegal += p["illegal"] + (last is not None and last + p["first"] not in LEGAL)
            last = p["last"]
    gaps = hi - lo + 1 - turns if lo is not None else 0
    return (gaps, *(sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated")), illegal)


def meetings(parts: DataFrame) -> DataFrame:
    """(place, right, state, is_last, totals) of the chunks of conversations in several chunks, from their functions alone."""
    schema = T._parse_datatype_string(f"place long, right int, state int, is_last boolean, {STATS}")
    names = ["conv_id", "place", "blank", "duplicate", "truncated", "illegal", "first", "last", "lo", "hi", "turns", "to", "add", "ends"]

    def run(batches):
        arrow, held = to_arrow_schema(schema), []

        def solved():
            right, rights, cost = 0, [], 0
            for p in reversed(held):
                rights.append(right)
                cost += p["add"][right]
                right = p["to"][right]
            cost += tables().vectors[right][0]
            state, out = 0, []
            for i, (p, v) in enumerate(zip(held, reversed(rights), strict=True)):
                stats = (*totals(held), cost) if i == 0 else (None,) * 6
                out.append((p["place"], v, state, i == len(held) - 1, *stats))
                state = p["ends"][v * STATES + state]
            return record(out, arrow)

        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                p = dict(zip(names, values, strict=True))
                if held and held[0]["conv_id"] != p["conv_id"]:
                    yield solved()
                    held = []
                held.append(p)
        if held:
            yield solved()

    return parts.select(names).repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(run, schema)


def pieces(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired conversations, a row a chunk: (conv_id, place, whole, edits, roles, texts, gaps, ..., cost).

    First those of one chunk, then the chunks of the others.

    ``roles`` and ``texts`` are the rows after repair.  The counts stand in the first chunk of a conversation alone.
    """
    made = chunks(faults(rows))
    conv = made.schema["conv_id"].dataType.simpleString()
    schema = T._parse_datatype_string(f"conv_id {conv}, place long, whole boolean, edits string, roles array<string>, texts array<string>, {STATS}")

    def run(batches, whole):
        arrow = to_arrow_schema(schema)
        t = tables()
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                left, cost, rights = t.backward(p["symbols"], 0 if whole else p["right"])
                q = 0 if whole else p["state"]
                edits, end = t.forward(p["symbols"], rights, q)
                if whole or p["is_last"]:
                    edits.append(t.tail[end])
                stats = (*totals([p]), cost + t.vectors[left][0]) if whole else tuple(p[f"t_{k.split()[0]}"] for k in STATS.split(", "))
                out.append((p["conv_id"], p["place"], whole, "".join(edits), *apply_edits(edits, p["roles"], p["texts"], q), *stats))
            yield record(out, arrow)

    whole = made.where("whole").select("conv_id", "place", "symbols", "roles", "texts", "blank", "duplicate", "truncated", "illegal",
                                       "first", "last", "lo", "hi", "turns")
    parts = made.where("not whole")
    met = meetings(parts)
    met = met.select("place", "right", "state", "is_last", *(F.col(k.split()[0]).alias(f"t_{k.split()[0]}") for k in STATS.split(", ")))
    parts = parts.select("conv_id", "place", "symbols", "roles", "texts").join(met, "place")
    return whole.mapInArrow(lambda b: run(b, True), schema), parts.mapInArrow(lambda b: run(b, False), schema)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired rows: (conv_id, place, line, role, text); place and line order the rows of a conversation."""
    both = F.arrays_zip("roles", "texts")
    whole, parts = pieces(rows)
    return (whole.unionByName(parts).select("conv_id", "place", F.posexplode(both).alias("line", "r"))
            .select("conv_id", "place", "line", F.col("r.roles").alias("role"), F.col("r.texts").alias("text")))


def report(rows: DataFrame) -> DataFrame:
    """One row a conversation: counts of faults, cost, ``audit`` (the edits) and the hash of the repaired rows.

    The hash of a long conversation is fed chunk by chunk by the task that reads its sorted chunks.
    """
    whole, parts = pieces(rows)
    conv = whole.schema["conv_id"].dataType.simpleString()
    schema = T._parse_datatype_string(f"conv_id {conv}, {STATS}, audit string, repaired_sha256 string")

    def run(batches):
        arrow = to_arrow_schema(schema)
        held = None  # (conv_id, counts, edits so far, hash so far, whether it holds a line)

        def closed(h):
            return (h[0], *h[1], "".join(h[2]), h[3].hexdigest())

        for batch in batches:
            out = []
            for p in batch.to_pylist():
                if held is None or p["whole"] or held[5] or p["cost"] is not None:  # counts: the first chunk of a conversation
                    if held is not None:
                        out.append(closed(held))
                    held = [p["conv_id"], tuple(p[k.split()[0]] for k in STATS.split(", ")), [], hashlib.sha256(), False, p["whole"]]
                held[2].append(p["edits"])
                lines = "\n".join(f"{r}:{t}" for r, t in zip(p["roles"], p["texts"], strict=True))
                if p["roles"]:
                    held[3].update((("\n" if held[4] else "") + lines).encode("utf-8", "surrogatepass"))
                    held[4] = True
            yield record(out, arrow)
        if held is not None:
            yield record([closed(held)], arrow)

    parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return whole.mapInArrow(run, schema).unionByName(parts.mapInArrow(run, schema))

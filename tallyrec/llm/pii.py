"""Personal data: fixed patterns, and a bidirectional LSTM with CRF transitions (operator 4).

The pattern matches are spans in any case.  The model, trained on labelled spans of a bounded sample
(the matches, and the same with the usual disguises: a phone without its plus, an address with "at" and
"dot"), reads overlapping windows of the text.  Scores of a character from its windows are averaged, weighted by
its distance to the window's edge, and one best path goes through each connected stretch of windows, so windows
never contradict each other.  A decoded span is added if it overlaps no match and holds what its kind must hold.
Every kind but an address needs a digit, and an address is accepted only as a match of ``DISGUISED``, so only
windows of digits, of @, of "dot" and of the whole stretch of what could be such a match are computed.  An
accepted address takes the rest of the words in which it begins and ends.

Null texts count as empty and have no spans.  Texts are read whole.  Repeated rows are read each.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.common import LONGEST, lowest, map_slices, replace_texts
from tallyrec.llm.lstm_crf import Tagger, classes

KINDS = ["email", "ip", "card", "phone"]
WINDOW, STRIDE = 64, 32

# Patterns and limits of the kinds.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]|\bdot\b")
DIGITS = re.compile(r"[0-9]")
DISGUISED = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@| at |\[at\]|\(at\)) ?[A-Za-z0-9-]+(?: ?(?:\.| dot |\[dot\]|\(dot\)) ?[A-Za-z0-9-]+)+")
_AT = r"(?:@| at |\[at\]|\(at\)) ?[A-Za-z0-9-]+"
_DOT = r" ?(?:\.| dot |\[dot\]|\(dot\)) ?[A-Za-z0-9-]"
# Where the middle of a match of DISGUISED begins (looked for at every place, as such middles may share a blank), and all from there on.
MIDDLE = re.compile(f"(?={_AT}{_DOT})")
DOMAINS = re.compile(f"{_AT}(?:{_DOT}+)+")
NAME = re.compile(r"[A-Za-z0-9-]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = 2 * v - 9 * (v > 4)
        total += v
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(DIGITS.findall(s))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: a match begins where the run of local characters before an @ begins, or at the end of the match before."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and LOCAL.match(text, begin - 1):
            begin -= 1
        m = DOMAIN.match(text, at) if begin < at else None
        if m:
            out.append((begin, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    # a run of digits that fails from its first digit fails from the others too, so matches are tried at run starts
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = _digits(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def holds(kind: int, value: str) -> bool:
    """Whether a decoded span holds what its kind must hold."""
    d = _digits(value)
    if kind == 0:
        return bool(DISGUISED.fullmatch(value))
    if kind == 1:
        parts = re.findall(r"[0-9]+", value)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and len(value) <= 24
    if kind == 2:
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15 and len(re.findall(r"[\x20().-]", value)) >= 2 and not re.search(r"[^\x20()+.0-9-]", value)


def signs_of(text: str) -> list[int]:
    """Places whose windows are read: all signs, and each stretch that may be an address, from its first character to its last."""
    out = [m.start() for m in SIGN.finditer(text)]
    for m in MIDDLE.finditer(text):
        begin = at = m.start()
        if begin and text[begin - 1] == " ":
            begin -= 1
        head = begin
        while begin and LOCAL.match(text, begin - 1):
            begin -= 1
        if begin < head:
            end = DOMAINS.match(text, at).end()
            out += [*range(begin, end, STRIDE), end - 1]
    return out


def whole(text: str, a: int, b: int, spans: list[tuple]) -> tuple[int, int]:
    """The address at a to b with the rest of the words in which it begins and ends, up to the spans beside it."""
    first = max([q for _, _, q in spans if q <= a], default=0)
    last = min([p for _, p, _ in spans if p >= b], default=len(text))
    while a > first and LOCAL.match(text, a - 1):
        a -= 1
    while b < last and NAME.match(text, b):
        b += 1
    return a, b


def windows(text: str, signs: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """First positions of the windows that hold a sign, and their character classes."""
    first = sorted({k * STRIDE for s in signs for k in (s // STRIDE - 1, s // STRIDE)} )
    padded = np.concatenate([np.zeros(STRIDE, np.uint8), classes(text), np.zeros(2 * WINDOW, np.uint8)])
    at = np.array(first, np.int64)
    return at, padded[at[:, None] + STRIDE + np.arange(WINDOW)]


def labelled(text: str) -> list[tuple[int, str, str, str]]:
    """(kind, text before, value, text after) of the matches in a text, disguised ones too; kind -1: no personal data."""
    spans, out = base_spans(text), []
    for kind, a, b in spans:
        if any(x != (kind, a, b) and x[1] < b and a < x[2] for x in spans) or b - a > WINDOW - 8:
            continue
        before, value, after = text[max(0, a - WINDOW):a], text[a:b], text[b:b + WINDOW]
        forms = [value]
        if kind == 0:
            user, _, domain = value.partition("@")
            forms += [user + " at " + domain.replace(".", " dot "), user + "[at]" + domain.replace(".", "[dot]"),
                      user + " at " + domain, user + "[at]" + domain, user + "(at)" + domain]
        if kind == 3:
            forms += [re.sub(r"^\+[0-9]{1,3}[\x20.-]*", "", value), value[1:]]
        out += [(kind, before, form, after) for form in forms if len(form) <= WINDOW - 8]
    # "at" in ordinary sentences too, which are no addresses
    clear = [m.start() for m in SIGN.finditer(text)][:4] + [m.start() for m in MIDDLE.finditer(text) if text[m.start()] != "@"][:4]
    for s in [*clear, len(text) // 2]:
        a = max(0, s - WINDOW // 2)
        if len(text) > 4 and not any(x[1] < a + WINDOW and a < x[2] for x in spans):
            out.append((-1, "", "", text[a:a + WINDOW]))
    return out


def train(texts: list[str], per_kind: int = 300, hidden: int = 12, epochs: int = 8) -> Tagger | None:
    """Fit the tagger on ``per_kind`` windows of every kind, and twice as many without personal data.

    Matches are drawn again and again until a kind has its windows, each time at another place of the window and, but for
    addresses, with other digits, so rare kinds count as much as frequent ones.  Where kinds are missing, half or less of the
    usual windows are drawn; they are read more often, as so few steps would teach nothing.
    """
    rng = np.random.default_rng(11)
    examples: dict[int, list] = {}
    for t in texts:
        for e in labelled(t):
            examples.setdefault(e[0], []).append(e)
    if not any(k >= 0 for k in examples):
        return None
    drawn = []
    for kind, found in sorted(examples.items()):
        n = per_kind if kind >= 0 else min(2 * per_kind, len(found))
        at = np.concatenate([rng.permutation(len(found)) for _ in range(-(-n // len(found)))])[:n]
        drawn += [found[i] for i in at]
    x, y = np.zeros((len(drawn), WINDOW), np.uint8), np.zeros((len(drawn), WINDOW), np.int64)
    for i, (kind, before, value, after) in enumerate(drawn):
        lead = 0
        if kind >= 0:
            lead = min(len(before), int(rng.integers(0, WINDOW - len(value) + 1)))
            if kind and rng.random() < 0.7:
                value = "".join(str(rng.integers(10)) if c in "0123456789" else c for c in value)
            y[i, lead:lead + len(value)] = 2 + 2 * kind
            y[i, lead] = 1 + 2 * kind
        c = classes(before[len(before) - lead:] + value + after)[:WINDOW]
        x[i, :len(c)] = c
    tagger = Tagger(len(KINDS), hidden)
    tagger.train(x, y, epochs * max(1, (len(KINDS) + 2) * per_kind // len(drawn)))
    return tagger


def fit(docs: DataFrame, sample: int = 4000) -> Tagger | None:
    """Train on the labelled spans of the ``sample`` documents with the smallest salted hash among those that hold a digit or an @.

    ``sample`` bounds what the driver gets at every size; texts of over 100,000 characters are not drawn.
    """
    rank = F.xxhash64("doc_id", F.lit("personal"))
    able = F.col("doc_id").isNotNull() & (F.length("text") <= LONGEST) & F.col("text").rlike("[0-9@]")
    near = lowest(docs.select("doc_id", "text"), rank, sample, able, "doc_id")
    ids = near.select("doc_id", rank.alias("_rank")).orderBy("_rank", "doc_id").limit(sample)
    rows = near.join(F.broadcast(ids.distinct()), "doc_id")
    got = rows.orderBy("_rank", "doc_id", "text").limit(sample).collect()
    return train([r["text"] for r in got])


def added(tagger: Tagger, texts: list[str], signs: list[list[int]], base: list[list[tuple]]) -> list[list[tuple]]:
    """Spans that the model adds to the pattern matches of each text."""
    out: list[list[tuple]] = [[] for _ in texts]
    todo = [i for i, s in enumerate(signs) if s]
    made = [windows(texts[i], signs[i]) for i in todo]
    if not made:
        return out
    x = np.concatenate([w for _, w in made])
    scores = np.concatenate([tagger.scores(x[b:b + 2048]) for b in range(0, len(x), 2048)])
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float64)
    row = 0
    for i, (at, _) in zip(todo, made, strict=True):
        text = texts[i]
        cuts = np.flatnonzero(np.diff(at) > STRIDE) + 1  # stretches of overlapping windows
        for group in np.split(np.arange(len(at)), cuts):
            begin, end = int(at[group[0]]), int(at[group[-1]]) + WINDOW
            e, total = np.zeros((end - begin, tagger.tags)), np.zeros(end - begin)
            for g in group:
                a = int(at[g]) - begin
                e[a:a + WINDOW] += scores[row + g] * weight[:, None]
                total[a:a + WINDOW] += weight
            tags = tagger.best(e / total[:, None])
            for s in np.flatnonzero(tags % 2 == 1):
                kind, stop = int(tags[s]) // 2, int(s) + 1
                while stop < len(tags) and tags[stop] == tags[s] + 1:
                    stop += 1
                a, b = max(0, begin + int(s)), min(len(text), begin + stop)
                while a < b and text[a] in " .,;:":
                    a += 1
                while a < b and text[b - 1] in " .,;:":
                    b -= 1
                if a < b and kind == 0 and holds(kind, text[a:b]):
                    a, b = whole(text, a, b, base[i] + out[i])
                if a < b and holds(kind, text[a:b]) and not any(p < b and a < q for _, p, q in base[i]) and not any(p < b and a < q for _, p, q in out[i]):
                    out[i].append((kind, a, b))
        row += len(at)
    return out


def spans_of(tagger: Tagger | None, texts: list[str | None]) -> tuple[list[list[tuple]], list[list[tuple]]]:
    """Pattern matches and added spans of each text."""
    texts = [t or "" for t in texts]
    signs = [signs_of(t) for t in texts]
    base = [base_spans(t) if s else [] for t, s in zip(texts, signs, strict=True)]
    more = added(tagger, texts, signs, base) if tagger else [[] for _ in texts]
    return base, more


def shown(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def make():
        def run(doc_ids, texts):
            base, more = spans_of(shared.value, texts)
            counts = [[sum(k == kind for k, _, _ in b) for b in base] for kind in range(len(KINDS))]
            digests = [hashlib.sha256(shown(b).encode()).hexdigest() for b in base]
            return [doc_ids, *counts, digests, [shown(b + m) for b, m in zip(base, more, strict=True)], [len(m) for m in more]]

        return run

    return map_slices(docs.select("doc_id", "text"), make, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                      "base_sha256 string, spans string, n_added long")


def masked(text: str, spans: list[tuple]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named after the first."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """All rows and columns, with the spans masked in ``text`` and ``n_chars`` (if there) counted anew.  Null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def clean(texts):
        base, more = spans_of(shared.value, texts)
        return [None if t is None else masked(t, b + m) for t, b, m in zip(texts, base, more, strict=True)]

    out = replace_texts(docs, lambda: clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return out

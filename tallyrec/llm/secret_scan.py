"""Secret scan: fixed patterns, and Markov models of random strings and ordinary identifiers (operator 2).

DataFrame functions only.  Besides the pattern matches, every run of 16 or more token characters
is scored, whatever characters it holds, by first-order Markov models of random strings and of ordinary
identifiers with additive smoothing.  A character pair counts log P(random) - log P(ordinary); a run's score is the log-likelihood ratio of its best stretch (the
largest sum over neighbouring pairs), so a key inside a long path counts in full and a long ordinary path does not
add up.  The models are trained from labelled samples: random strings made from digests (base64 in both alphabets, letters and digits, capitals
and digits, small letters and digits); ordinary ones from the words of the documents outside the pattern matches, and identifiers
of all lengths: snake, kebab and camel case, paths, constants, dated and numbered names put together from neighbouring words of the documents and from a list of
common identifier words, UUIDs, ruled lines and one character repeated.  A run above ``threshold`` nats that lies in no pattern match is a span of kind ``markov``;
it may hold a pattern match, which stays a span of its own.

Null texts count as empty and have no spans.  Texts are searched whole.  Repeated rows are scanned each.  An empty table gives no
rows.  There are no ties: a span is reported or not by its own score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyrec.functions.ids import smallest_hashes

# The patterns of the three base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a run of AKIA[A-Z0-9]+ with 18 or more characters, whole
HEX = r"[0-9a-f]{16,}"
RUN = r"[A-Za-z0-9+/_=-]{16,}"
KINDS = ["assign", "access", "hex", "markov"]
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,15}(?![A-Za-z0-9+/_=-])"  # shorter than what is scored, so no key is learned as ordinary
TOKEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Labelled sample: words that identifiers are commonly made of.
NAMES = """account action address admin agent alias allow api app apply array async audit auth author backup balance base batch begin
binary block body branch browser buffer build bundle button bytes cache call card cart cell chain change channel char check child class clean
client clock close cluster code color column command comment commit common compare config connect connection content context control controller
convert cookie copy count create cursor custom data database date debug default delete delta deploy detail device digest directory disable disk display
document domain double driver edit element email empty enable encode engine entity entry error event example execute export factory failed
feature field file filter final find first flag folder format frame function group handler hash header height home host icon image import index
info input insert instance integer interface invalid item job join key keyword label language layout length level library limit line link list
load local location lock logger login main manager mapping master max memory message method metric min mode model module monitor name network next node
""".split()
SIZE = 128  # characters of the models are ASCII


def found(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Matches as an array of (start, kind, end, value), in code points.

    ``split`` gives the pieces between the matches that ``regexp_extract_all`` gives; the running sum of both lengths is
    a match's place.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(acc, pair):
        start = acc["at"] + F.length(pair["piece"])
        end = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["hit"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(hits, F.slice(pieces, 1, F.size(hits)), lambda h, p: F.struct(h.alias("hit"), p.alias("piece")))
    spans = F.aggregate(pairs, begin, step, lambda acc: acc["spans"])
    spans = F.when(text.rlike(pattern), spans).otherwise(none)
    return F.filter(spans, keep) if keep else spans


def base_spans(text: Column) -> Column:
    assign = found(text, ASSIGN, 0, lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 12)
    return F.concat(assign, found(text, ACCESS, 1), found(text, HEX, 2))


def shown(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pairs_of(value: Column) -> Column:
    """Numbers of a string's neighbouring ASCII pairs."""
    codes = F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.least(F.ascii(F.substring(value, i, F.lit(1))), F.lit(SIZE - 1)))
    return F.zip_with(F.slice(codes, F.lit(1), F.greatest(F.size(codes) - 1, F.lit(0))), F.slice(codes, F.lit(2), F.size(codes)),
                      lambda a, b: a * SIZE + F.coalesce(b, F.lit(0)))


def styled(words: Column, style: Column, number: Column) -> Column:
    """An identifier of an array of four small words; ``style`` (0 to 8) picks its form, ``number`` its digits."""
    capital = F.transform(words, F.initcap)
    w = [F.get(words, F.lit(i)) for i in range(4)]
    day = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(number, F.lit(12_000)).cast("int")), "yyyy/MM/dd")
    forms = [F.array_join(words, "_"), F.array_join(words, "-"), F.concat(F.lit("/"), F.array_join(words, "/")),
             F.concat(w[0], F.array_join(F.slice(capital, 2, 3), "")), F.upper(F.array_join(words, "_")),
             F.concat(F.upper(F.concat_ws("_", w[0], w[1])), F.lit("="), F.pmod(number, F.lit(5000)).cast("string")),
             F.concat_ws("/", w[0], w[1], F.array_join(capital, "")),
             F.concat_ws("-", w[0], w[1], F.pmod(number, F.lit(100_000)).cast("string"), w[2], w[3]),
             F.concat(F.concat_ws("/", w[0], day, w[1]), F.lit("_v"), F.pmod(number, F.lit(20)).cast("string"), F.lit("-"), F.translate(day, "/", "-"))]
    return F.get(F.array(*forms), style)


def random_strings(numbers: DataFrame) -> DataFrame:
    """Labelled random strings, four of every ``id``."""
    digest = F.sha2(F.concat(F.lit("random string "), F.col("id").cast("string")), 512)
    coded = F.base64(F.unhex(F.substring(digest, 1, 60)))
    small = F.array_join(F.array(*(F.lower(F.conv(F.substring(digest, at, 15), 16, 36)) for at in (1, 16, 31))), "")
    return numbers.select(F.explode(F.array(
        coded, F.translate(F.base64(F.unhex(F.substring(digest, 61, 60))), "+/", "-_"), F.translate(F.upper(coded), "+/=", ""), small)).alias("value"))


def ordinary_strings(numbers: DataFrame, texts: DataFrame) -> DataFrame:
    """Labelled ordinary strings: (value, n) with their number."""
    text = F.coalesce("text", F.lit(""))
    for pattern in (ASSIGN, ACCESS, HEX):
        text = F.regexp_replace(text, pattern, " ")
    cut = texts.select(text.alias("text"))
    words = cut.select(F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("value"))
    plain = cut.select(F.transform(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,12}"), F.lit(0)), F.lower).alias("w"))
    fours = plain.select(F.explode(F.when(F.size("w") >= 4, F.transform(
        F.sequence(F.lit(0), F.floor(F.size("w") / 4).cast("int") - 1), lambda i: F.slice(F.col("w"), i * 4 + 1, 4)))).alias("w"))
    h = F.xxhash64("w")
    made = fours.select(styled(F.col("w"), F.pmod(h, F.lit(9)).cast("int"), F.shiftrightunsigned(h, 8)).alias("value"))
    names = F.array(*[F.lit(x) for x in NAMES])
    draw = F.transform(F.array(*[F.lit(i) for i in range(4)]), lambda i: F.get(names, F.pmod(F.xxhash64(F.col("id"), i), F.size(names)).cast("int")))
    named = numbers.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(8)), lambda f: styled(draw, f, F.xxhash64("id", f)))).alias("value"))
    digest = F.md5(F.concat(F.lit("uuid "), F.col("id").cast("string")))
    uuid = numbers.select(F.concat_ws("-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))).alias("value"))
    lines = numbers.limit(1).select(F.explode(F.array(*[F.lit(c * 1000) for c in TOKEN])).alias("value"))
    every = words.unionByName(made).unionByName(named).unionByName(uuid).unionByName(lines)
    return every.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def ratio_table(docs: DataFrame, sample: int = 2000, smooth: float = 0.5) -> DataFrame:
    """One row, one column ``ratio``: SIZE * SIZE log-ratios by pair number.

    Learned from ``sample`` documents (smallest hash of the id; a hash cutoff, so no task sees more than about that many)
    and ``sample`` made strings of every form, at every input size, so the row is bounded.
    """
    ids = smallest_hashes(docs.select("doc_id").where("doc_id is not null"), sample, ["doc_id"], "secrets").distinct()
    numbers = docs.sparkSession.range(sample)
    some = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    random = random_strings(numbers).select("value", F.lit(1).alias("r"), F.lit(0).alias("w"))
    plain = ordinary_strings(numbers, some).select("value", F.lit(0).alias("r"), F.col("n").alias("w"))
    count = (random.unionByName(plain).select("r", "w", F.explode(pairs_of(F.col("value"))).alias("pair"))
             .groupBy("pair").agg(F.sum("r").alias("r"), F.sum("w").alias("w")))
    grid = docs.sparkSession.range(SIZE * SIZE).select(F.col("id").cast("int").alias("pair")).join(count, "pair", "left").fillna(0, ["r", "w"])
    first = (grid.groupBy((F.col("pair") / SIZE).cast("int").alias("first"))
             .agg(F.sum("r").alias("nr"), F.sum("w").alias("nw"), F.collect_list(F.struct("pair", "r", "w")).alias("cells")))
    part = lambda c, n: F.log((c + smooth) / (n + smooth * SIZE))
    cells = first.select(F.explode("cells").alias("c"), "nr", "nw").select(
        F.struct(F.col("c.pair").alias("pair"), (part(F.col("c.r"), F.col("nr")) - part(F.col("c.w"), F.col("nw"))).alias("v")).alias("x"))
    return cells.agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["v"]).alias("ratio"))


def best_stretch(value: Column, ratio: Column) -> Column:
    """The log-likelihood ratio of a string's best stretch of neighbouring pairs, at least 0."""
    begin = F.struct(F.lit(0.0).alias("now"), F.lit(0.0).alias("best"))

    def step(acc, pair):
        now = F.greatest(acc["now"] + F.get(ratio, pair), F.lit(0.0))
        return F.struct(now.alias("now"), F.greatest(acc["best"], now).alias("best"))

    return F.aggregate(pairs_of(value), begin, step, lambda acc: acc["best"])


def scan(docs: DataFrame, threshold: float = 28.0) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov of every row."""
    ratio = ratio_table(docs).scalar()
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select(
        "doc_id", base_spans(F.col("text")).alias("base"),
        found(F.col("text"), RUN, 3).alias("run"))
    clear = F.filter("run", lambda r: ~F.exists("base", lambda b: (b["start"] <= r["start"]) & (r["end"] <= b["end"])))
    rows = rows.select("doc_id", "base", clear.alias("run"))
    # the table joins as one row only where there is something to score
    rows = rows.withColumn("ratio", F.when(F.size("run") > 0, ratio))
    rows = rows.select("doc_id", "base", F.when(F.size("run") > 0, F.filter("run", lambda s: best_stretch(s["value"], F.col("ratio")) > threshold)).otherwise(F.col("run")).alias("more"))
    kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select("doc_id", kind(0).alias("n_assign"), kind(1).alias("n_access"), kind(2).alias("n_hex"),
                       F.sha2(shown(F.col("base")), 256).alias("base_sha256"),
                       shown(F.concat("base", "more")).alias("spans"), F.size("more").cast("long").alias("n_markov"))

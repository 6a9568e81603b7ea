"""Secret scan: fixed patterns, and character Markov models of random strings against ordinary identifiers. Native.

Two first-order Markov models over the characters of [A-Za-z0-9+/_=-] (all others one further state) are counted, with
add-``smooth`` smoothing, from labelled samples: digests in hex and base64 on the one side; compounds of ordinary words in
the usual spellings, run-together words of four languages and ruled lines on the other. Every run of ``least`` or more such
characters is scored; it is a secret if its log-likelihood ratio, which grows with its length, exceeds ``threshold`` nats.
The table of ratios has 67 * 67 entries, so it is a literal. A run that holds or crosses a pattern's span is added beside it.

Places come from split() and regexp_extract_all(): the lengths of the parts between matches and of the matches give them.
Work on one text is linear in its length and, but for small terms (see scan()), in its spans.

Nulls: a null text is empty and has no spans. Repeated rows each get a result. Extra columns are kept; where one is called
secrets, the spans' column is _secrets. Recall of random strings by length: tests/llm/test_operators.py.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunked, let, own_name, scan, table

#: The kinds' patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the matches of AKIA[A-Z0-9]+ with 18 characters or more
HEX = r"[0-9a-f]{16,}"  # the matches of [0-9a-f]+ with 16 characters or more
KINDS = ["assign", "access", "hex", "markov"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1
LEAST, THRESHOLD, SMOOTH, SAMPLES = 12, 14.0, 0.5, 4000
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}"
MARK = "[SECRET]"
#: Ordinary words of the identifiers' samples.
WORDS = """account action active address after agent all amount and array author base before begin block body buffer build button byte
cache call cell change channel char check child class clean click client close code color column command common config connect content
context control copy core count create current data date default delete depth detail device direct domain done down draw edit element
empty enable end entry error event exit extra factor field file filter find first flag flow folder font form format frame from full
function general get global graph group handle header height hidden host image index info init input insert inside item join key label
last layer layout left length level library light limit line link list load local lock log long lower machine main manager map mark match
max memory menu message method middle min mode model module mouse move name native network next node normal note number object offset
open option order output own page panel parent parse part path pattern pixel player point pool port position post power print process
product profile project prompt query queue random range rate read record remove render report request reset resource response result
return right role root row rule run sample save scale scan scene schema score screen search section select send server service session
set shape share show side signal simple single size slot small sort source space split stack start state static status step stop store
stream string style submit switch symbol sync system table target task temp test text theme thread time title tool top total track tree
type unit update upper user util value vector version view visible volume watch weight width window word worker wrap write zone""".split()  # fmt: skip


#: Common words of English, Spanish, German and French; run together, they stand for the words of prose.
PROSE = """the and that was for with his had not are but from have they which you were all her she there would their been has when who will more out
que del los por con una su para como pero sus este entre cuando todo esta ser desde porque donde tiempo mismo ahora cada vida despues muy hasta
der die und den von das mit sich auf ist nicht ein eine als auch werden aus hat dass sie nach wird bei einer noch wie einem haben oder aber durch wurde schon wenn diese
les des est dans par sur pas plus sont mais avec son aux elle cette ont ses comme fait leur bien deux meme nous vous tout sans aussi apres avant dont faire moins monde autre""".split()  # fmt: skip
SPANS = "array<struct<start:int,kind:int,end:int>>"


def spans_of(text, pattern: str, kind: str, counts=lambda m: F.lit(True)):
    """Array of (start, kind, end) of the pattern's matches, leftmost and not overlapping, of which those count that counts() accepts."""
    empty = F.array().cast(SPANS)
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = let(found, lambda ms: F.zip_with(F.slice(parts, 1, F.size(ms)), ms, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size"), counts(m).alias("ok"))))

    def emit(at, x):
        start = at + x["gap"]
        return F.when(x["ok"], F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + x["size"]).alias("end")))).otherwise(empty)

    return F.when(text.rlike(pattern), scan(both, F.lit(0), lambda at, x: at + x["gap"] + x["size"], emit, empty)).otherwise(empty)


def labelled_samples(spark: SparkSession, count: int = SAMPLES) -> DataFrame:
    """sample, secret: count random strings (half hex, half base64), as many identifiers and words of prose, and ruled lines; all made from fixed seeds."""
    ids = spark.range(count)
    digest = F.sha2(F.concat(F.lit("random string "), F.col("id")), 256)
    random = ids.select(F.when(F.col("id") % 2 == 0, F.substring(digest, 1, 40)).otherwise(F.translate(F.substring(F.base64(F.unhex(digest)), 1, 40), "=", "")).alias("sample"), F.lit(1).alias("secret"))
    words = F.split(F.lit(" ".join(WORDS)), " ")
    pick = lambda k: F.get(words, F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(len(WORDS))).cast("int"))
    w = [pick(k) for k in range(5)]
    number = F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(1000)).cast("string")
    forms = [F.concat_ws("_", *w), F.concat(w[0], *[F.initcap(x) for x in w[1:]]), F.concat_ws("-", *w, number), F.concat_ws("/", *w), F.upper(F.concat_ws("_", *w[:4])), F.concat(*[F.initcap(x) for x in w], number)]
    spelled = reduce(lambda rest, k: F.when(F.col("id") % len(forms) == k, forms[k]).otherwise(rest), range(1, len(forms)), forms[0])
    prose = F.split(F.lit(" ".join(PROSE)), " ")
    said = F.concat(*[F.when(F.pmod(F.xxhash64(F.lit("size"), "id"), F.lit(4)) + 3 > k, F.get(prose, F.pmod(F.xxhash64(F.lit("prose"), F.lit(k), "id"), F.lit(len(PROSE))).cast("int"))).otherwise("") for k in range(6)])
    said = F.when(F.col("id") % 3 == 0, F.initcap(said)).when(F.col("id") % 9 == 1, F.upper(said)).otherwise(said)
    ruled = F.repeat(F.substring(F.lit("-=_/+"), (F.col("id") % 5 + 1).cast("int"), F.lit(1)), (F.col("id") % 30 + 12).cast("int"))
    ordinary = ids.select(spelled.alias("sample")).union(ids.select(said)).union(ids.where("id < 200").select(ruled))
    return random.union(ordinary.select("sample", F.lit(0).alias("secret")))


def state_of(c):
    return F.instr(F.lit(ALPHABET), c)


def train(samples: DataFrame, smooth: float = SMOOTH) -> list[float]:
    """The log-likelihood ratio of each pair of states, row by row: at most 2 * STATES**2 counts reach the driver."""
    pairs = samples.select("secret", "sample", F.explode(F.sequence(F.lit(1), F.length("sample") - 1)).alias("i")).where("i > 0")
    pairs = pairs.select("secret", F.instr(F.lit(ALPHABET), F.substring("sample", F.col("i"), F.lit(1))).alias("a"), F.instr(F.lit(ALPHABET), F.substring("sample", F.col("i") + 1, F.lit(1))).alias("b"))
    n: list = [[[smooth] * STATES for _ in range(STATES)] for _ in range(2)]
    for secret, a, b, c in pairs.groupBy("secret", "a", "b").count().collect():
        n[secret][a][b] += c
    return [math.log(n[1][a][b] / sum(n[1][a])) - math.log(n[0][a][b] / sum(n[0][a])) for a in range(STATES) for b in range(STATES)]


def ratio(token, llr: list[float]):
    """Log-likelihood ratio of a token, in nats."""
    weights = F.split(F.lit(",".join(f"{x:.6f}" for x in llr)), ",").cast("array<double>")
    states = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    step = lambda acc, s: F.struct((acc["sum"] + F.when(acc["last"] >= 0, F.get(weights, acc["last"] * STATES + s)).otherwise(0.0)).alias("sum"), s.alias("last"))
    return F.aggregate(states, F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("last")), step)["sum"]


def find_secrets(docs: DataFrame, llr: list[float] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """docs plus secrets: array of (start, kind, end), by start, then kind."""
    llr = llr or train(labelled_samples(docs.sparkSession))
    text = F.coalesce("text", F.lit(""))
    base = [spans_of(text, ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 12), spans_of(text, ACCESS, "access"), spans_of(text, HEX, "hex")]
    more = spans_of(text, CANDIDATE, "markov", lambda m: ratio(m, llr) > threshold)
    return docs.withColumn(own_name("secrets", docs.columns), F.array_sort(F.concat(*base, more)))


def written(spans):
    name = F.split(F.lit(",".join(KINDS)), ",")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(kind: str):
    return F.filter("secrets", lambda s: s["kind"] == KINDS.index(kind))


def redacted(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """docs with each secret (overlapping spans as one) replaced by a mark; columns as given."""
    name, text, none = own_name("secrets", docs.columns), F.col("text"), F.array().cast("array<string>")
    reach = lambda at, s: F.greatest(at, s["end"])

    def pieces(spans, begin):  # of one chunk: cut out of its own stretch of the text
        def cut(own):
            step = lambda acc, s: F.struct(reach(acc["at"], s).alias("at"), F.concat(acc["out"], F.when(s["start"] >= acc["at"], F.array(F.concat(F.substring(own, acc["at"] - begin + 1, s["start"] - acc["at"]), F.lit(mark)))).otherwise(none)).alias("out"))
            return F.aggregate(spans, F.struct(begin.alias("at"), none.alias("out")), step)["out"]

        return let(F.substring(text, begin + 1, F.aggregate(spans, begin, reach) - begin), cut)

    def whole(chunks):
        step = lambda acc, c: F.struct(F.aggregate(c, acc["at"], reach).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        ends = F.aggregate(chunks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step)
        return let(ends, lambda e: F.concat(F.array_join(F.flatten(F.zip_with(chunks, e["out"], pieces)), ""), F.substring(text, e["at"] + 1, F.length(text))))

    found = F.size(name) > 0
    new = {"text": F.when(found, let(chunked(F.col(name)), whole)).otherwise(text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(found, F.length(new["text"])).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return find_secrets(docs).select([new.get(c, F.col(c)).alias(c) for c in docs.columns])


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    df = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(of_kind(k)).cast("long").alias(f"n_{k}")
    base = F.filter("secrets", lambda s: s["kind"] < KINDS.index("markov"))
    return df.select("doc_id", *[count(k) for k in KINDS], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("secrets")).alias("spans"))

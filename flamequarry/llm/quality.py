"""Quality rules from one text (length, repetition, symbols) and from line frequency across documents. Native: SQL functions only.

Lines are normalised (A-Z lower-cased, white space collapsed, trimmed) and hashed. For each host the documents (rows) that
hold a line are counted. A line is above the limit if more than ``limit`` documents of its host hold it, and more than
``share`` percent of them, so the limit grows with a host; such lines are removed, and a document that keeps less than
``depleted`` percent of its words is rejected. Of several documents of a host with equal texts one stays: from that of the
smallest doc_id, lines go only if more than the limit of different texts hold them. Counting is two aggregations that combine
before the shuffle; the frequent lines meet the documents' lines in a shuffle join, so nothing is broadcast and a hot host or
line is split by AQE.

``cleaned`` keeps lines that are frequent in near copies of one another only, whatever their number. For each document and
line, the least hash of the document's other lines is a sample of what stands around the line: near copies mostly have the
same, unrelated documents have their own. A line goes only if, by one of ``SALTS`` such samples, at least a third of its
documents differ. This too is SQL functions only, and looks at lines above the limit alone.

Nulls, blank texts: no words, base_failed. A null host is a host of its own. Repeated rows each get their own result.
``judged`` replaces columns of docs that are named like its own; ``cleaned`` returns all columns of docs as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, lower_ascii, materialize, scan, shared_folder, table, word_array

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
LINE_LIMIT, LINE_SHARE, DEPLETED = 20, 1, 20
SALTS, APART = 3, 3  # samples of a document for each line; documents for each different sample, at most
MIN_WORDS, MAX_REPEAT = 50, 50
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def base_measures(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    own = [c for c in docs.columns if c not in MEASURES]
    docs, text = docs.select(own), F.coalesce("text", F.lit(""))
    length = lambda c: F.length(c).cast("long")
    df = docs.withColumn("_words", word_array(F.col("text"))).withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    # (hash of the window, its place), sorted: windows found twice are neighbours
    window = lambda i: F.struct(F.xxhash64(F.get("_words", i - 1), F.get("_words", i), F.get("_words", i + 1)).alias("h"), i.alias("p"))
    df = df.withColumn("_tri", F.when(F.col("n_words") >= 3, F.sort_array(F.transform(F.sequence(F.lit(1), (F.col("n_words") - 2).cast("int")), window))).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")))
    at = lambda i: F.get("_tri", i)["h"]
    df = df.withColumn("_twice", F.array_sort(F.transform(F.filter("_tri", lambda x, i: F.coalesce(at(i - 1) == x["h"], F.lit(False)) | F.coalesce(at(i + 1) == x["h"], F.lit(False))), lambda x: x["p"])))
    step = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"]).cast("long")).alias("n"), p.alias("last"))
    df = df.withColumn("n_repeat_words", F.aggregate("_twice", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")), step)["n"])
    df = df.withColumns({
        "word_chars": length(F.translate(text, BLANKS, "")),
        "n_symbols": length(text) - length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    # a generator: a filter on a measure stays above it, so the measures are not worked out inside their own lambdas
    return df.select(*own, F.inline(F.array(F.struct(*MEASURES))))


def normal_line(line):
    return F.trim(F.regexp_replace(lower_ascii(line), f"{SPACE}+", " "))


def line_table(docs: DataFrame) -> DataFrame:
    """A row for each normalised line with a word, of each row of docs: row, host, digest, doc_id, line, words, first (of equal lines of the row)."""
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), normal_line), lambda x: x != "")
    found = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.translate(x, " ", "")) + 1).cast("long").alias("words")))
    marked = let(F.sort_array(found), lambda s: F.transform(s, lambda x, i: F.struct(x["line"].alias("line"), x["words"].alias("words"), ((i == 0) | (F.get(s, i - 1)["line"] != x["line"])).cast("int").alias("first"))))
    return docs.select("_row", F.col("source").alias("host"), F.xxhash64("text").alias("digest"), "doc_id", F.explode(marked).alias("x")).select("_row", "host", "digest", "doc_id", "x.*")


def frequent_lines(lines: DataFrame, hosts: DataFrame, limit: int, share: int) -> DataFrame:
    """fhost, fline, always of the lines above the limit; always: whether that holds for different texts (digests) too."""
    counts = lines.groupBy("host", "line", "digest").agg(F.sum("first").alias("documents")).groupBy("host", "line").agg(F.sum("documents").alias("documents"), F.count("*").alias("texts"))
    counts = counts.where(F.col("documents") > limit).join(hosts, F.col("host").eqNullSafe(F.col("h")))
    above = lambda c: (F.col(c) > limit) & (100 * F.col(c) > share * F.col("size"))
    counts = counts.where(above("documents"))
    return counts.select(F.col("host").alias("fhost"), F.col("line").alias("fline"), above("texts").alias("always"))


def held(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    return lines.join(frequent, lines.host.eqNullSafe(F.col("fhost")) & (lines.line == F.col("fline"))).drop("fhost", "fline")


def apart(docs: DataFrame, lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """The frequent lines whose documents are no near copies of one another."""
    held_lines = held(lines, frequent)
    other = lines.groupBy("_row").agg(*[F.min(F.struct(F.xxhash64("line", F.lit(k)), "line")).alias(f"m{k}") for k in range(SALTS)])
    # the least of the other lines: where the line is the least itself, the least of those that are not
    rest = lines.join(other, "_row").groupBy("_row").agg(*[F.min(F.when(F.col("line") != F.col(f"m{k}.line"), F.xxhash64("line", F.lit(k)))).alias(f"n{k}") for k in range(SALTS)])
    samples = other.join(rest, "_row")
    sample = lambda k: F.when(F.col("line") == F.col(f"m{k}.line"), F.col(f"n{k}")).otherwise(F.col(f"m{k}.col1"))
    seen = held_lines.where("first = 1").join(samples, "_row").select("host", "line", F.posexplode(F.array(*[F.coalesce(sample(k), F.lit(0)) for k in range(SALTS)])).alias("salt", "sample"))
    counts = seen.groupBy("host", "line", "salt", "sample").agg(F.count("*").alias("n")).groupBy("host", "line", "salt").agg(F.sum("n").alias("documents"), F.count("*").alias("kinds"))
    counts = counts.groupBy("host", "line").agg(F.max(APART * F.col("kinds") >= F.col("documents")).alias("apart")).where("apart")
    return counts.select(F.col("host").alias("fhost"), F.col("line").alias("fline"), F.lit(True).alias("always"))


def judged(docs: DataFrame, limit: int = LINE_LIMIT, depleted: int = DEPLETED, families: bool = False, share: int = LINE_SHARE) -> DataFrame:
    """docs with the base measures, removed (hashes of its lines above the limit), n_removed_words, kept; families: lines of near copies stay."""
    folder = shared_folder(docs.sparkSession)
    given = ("doc_id", "text", "source")
    docs = docs.withColumn("_row", F.xxhash64(*given, *[F.col(c).isNull() for c in given]))
    lines = materialize(line_table(docs), folder, "lines")
    hosts = docs.groupBy(F.col("source").alias("h")).agg(F.count("*").alias("size"))
    frequent = materialize(frequent_lines(lines, hosts, limit, share), folder, "frequent")
    if families:
        gone = held(lines, apart(docs, lines, frequent))
    else:
        gone = held(lines, frequent)
        copies = docs.groupBy(F.col("source").alias("h"), F.xxhash64("text").alias("d")).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
        gone = gone.join(copies, gone.host.eqNullSafe(F.col("h")) & (gone.digest == F.col("d")), "left")
        first = F.col("n").isNull() | F.col("doc_id").eqNullSafe(F.col("least"))
        gone = gone.where(F.col("always") | ~first)
    # equal rows share _row: their lines are counted once
    repeats = docs.groupBy("_row").agg(F.count("*").alias("copies"))
    gone = gone.groupBy("_row").agg(F.sum("words").alias("all_words"), F.collect_set("line").alias("removed")).join(repeats, "_row").select("_row", (F.col("all_words") / F.col("copies")).cast("long").alias("n_removed_words"), "removed")
    out = base_measures(docs.drop("n_removed_words", "removed", "kept")).join(gone, "_row", "left").drop("_row")
    out = out.withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long"))).withColumn("removed", F.coalesce("removed", F.array().cast("array<bigint>")))
    enough = 100 * (F.col("n_words") - F.col("n_removed_words")) >= depleted * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & enough)


def without_lines(text, removed):
    """text without the lines whose hash is in removed: both sorted together, so no line is compared with all of them."""
    kind = "array<struct<pos:int,line:string>>"
    own = F.transform(F.split(text, "\n"), lambda x, i: F.struct(F.xxhash64(normal_line(x)).alias("h"), F.lit(1).alias("own"), i.alias("pos"), x.alias("line")))
    other = F.transform(removed, lambda h: F.struct(h.alias("h"), F.lit(0).alias("own"), F.lit(-1).alias("pos"), F.lit("").alias("line")))
    empty = F.array().cast(kind)
    emit = lambda at, x: F.when((x["own"] == 1) & ~at.eqNullSafe(x["h"]), F.array(F.struct(x["pos"].alias("pos"), x["line"].alias("line")))).otherwise(empty)
    kept = scan(F.sort_array(F.concat(other, own)), F.lit(None).cast("long"), lambda at, x: F.when(x["own"] == 0, x["h"]).otherwise(at), emit, empty)
    return F.array_join(F.transform(F.sort_array(kept), lambda x: x["line"]), "\n")


def cleaned(docs: DataFrame, limit: int = LINE_LIMIT, depleted: int = DEPLETED) -> DataFrame:
    """The documents kept, their frequent lines removed; columns as given."""
    folder, others = shared_folder(docs.sparkSession), [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    packed = docs.select("doc_id", "text", "source", F.struct(F.lit(0).alias("_"), *others).alias("_given"))
    out = materialize(judged(packed, limit, depleted, families=True), folder, "judged").where("kept")
    out = out.withColumn("text", F.when(F.size("removed") > 0, without_lines(F.col("text"), F.col("removed"))).otherwise(F.col("text")))
    given = {c: F.col("_given").getField(c) for c in others}
    if "n_chars" in given:
        given["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select([given.get(c, F.col(c)).alias(c) for c in docs.columns])


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept")


#: Over {docs}: doc_id, text, source.
JUDGED_SQL = r"""
d AS (SELECT *, row_number() OVER () AS r FROM {docs}),
w AS (SELECT r, unnest(x) AS w, generate_subscripts(x, 1) AS p FROM (SELECT r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda y: y <> '') AS x FROM d)),
t AS (SELECT r, p, w, lead(w) OVER a AS w2, lead(w, 2) OVER a AS w3 FROM w WINDOW a AS (PARTITION BY r ORDER BY p)),
c AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM t WHERE w3 IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, sum(least(3, p - before)) AS n FROM (SELECT r, p, lag(p, 1, -3) OVER (PARTITION BY r ORDER BY p) AS before FROM c) GROUP BY r),
nw AS (SELECT r, count(*) AS n FROM w GROUP BY r),
l AS (SELECT r, source, text, unnest(string_split(coalesce(text, ''), chr(10))) AS l FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM l WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
nl AS (SELECT r, source, text, trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS l FROM l),
h AS (SELECT source, count(*) AS size FROM d GROUP BY source),
first AS (SELECT source, text, min(doc_id) AS least FROM d GROUP BY source, text),
f AS (SELECT nl.source, l, any_value(size) AS size, count(DISTINCT r) AS documents, count(DISTINCT text) AS texts FROM nl JOIN h ON nl.source IS NOT DISTINCT FROM h.source WHERE l <> '' GROUP BY nl.source, l),
g AS (SELECT nl.r, sum(length(nl.l) - length(replace(nl.l, ' ', '')) + 1) AS n FROM nl JOIN d ON nl.r = d.r JOIN first ON d.source IS NOT DISTINCT FROM first.source AND d.text IS NOT DISTINCT FROM first.text
  JOIN f ON nl.l = f.l AND nl.source IS NOT DISTINCT FROM f.source
  WHERE documents > {limit} AND 100 * documents > {share} * size AND (d.doc_id IS DISTINCT FROM least OR (texts > {limit} AND 100 * texts > {share} * size)) GROUP BY nl.r),
m AS (SELECT d.*, coalesce(nw.n, 0) AS n_words,
  length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS n_symbols,
  coalesce(dup.n, 0) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN nw USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN g USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (n_words - n_removed_words) >= {depleted} * n_words AS kept FROM m)
"""


def op3_sql() -> str:
    return "WITH " + JUDGED_SQL.format(docs="documents", limit=LINE_LIMIT, share=LINE_SHARE, depleted=DEPLETED) + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words, kept FROM judged"

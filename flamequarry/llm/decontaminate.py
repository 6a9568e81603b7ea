"""Benchmark decontamination: a prefix-filtered set join of item windows with documents, verified word by word.

A window is 10 consecutive item words (a shorter item is one window). Its shingles (3 words, fewer in a shorter window)
are ordered by the number of documents that hold them. As a window must be contained whole, the prefix that a match
cannot avoid is its rarest shingle: documents are joined with these prefix shingles only. The shingle's place gives the
window's place; bounds drop windows that would begin before the text or end after it, and the words decide.

A benchmark of up to ``block`` windows is one index, bounded by that, which goes to the executors: one pass counts
shingles and one joins, nothing is shuffled by text, and frequent passages and hot sources cost no skew. A larger one is
joined in shuffles, in two passes whatever its size: windows and shingles are tables; a bitmap of their keys (at most
2**``BITS`` bits) leaves out the documents' other shingles; what passes meets the prefix shingles by key, with the words
around it for the verification. A hot shingle has many document rows but only its own windows, so a skewed join splits it.

Nulls: a null text has no words; items with a null item_id or without words are ignored. Repeated document rows each get
a result. Items that share an item_id count once. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shared_folder, table

WINDOW, SHINGLE, BLOCK, BITS = 10, 3, 50_000, 28
#: Bytes of lower-cased words stay (letters, digits, all of UTF-8 beyond ASCII); all others part them.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_WORDS).split()


def item_windows(text: str | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    w = words_of(text)
    return [tuple(w[i : i + window]) for i in range(max(1, len(w) - window + 1))] if w else []


def keys_of(ids: np.ndarray, k: int) -> np.ndarray:
    """A key for each run of k words, 0 where one of them is no item word. Word numbers stay below 2**20 (BLOCK * WINDOW is)."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.int64)
    key, known = ids[:n].copy(), ids[:n] > 0
    for i in range(1, k):
        key = (key << 20) | ids[i : n + i]
        known &= ids[i : n + i] > 0
    return np.where(known, key | (k << 60), 0)


class Block:
    """The windows of a block of items: their words as numbers, and their shingles."""

    def __init__(self, items: list[tuple[int, tuple[bytes, ...]]]):
        owners: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
        for item, window in items:
            owners[window].add(item)
        self.vocabulary: dict[bytes, int] = {}
        for window in owners:
            for w in window:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.windows = [np.array([self.vocabulary[w] for w in window], np.int64) for window in owners]
        self.items = [sorted(x) for x in owners.values()]
        self.shingles = [keys_of(w, min(SHINGLE, len(w))) for w in self.windows]
        self.keys = np.unique(np.concatenate(self.shingles))
        self.lengths = sorted({min(SHINGLE, len(w)) for w in self.windows})

    def found(self, words: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """The text's word numbers; for each shingle length the places and the numbers of known shingles."""
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
        out = []
        for k in self.lengths:
            keys = keys_of(ids, k)
            at = np.flatnonzero(keys)
            if len(at):
                n = np.searchsorted(self.keys, keys[at])
                n[n == len(self.keys)] = 0
                hit = self.keys[n] == keys[at]
                out.append((at[hit], n[hit]))
        return ids, out

    def prefixes(self, df: np.ndarray) -> None:
        """Orders each window's shingles by rarity, ties by key; keeps the rarest and its place."""
        by_prefix: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, own in enumerate(self.shingles):
            n = np.searchsorted(self.keys, own)
            off = min(range(len(own)), key=lambda j: (df[n[j]], own[j]))
            by_prefix[int(n[off])].append((i, off))
        self.by_prefix = dict(by_prefix)
        self.is_prefix = np.zeros(len(self.keys), bool)
        self.is_prefix[list(self.by_prefix)] = True
        self.coded = [w.tobytes() for w in self.windows]

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Places (begin, end) of windows in the text, and their items."""
        ids, known = self.found(words)
        coded, spans, items = None, [], set()
        for at, n in known:
            for p, shingle in zip(at[self.is_prefix[n]].tolist(), n[self.is_prefix[n]].tolist()):
                for i, off in self.by_prefix[shingle]:
                    begin, size = p - off, len(self.windows[i])
                    if begin >= 0 and begin + size <= len(words):
                        coded = ids.tobytes() if coded is None else coded
                        if coded[8 * begin : 8 * (begin + size)] == self.coded[i]:
                            spans.append((begin, begin + size))
                            items.update(self.items[i])
        return spans, items


def block_of(plain: dict) -> Block:
    """The block with this state: executors get plain data, as they may have no copy of this package."""
    out = Block.__new__(Block)
    out.__dict__.update(plain)
    return out


def document_frequency(docs: DataFrame, block: Block) -> np.ndarray:
    sent = docs.sparkSession.sparkContext.broadcast(vars(block))

    def run(batches):
        own = block_of(sent.value)
        df = np.zeros(len(own.keys), np.int64)
        for batch in batches:
            for text in batch.column(0):
                if seen := [n for _, n in own.found(words_of(text.as_py()))[1]]:
                    df[np.unique(np.concatenate(seen))] += 1
        n = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(df[n], pa.int64())], names=["shingle", "documents"])

    counts = docs.select("text").mapInArrow(run, "shingle long, documents long").groupBy("shingle").agg(F.sum("documents")).collect()
    out = np.zeros(len(block.keys), np.int64)
    for n, c in counts:  # at most the block's shingles
        out[n] = c
    return out


FOUND = "doc_id long, digest long, n_words long, spans array<struct<begin:int,end:int>>, items array<bigint>"


def matched(docs: DataFrame, block: Block | None) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(vars(block) if block else None)

    def run(batches):
        own = block_of(sent.value) if sent.value else None
        for batch in batches:
            size, spans, items = [], [], []
            for text in batch.column(2):
                words = words_of(text.as_py())
                s, i = own.matches(words) if own else ([], set())
                size.append(len(words))
                spans.append([{"begin": b, "end": e} for b, e in sorted(set(s))])
                items.append(sorted(i))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))), pa.array(items, pa.list_(pa.int64()))], names=["doc_id", "digest", "n_words", "spans", "items"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), "text").mapInArrow(run, FOUND)


def hashed(words: list[bytes], k: int, seen: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of the runs of k words."""
    if len(seen) > 1 << 19:
        seen.clear()
    x = np.fromiter((seen.get(w) or seen.setdefault(w, xxhash.xxh64_intdigest(w)) for w in words), np.uint64, len(words))
    out = x[: max(0, len(x) - k + 1)] + np.uint64(k)
    for i in range(1, k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + x[i : len(out) + i]
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def window_table(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, window (words joined by spaces), distinct."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = [(i, b" ".join(w).decode()) for i, t in zip(batch.column(0).slice(at, 64).to_pylist(), batch.column(1).slice(at, 64).to_pylist()) for w in item_windows(t, window)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([w for _, w in rows], pa.string())], names=["item_id", "window"])

    return benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null").mapInArrow(run, "item_id long, window string").distinct()


def window_shingles(windows: DataFrame) -> DataFrame:
    """window, k (words of a shingle), place, key of each shingle of each window."""

    def run(batches):
        seen: dict[bytes, int] = {}
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                words = text.encode().split(b" ")
                k = min(SHINGLE, len(words))
                rows += [(text, k, i, h) for i, h in enumerate(hashed(words, k, seen).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, (pa.string(), pa.int32(), pa.int32(), pa.int64()))], names=["window", "k", "place", "key"])

    return windows.select("window").distinct().mapInArrow(run, "window string, k int, place int, key long")


def bitmap(keys: DataFrame, count: int) -> np.ndarray:
    """A bit for each key (its low bits), in at most 2**BITS bits: it lets other keys pass, a join decides."""
    bits = min(BITS, max(10, (16 * count).bit_length()))
    rows = keys.select((F.col("key").bitwiseAND(F.lit((1 << bits) - 1))).alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("b").bitwiseAND(F.lit(63)).cast("int"))).alias("v"))
    out = np.zeros(max(1, (1 << bits) >> 6), np.int64)
    for w, v in rows.toLocalIterator():
        out[w] = v
    return out


def passing(keys: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Places of the keys whose bit is set."""
    b = keys & (len(own) * 64 - 1)
    return np.flatnonzero((own[b >> 6] >> (b & 63)) & 1)


def joined(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """What matched() gives, for benchmarks of any size: windows and documents meet in shuffles."""
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    windows = materialize(window_table(benchmark, window), folder, "windows")
    shingles = materialize(window_shingles(windows), folder, "shingles")
    lengths = sorted(r[0] for r in shingles.select("k").distinct().collect())
    keys = materialize(shingles.select("key").distinct(), folder, "keys")
    sent = spark.sparkContext.broadcast((bitmap(keys, keys.count()), lengths))

    def held(batches):
        own, lengths = sent.value
        seen: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                found = [h[passing(h, own)] for h in (hashed(words, k, seen) for k in lengths)]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)) if found else [], pa.int64())], names=["key"])

    frequency = docs.select("text").mapInArrow(held, "key long").groupBy("key").agg(F.count("*").alias("documents"))
    frequency = materialize(frequency.join(keys, "key", "left_semi"), folder, "frequency")
    ranked = shingles.join(frequency, "key")  # a window with a shingle that no document holds drops out below
    rarest = F.min(F.struct("documents", "key", "place", "k")).alias("r")
    prefixes = ranked.groupBy("window").agg(rarest, F.count("*").alias("n")).where("n = size(split(window, ' ')) - r.k + 1").select("window", "r.key", "r.place", "r.k")
    prefixes = materialize(prefixes, folder, "prefixes")
    prefix_keys = prefixes.select("key").distinct()
    wanted = spark.sparkContext.broadcast((bitmap(prefix_keys, prefixes.count()), lengths))

    def placed(batches):
        from pyspark import TaskContext

        own, lengths = wanted.value
        seen: dict[bytes, int] = {}
        home, n = TaskContext.get().partitionId() << 40, 0
        names = ["row", "doc_id", "digest", "n_words", "key", "at", "before", "around"]
        kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.string()]
        for batch in batches:
            for i, d, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                words = words_of(text)
                rows = [(home + n, i, d, len(words), None, None, None, None)]
                for k in lengths:
                    h = hashed(words, k, seen)
                    for at in passing(h, own).tolist():
                        low = max(0, at - window + 1)
                        rows.append((home + n, None, None, None, int(h[at]), at, at - low, b" ".join(words[low : at + window]).decode()))
                n += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    kind = "row long, doc_id long, digest long, n_words long, key long, at int, before int, around string"
    rows = materialize(docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), "text").mapInArrow(placed, kind), folder, "placed")
    met = rows.where("key is not null").select("row", "key", "at", "before", "around").join(prefixes, "key").where("place <= before")
    own = F.split("window", " ")
    met = met.select("row", "window", (F.col("at") - F.col("place")).alias("begin"), F.size(own).alias("size"), F.slice(F.split("around", " "), F.col("before") - F.col("place") + 1, F.size(own)).alias("words"), own.alias("own"))
    hits = materialize(met.where("words = own").select("row", "window", "begin", (F.col("begin") + F.col("size")).alias("end")).distinct(), folder, "hits")
    spans = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    items = hits.select("row", "window").distinct().join(windows, "window").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    out = rows.where("key is null").select("row", "doc_id", "digest", "n_words").join(spans, "row", "left").join(items, "row", "left")
    none = lambda c, t: F.coalesce(c, F.array().cast(t)).alias(c)
    return out.select("doc_id", "digest", "n_words", none("spans", "array<struct<begin:int,end:int>>"), none("items", "array<bigint>"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """For each row of docs: doc_id, digest (of its text), n_words, spans (of words, begin and end), items."""
    words = F.size(F.split(F.coalesce("text", F.lit("")), "[^0-9A-Za-z\\x80-\\x{10FFFF}]+"))  # at least the words of a text
    most = benchmark.where("item_id is not null").select(F.greatest(F.lit(1), words - window + 1).cast("long").alias("n")).agg(F.sum("n")).first()[0] or 0
    if most > block:
        return joined(docs, benchmark, window)
    items = [(i, w) for i, t in benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null").collect() for w in item_windows(t, window)]  # at most block windows
    if not items:
        return matched(docs, None)
    own = Block(items)
    own.prefixes(document_frequency(docs, own))
    return matched(docs, own)


def hit_words(spans):
    """Words under any of the sorted spans."""
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["begin"], acc["last"]))).alias("n"), F.greatest(acc["last"], s["end"]).alias("last"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("last")), step)["n"].cast("long")


def reported(found: DataFrame) -> DataFrame:
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", hit_words(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def cleaned(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a window of any item."""
    bad = contamination(docs, benchmark).where(F.size("spans") > 0).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    bad = materialize(bad, shared_folder(docs.sparkSession), "contaminated")
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_digest")), "left_anti")


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    return reported(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


#: Over {docs}: doc_id, text.
CONTAMINATED_SQL = r"""
bi AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(x), 10) AS k, array_to_string(x[i:i + 9], ' ') AS s FROM (SELECT *, unnest(range(1, greatest(len(x) - 9, 1) + 1)) AS i FROM bi WHERE len(x) > 0)),
bd AS (SELECT *, row_number() OVER () AS r FROM {docs}),
dx AS (SELECT r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM bd),
bk AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, i, k, array_to_string(x[i:i + k - 1], ' ') AS s FROM (SELECT r, x, k, unnest(range(1, len(x) - k + 2)) AS i FROM dx, bk WHERE len(x) >= k)),
hit AS (SELECT r, i, bw.k, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.k = bw.k),
hw AS (SELECT r, count(DISTINCT i + o) AS n FROM (SELECT DISTINCT r, i, unnest(range(0, k)) AS o FROM hit) GROUP BY r),
hi AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY r)
"""


def op10_sql() -> str:
    return "WITH " + CONTAMINATED_SQL.format(docs="documents").strip() + " SELECT doc_id, CAST(len(x) AS BIGINT) AS n_words, coalesce(hw.n, 0) AS n_hit, coalesce(hi.n, 0) AS n_items, sha256(coalesce(hi.s, '')) AS items_sha256, hw.n IS NOT NULL AS contaminated FROM dx LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)"


def digest(items) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()

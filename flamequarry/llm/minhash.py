"""MinHash near-duplicate groups: universal hash minima, banding, verification, star-contraction components.

1. One Arrow pass makes each text's set of shingle hashes, its digest and its signature. Texts with equal sets form a
   class, the node of all that follows: copies, and rows that share a doc_id, cost one row each, never pairs.
2. Signatures are cut into bands; classes that share a band's minima meet in a bucket. A pair goes on from the first band
   that it shares only, if its signatures agree in enough places, and is confirmed on the full sets built from both texts.
   Buckets of any size take these three steps, in one of two physical forms:
   * up to ``small`` members: a self-join by bucket (at most (small-1)/2 rows a member);
   * above: blocks of members, bounded in documents and in shingles. Each pair of blocks is a task that compares signatures
     in batches; only members with an agreeing pair not met in an earlier band go on, and their intersections are counted
     exactly by matrix products over slices of the shingles, of which a spanning forest of the links is returned.
3. Components: alternating large-star and small-star until nothing changes, each round written to the shared folder.

A pair at the threshold shares no band with a chance of (1 - s**rows)**bands (below 4e-7 at s = 0.85, 3e-5 at 0.8), and its
signatures agree in fewer than the required places (six standard deviations below the mean) with one below 2e-8.

Nulls, blank texts: no shingles, linked with nothing, component of their own. A null doc_id is kept as it is and
linked with nothing. Each row is a document of its own: rows of one doc_id with equal texts are copies, those with other
texts have other components, and each row's component is named by the smallest doc_id of its component. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import bloom_split, discard, fresh_name, materialize, shared_folder

SHINGLE = 5
BANDS, ROWS = 20, 4
SMALL, BLOCK, SLICE = 32, 512, 4096
LONG = 2048  # shingles of an average member of a full block
CACHE = 1 << 18
MIX = 0x9E3779B97F4A7C15


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word):
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(text: str | None, words: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a lower-cased (A-Z) text."""
    tokens = (text or "").encode().lower().split()
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    x = np.fromiter(map(words.__getitem__, tokens), np.uint64, n)
    k = min(shingle, n)
    out = x[: n - k + 1] + np.uint64(k)
    for i in range(1, k):
        out = out * np.uint64(MIX) + x[i : n - k + 1 + i]
        out ^= out >> np.uint64(29)
    return np.unique(out)


def digest_of(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def universal(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift functions: odd factors and offsets."""
    rng = np.random.default_rng(seed)
    return rng.integers(1, 2**63, count, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, count, dtype=np.uint64)


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(hashes), 2048):  # stays in cache
        m = (a[:, None] * hashes[None, at : at + 2048] + b[:, None]) >> np.uint64(32)
        np.minimum(out, m.min(1).astype(np.uint32), out=out)
    return out


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, class (digest of the shingle set, null without words), n_shingles, signature."""

    def run(batches):
        words, (a, b) = WordHashes(), universal(bands * rows)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, len(ids), 512):
                cls, size, sig = [], [], []
                for text in texts.slice(at, 512).to_pylist():
                    h = shingle_hashes(text, words, shingle)
                    size.append(len(h))
                    cls.append(digest_of(h) if len(h) else None)
                    sig.append(minima(h, a, b).astype("<u4").tobytes() if len(h) else None)
                yield pa.RecordBatch.from_arrays([ids.slice(at, 512), pa.array(cls, pa.binary()), pa.array(size, pa.int64()), pa.array(sig, pa.binary())], names=["doc_id", "class", "n_shingles", "signature"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, class binary, n_shingles long, signature binary")


LINKS = "a binary, b binary"


def linked(inter, a, b, percent: int):
    return 100 * inter >= percent * (a + b - inter)


def confirm(pairs: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """Rows a, b (classes), text_a, text_b -> the links among them, on full sets."""

    def run(batches):
        words = WordHashes()
        for batch in batches:
            a, keep, last, last_set = batch.column(0).to_pylist(), [], None, None
            for i in range(len(a)):
                if a[i] != last:
                    last, last_set = a[i], shingle_hashes(batch.column(2)[i].as_py(), words, shingle)
                other = shingle_hashes(batch.column(3)[i].as_py(), words, shingle)
                inter = len(np.intersect1d(last_set, other, assume_unique=True))
                if linked(inter, len(last_set), len(other), percent):
                    keep.append(i)
            keep = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, LINKS)


def forest(ids: list[bytes], sets: list[np.ndarray], percent: int) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links among these sets; all intersections are counted."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner, flat = np.repeat(np.arange(n), sizes), np.concatenate(sets)
    value, column, df = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.cumsum(df > 1) - 1  # shingles of one document alone meet nothing
    shared = df[column] > 1
    owner, column = owner[shared], rank[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    inter = np.zeros((n, n), np.float32)  # counts below 2**24 are exact
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, SLICE):
        lo, hi = np.searchsorted(column, [at, at + SLICE])
        x = np.zeros((n, min(SLICE, width - at)), np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        inter += x @ x.T
    link = linked(inter.astype(np.int64), sizes[:, None], sizes[None, :], percent)
    seen, out = np.zeros(n, bool), []
    for root in range(n):
        if seen[root]:
            continue
        seen[root], stack = True, [root]
        while stack:
            i = stack.pop()
            for j in np.flatnonzero(link[i] & ~seen):
                seen[j] = True
                out.append((ids[i], ids[j]))
                stack.append(int(j))
    return out


def fewest(count: int, percent: int) -> int:
    """Places in which the signatures of a pair at the threshold agree: six standard deviations below the mean."""
    s = percent / 100
    return int(s * count - 6 * (s * (1 - s) * count) ** 0.5)


def earlier_bands(x: np.ndarray, y: np.ndarray, band: int, rows: int) -> np.ndarray:
    """For signatures x and y: whether each pair shares all minima of a band before this one."""
    out = np.zeros((len(x), len(y)), bool)
    for k in range(band):
        same = np.ones_like(out)
        for i in range(k * rows, (k + 1) * rows):
            same &= x[:, i, None] == y[None, :, i]
        out |= same
    return out


def block_members(placed: DataFrame, percent: int, count: int, rows: int) -> DataFrame:
    """Rows band, key, left, right, class, part, n_shingles, signature (one group: a pair of blocks) -> its members with an agreeing pair."""
    least = fewest(count, percent)

    def run(key, group):
        band, left, right = key[0].as_py(), key[2].as_py(), key[3].as_py()
        sig = np.frombuffer(b"".join(group.column("signature").to_pylist()), "<u4").reshape(-1, count)
        size, part = group.column("n_shingles").to_numpy(), group.column("part").to_numpy()
        x, y = np.flatnonzero(part == left), np.flatnonzero(part == right)
        wanted = np.zeros(len(part), bool)
        for at in range(0, len(x), 128):
            i = x[at : at + 128]
            agree = np.zeros((len(i), len(y)), np.uint16)
            for k in range(count):
                agree += sig[i, k, None] == sig[None, y, k]
            ok = (agree >= least) & (100 * np.minimum(size[i, None], size[None, y]) >= percent * np.maximum(size[i, None], size[None, y]))
            if left == right:
                ok &= i[:, None] < y[None, :]
            if band and ok.any():
                ok &= ~earlier_bands(sig[i], sig[y], band, rows)
            wanted[i] |= ok.any(1)
            wanted[y] |= ok.any(0)
        return group.select(["band", "key", "left", "right", "class"]).filter(pa.array(wanted))

    return placed.groupBy("band", "key", "left", "right").applyInArrow(run, "band int, key long, left int, right int, class binary")


def block_links(members: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """Rows band, key, left, right, class, text (one group: a pair of blocks) -> links."""

    def run(group):
        words = WordHashes()
        ids, sets = [], []
        for i, text in zip(group.column("class").to_pylist(), group.column("text")):
            ids.append(i)
            sets.append(shingle_hashes(text.as_py(), words, shingle))
        found = forest(ids, sets, percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())})

    return members.groupBy("band", "key", "left", "right").applyInArrow(run, LINKS)


def components(edges: DataFrame, folder: str, most: int = 40) -> DataFrame:
    """(node, component) for each node of edges (a, b): alternating large-star and small-star.

    large-star: each node links its larger neighbours to the smallest of itself and its neighbours.
    small-star: each node links its smaller neighbours and itself to the smallest of them.
    Ends when a round leaves the edges as they were; each edge then leads to its component's smallest node.
    """
    spark = edges.sparkSession
    small, large = F.least("a", "b"), F.greatest("a", "b")

    def state(df):  # the edges' number and an order-free digest
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now, before = materialize(edges.where("a <> b").select(small.alias("a"), large.alias("b")).distinct(), folder, "edges0"), None
    for k in range(1, most + 1):
        if (s := state(now)) == before or not s[0]:
            break
        before = s
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large_star = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # every edge is now (smaller, larger): small-star looks from the larger end
        least = large_star.groupBy("b").agg(F.min("a").alias("m"))
        star = large_star.join(least, "b").select(F.explode(F.array("a", "b")).alias("b"), F.col("m").alias("a")).where("a <> b").select("a", "b").distinct()
        now = materialize(star, folder, f"edges{k}")
        discard(spark, folder, f"edges{k - 1}")
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))


def near_duplicates(docs: DataFrame, percent: int = 80, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept, class, component (its smallest class).

    Links texts with 100 * intersection >= percent * union of their shingle sets.
    """
    folder, count = shared_folder(docs.sparkSession), bands * rows
    signed = materialize(signatures(docs, bands, rows, shingle), folder, "signed")
    usable = signed.where("class is not null and doc_id is not null")
    classes = usable.groupBy("class").agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("r")).select("class", "r.*")
    classes = materialize(classes, folder, "classes")
    width = 4 * rows
    buckets = classes.select("class", "n_shingles", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(F.substring("signature", i * width + 1, F.lit(width))))).alias("band", "key"))
    buckets = materialize(buckets, folder, "buckets")
    sizes = buckets.groupBy("band", "key").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("shingles")).where("members > 1")
    met = materialize(buckets.drop("n_shingles").join(sizes, ["band", "key"]), folder, "met")
    sig = classes.select("class", "n_shingles", "signature")
    # small buckets: pairs, then signatures
    few = met.where(F.col("members") <= small)
    pairs = few.select("band", "key", F.col("class").alias("a")).join(few.select("band", "key", F.col("class").alias("b")), ["band", "key"]).where("a < b").select("a", "b").distinct()
    pairs = pairs.join(sig.toDF("a", "na", "sa"), "a").join(sig.toDF("b", "nb", "sb"), "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    pairs = materialize(agreeing(pairs, count, percent), folder, "pairs")
    # crowded buckets: pairs of blocks, then signatures
    parts = F.ceil(F.greatest(F.col("members") / block, F.col("shingles") / (block * LONG))).cast("int")
    crowd = met.where(F.col("members") > small).select("band", "key", "class", parts.alias("parts"), F.pmod(F.xxhash64("class"), parts).cast("int").alias("part"))
    placed = crowd.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")).select("band", "key", "class", "part", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"))
    members = materialize(block_members(placed.join(sig, "class"), percent, count, rows), folder, "members")
    # the texts of the classes in question, once
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).union(members.select("class")).distinct()
    wanted = materialize(wanted.join(classes.select("class", "doc_id"), "class"), folder, "wanted")
    # a doc_id may have several texts: a text is known by its digest there too
    texts = bloom_split(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id", wanted.select("doc_id").distinct(), folder, "wanted_filter")[0]
    texts = texts.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = materialize(with_class(texts.select("text"), "class", shingle).join(wanted.select("class"), "class", "left_semi").groupBy("class").agg(F.min("text").alias("text")), folder, "texts")
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").sortWithinPartitions("a")
    links = confirm(both, percent, shingle).union(block_links(members.join(texts, "class"), percent, shingle))
    found = materialize(components(links, folder), folder, "components")
    # a component is named by its smallest doc_id
    named = classes.select("class", "doc_id").join(found.toDF("class", "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    linked_ids = named.join(found.select(F.col("component")).distinct(), "component", "left_semi").groupBy("component").agg(F.min("doc_id").alias("least"))
    homes = named.join(linked_ids, "component", "left").select("class", "component", F.coalesce("least", "doc_id").alias("component_id"))
    out = signed.select("doc_id", "class", "n_shingles").join(homes, "class", "left")
    home = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    named = lambda c: F.lower(F.hex(c)).alias(c)
    return out.select("doc_id", "n_shingles", home.alias("component_id"), F.coalesce(home == F.col("doc_id"), F.lit(True)).alias("kept"), named("class"), named("component"))


def with_class(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """docs plus the class of each text (null without words)."""

    def run(batches):
        words = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, found = batch.slice(at, 512), []
                for text in part.column(part.schema.get_field_index("text")):
                    h = shingle_hashes(text.as_py(), words, shingle)
                    found.append(digest_of(h) if len(h) else None)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=[*part.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def agreeing(pairs: DataFrame, count: int, percent: int) -> DataFrame:
    """The pairs whose signatures agree in enough places."""
    least = fewest(count, percent)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, count) for i in (2, 3))
            keep = pa.array((a == b).sum(1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, LINKS)


def op1_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates: of its smallest doc_id, and of that id's rows in the group the one with the smallest text; columns as given.

    Rows of one doc_id whose texts are in different groups are judged apart. Only rows whose doc_id may be a removed or a
    repeated one are shuffled. Rows without doc_id stay; of those without words one stays for each doc_id.
    """
    folder, own = shared_folder(docs.sparkSession), docs.columns
    groups = materialize(near_duplicates(docs, percent).select("doc_id", "class", "component", "kept"), folder, "groups").where("doc_id is not null")
    special = groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("kept").alias("kept")).where("n > 1 or not kept")
    special = materialize(special, folder, "special")
    key, cls, kept, row = (fresh_name(x, own) for x in ("key", "class", "kept", "row"))
    keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    maybe, clear = bloom_split(keyed, key, special.select(F.col("doc_id").alias(key)), folder, "special_filter")
    marked = maybe.join(special.select(F.col("doc_id").alias(key), F.struct("n", "kept").alias(kept)), key, "left")
    single = marked.where(f"{kept} is null or ({kept}.n = 1 and {kept}.kept)").select(own)
    # several rows of an id: one for each group that they lead
    leads = groups.where("kept").select(F.col("doc_id").alias(key), F.unhex("class").alias(cls), F.coalesce("component", F.lit("")).alias(kept)).distinct()
    several = with_class(marked.where(f"{kept}.n > 1").drop(kept), cls)
    several = several.join(leads.withColumnsRenamed({key: f"{key}2", cls: f"{cls}2"}), (F.col(key) == F.col(f"{key}2")) & F.col(cls).eqNullSafe(F.col(f"{cls}2")))
    first = several.groupBy(key, kept).agg(F.min_by(F.struct(*own), F.coalesce("text", F.lit(""))).alias(row)).select([F.col(row).getField(c).alias(c) for c in own])
    return single.unionByName(first).unionByName(clear.select(own))

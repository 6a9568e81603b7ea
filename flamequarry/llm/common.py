"""What the operators of this subpackage share: tables, the shared folder, words."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java and RE2 class of the white space that separates words.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Only a local session (tests) may leave that unset: executors elsewhere would not share a folder of ours."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = "/tmp/checkpoints/flamequarry"
    return f"{top.rstrip('/')}/fq-{uuid.uuid4().hex}"


def fresh_name(name: str, columns: list[str]) -> str:
    """A column name that none of columns has, whatever its case."""
    taken = {c.lower() for c in columns}
    name = f"_{name}"
    while any(c.startswith(name) for c in taken):
        name = f"_{name}"
    return name


def own_name(name: str, columns: list[str]) -> str:
    """The name of a column that an operator adds: with underscores before it where the input has one of that name."""
    return name if name.lower() not in {c.lower() for c in columns} else fresh_name(name, columns)


def let(value, body):
    """body of value, which is worked out once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Elements that scan() takes at once.
CHUNK = 256


def scan(items, zero, carry, emit, empty):
    """Left to right over an array: emit(state, x) gives an array of outputs, carry(state, x) the state after x.

    Arrays of Spark are copied when something is appended, so a plain aggregate is quadratic. Here the states at the
    begin of each chunk come first, then each chunk's outputs: n * CHUNK / 2 + (n / CHUNK)**2 / 2 copied elements.
    """
    def outputs(chunks):
        step = lambda acc, c: F.struct(F.aggregate(c, acc["at"], carry).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        states = F.aggregate(chunks, F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out")), step)["out"]
        inner = lambda acc, x: F.struct(carry(acc["at"], x).alias("at"), F.concat(acc["out"], emit(acc["at"], x)).alias("out"))
        return let(states, lambda begins: F.flatten(F.zip_with(chunks, begins, lambda c, b: F.aggregate(c, F.struct(b.alias("at"), empty.alias("out")), inner)["out"])))

    return let(items, lambda xs: let(chunked(xs), outputs))


def chunked(xs):
    """An array as arrays of CHUNK elements; one empty array if it has none."""
    last = F.floor((F.greatest(F.size(xs), F.lit(1)) - 1) / CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(xs, k * CHUNK + 1, F.lit(CHUNK)))


def materialize(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, and a lost executor costs no recomputation."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str, name: str = "") -> None:
    """Delete a table (or everything) of the shared folder that no later plan reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}" if name else folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_ascii(column):
    return F.translate(column, UPPER, LOWER)


def word_array(column):
    """Maximal runs without white space; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(column, F.lit("")), f"{SPACE}+"), lambda w: w != "")


#: Bits of a Bloom filter for each value.
BLOOM_BITS = 16


def bloom_place(value, blocks: int) -> dict:
    """The 256-bit block of a value, and the masks (four longs) of its eight bits there."""
    h = F.xxhash64(F.lit("bits"), value)
    at = [F.shiftrightunsigned(h, 8 * i).bitwiseAND(F.lit(255)).cast("int") for i in range(8)]
    one = lambda p, w: F.when(F.shiftright(p, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)))).otherwise(F.lit(0).cast("long"))
    return {"block": F.pmod(F.xxhash64(value), F.lit(blocks))} | {f"m{w}": reduce(lambda a, b: a.bitwiseOR(b), [one(p, w) for p in at]) for w in range(4)}


def bloom_filter(values: DataFrame, column: str, count: int, bits: int = BLOOM_BITS, most_blocks: int | None = None) -> tuple[DataFrame, int]:
    """The filter of a column as a table of blocks (block, f0..f3), and their number."""
    blocks = max(1, -(-count * bits // 256))
    blocks = min(blocks, most_blocks) if most_blocks else blocks
    placed = values.select([c.alias(k) for k, c in bloom_place(F.col(column), blocks).items()])
    return placed.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"f{w}") for w in range(4)]), blocks


def bloom_fits():
    """Whether the masks m0..m3 lie in the block f0..f3."""
    return reduce(lambda a, b: a & b, [F.col(f"m{w}").bitwiseAND(F.col(f"f{w}")) == F.col(f"m{w}") for w in range(4)])


def bloom_split(df: DataFrame, key: str, values: DataFrame, folder: str, name: str, most_blocks: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """The rows of df whose key may be in values (a column of the same name, distinct), and those whose key is not: no shuffle of df.

    The filter is broadcast; most_blocks bounds it (10 MB). Beyond that it lets more rows pass, and a join decides anyway.
    """
    bloom, blocks = bloom_filter(values, key, values.count(), most_blocks=most_blocks)
    bloom = materialize(bloom, folder, name)
    own = df.columns
    mark = f"_{name}"
    marked = df.withColumns({f"{mark}_{k}": c for k, c in bloom_place(F.col(key), blocks).items()})
    bloom = F.broadcast(bloom.toDF(*[f"{mark}_b{i}" for i in range(5)]))
    marked = marked.join(bloom, F.col(f"{mark}_block") == F.col(f"{mark}_b0"), "left")
    fits = reduce(lambda a, b: a & b, [F.col(f"{mark}_m{w}").bitwiseAND(F.col(f"{mark}_b{w + 1}")) == F.col(f"{mark}_m{w}") for w in range(4)])
    fits = F.coalesce(fits, F.lit(False)) & F.col(key).isNotNull()
    return marked.where(fits).select(own), marked.where(~fits).select(own)

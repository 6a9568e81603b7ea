"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are context, and only that reply is under the
loss mask. Turns that follow the last reply (or a conversation without one) come in a closing example without a target,
so the formatted output holds every turn. Rows are dealt by conversation, sorted by turn and streamed: a task holds one
conversation's prefix at a time. What is written grows with the square of a conversation's length, as the method asks; so a
conversation of more than ``long`` rows is cut into ranges of ``span`` rows in order, and each range is a task of its own,
which reads all rows up to its end and writes the examples of its own. No task writes more than ``span`` examples, and rows
are copied once for each later range only.

Nulls: a null text or role is empty; a null conv_id is a conversation, a null turn comes first. Rows with equal turns are
taken in the order of role, then text. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bloom_split, materialize, shared_folder, table

#: The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
PLANTED = END + START + "assistant ok"
EXAMPLES = "conv_id long, example int, text string, loss_start int, loss_end int, spread boolean, closing boolean"
LONG, SPAN = 512, 256


def escape(text: str) -> str:
    r"""One backslash more between < and |: the result holds no <|, and unescape() takes it away again."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turn_text(role: str, text: str) -> tuple[str, str, str]:
    return f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"


TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of every turn of a formatted example."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return out


def streamed(rows: DataFrame, spread: bool) -> DataFrame:
    """Examples of rows conv_id, part, span, emit, last, role, text that lie together and in order by (conv_id, part, span)."""
    schema = pa.schema([("conv_id", pa.int64()), ("example", pa.int32()), ("text", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("spread", pa.bool_()), ("closing", pa.bool_())])

    def run(batches):
        now, prefix, n, tail, size, rows = (), "", 0, False, 0, []

        def add(start, end):
            nonlocal size
            rows.append({"conv_id": now[0], "example": n, "text": prefix, "loss_start": start, "loss_end": end, "spread": spread, "closing": False})
            size += len(prefix)

        def close():  # a group ends: what follows its last reply, and its last example
            if now and tail and now[3]:
                add(None, None)
            if now and now[3] and rows:
                rows[-1]["closing"] = True

        for batch in batches:
            for conv, part, span, emit, last, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now[:3] != (conv, part, span):
                    close()
                    now, prefix, n, tail = (conv, part, span, last), "", 0, False
                head, body, foot = turn_text(role or "", text or "")
                start = len(prefix) + len(head)
                prefix += head + body + foot
                tail = role != "assistant"
                if not tail:
                    if emit:
                        add(start, start + len(body))
                    n += 1
                if size > 1 << 20 or len(rows) > 2000:  # the newest may be a group's last
                    yield pa.RecordBatch.from_pylist(rows[:-1], schema=schema)
                    del rows[:-1]
                    size = 0
        close()
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return rows.select("conv_id", "part", "span", "emit", "last", "role", "text").mapInArrow(run, EXAMPLES)


def expand(conversations: DataFrame, long: int = LONG, span: int = SPAN) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end (code points; both null without a target), in order within each conversation that is not spread over tasks; closing: a conversation's last example."""
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    folder = shared_folder(rows.sparkSession)
    hot = rows.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > long).select(F.xxhash64("conv_id").alias("key")).distinct()
    hot = materialize(hot, folder, "long")
    whole = lambda df: streamed(df.repartition("conv_id").sortWithinPartitions(*order).select(*order, F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("span"), F.lit(True).alias("emit"), F.lit(True).alias("last")), False)
    if hot.isEmpty():
        return whole(rows)
    maybe, clear = bloom_split(rows.withColumn("key", F.xxhash64("conv_id")), "key", hot, folder, "long_filter")
    short = clear.unionByName(maybe.join(hot, "key", "left_anti").select(clear.columns))
    # long ones: sorted over all tasks, numbered within each, cut into ranges
    placed = maybe.join(hot, "key", "left_semi").select(order).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.select("*", F.spark_partition_id().cast("long").alias("own_part"), F.monotonically_increasing_id().alias("at")), folder, "placed")
    within = Window.partitionBy("conv_id", "own_part").orderBy("at")
    placed = placed.withColumn("own_span", F.floor((F.row_number().over(within) - 1) / span))
    ranges = materialize(placed.groupBy("conv_id", "own_part", "own_span").agg(F.count("*").alias("n")), folder, "ranges").drop("n")
    ends = ranges.groupBy("conv_id").agg(F.max(F.struct("own_part", "own_span")).alias("end"))
    later = ranges.toDF("c", "part", "span").join(ends.withColumnRenamed("conv_id", "e"), F.col("c").eqNullSafe(F.col("e"))).select("c", "part", "span", (F.struct("part", "span") == F.struct(F.col("end.own_part").alias("part"), F.col("end.own_span").alias("span"))).alias("last"))
    pairs = ranges.join(later, F.col("conv_id").eqNullSafe(F.col("c")) & ((F.col("own_part") < F.col("part")) | ((F.col("own_part") == F.col("part")) & (F.col("own_span") <= F.col("span"))))).drop("c")
    pairs = pairs.toDF("c", "p", "s", "part", "span", "last")
    dealt = placed.join(pairs, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("own_part") == F.col("p")) & (F.col("own_span") == F.col("s")))
    dealt = dealt.withColumn("emit", (F.col("own_part") == F.col("part")) & (F.col("own_span") == F.col("span")))
    return whole(short).unionByName(streamed(dealt.repartition("conv_id", "part", "span").sortWithinPartitions("conv_id", "part", "span", "at"), True))


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(examples: DataFrame) -> DataFrame:
    """For each conversation of expand()'s rows: the digests of what the formatted text says."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def said_by(formatted):
        turns = read_turns(formatted)
        return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()

    def run(batches):
        now, loss, loss_chars, chars, text, out = (), None, 0, 0, "", []

        def close():
            turns, digest = said_by(text)
            return {"conv_id": now[0], "n_turns": turns, "turns_sha256": digest, "loss_chars": loss_chars, "loss_sha256": loss.hexdigest(), "formatted_chars": chars}

        for batch in batches:
            for i in range(batch.num_rows):
                conv, formatted, start, end = (batch.column(k)[i].as_py() for k in range(4))
                if now != (conv,):
                    if now:
                        out.append(close())
                    now, loss, loss_chars, chars = (conv,), hashlib.sha256(), 0, 0
                if start is not None:
                    target = unescape(formatted[start:end])
                    loss.update(target.encode())
                    loss_chars += len(target)
                chars += len(formatted)
                text = formatted  # the last example holds every turn
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out = []
        if now:
            yield pa.RecordBatch.from_pylist([close()], schema=schema)

    parts = pa.schema([("conv_id", pa.int64()), ("example", pa.int32()), ("target", pa.string()), ("chars", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string())])

    def one(batches):  # an example of a spread conversation: its target, and of the closing one what all turns say
        for batch in batches:
            rows = []
            for conv, n, formatted, start, end, closing in zip(*(c.to_pylist() for c in batch.columns)):
                turns, digest = said_by(formatted) if closing else (None, None)
                rows.append({"conv_id": conv, "example": n, "target": unescape(formatted[start:end]) if start is not None else None, "chars": len(formatted), "n_turns": turns, "turns_sha256": digest})
            yield pa.RecordBatch.from_pylist(rows, schema=parts)

    def fold(batches):
        now, out = (), None
        for batch in batches:
            ready = []
            for conv, _, target, chars, turns, digest in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (conv,):
                    if out:
                        ready.append(out | {"loss_sha256": out["loss_sha256"].hexdigest()})
                    now, out = (conv,), {"conv_id": conv, "n_turns": 0, "turns_sha256": "", "loss_chars": 0, "loss_sha256": hashlib.sha256(), "formatted_chars": 0}
                if target is not None:
                    out["loss_sha256"].update(target.encode())
                    out["loss_chars"] += len(target)
                out["formatted_chars"] += chars
                if turns is not None:
                    out["n_turns"], out["turns_sha256"] = turns, digest
            yield pa.RecordBatch.from_pylist(ready, schema=schema)
        if out:
            yield pa.RecordBatch.from_pylist([out | {"loss_sha256": out["loss_sha256"].hexdigest()}], schema=schema)

    whole = examples.where("not spread").select("conv_id", "text", "loss_start", "loss_end").mapInArrow(run, READ)
    spread = examples.where("spread").select("conv_id", "example", "text", "loss_start", "loss_end", "closing").mapInArrow(one, "conv_id long, example int, target string, chars long, n_turns long, turns_sha256 string")
    return whole.unionByName(spread.repartition("conv_id").sortWithinPartitions("conv_id", "example").mapInArrow(fold, READ))


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{PLANTED}'), (-1L, 1L, 'assistant', '{PLANTED}') AS t(conv_id, turn, role, text)")
    return read_back(expand(rows.unionByName(planted)))


def op4_sql() -> str:
    return rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PLANTED}' UNION ALL SELECT -1, 1, 'assistant', '{PLANTED}'),
f AS (SELECT *, {len(START) + len(END) + 2} + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS n FROM c),
p AS (SELECT *, sum(n) OVER w AS prefix, last_value(role) OVER v AS final, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back FROM f
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING), v AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(prefix) FILTER (role = 'assistant' OR back = 1) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id"""

"""Documents are counted, not texts; one copy of a text stays; the limit grows with the host; all against the query's SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from flamequarry.llm import quality


def body(k):
    return " ".join(f"w{k}x{j}" for j in range(60))


def both(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    own = {(r.doc_id, r.n_removed_words, r.kept) for r in quality.judged(df).collect()}
    df.coalesce(1).write.parquet(f"{tmp_path}/d")
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    result = duckdb.sql(quality.op3_sql())
    at = [result.columns.index(c) for c in ("doc_id", "n_removed_words", "kept")]
    assert own == {tuple(r[i] for i in at) for r in result.fetchall()}
    return {i: (n, kept) for i, n, kept in own}


def test_copies_count_and_one_stays(spark, tmp_path):
    got = both(spark, [(i, body(0) + "\nthe line", "h") for i in range(30)] + [(50, body(1) + "\nthe line", "h"), (None, body(2), None), (None, body(2), None)], tmp_path)
    assert got[0] == (0, True) and all(got[i] == (62, False) for i in range(1, 30))
    assert got[50] == (0, True)  # the line stands in two texts only, and this is the first copy of its own


@pytest.mark.parametrize("size, gone", [(40, True), (3000, False)])
def test_limit_grows_with_the_host(spark, tmp_path, size, gone):
    rows = [(i, body(i) + ("\nthe line" if i < 25 else ""), "h") for i in range(size)]
    assert (both(spark, rows, tmp_path)[3][0] > 0) == gone


def test_nulls_do_not_share_rows(spark, tmp_path):
    rows = [(1, None, "x"), (1, "x", None)] + [(i, "x\n" + body(i), None) for i in range(2, 40)]
    assert both(spark, rows, tmp_path)[1] is not None


def test_many_lines_are_removed_in_time(spark):
    import time

    text = "\n".join(f"line number {i} of many" for i in range(40_000))
    df = spark.createDataFrame([(i, text + "\n" + body(i) * 2000, "h") for i in range(22)], "doc_id long, text string, source string").select("*")
    began = time.time()
    out = df.select(quality.without_lines(df.text, F.expr("transform(sequence(0, 39998), i -> xxhash64(concat('line number ', i, ' of many')))")).alias("t")).limit(1).first().t
    assert out.startswith("line number 39999 of many\nw") and time.time() - began < 60

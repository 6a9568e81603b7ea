import random

import duckdb
import pytest

from flamequarry.llm.minhash import near_duplicates, one_of_each


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    ids, up = sorted(sets), {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("percent", [80, 85])
def test_against_brute_force(spark, percent):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.01/documents.parquet' order by 1 limit 400").fetchall()
    assert found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent)) == brute(rows, percent)


def test_crowded_bucket_goes_by_blocks(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    got = found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85, small=4, block=32))
    assert got == brute(rows, 85)


def test_edges(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n\t ", 0), (4, "a b", 0), (5, "A  B", 0), (None, "a b", 0), (6, "long " * 30000, 0), (7, "a b", 1), (7, "a b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `class` int")
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert len(got) == 9
    assert {r[0]: r[1:] for r in got} == {1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 4, False), -1: (1, None, True), 6: (1, 6, True), 7: (1, 4, False)}
    assert near_duplicates(df.limit(0)).count() == 0


def near(text, *places):
    words = text.split()
    for p in places:
        words[p] = f"other{p}"
    return " ".join(words)


def test_repeated_ids_with_other_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(61)) for x in "ab")
    rows = [(1, a), (1, b), (2, near(b, 30)), (3, near(a, 0)), (0, near(a, 60))]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 80).collect())
    assert got == [(0, 0, True), (1, 0, False), (1, 1, True), (2, 1, False), (3, 0, False)]


def test_one_of_each(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(61)) for x in "ab")
    rows = [(1, a, 0, "p"), (1, b, 0, "p"), (1, b, 1, "q"), (1, near(b, 60), 1, "q"), (2, near(b, 30), 0, "r"), (0, near(a, 60), 0, "s"), (None, a, 0, "t"), (5, None, 0, "u"), (5, "", 0, "u"), (6, None, 1, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key int, gone string")
    out = one_of_each(df, 80)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text or None) for r in out.collect()), key=str) == sorted([(1, b), (0, near(a, 60)), (None, a), (5, None), (6, None)], key=str)
    assert one_of_each(df.limit(0)).count() == 0


def test_whole_table_against_brute_force(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    for small in (1, 32):
        assert found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85, small=small)) == brute(rows, 85)

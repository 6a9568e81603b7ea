"""The pipeline over a whole table, and over one with planted cases, against the same steps in plain Python."""

import random

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from flamequarry.llm import decontaminate, pieces, quality, secrets

from test_minhash import brute
from test_operators import python_spans

SF = "/root/testdata/sf0.001"


def plain_quality(rows, samples):
    """Rows (id, text, source) kept, with frequent lines gone, but for those of near copies. samples: the salted hashes of a line."""
    normal = lambda x: " ".join(x.lower().split())  # noqa: E731  the texts hold no other letters' case that lower() of A-Z would leave
    lines = {i: {normal(x) for x in (t or "").split("\n")} - {""} for i, t, _ in rows}
    holders, size = {}, {}
    for i, _, s in rows:
        size[s] = size.get(s, 0) + 1
        for x in lines[i]:
            holders.setdefault((s, x), []).append(i)
    frequent = set()
    for (s, x), ids in holders.items():
        if len(ids) > quality.LINE_LIMIT and 100 * len(ids) > quality.LINE_SHARE * size[s]:
            kinds = [len({min((samples[y][k] for y in lines[i] - {x}), default=0) for i in ids}) for k in range(quality.SALTS)]
            if quality.APART * max(kinds) >= len(ids):
                frequent.add((s, x))
    out = []
    for i, t, s in rows:
        words = (t or "").split()
        tri = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        many = {x for x in tri if tri.count(x) > 1} if len(set(tri)) < len(tri) else set()
        repeated = {k + j for k, x in enumerate(tri) if x in many for j in range(3)}
        if len(words) < 50 or 100 * len(repeated) > 50 * len(words):
            continue
        kept = [x for x in t.split("\n") if (s, normal(x)) not in frequent]
        left = sum(len(x.split()) for x in kept)
        if 100 * left >= quality.DEPLETED * len(words):
            out.append((i, "\n".join(kept) if left < len(words) else t, s))
    return out


def plain_pipeline(docs, items, llr, encode, samples):
    rows = plain_quality(docs, samples)
    leads = brute([(i, t) for i, t, _ in rows], corpus_pipeline.SIMILAR)
    rows = [r for r in rows if leads[r[0]][2]]
    windows = {w for t in items for w in decontaminate.item_windows(t)}
    sizes = {len(w) for w in windows}
    held = lambda w: any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))
    rows = [r for r in rows if not held(decontaminate.words_of(r[1]))]
    out = {}
    for i, t, _ in rows:
        at, text = 0, []
        for start, _, end in python_spans(t, llr):
            if start >= at:
                text += [t[at:start], secrets.MARK]
            at = max(at, end)
        out[i] = encode("".join([*text, t[at:]]))
    return out


@pytest.mark.parametrize("planted", [False, True])
def test_against_plain_python(spark, tmp_path, planted):
    import sentencepiece

    docs = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet' ORDER BY 1").fetchall()
    folder = SF
    if planted:
        rng = random.Random(5)
        folder = str(tmp_path)
        base = [d for d in docs if d[1] and 60 < len(d[1].split()) < 400][:60]
        more = []
        for k, (i, t, lang, _) in enumerate(base):
            own = f"{t}\nthis line stands in many documents" + ("\n" + items[k % len(items)][1] if k % 6 == 0 else "") + (f"\ntoken: {rng.getrandbits(160):040x}" if k % 5 == 0 else "")
            more.append((10_000 + k, own, lang, "hot"))
            for c in range(30 if k == 3 else k % 3):  # near copies, one family of thirty
                words = own.split(" ")
                words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
                more.append((20_000 + 100 * k + c, " ".join(words), lang, "hot"))
        docs += more
        spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in docs], "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    llr = secrets.train(secrets.labelled_samples(spark))
    own = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    lines = sorted({" ".join(x.lower().split()) for _, t, _, _ in docs for x in (t or "").split("\n")})
    salted = spark.createDataFrame([(x,) for x in lines], "x string").select("x", *[F.xxhash64(F.xxhash64("x"), F.lit(k)).alias(f"s{k}") for k in range(quality.SALTS)])
    samples = {r[0]: r[1:] for r in salted.collect()}
    expected = plain_pipeline([(i, t, s) for i, t, _, s in docs], [t for _, t in items], llr, own.encode, samples)
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, folder).collect()}
    assert got.keys() == expected.keys() and len(got) > 60
    assert got == expected

"""The tokens outside the head of the language model: own vectors, and probabilities that sum to one."""

import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np

from flamequarry.llm import lm


def test_lm_tail_follows_context(spark):
    # outputs=4: x, y and the end token are the head; ten pairs of words of the tail, equally frequent, follow x or y alone
    texts = [f"{h} {h}w{k}" for _ in range(60) for k in range(10) for h in "xy"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(10_000 + 2 * k + j, f"{h} {w}w{k}") for k in range(10) for j, (h, w) in enumerate(("xx", "xy"))]
    got = {r.doc_id: r.score for r in lm.language_model_scores(spark.createDataFrame(rows, "doc_id long, text string"), outputs=4).collect()}
    assert sum(got[10_000 + 2 * k] for k in range(10)) > sum(got[10_001 + 2 * k] for k in range(10)) + 1


def test_lm_tail_is_normalised(spark):
    words, classes = [f"t{i}".encode() for i in range(60)], 2
    rng = np.random.default_rng(0)
    params = rng.normal(0, 0.5, 3 * 6 * lm.WIDTH + 6).astype(np.float32)
    count = Counter({w: 1 + i % 7 for i, w in enumerate(words)})
    mass = np.zeros(classes)
    for w, c in count.items():
        mass[zlib.crc32(w) % classes] += c + 0.5
    groups, unknown, r, b = 3, 2, lm.views(params)[2], lm.views(params)[3]
    r[unknown] = 0
    part = lambda w: zlib.crc32(w) % classes * groups + zlib.crc32(w) // classes % groups
    place = lambda w, docs, at: (part(w) // lm.TOGETHER, w, 0, np.zeros(len(docs), "<u4").tobytes(), np.array(docs, "<u4").tobytes(), np.array(at, "<u4").tobytes())
    rows = [place(w, [0] * c, rng.integers(0, 36, c)) for w, c in count.items()] + [place(w, [2 * i + 3], [3 * 6 + 5]) for i, w in enumerate([*words, b"unseen"])]
    df = spark.createDataFrame(rows, "task int, words binary, home int, own binary, docs binary, contexts binary")
    got = {x.row: x for x in lm.tail_scores(df, SimpleNamespace(classes=classes, groups=groups, unknown=unknown, mass=mass), params).collect()}
    by = [0.0] * classes
    for i, w in enumerate(words):
        by[zlib.crc32(w) % classes] += 10 ** got[i + 1].tail_model
        assert np.isclose(10 ** got[i + 1].tail_base, count[w] + 0.5)
    assert np.allclose(by, 1, rtol=1e-4)
    q1, q2, own = lm.views(params)[0], lm.views(params)[1], zlib.crc32(b"unseen") % classes
    assert np.isclose(got[61].tail_model * np.log(10), b[unknown] - b[own] - (q1[3] + q2[5]) @ r[own], rtol=1e-4) and got[61].tail_known == 0


def test_lm_scores_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    words = [f"v{i}" for i in range(400)]
    rows = [(i if i % 50 else None, " ".join(words[min(399, int(rng.pareto(0.7)))] for _ in range(80))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    both = [{(r.doc_id, r.base_score): r.score for r in lm.language_model_scores(df.repartition(n), outputs=64, shard=4000).collect()} for n in (1, 4, 8, 32)]
    assert all(x.keys() == both[0].keys() for x in both)
    for x in both[1:]:
        assert np.allclose([x[k] for k in sorted(x, key=str)], [both[0][k] for k in sorted(x, key=str)], rtol=1e-4)


def test_lm_scores_against_brute_force(spark):
    """One output at a time, without tables or batches: all tokens are in the head or unknown."""
    docs = spark.createDataFrame([(i, "a b c a d b"[: 2 * (1 + i % 6) - 1]) for i in range(40)] + [(100, "zzz a b")], "doc_id long, text string")
    counts = lm.token_counts(docs.where("doc_id < 100"))
    v = lm.Vocabulary(counts, 64)
    params = lm.smoothed(np.random.default_rng(2).normal(0, 1, len(lm.start(v))).astype(np.float32), v)
    rows = lm.coded(docs, v)
    got = {r.doc_id: r.model for r in lm.scored(rows.where("task is null"), params, v.end).collect()}
    q1, q2, r, b = lm.views(params)
    out = v.coder()
    for i, text in docs.collect():
        before, total = [v.end, v.end], 0.0
        for w in [*text.encode().split(), b"\n"]:
            k = int(out.outputs_of([w])[0])
            s = [float((q1[before[-1]] + q2[before[-2]]) @ r[j] + b[j]) for j in range(len(b))]
            total += s[k] - np.log(np.sum(np.exp(s)))
            before.append(k)
        assert np.isclose(got[i], total / np.log(10), rtol=1e-4)

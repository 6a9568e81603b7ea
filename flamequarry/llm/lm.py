"""Log-bilinear language model, trained in numpy with noise-contrastive estimation over all training documents.

The model: score(w | c1, c2) = (Q1[c1] + Q2[c2]) . R[w] + b[w] over the ``outputs`` - 1 most frequent tokens (the head),
an unknown token, and ``outputs`` / ``HEAD_CLASS`` classes by hash for all others (the tail). The tail has no limit: a class is
split by hash into groups of about ``GROUP`` tokens, as many as the corpus needs. A group has its smoothed frequency within
its class, and each of its tokens a vector and a bias of its own, normalised over the group. So the probabilities of all
known tokens and of one unknown token sum to one. As context, a token of the tail is its class.

* Counts: every training token, one aggregation that combines before the shuffle. The head is a top-k of it; it has ``OUTPUTS``
  tokens, and more (the square root of the distinct ones, as a power of two) for a vocabulary beyond a million.
* Coding: one pass turns texts into packed output numbers and packs the tail's places by the task they go to; later passes
  read these.
* Tail: each occurrence goes to its group in one shuffle; the group's task counts, trains (one pass over the training
  documents' occurrences, softmax over the group) and scores. A group holds no token of the head, which bounds it.
* Training: documents are dealt by hash to shards of about ``SHARD`` tokens, however the rows are partitioned. A shard's task
  runs over its documents in order of doc_id, from the same start and a seed of its own, in two rounds (half of the
  documents each); after a round the shards' parameters are averaged, weighted by tokens, in groups of at most ``FAN`` a task.
  So scores do not depend on the partitions or the number of executors, but for rounding.
* Smoothing: half a count is added to each token, known or not, as prior odds in the biases; NCE learns the counts' own.
* Scoring: batched matrix products. The normaliser depends on the two context tokens alone, so it is summed over all
  outputs once for each context met, and remembered in a table of fixed size.

Nulls: a null text is empty and has the end token alone; a null doc_id belongs to the training part. Repeated rows each
count and each get a result. Without training documents every token is unknown.
"""

from __future__ import annotations

import hashlib
import math
import sys
import zlib
from array import array
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shared_folder, table

OUTPUTS, WIDTH, NOISE, BATCH, RATE = 1024, 24, 32, 1024, 0.2
SHARD, FAN, KEPT, DISTINCT = 1 << 22, 16, 1 << 22, 1 << 19
HEAD_CLASS, GROUP, TOGETHER, TAIL_BATCH, TAIL_RATE, PLACES = 64, 64, 16, 256, 1.0, 1 << 21


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


def tokens_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), b"\n"]


def token_counts(docs: DataFrame) -> DataFrame:
    """word, c: a task adds up its own tokens, as many distinct ones as DISTINCT at a time, before the shuffle."""

    def run(batches):
        own: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()).cast(pa.string()), pa.array(list(own.values()), pa.int64())], names=["word", "c"])
            own.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                own.update(tokens_of(text.as_py()))
                if len(own) > DISTINCT:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The head's tokens and counts, the classes of the tail, and the corpus' totals. Outputs: classes, the unknown token, the head."""

    def __init__(self, counts: DataFrame, outputs: int | None = None):
        total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
        self.total, self.distinct = total or 0, distinct
        outputs = outputs or max(OUTPUTS, 1 << (math.isqrt(distinct) - 1).bit_length() if distinct > 1 else 1)
        rows = counts.orderBy(F.desc("c"), "word").limit(outputs - 1).collect()
        self.words, self.counts = [r["word"].encode() for r in rows], np.array([r["c"] for r in rows], np.float64)
        self.classes = max(1, outputs // HEAD_CLASS)
        self.unknown, self.first = self.classes, self.classes + 1
        self.outputs = self.first + len(rows)
        tail, words = np.zeros(self.classes), np.zeros(self.classes)
        for k, c, n in counts.groupBy((F.crc32(F.col("word").cast("binary")) % self.classes).cast("int").alias("k")).agg(F.sum("c"), F.count("*")).collect():
            tail[k], words[k] = c, n
        for c, w in zip(self.counts, self.words):
            tail[zlib.crc32(w) % self.classes] -= c
            words[zlib.crc32(w) % self.classes] -= 1
        self.groups = max(1, -(-int(words.sum()) // (self.classes * GROUP)))  # of each class
        self.mass = tail + 0.5 * words
        unigram = np.concatenate([np.maximum(tail, 0.5), [0.5], self.counts])
        self.unigram = unigram / unigram.sum()
        smooth = np.concatenate([np.maximum(self.mass, 1e-6), [0.5], self.counts + 0.5])
        self.log_smooth = np.log(smooth / smooth.sum())
        self.smooth = (self.log_smooth - np.log(self.unigram)).astype(np.float32)
        self.end = int(self.coder().outputs_of([b"\n"])[0])

    def plain(self) -> tuple:
        """What a Coder needs, without any class of ours: executors may have no copy of this package."""
        return self.words, self.counts, self.classes, self.groups

    def coder(self) -> Coder:
        return Coder(*self.plain())


class Coder:
    """Tokens to outputs; rebuilt in each task."""

    def __init__(self, words: list[bytes], counts: np.ndarray, classes: int, groups: int):
        self.classes, self.groups, self.first, self.outputs = classes, groups, classes + 1, classes + 1 + len(words)
        self.number = {w: self.first + i for i, w in enumerate(words)}
        self.log_c = np.concatenate([np.zeros(self.first), np.log10(counts + 0.5)])
        self.kind = "<u4" if self.outputs < 1 << 16 else "<u8"  # of a pair of contexts

    def part_of(self, word: bytes) -> int:
        """The group of a token of the tail: those of a class are neighbours. TOGETHER groups are one task's."""
        h = zlib.crc32(word)
        return h % self.classes * self.groups + h // self.classes % self.groups

    def outputs_of(self, words: list[bytes]) -> np.ndarray:
        return np.array([self.number[w] if w in self.number else zlib.crc32(w) % self.classes for w in words], np.int64)


def of_process(kind: str, state: tuple, make):
    """An object that the tasks of one worker process share while their state is the same: what it remembers is worked out once."""
    held = sys.__dict__.setdefault("_flamequarry_lm", {})
    key = hashlib.blake2b(b"".join(x.tobytes() if isinstance(x, np.ndarray) else repr(x).encode() for x in state)).digest()
    if held.get(kind, (None,))[0] != key:
        held[kind] = key, make()
    return held[kind][1]


def id_kind(outputs: int) -> str:
    return "<u2" if outputs < 1 << 16 else "<u4"


class Numbers(dict):
    """Own numbers of the words that a task meets, with the output of each."""

    def __init__(self, coder: Coder):
        self.coder, self.words, self.outputs, self.tasks = coder, [], array("q"), array("q")

    def forget(self) -> None:
        self.clear()
        self.words, self.outputs, self.tasks = [], array("q"), array("q")

    def __missing__(self, word: bytes) -> int:
        out = self.coder.number.get(word)
        n = self[word] = len(self.words)
        self.words.append(word)
        self.outputs.append(zlib.crc32(word) % self.coder.classes if out is None else out)
        self.tasks.append(self.coder.part_of(word) // TOGETHER)
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def before(w: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The outputs one and two places before each of w, in texts that begin at starts (none is empty); an end comes before a text."""
    c1, c2 = np.concatenate([[end], w[:-1]]), np.concatenate([[end, end], w[:-2]])[: len(w)]
    c1[starts] = end
    c2[starts] = end
    second = starts + 1
    c2[second[second < len(w)]] = end
    return c1, c2


def contexts(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the outputs of texts (each closed by end): the two before each token and the token."""
    if not texts:
        return (np.empty(0, np.int64),) * 3
    w, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    return *before(w, np.cumsum(sizes) - sizes, end), w


def start(vocabulary: Vocabulary, width: int = WIDTH, seed: int = 1) -> np.ndarray:
    rng, k = np.random.default_rng(seed), vocabulary.outputs
    return np.concatenate([rng.normal(0, 0.1, 3 * k * width), np.log(vocabulary.unigram)]).astype(np.float32)


def smoothed(params: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The parameters with half a count added to each token in the biases: without any interaction, the model is the base. The unknown token has no vector."""
    params = params.copy()
    _, _, r, b = views(params)
    b += vocabulary.smooth
    r[vocabulary.unknown], b[vocabulary.unknown] = 0, vocabulary.log_smooth[vocabulary.unknown]
    return params


def views(p: np.ndarray, width: int = WIDTH):
    k = len(p) // (3 * width + 1)
    n = k * width
    return p[:n].reshape(k, width), p[n : 2 * n].reshape(k, width), p[2 * n : 3 * n].reshape(k, width), p[3 * n :]


class Trainer:
    """Noise-contrastive estimation by AdaGrad; the noise tokens are drawn once a batch from the unigram distribution."""

    def __init__(self, params: np.ndarray, unigram: np.ndarray, seed: int):
        self.p, self.squares = params.copy(), np.full(len(params), 1e-2, np.float32)
        self.noise_log = (np.log(unigram) + math.log(NOISE)).astype(np.float32)
        self.cumulated, self.rng, self.seen = np.cumsum(unigram), np.random.default_rng(seed), 0

    def step(self, c1, c2, w):
        q1, q2, r, b = views(self.p)
        k = len(b)
        noise = np.minimum(np.searchsorted(self.cumulated, self.rng.random(NOISE)), k - 1)
        q, rw, rn = q1[c1] + q2[c2], r[w], r[noise]
        true = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", q, rw) + b[w] - self.noise_log[w], -30, 30)))
        false = 1 / (1 + np.exp(np.clip(-(q @ rn.T + b[noise] - self.noise_log[noise]), -30, 30)))
        gq = true[:, None] * rw - false @ rn
        g = np.zeros_like(self.p)
        g1, g2, gr, gb = views(g)
        by = true[:, None] * q
        for d in range(q.shape[1]):
            g1[:, d] = np.bincount(c1, gq[:, d], k)
            g2[:, d] = np.bincount(c2, gq[:, d], k)
            gr[:, d] = np.bincount(w, by[:, d], k)
        gb += np.bincount(w, true, k)
        np.subtract.at(gr, noise, false.T @ q)
        np.subtract.at(gb, noise, false.sum(0))
        g /= len(w)
        self.squares += g * g
        self.p += RATE * g / np.sqrt(self.squares)
        self.seen += len(w)


def train_round(coded: DataFrame, v: Vocabulary, params: np.ndarray, shards: int, folder: str, name: str) -> np.ndarray:
    """coded: doc_id, ids."""
    sent = coded.sparkSession.sparkContext.broadcast((v.unigram, v.end, params))

    def run(key, group):
        unigram, end, p = sent.value
        part = key[0].as_py()
        ids, texts = group.column("doc_id").to_pylist(), group.column("ids").to_pylist()
        trainer, held, size = Trainer(p, unigram, part), [], 0
        for i in sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i])):
            held.append(np.frombuffer(texts[i], id_kind(len(unigram))).astype(np.int64))
            size += len(held[-1])
            if size >= 1 << 18:
                fit(trainer, held, end)
                held, size = [], 0
        fit(trainer, held, end)
        return pa.table({"part": pa.array([part], pa.int64()), "weight": pa.array([float(trainer.seen)], pa.float64()), "params": pa.array([trainer.p.tobytes()], pa.binary())})

    def mean(group):
        weight, total = np.array(group.column("weight").to_pylist()), 0
        parts, params = group.column("part").to_pylist(), group.column("params")
        for i in np.argsort(parts).tolist():
            total = total + weight[i] * np.frombuffer(params[i].as_py(), np.float32).astype(np.float64)
        return pa.table({"part": pa.array([min(parts)], pa.int64()), "weight": pa.array([weight.sum()], pa.float64()), "params": pa.array([(total / weight.sum()).astype(np.float32).tobytes()], pa.binary())})

    kind = "part long, weight double, params binary"
    shard = F.pmod(F.xxhash64(F.lit("shard"), "doc_id", "ids"), F.lit(shards)).alias("shard")
    rows = materialize(coded.select(shard, "doc_id", "ids").groupBy("shard").applyInArrow(run, kind), folder, name)
    level = 0
    while (n := rows.count()) > 1:
        groups = -(-n // FAN)
        key = F.pmod(F.xxhash64("part", F.lit(level)), F.lit(groups))
        rows = materialize(rows.withColumn("bucket", key).groupBy("bucket").applyInArrow(mean, kind), folder, f"{name}-{(level := level + 1)}")
    found = rows.collect()
    return np.frombuffer(found[0]["params"], np.float32) if found else params


def fit(trainer: Trainer, texts: list[np.ndarray], end: int) -> None:
    c1, c2, w = contexts(texts, end)
    order = trainer.rng.permutation(len(w))
    for at in range(0, len(w), BATCH):
        i = order[at : at + BATCH]
        trainer.step(c1[i], c2[i], w[i])


class Scorer:
    """Normalised natural log-probabilities; normalisers are kept by context, the newest of those that share a place."""

    def __init__(self, params: np.ndarray):
        self.q1, self.q2, self.r, self.b = views(params)
        self.outputs, self.places = len(self.b), min(len(self.b) ** 2, KEPT)
        self.key, self.log_z = np.full(self.places, -1, np.int64), np.zeros(self.places, np.float32)

    def normalisers(self, key: np.ndarray) -> np.ndarray:
        pairs, at = np.unique(key, return_inverse=True)
        slot = pairs % self.places
        out, n = self.log_z[slot], len(self.b)
        fresh = np.flatnonzero(self.key[slot] != pairs)
        for i in range(0, len(fresh), 1024):
            j = fresh[i : i + 1024]
            s = (self.q1[pairs[j] // n] + self.q2[pairs[j] % n]) @ self.r.T + self.b
            top = s.max(1)
            out[j] = top + np.log(np.exp(s - top[:, None]).sum(1))
        self.key[slot[fresh]], self.log_z[slot[fresh]] = pairs[fresh], out[fresh]
        return out[at]

    def score(self, c1, c2, w) -> np.ndarray:
        out = np.empty(len(w))
        for at in range(0, len(w), BATCH):
            i = slice(at, at + BATCH)
            out[i] = np.einsum("ij,ij->i", self.q1[c1[i]] + self.q2[c2[i]], self.r[w[i]]) + self.b[w[i]]
        return out - self.normalisers(c1 * len(self.b) + c2)


#: Two kinds of row: of a document (task is null), and of places of the tail's tokens: the task's words, then for each place the word's number, document and contexts.
CODED = "row long, doc_id long, held_out boolean, n_tokens long, n_head long, base double, ids binary, task int, words binary, home int, own binary, docs binary, contexts binary"
CODED_TYPE = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_head", pa.int64()), ("base", pa.float64()), ("ids", pa.binary()), ("task", pa.int32()), ("words", pa.binary()), ("home", pa.int32()), ("own", pa.binary()), ("docs", pa.binary()), ("contexts", pa.binary())])


class Places:
    """The places of tokens of the tail in a task's documents, packed by token once there are PLACES of them."""

    def __init__(self, coder: Coder, numbers: Numbers, home: int):
        self.v, self.numbers, self.home = coder, numbers, home
        self.clear()

    def clear(self) -> None:
        self.words, self.docs, self.contexts, self.size = [], [], [], 0

    def add(self, words: np.ndarray, docs: np.ndarray, contexts: np.ndarray) -> None:
        """words: the task's own numbers; docs: twice the document's number in the task, and one if it is held out; contexts: c1 * outputs + c2."""
        self.words.append(words)
        self.docs.append(docs.astype("<u4"))
        self.contexts.append(contexts.astype(self.v.kind))
        self.size += len(words)

    def packed(self):
        w, docs, contexts = np.concatenate(self.words), np.concatenate(self.docs), np.concatenate(self.contexts)
        task = np.frombuffer(self.numbers.tasks, np.int64)[w]
        order = np.argsort(task << 32 | w, kind="stable")
        w, task, docs, contexts = w[order], task[order], docs[order], contexts[order]
        self.clear()
        begins = np.flatnonzero(np.diff(task, prepend=-1)).tolist()
        rows: dict[str, list] = {c: [] for c in ("task", "words", "own", "docs", "contexts")}
        for i, j in zip(begins, [*begins[1:], len(w)]):
            fresh = np.diff(w[i:j], prepend=-1) != 0
            rows["task"].append(int(task[i]))
            rows["words"].append(b"\n".join([self.numbers.words[k] for k in w[i:j][fresh].tolist()]))  # no word holds a line's end
            rows["own"].append((np.cumsum(fresh) - 1).astype("<u4").tobytes())
            rows["docs"].append(docs[i:j].tobytes())
            rows["contexts"].append(contexts[i:j].tobytes())
        n = len(begins)
        columns = {c: pa.array(v, CODED_TYPE.field(c).type) for c, v in rows.items()} | {"home": pa.array(np.full(n, self.home, np.int32))}
        whole = pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in CODED_TYPE], schema=CODED_TYPE)
        for at in range(0, n, 500):
            yield whole.slice(at, 500)


def coded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """For each row of docs: its outputs and sums over its tokens of the head; and the places of the tokens of the tail."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary.plain(), vocabulary.end))

    def run(batches):
        from pyspark import TaskContext

        plain, end = sent.value
        numbers, home, n = of_process("numbers", plain, lambda: Numbers(Coder(*plain))), TaskContext.get().partitionId(), 0
        v = numbers.coder
        places = Places(v, numbers, home)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words = [tokens_of(text.as_py()) for text in part.column(2)]
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                starts = np.cumsum(sizes) - sizes
                own = numbers.of(list(chain.from_iterable(words)))
                w = np.frombuffer(numbers.outputs, np.int64)[own]
                c1, c2 = before(w, starts, end)
                tail = w < v.first
                i = np.flatnonzero(tail)
                held = np.array(part.column(1).to_pylist(), bool)
                places.add(own[i], np.repeat(2 * (n + np.arange(len(words))) + held, sizes)[i], c1[i] * v.outputs + c2[i])
                total = lambda x: pa.array(np.add.reduceat(x, starts))
                packed = pa.BinaryArray.from_buffers(pa.binary(), len(words), [None, pa.array((np.concatenate([starts, [len(w)]]) * np.dtype(id_kind(v.outputs)).itemsize).astype(np.int32)).buffers()[1], pa.py_buffer(w.astype(id_kind(v.outputs)).tobytes())])
                columns = {"row": pa.array((home << 40) + n + np.arange(len(words))), "doc_id": part.column(0), "held_out": part.column(1), "n_tokens": pa.array(sizes), "n_head": total((~tail).astype(np.int64)), "base": total(v.log_c[w]), "ids": packed}
                n += len(words)
                yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(words), f.type)) for f in CODED_TYPE], schema=CODED_TYPE)
                if places.size >= PLACES or len(numbers.words) > DISTINCT:
                    if places.size:
                        yield from places.packed()
                    if len(numbers.words) > DISTINCT:
                        numbers.forget()
        if places.size:
            yield from places.packed()

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")), "text").mapInArrow(run, CODED)


#: Columns of a coded document that the result needs.
DOCUMENT = ["row", "doc_id", "held_out", "n_tokens", "n_head", "base"]


def scored(rows: DataFrame, params: np.ndarray, end: int) -> DataFrame:
    """Coded documents with model: the sum over all tokens, those of the tail as their class."""
    sent = rows.sparkSession.sparkContext.broadcast((params, end))

    def run(batches):
        params, end = sent.value
        scorer = of_process("scorer", (params,), lambda: Scorer(params))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                outs = [np.frombuffer(x.as_py(), id_kind(scorer.outputs)).astype(np.int64) for x in part.column("ids")]
                sizes = np.array([len(o) for o in outs])
                s = np.add.reduceat(scorer.score(*contexts(outs, end)), np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in DOCUMENT), pa.array(s / math.log(10))], names=[*DOCUMENT, "model"])

    return rows.select(*DOCUMENT, "ids").mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_head long, base double, model double")


def fit_group(q: np.ndarray, w: np.ndarray, counts: np.ndarray, rng, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and biases of a group's tokens, from its training occurrences (features of the contexts, tokens): one pass by AdaGrad."""
    r, b = np.zeros((len(counts), q.shape[1]), np.float32), np.log(counts + 0.5).astype(np.float32)
    squares = np.full(r.shape, 1e-2, np.float32)
    order = rng.permutation(len(w))
    for at in range(0, len(w) if rate else 0, TAIL_BATCH):
        i = order[at : at + TAIL_BATCH]
        g = -group_probabilities(q[i], r, b)
        g[np.arange(len(i)), w[i]] += 1
        g = g.T @ q[i] / len(i)
        squares += g * g
        r += rate * g / np.sqrt(squares)
    return r, b


def group_probabilities(q, r, b) -> np.ndarray:
    s = q @ r.T + b
    s = np.exp(s - s.max(1, keepdims=True))
    return s / s.sum(1, keepdims=True)


def group_scores(part: int, own: int, w: np.ndarray, train: np.ndarray, context: np.ndarray, q: np.ndarray, counts: np.ndarray, mass: np.ndarray, rate: float, model: np.ndarray) -> None:
    """Trains a group on its training occurrences and writes the log-probabilities of all its known ones within the class. w: its tokens' numbers from 0."""
    number = np.cumsum(counts > 0) - 1
    c = counts[counts > 0]
    k, at = number[w], np.flatnonzero(counts[w] > 0)
    first = np.flatnonzero(train)
    first = first[np.lexsort((context[first], k[first]))]  # whatever the order of the rows
    r, b = fit_group(q[first], k[first], c, np.random.default_rng(part), rate)
    share = math.log((c + 0.5).sum() / mass[own])
    for i in range(0, len(at), 4096):
        j = at[i : i + 4096]
        s = q[j] @ r.T + b
        top = s.max(1)
        model[j] = share + s[np.arange(len(j)), k[j]] - top - np.log(np.exp(s - top[:, None]).sum(1))


def tail_scores(rows: DataFrame, vocabulary: Vocabulary, params: np.ndarray) -> DataFrame:
    """For each document with tokens of the tail: sums over them of the base, of the model beyond their class, and the number known."""
    sent = rows.sparkSession.sparkContext.broadcast((params, vocabulary.mass, vocabulary.classes, vocabulary.groups, vocabulary.unknown, TAIL_RATE))

    def run(group):
        params, mass, classes, groups, unknown, rate = sent.value
        q1, q2, output_r, output_b = views(params)
        kind = "<u4" if len(output_b) < 1 << 16 else "<u8"
        coder = Coder([], np.empty(0), classes, groups)
        lists = [x.split(b"\n") for x in group.column("words").to_pylist()]
        # words in order of group, then word; occurrences in the order of their words
        found = sorted({(coder.part_of(x), x) for x in set(chain.from_iterable(lists))})
        number = {word: i for i, (_, word) in enumerate(found)}
        joined = lambda c, kind="<u4": np.frombuffer(b"".join(group.column(c).to_pylist()), kind).astype(np.int64)
        sizes = pc.binary_length(group.column("own")).to_numpy() // 4
        first = np.concatenate([[0], np.cumsum([len(x) for x in lists])[:-1]])
        flat = np.fromiter(map(number.__getitem__, chain.from_iterable(lists)), np.int64)
        w, home = flat[np.repeat(first, sizes) + joined("own")], np.repeat(group.column("home").to_numpy().astype(np.int64), sizes)
        order = np.argsort(w, kind="stable")
        w, home, docs, context = w[order], home[order], joined("docs")[order], joined("contexts", kind)[order]
        train, row = docs % 2 == 0, (home << 40) + docs // 2
        q = q1[context // len(output_b)] + q2[context % len(output_b)]
        counts = np.bincount(w[train], minlength=len(found))
        parts = np.array([p for p, _ in found])
        own = (parts // groups)[w]
        # an unknown token: the unknown one's output in place of the class'
        model = (output_b[unknown] - output_b[own] - np.einsum("ij,ij->i", q, output_r[own])).astype(np.float64)
        for part in np.unique(parts).tolist():
            lo, hi = np.searchsorted(parts, [part, part + 1])
            i = slice(*np.searchsorted(w, [lo, hi]))
            if train[i].any():
                group_scores(part, part // groups, w[i] - lo, train[i], context[i], q[i], counts[lo:hi], mass, rate, model[i])
        row, place = np.unique(row, return_inverse=True)
        total = lambda x: pa.array(np.bincount(place, x, len(row)))
        return pa.table({"row": pa.array(row), "base": total(np.log10(counts + 0.5)[w]), "model": total(model / math.log(10)), "known": total(counts[w] > 0)})

    places = rows.where("task is not null").select("task", "words", "home", "own", "docs", "contexts")
    found = places.groupBy("task").applyInArrow(run, "row long, base double, model double, known double")
    return found.groupBy("row").agg(*[F.sum(c).alias(f"tail_{c}") for c in ("base", "model", "known")])


def language_model_scores(docs: DataFrame, outputs: int | None = None, shard: int = SHARD) -> DataFrame:
    """For each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    folder = shared_folder(docs.sparkSession)
    counts = materialize(token_counts(docs.where(~held_out(F.col("doc_id")))), folder, "counts")
    v = Vocabulary(counts, outputs)
    rows = materialize(coded(docs, v), folder, "coded")
    texts = rows.where("task is null")
    train, params = texts.where("not held_out").select("doc_id", "ids"), start(v)
    for k in (0, 1):
        half = F.pmod(F.xxhash64(F.lit("half"), "doc_id", "ids"), F.lit(2)) == k
        params = train_round(train.where(half), v, params, max(1, -(-v.total // shard)), folder, f"round{k}")
    params = smoothed(params, v)
    out = scored(texts, params, v.end).join(tail_scores(rows, v, params), "row", "left")
    extra = lambda c: F.coalesce(f"tail_{c}", F.lit(0.0))
    scale = math.log10(v.total + 0.5 * (v.distinct + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + extra("known")).cast("long").alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + extra("base") - F.col("n_tokens") * F.lit(scale)).alias("base_score"), (F.col("model") + extra("model")).alias("score"),
    )


def op7_lm_scores(spark, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))

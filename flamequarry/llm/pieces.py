"""Encoding and decoding with a sentence-piece model as a weighted finite-state transducer.

The model file (given by path, read as protocol-buffer fields) is compiled to
* the normaliser N: one state for arcs of single characters (space to word mark), and a trie of states for a model's rules,
  the longest of which is taken; white space is stripped and joined, and a mark put first, as the model asks;
* the lexicon L: a trie of states, whose arcs read a character; the last arc of a piece writes its id and leads back to the
  start; byte fallback is an arc of its own there, which reads a character that no piece covers and writes byte pieces;
* weights. Unigram model: a piece's negative score; fallback: ten beyond the worst. Byte-pair model: L's start is split by
  the last piece, and an arc weighs nothing if the two pieces can stand side by side, and infinity if not. That follows
  from the ranks of merges alone: the pieces' merges are undone, the latest first, and no merge across the border may come
  before an undone one. Where several pieces share a rank (runs of marks), the two pieces' characters are merged in order.
A text goes through N; its composition with L has states (place, trie state, last piece), built place by place, and the
tropical shortest path runs through them: least sum of weights, infinite arcs cut, and of paths of equal
weight the one whose last piece begins earlier. Every
``FLUSH`` places the part that all living paths share is written out, so a word of any length takes bounded memory. If no
piece holds a word mark after another character, paths part before every run of marks; then the path of a text is the
chain of its words' paths, and these are remembered up to a bound.

Nulls and empty texts: no ids, decoded to an empty text. Repeated rows each get a result. Texts are taken whole.
Models with user-defined pieces are refused.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import sys
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
REMEMBERED, FLUSH = 3 << 17, 4096
INFINITE = math.inf


def fields(data: bytes):
    """The (number, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            n = varint()
            value, at = data[at : at + n], at + n
        else:
            n = {1: 8, 5: 4}[kind]
            value, at = data[at : at + n], at + n
        yield tag >> 3, value


def rules_of(data: bytes) -> dict[bytes, bytes]:
    """The rules of a compiled character map: a double array of 32-bit units, then the outputs, each closed by a zero."""
    if not data:
        return {}
    size = struct.unpack_from("<I", data)[0]
    units, outputs = struct.unpack_from(f"<{size // 4}I", data, 4), data[4 + size :]
    step = lambda u: (u >> 10) << ((u & 512) >> 6)
    out, stack = {}, [(step(units[0]), b"")]
    while stack:
        base, read = stack.pop()
        for c in range(1, 256):
            at = base ^ c
            if at < len(units) and units[at] & 0x800000FF == c:
                below = at ^ step(units[at])
                if units[at] & 256:
                    begin = units[below] & 0x7FFFFFFF
                    out[read + bytes([c])] = outputs[begin : outputs.index(b"\0", begin)]
                stack.append((below, read + bytes([c])))
    return out


class Normaliser:
    """The transducer N."""

    def __init__(self, rules: dict[str, str], prefix: bool, strip: bool, escape: bool):
        self.prefix, self.strip = prefix, strip
        self.space = MARK if escape else " "
        self.single = {ord(k): v for k, v in rules.items() if len(k) == 1}
        self.longest = max(map(len, rules), default=1)
        self.rules = rules
        self.begins = {k[0] for k in rules if len(k) > 1}

    def rewritten(self, text: str) -> str:
        if not self.begins:
            return text.translate(self.single) if self.single else text
        out, at = [], 0
        while at < len(text):
            c = text[at]
            size = next((n for n in range(min(self.longest, len(text) - at), 1, -1) if text[at : at + n] in self.rules), 1) if c in self.begins else 1
            out.append(self.rules.get(text[at : at + size], c))
            at += size
        return "".join(out)

    def __call__(self, text: str) -> str:
        text = self.rewritten(text)
        if self.strip:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = ((" " if self.prefix else "") + text).replace(" ", self.space)
        return text.rstrip(self.space) if self.strip else text  # marks of the text itself too, as in the library


class Transducer:
    """A compiled model: encode() and decode()."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        self.scores: list[float] = []
        prefix, strip, escape, rules, kind, self.byte_fallback = True, True, True, b"", 1, False
        for number, value in fields(model):
            if number == 1:
                f = dict(fields(value))
                self.pieces.append(f.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                self.kinds.append(f.get(3, NORMAL))
            elif number == 2:
                f = dict(fields(value))
                kind, self.byte_fallback = f.get(3, 1), bool(f.get(35, 0))
            elif number == 3:
                f = dict(fields(value))
                rules, prefix, strip, escape = f.get(2, b""), bool(f.get(3, 1)), bool(f.get(4, 1)), bool(f.get(5, 1))
        if kind not in (1, 2) or USER in self.kinds:
            raise ValueError("only unigram and byte-pair models without user-defined pieces are compiled")
        self.pairs, self.dummy_prefix = kind == 2, prefix
        self.normal = Normaliser({k.decode(): v.decode() for k, v in rules_of(rules).items()}, prefix, strip, escape)
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.words: dict[str, tuple[int, ...]] = {}
        self.weights: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        parted = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.chunk = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if parted else "(?s).+")
        self.penalty = 10.0 - min((self.scores[i] for i in self.ids.values()), default=0.0)
        if self.pairs:
            self.compile_merges()
            lexicon = {p: i for p, i in self.ids.items() if len(p) == 1 or i in self.halves}
        else:
            lexicon = self.ids
        self.lexicon = lexicon
        # the trie: a state is its arcs, by character: (next state, the piece that ends there or -1)
        self.start: dict = {}
        for piece, i in lexicon.items():
            state = self.start
            for c in piece[:-1]:
                state = state.setdefault(c, ({}, -1))[0]
            below = state.get(piece[-1], ({}, -1))[0]
            state[piece[-1]] = (below, i)

    def compile_merges(self) -> None:
        """Ranks of merges (equal scores share one), and the two halves that a piece's last merge joins."""
        merged = [i for p, i in self.ids.items() if len(p) > 1]
        order = {s: r for r, s in enumerate(sorted({self.scores[i] for i in merged}, reverse=True))}
        self.rank = {i: order[self.scores[i]] for i in merged} | {i: -1 for p, i in self.ids.items() if len(p) == 1}
        shared = Counter(self.rank[i] for i in merged)
        self.tied: set[int] = set()  # pieces with a merge whose rank others share
        for i in sorted(merged, key=self.rank.get):
            p, own = self.pieces[i], self.rank[i]
            if shared[own] > 1:
                if self.merged(p) == [p]:
                    self.halves[i] = (-1, -1)
                    self.tied.add(i)
                continue
            for k in range(1, len(p)):
                # a character that is no piece can still be merged: it stands for itself
                left, right = self.ids.get(p[:k], p[:k] if k == 1 else None), self.ids.get(p[k:], p[k:] if k == len(p) - 1 else None)
                if left is not None and right is not None and self.reached(left, own) and self.reached(right, own) and self.finite(left, right, own):
                    self.halves[i] = (left, right)
                    if left in self.tied or right in self.tied:
                        self.tied.add(i)
                    break

    def reached(self, i, before: int) -> bool:
        return isinstance(i, str) or self.rank[i] < 0 or (i in self.halves and self.rank[i] < before)

    def finite(self, left, right, limit: float = INFINITE) -> bool:
        """Whether two pieces stay side by side: undo their merges, the latest first (of equal ones the right, which came later)."""
        string = lambda i: i if isinstance(i, str) else self.pieces[i]
        if left in self.tied or right in self.tied:
            if limit < INFINITE:  # of a merge that comes after all of theirs
                return self.merged(string(left) + string(right)) == [string(left) + string(right)]
            return self.merged(string(left) + string(right)) == [string(left), string(right)]
        rank = lambda i: -1 if isinstance(i, str) else self.rank[i]
        while True:
            across = self.ids.get(string(left) + string(right))
            if across is not None and self.rank[across] < limit:
                return False
            a, b = rank(left), rank(right)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.halves[left][1]
            else:
                limit, right = b + 1, self.halves[right][0]

    def merged(self, s: str) -> list[str]:
        """The characters of s, merged by rank, the leftmost first among equals."""
        parts = list(s)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                n = self.ids.get(parts[i] + parts[i + 1])
                if n is not None and (best is None or self.rank[n] < best):
                    best, at = self.rank[n], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def light(self, last: int, piece: int) -> bool:
        """Whether the arc that writes piece weighs nothing after last (a byte-pair model's other weight is infinite)."""
        if len(self.weights) > REMEMBERED:
            self.weights.clear()
        ok = self.weights[last << 32 | piece] = self.finite(last, piece)
        return ok

    def shortest(self, word: str) -> tuple[int, ...]:
        """The output of the shortest path through the composition of a word with the lexicon.

        One state a place is kept, the lightest. A byte-pair model has no other finite one: every beginning of a word has one
        segmentation, so its last piece is known (-1: bytes, which merge with nothing).
        """
        if self.pairs:
            if word in self.lexicon:
                return (self.lexicon[word],)
            if len(word) <= 64:
                return self.shortest_pairs(word)
        out: list[int] = []
        nodes: dict[int, tuple] = {0: (0.0, -1, (), None)}  # weight, last piece, written ids, the state before
        pairs, scores, weights, size = self.pairs, self.scores, self.weights, len(word)
        for place in range(size):
            node = nodes.pop(place, None)
            if node is None:
                continue
            last, state, at, alone = node[1], self.start, place, False
            while at < size and (arc := state.get(word[at])):
                state, i = arc
                at += 1
                if i < 0:
                    continue
                alone |= at == place + 1
                if pairs:
                    if last >= 0:
                        ok = weights.get(last << 32 | i)
                        if not (self.light(last, i) if ok is None else ok):
                            continue
                    nodes.setdefault(at, (0.0, i, (i,), node))
                else:
                    w = node[0] - scores[i]
                    if at not in nodes or w < nodes[at][0]:
                        nodes[at] = (w, -1, (i,), node)
            if not alone:  # no piece of this character alone: fallback
                w = node[0] if pairs else node[0] + self.penalty
                if place + 1 not in nodes or w < nodes[place + 1][0]:
                    nodes[place + 1] = (w, -1, self.fallback(word[place]), node)
            if place % FLUSH == FLUSH - 1:
                self.flush(nodes, out)
        if size not in nodes:
            raise AssertionError(f"no path of finite weight through {word!r}")
        for node in self.chain(nodes[size]):
            out.extend(node[2])
        return tuple(out)

    def fallback(self, c: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in c.encode()) if self.byte_fallback else (self.unknown,)

    def shortest_pairs(self, word: str) -> tuple[int, ...]:
        """The same for short words of a byte-pair model, whose finite paths weigh nothing: last piece and begin by place."""
        size, weights, start = len(word), self.weights, self.start
        last, begin = [-2] * (size + 1), [0] * (size + 1)  # -2: no path, -1: none or bytes
        last[0] = -1
        for place in range(size):
            before = last[place]
            if before == -2:
                continue
            state, at, alone = start, place, False
            while at < size:
                arc = state.get(word[at])
                if arc is None:
                    break
                state, i = arc
                at += 1
                if i < 0:
                    continue
                if at == place + 1:
                    alone = True
                if last[at] == -2:
                    if before >= 0:
                        ok = weights.get(before << 32 | i)
                        if not (self.light(before, i) if ok is None else ok):
                            continue
                    last[at], begin[at] = i, place
            if not alone and last[place + 1] == -2:
                last[place + 1], begin[place + 1] = -1, place
        if last[size] == -2:
            raise AssertionError(f"no path of finite weight through {word!r}")
        out, at = [], size
        while at:
            i, at = last[at], begin[at]
            out.append(i if i >= 0 else self.fallback(word[at]))
        if -1 in last[1:]:
            return tuple(x for i in reversed(out) for x in ((i,) if isinstance(i, int) else i))
        return tuple(reversed(out))

    @staticmethod
    def chain(node) -> list[tuple]:
        out = []
        while node is not None:
            out.append(node)
            node = node[3]
        return out[::-1]

    def flush(self, nodes: dict[int, tuple], out: list[int]) -> None:
        """Writes out what all living paths share, and lets it go."""
        chains = {place: self.chain(node) for place, node in nodes.items()}
        shared = 0
        while all(len(c) > shared + 1 for c in chains.values()) and len({id(c[shared]) for c in chains.values()}) == 1:
            shared += 1
        if shared < 2:
            return
        for place, chain in chains.items():
            if place == min(chains):
                for node in chain[1:shared]:
                    out.extend(node[2])
            before = None
            for k, x in enumerate(chain[shared - 1 :]):
                before = (x[0], x[1], x[2] if k else (), before)
            nodes[place] = before

    def encode(self, text: str) -> list[int]:
        words, out = self.words, []
        for w in self.chunk.findall(self.normal(text)):
            ids = words.get(w)
            if ids is None:
                ids = self.shortest(w)
                if len(w) <= 64:
                    if len(words) >= REMEMBERED:
                        words.clear()
                    words[w] = ids
            out += ids
        return out if self.byte_fallback else self.joined(out)

    def joined(self, ids: list[int]) -> list[int]:
        """Neighbouring unknown ids as one."""
        return [i for k, i in enumerate(ids) if i != self.unknown or not k or ids[k - 1] != self.unknown]

    def decode(self, ids: list[int]) -> str:
        out: list[str] = []
        raw, begun, strip = bytearray(), False, self.normal.strip
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw, begun = bytearray(), True
            if self.kinds[i] == CONTROL:
                continue
            piece = " \u2047 " if self.kinds[i] == UNKNOWN else self.pieces[i]
            if not begun and (self.dummy_prefix or strip) and piece.startswith(MARK):
                piece = piece[1:]
                begun = not strip  # a model that strips takes every mark before the first character
            begun = begun or bool(piece)
            out.append(piece)
        if raw:
            out.append(raw.decode(errors="replace"))
        return "".join(out).replace(MARK, " ")


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def transducer(model: bytes) -> Transducer:
    """One transducer a process, whatever the number of its tasks."""
    held = sys.__dict__.setdefault("_flamequarry_transducers", {})
    key = hashlib.sha256(model).digest()
    if key not in held:
        held[key] = Transducer(model)
    return held[key]


def encoded(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids, decoded (the text read back from the ids)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one vocabulary file: its size does not follow the data

    def run(batches):
        t = transducer(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [t.encode(x.as_py() or "") for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([t.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_ids, n_bytes (ids of byte pieces), ids_sha256 (of the little-endian 32-bit ids), round_trip (decoded equals the text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "n_ids", "n_bytes", "ids_sha256", "round_trip"]

    def run(batches):
        t = transducer(sent.value)
        for batch in batches:
            n, byte, sha, same = [], [], [], []
            for x in batch.column(1):
                text = x.as_py() or ""
                ids = t.encode(text)
                n.append(len(ids))
                byte.append(sum(i in t.byte_of for i in ids))
                sha.append(hashlib.sha256(struct.pack(f"<{len(ids)}i", *ids)).hexdigest())
                same.append(t.decode(ids) == text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(byte, pa.int64()), pa.array(sha, pa.string()), pa.array(same, pa.bool_())], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_ids long, n_bytes long, ids_sha256 string, round_trip boolean")


def op8_sentencepiece(spark, sf_dir: str, model: str = MODEL) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), read_model(model))

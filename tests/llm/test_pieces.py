"""The transducer against the library: a byte-pair model, and unigram models put together here, with and without normaliser rules."""

import random
import struct

import duckdb
import pytest

from flamequarry.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")
TEXTS = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' WHERE text IS NOT NULL").fetchall()]
ODD = ["", " ", "  a   b ", "\n\t x", "漢字 😀 \x01", "<s></s><0x0A>", " " * 40 + "x", "a" * 27, "ab" * 40, "ﬁne ½ Ａｂｃ é é", "x" * 9000 + "y" + "ab" * 6000, "▁mark ▁", "ééééé", "　wide space"]


def varint(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram(rules=b"", prefix=1, strip=1, fallback=True):
    """A model of substrings of the texts, with scores drawn at random: multiples of 1/64, whose sums the library's 32-bit numbers hold exactly."""
    rng = random.Random(3)
    found = {}
    for t in TEXTS:
        t = "▁" + t.replace(" ", "▁").replace("\n", "")
        for _ in range(60):
            at, n = rng.randrange(len(t)), rng.randint(1, 7)
            p = t[at : at + n]
            if p and "▁" not in p[1:]:
                found.setdefault(p, -rng.randint(128, 768) / 64)
    for c in "▁abcdefghijklmnopqrstuvwxyzé":
        found.setdefault(c, -13.0)
    piece = lambda text, score, kind: field(1, field(1, text.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + field(3, kind))
    out = piece("<unk>", 0, 2) + piece("<s>", 0, 3) + piece("</s>", 0, 3)
    if fallback:
        out += b"".join(piece(f"<0x{b:02X}>", 0, 6) for b in range(256))
    out += b"".join(piece(p, x, 1) for p, x in found.items() if not (p.startswith("<0x") or p in ("<unk>", "<s>", "</s>")))
    trainer = field(3, 1) + (varint(35 << 3) + varint(1) if fallback else b"")
    return out + field(2, trainer) + field(3, field(1, b"own") + (field(2, rules) if rules else b"") + field(3, prefix) + field(4, strip) + field(5, 1))


def nfkc():
    model = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    spec = dict(pieces.fields(dict(pieces.fields(model))[3]))
    return spec[2]


def same(model):
    own, other = pieces.Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for x in TEXTS + ODD:
        assert own.encode(x) == other.encode(x), x[:80]
        assert own.decode(own.encode(x)) == other.decode(other.encode(x)), x[:80]


def test_byte_pair_model():
    same(pieces.read_model(pieces.MODEL))


def test_byte_pairs_of_random_strings():
    own, other = pieces.Transducer(pieces.read_model(pieces.MODEL)), sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(1)
    for alphabet in ("ab", "aaab", "the in", "erstion", "0123456789abcdef", "=-_ ", "éñaß "):
        for _ in range(300):
            x = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40)))
            assert own.encode(x) == other.encode(x), x


@pytest.mark.parametrize("prefix, strip, fallback", [(1, 0, True), (0, 0, True), (1, 1, True), (1, 1, False)])
def test_unigram_model(prefix, strip, fallback):
    same(unigram(prefix=prefix, strip=strip, fallback=fallback))


def test_unigram_model_with_rules():
    same(unigram(rules=nfkc()))


def test_query_columns(spark):
    import hashlib

    other = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rows = list(enumerate(TEXTS + ODD)) + [(-1, None)]
    got = {r.doc_id: r for r in pieces.digests(spark.createDataFrame(rows, "doc_id long, text string"), pieces.read_model(pieces.MODEL)).collect()}
    for i, t in rows:
        ids = other.encode(t or "")
        r = got[i]
        assert (r.n_ids, r.n_bytes, r.ids_sha256) == (len(ids), sum(other.is_byte(x) for x in ids), hashlib.sha256(struct.pack(f"<{len(ids)}i", *ids)).hexdigest())
        assert r.round_trip == (other.decode(ids) == (t or ""))

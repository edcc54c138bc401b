"""Prefix trie, Merkle manifest and byte-level BPE against brute force."""

import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from crowdscope.llm import bytebpe, manifest, prefix_trie
from crowdscope.llm.common import utf8_buffers

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key(row):
    return tuple(str(x) for x in row)


def brute_trie(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs.setdefault(c, []).append((t is not None, t or 0, r, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest(), x))
    turns = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = turns.get(c - c % 5, [])[:h] + v[h:]
    nodes, kids = {}, {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def below(p):
        leaves, saved = 0, (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        for k in kids.get(p, []):
            a, b = below(k)
            leaves, saved = leaves + a, saved + b
        return leaves or 1, saved

    for p, m in nodes.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        yield (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), *below(p), sha(ends))


def conversations(n):
    rng, rows = random.Random(3), []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 5, 8, 30 if c % 50 == 0 else 3])):
            rows.append((c, rng.choice([t, t, None]) if t else 0, rng.choice(["user", "a", None]), rng.choice(["x", "yé", None]) if t < 5 else f"t{t}"))
    if n > 100:  # repeated rows, a hot first turn, a hot conversation
        rows += rows[:9] + [(1000 + 5 * i, 0, "user", "same") for i in range(200)] + [(2000 + 5 * i, t, "user", f"same{t}") for i in range(200) for t in range(3)]
    return [*rows, (None, 1, "user", "q")]


@pytest.mark.parametrize(("n", "together", "band"), [(0, 400_000, 64), (1, 400_000, 64), (30, 400_000, 5), (300, 3, 64), (300, 400_000, 64)])
def test_trie_against_brute_force(spark, monkeypatch, n, together, band):
    """Deep bands inside tasks or depth by depth give the same nodes."""
    monkeypatch.setattr(prefix_trie, "TOGETHER", together)
    monkeypatch.setattr(prefix_trie, "DEEP_BAND", band)
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    rows, conv = conversations(n), F.col("conv_id")
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit(1)).withColumn("near", F.lit(2)).repartition(4)
    out = prefix_trie.build_trie(turns, conv - F.pmod(conv, F.lit(5)), F.crc32(conv.cast("string").cast("binary")) % 9, 8)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(brute_trie(rows), key=key)


def brute_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(field(x) for x in (r[0], r[3], r[2], r[4], text)))

    def tree(level):
        levels = [level]
        while len(level) > 1:
            level = [sha("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
            levels.append(level)
        return levels

    def path(levels, i):
        for lv in levels[:-1]:
            a = i // 8 * 8
            yield "".join(lv[a:i]), "".join(lv[i + 1:a + 8])
            i //= 8

    parts = {}
    for r in rows:
        parts.setdefault(r[2], []).append(r)
    langs = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in langs:
        parts[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[x] = tree([leaf(r, r[1]) for r in parts[x]])
    top = tree([trees[x][-1][0] for x in langs])
    for k, x in enumerate(langs):
        for i, r in enumerate(parts[x]):
            beside = [*path(trees[x], i), *path(top, k)]
            folded = leaf(r, r[1])
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                folded = leaf(r, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1]))
            for a, b in beside:
                folded = sha(a + folded + b)
            yield r[0], leaf(r, r[1]), trees[x][-1][0], top[-1][0], sha("".join(a + b for a, b in beside)), folded, folded == top[-1][0]


@pytest.mark.parametrize("n", [0, 1, 9, 700, 5000])
def test_manifest_against_brute_force(spark, n):
    """Nulls, ties, a hot repeated row, clashing column names, one to three rounds."""
    rng = random.Random(n)
    rows = [(i if i % 50 else None if i % 100 else 7, rng.choice([None, "", "Ab é", "x" * 50 + "Z", str(i)]),
             rng.choice([None, "en", "de", "", "é"]) if n < 5000 else "en", rng.choice([None, "s"]), rng.choice([None, 3])) for i in range(n)]
    rows += [(7, "Same", "en", "s", 4)] * (300 if n > 600 else 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("rank", F.lit(1)).withColumn("hash", F.lit("x"))
    out = manifest.build_manifest(docs.repartition(5), ["doc_id", "source", "lang", "n_chars", "text"],
                                  tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    got = out.select("id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")), "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_manifest(rows), key=key)


def test_manifest_emits_proofs_without_joins(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "cast(id AS string) AS text", "'en' AS lang")
    plan = manifest.build_manifest(docs, ["doc_id", "text"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.fixture(scope="module")
def ranks():
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}


@pytest.fixture(scope="module")
def both(ranks):
    return (bytebpe.Encoder(*bytebpe.tables(ranks), public_tokenizers.PATTERN),
            tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))


def test_bpe_like_tiktoken(both, ranks):
    own, other = both
    rng = random.Random(1)
    parts = ["a", "e", "t", "h", " ", "  ", "\n", "é", "文", "1", "23", "'s", "'", "!", "...", "\t", " \n", "\x1c", " ", "the", "ing", "aaaa", "😀", "<|endoftext|>"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert own.encode(text).tolist() == other.encode_ordinary(text), text
    tokens = list(ranks)
    for _ in range(4000):  # any bytes, also no UTF-8
        data = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 5)))
        assert own.piece(data) == other._encode_single_piece(data), data
    for text in ("a" * 200_000, " " * 200_000, "ab" * 50_000, "文" * 50_000, "x " * 50_000, "word\n " * 3):
        assert own.encode(text).tolist() == other.encode_ordinary(text)


def test_bpe_small_memos(both, ranks, monkeypatch):
    monkeypatch.setattr(bytebpe, "MEMO", 3)
    own = bytebpe.Encoder(*bytebpe.tables(ranks), public_tokenizers.PATTERN)
    text = "the water and the stones, again the water and 'tis\n\n cold " * 5
    assert own.encode(text).tolist() == both[1].encode_ordinary(text)


def test_bpe_rows_like_tiktoken(both, ranks, monkeypatch):
    rng = random.Random(2)
    parts = ["a", "Z", "é", "文", "²", "٣", "1", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x85", "\x1c", "'", "'s", "''", "'ll", "!", "...", "\u0301", "😀", " the", "ing", "\r\n"]
    texts = ["", "\n", " ", "", *["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(6000)], "", "a" * 70_000, "x " * 30_000, "", "'tis  \n"]
    for memo, cut in ((bytebpe.CHUNKS, bytebpe.CUT_BYTES), (3, 10_000)):  # long rows are read by themselves
        monkeypatch.setattr(bytebpe, "CHUNKS", memo)
        monkeypatch.setattr(bytebpe, "CUT_BYTES", cut)
        own = bytebpe.Encoder(*bytebpe.tables(ranks), public_tokenizers.PATTERN)
        numbers, ids = own.rows(*utf8_buffers(pa.array(texts)))
        for text, n, found in zip(texts, numbers.to_pylist(), ids.to_pylist(), strict=True):
            want = both[1].encode_ordinary(text)
            assert np.frombuffer(found, "<u4").tolist() == want and n == len(want), text
    other = bytebpe.Encoder(*bytebpe.tables(ranks), r"\S+|\s+")
    assert other.rows(*utf8_buffers(pa.array(["of it's", None])))[0].to_pylist() == [len(other.encode("of it's")), 0]


def test_bpe_encodes_each_piece_of_a_batch_once(ranks, monkeypatch):
    words = ["".join(c) for c in itertools.product("bdkvz", "aou", "qrwx", "aei")]
    texts = [".\n".join(words[i:] + words[:i]) for i in range(len(words))]
    read, piece = [], bytebpe.Encoder.piece
    monkeypatch.setattr(bytebpe.Encoder, "piece", lambda self, data: read.append(data) or piece(self, data))
    monkeypatch.setattr(bytebpe, "CHUNKS", 50)
    own = bytebpe.Encoder(*bytebpe.tables(ranks), public_tokenizers.PATTERN)
    own.rows(*utf8_buffers(pa.array(texts)))
    assert sorted(read) == sorted({w.encode() for w in words} | {b".", b"\n"})


def test_bpe_round_trip(spark, both):
    texts = ["Hello  wörld", None, "", "é" * 30_000, "same", "same", "文字 <|endoftext|>\n"]
    docs = spark.createDataFrame([(i, t, "mine", 1.5) for i, t in enumerate(texts)], "doc_id long, text string, encoded string, decoded double").repartition(2)
    ids, name = bytebpe.encode(docs, MULTI, public_tokenizers.PATTERN)
    out, text = bytebpe.decode(ids, MULTI, f"`{name}`.ids")
    assert out.columns == [*docs.columns, name, text] and out.count() == len(texts)
    for r in out.collect():
        want = both[1].encode_ordinary(texts[r.doc_id] or "")
        assert np.frombuffer(r[name].ids, "<u4").tolist() == want and r[name].n_tokens == len(want)
        assert bytes(r[text]).decode() == (texts[r.doc_id] or "") and r.decoded == 1.5
    none, _ = bytebpe.encode(docs.where("false"), MULTI, public_tokenizers.PATTERN)
    assert none.count() == 0

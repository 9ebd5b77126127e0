"""Byte-level BPE, Merkle manifest and periodic runs against plain versions."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from fractions import Fraction
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tests.llm import plain
from tests.llm.conftest import SCHEMA
from tidewatt.llm import byte_bpe, merkle, periodic, queries
from tidewatt.llm.words import mix

SF_DIR = "/root/testdata/sf0.001"
ALPHABET = ["a", "b", "Z", "é", "ß", "1", "9", "²", " ", " ", "\n", "\t", "'", "s", "t", "re", "ve", "ll", "d", "m", "!", "?", "😀", "日", "本",
            "́", "　", "'ll", "'RE", "\r", "\x1c", "\x85", "ſ", "٣"]


# ---- byte-level BPE --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    with open(byte_bpe.default_ranks()) as f:
        ranks = byte_bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def wanted(library, text):
    ids = np.array(library.encode_ordinary(text or ""), dtype="<u4")
    return len(ids), sha256(ids.tobytes()).hexdigest(), sha256((text or "").encode()).hexdigest()


def test_pre_tokens_are_the_matches_of_the_pattern():
    rng = random.Random(1)
    for _ in range(1500):
        texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(5)]
        data = [t.encode() for t in texts]
        whole = np.frombuffer(b"".join(data), dtype=np.uint8)
        start = byte_bpe.pre_tokens(whole, np.cumsum([0, *map(len, data)]))
        got = [whole[a:b].tobytes().decode() for a, b in zip(start, np.append(start[1:], len(whole)))]
        assert got == [x for t in texts for x in regex.findall(public_tokenizers.PATTERN, t)]


def test_classes_are_those_of_the_library():
    table, rng = byte_bpe._classes(), random.Random(2)
    points = [c for c in [*range(0x3000), *rng.sample(range(0x3000, 0x110000), 20_000)] if not 0xD800 <= c < 0xE000]
    assert [int(table[c]) for c in points] == [byte_bpe._asked(chr(c)) for c in points]


def test_bpe_of_long_texts(spark, library):
    """Texts of many chunks: stitched, and without a common boundary (a letter run, white space) at the first, a later or every edge."""
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(n)) for n in (300, 719, 720, 721, 5000, 20_000)]
    texts += ["x" * 3000 + " b c d" * 300, "a b " * 500 + "y" * 900 + " q" * 900, " " * 4000, "\n" * 1300 + "end", "😀" * 2000, None, "", "'"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[4]), (None, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = byte_bpe.digest(byte_bpe.decoded(byte_bpe.encoded(docs, chunk=600, overlap=120))).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((i, *wanted(library, t))) for i, t in rows)


def test_bpe_of_every_document(docs, rows, nothing, library):
    got = byte_bpe.digest(byte_bpe.decoded(byte_bpe.encoded(docs))).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {r[0]: wanted(library, r[1]) for r in rows} and len(got) == len(rows)
    assert byte_bpe.encoded(nothing).count() == 0


def test_bpe_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = queries.QUERIES["op11_byte_bpe"](spark, SF_DIR).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: wanted(library, t) for i, t in texts.items()} and len(got) == len(texts)


# ---- Merkle manifest -------------------------------------------------------------------------


def tampered():
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.expr("crc32(cast(doc_id as string)) % 5 = 0"), lowered).otherwise(F.col("text"))


@pytest.mark.parametrize("n", [0, 1, 2, 17, 300])
def test_merkle_manifest(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([None, "", "Abc É", "x" * 30, f"HELLO {i}"]), rng.choice(["en", None]),
             rng.choice([None, "", "a", "é", "b"]) if rng.random() < 0.3 else "hot", rng.choice([None, 5]), "x", 0, "y") for i in range(n)]
    if n == 300:
        rows += [(None, "X", "en", "hot", 1, "", 0, "")] * 2 + [rows[5]] * 3
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, merkle.manifest(docs, tampered()).collect()), key=str)
    assert got == plain.manifest(rows)
    assert n < 300 or any(not r[-1] for r in got)


def test_a_version_copies_only_the_way_up(spark):
    """Every copied node is the digest of its one changed child and shared siblings; untouched rows copy nothing."""
    rows = [(i, f"TEXT {i}", "en", "s", 5, "", 0, "") for i in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = merkle.manifest(docs, F.when(F.col("doc_id") == 77, "other").otherwise(F.col("text")), with_nodes=True).collect()
    copied = {r.doc_id: r.copied for r in got if r.copied}
    assert list(copied) == [77] and len(copied[77]) == 1 + 3  # 600 leaves: 38, 3, 1
    assert not next(r for r in got if r.doc_id == 77).verified and sum(r.verified for r in got) == 599
    assert {r.folded_root for r in got if r.doc_id == 77} == {copied[77][-1]}


def test_merkle_query(spark):
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = queries.QUERIES["op12_merkle_manifest"](spark, SF_DIR)
    assert got.columns == merkle.OUT and sorted(map(tuple, got.collect()), key=str) == plain.manifest(rows)


# ---- periodic runs ---------------------------------------------------------------------------


def found(texts):
    """Runs of texts given as lists of numbers, by the operator's core."""
    ids = np.array([x for t in texts for x in t], dtype=np.uint64)
    first = np.cumsum([0, *map(len, texts)])
    of = np.repeat(np.arange(len(texts)), np.diff(first)).astype(np.uint64)
    start, end, period = periodic.runs(mix(ids + np.uint64(1) + of * np.uint64(1_000_003)), first)
    return [[(int(a - x), int(b - a), int(q)) for a, b, q in zip(start, end, period) if x <= a < y] for x, y in zip(first, first[1:])]


def test_runs_against_search():
    rng = random.Random(7)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 5)):
            t = []
            for _ in range(rng.randint(0, 5)):
                unit = [rng.randrange(rng.choice([1, 2, 3, 5, 50])) for _ in range(rng.randint(1, rng.choice([2, 5, 30])))]
                t += [unit[i % len(unit)] for i in range(rng.randint(0, rng.choice([10, 60, 130])))]
                t += [rng.randrange(1000) for _ in range(rng.choice([0, 0, 4]))]
            texts.append(t * rng.choice([1, 1, 1, 3]))
        assert found(texts) == [plain.runs(t) for t in texts]


def test_runs_of_extreme_texts():
    rng = random.Random(8)
    unit = [rng.randrange(10**6) for _ in range(20_000)]
    assert found([[1] * 200_000, unit * 3 + [5], unit * 2]) == [[(0, 200_000, 1)], [(0, 60_000, 20_000)], []]
    blocks = ([1] * 300 + [2]) * 50
    assert found([blocks]) == [sorted([(0, 15_050, 301), *((301 * k, 300, 1) for k in range(50))], key=lambda r: (r[0], r[2]))]
    # A word sequence without repeats of a repeat, on which hashes modulo a power of two fail.
    odd = [bin(i).count("1") & 1 for i in range(1 << 13)]
    assert found([odd, odd + [1 - x for x in odd]]) == [[], []]


def described(i, text):
    w = plain.words(plain.planted(i, text), lower=False)
    runs = plain.runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = [x for k, x in enumerate(w) if not any(s + q <= k < s + n for s, n, q in runs)]
    digest = lambda x: sha256(x.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)), digest(" ".join(kept)))


def test_periodic_runs(docs, rows, nothing):
    got = periodic.digest(periodic.detect(periodic.planted(docs))).collect()
    want = {r[0]: described(r[0], r[1]) for r in rows}
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and any(w[0] for w in want.values())
    assert periodic.detect(nothing).count() == 0


def test_periodic_null_ids_and_repeats(spark):
    text = "a b " * 20
    got = periodic.detect(spark.createDataFrame([(None, text), (1, text), (1, text), (2, None)], "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_runs, r.length, r.collapsed) for r in got) == [
        ("1", 1, 40, "a b"), ("1", 1, 40, "a b"), ("2", 0, None, ""), ("None", 1, 40, "a b")]


def test_periodic_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    short = {i: t for i, t in texts.items() if len(plain.words(t)) < 1500}
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()}
    assert set(got) == set(texts) and {i: got[i] for i in short} == {i: described(i, t) for i, t in short.items()}
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and got[i][0] for i in short)

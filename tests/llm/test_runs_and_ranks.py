"""Periodic runs against brute force, byte-level BPE against the tokenizer library."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import public_tokenizers
import pytest
import tiktoken
from conftest import SMOKE

from funnel_engine.llm.byte_bpe import ByteCodec, encode_documents, op12_byte_bpe, ranks_path, read_ranks
from funnel_engine.llm.periodic_runs import collapsed, op11_periodic_runs, periodic_runs, runs_of

LONG = "lorem " * 200_000
ODD = [None, "", " \t", "a", "a  b\n\n c", "same", "same", "\x00\t\r\n", "日本語 🙂🙂", LONG, "x y " * 3 + "x", "x y " * 4, "\x1cx " * 6, "\xa0 " * 7]


def docs(spark, bodies):
    rows = [(None if i == 2 else i, t, i, str(i), i) for i, t in enumerate(bodies)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, runs bigint, ids string, best int")


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


# -- periodic runs --------------------------------------------------------


def brute_runs(w):
    """From the definition: every maximal stretch of every period that no smaller period has."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q) and not any(all(w[i + k] == w[i + k + d] for k in range(n - d)) for d in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        batch = []
        for _ in range(rng.randint(1, 4)):
            w = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 60))]
            for _ in range(rng.randint(0, 3)):
                a, p = rng.randint(0, len(w)), rng.randint(1, 9)
                w = w[:a] + w[a : a + p] * rng.randint(2, 8) + w[a + p :]
            batch.append([b"%d" % x for x in w])
        assert runs_of(batch) == [brute_runs(w) for w in batch]
    with pytest.raises(ValueError):
        runs_of([[b"a"] * 9], repeats=3)


def test_one_word_many_times_is_quick_and_whole():
    assert runs_of([[b"a"] * 300_000, [b"a", b"b"] * 50_000]) == [[(0, 300_000, 1)], [(0, 100_000, 2)]]


def test_runs_of_odd_rows_and_empty_tables(spark):
    df = docs(spark, ODD)
    got = {r.doc_id: r for r in periodic_runs(df).collect()}
    assert len(got) == len(ODD) and periodic_runs(df.limit(0)).count() == 0
    for i, t in enumerate(ODD):
        words = (t or "").encode().split()
        r = got[None if i == 2 else i]
        want = [(0, 200_000, 1)] if t is LONG else brute_runs(words)
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), want)
        assert r.collapsed.encode().split() == collapsed(words, want)
    assert got[9].collapsed == "lorem" and got[11].collapsed == "x y" and not got[10].runs


def test_op11_against_brute_force(spark):
    want = {}
    for r in spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect():
        w = (r.text or "").encode().split()
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        # Words q apart, over whole texts: only stretches of at least 3 q matches are looked at further.
        runs = brute_runs(w) if n < 3000 else runs_of([w])[0]
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if runs else (None,) * 3
        out = {i for s, m, q in runs for i in range(s + q, s + m)}
        want[r.doc_id] = (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in out)),
        )
    got = op11_periodic_runs(spark, SMOKE)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert any(v[0] for v in want.values()) and not all(v[0] for v in want.values())


# -- byte-level BPE -------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks_path()), special_tokens={})


def test_codec_against_the_library(library):
    codec = ByteCodec(ranks_path())
    rng = random.Random(2)
    # Among them letters and digits that only newer versions of Unicode know, and marks that even fewer do.
    parts = ["a", "e", "th", "ing", " ", "  ", "\n", "1", "2", ".", "é", "ß", "日", "🙂", "'s", "'ll", "Ᲊ", "\U0001ccf0", "࢏", "\t", "ſ", "\x85", "\x1c", "x" * 30, "<|endoftext|>"]
    bodies = ["", "a" * 5000, "ab" * 3000, " " * 4000, "aaa" * 777 + "b"] + ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(1500)]
    for t in bodies:
        ids = codec.encode(t)
        assert ids.tolist() == library.encode_ordinary(t), t
        assert codec.decode(ids) == t.encode()
    assert not codec.buckets and not any(codec.words)


def test_queue_on_a_long_pretoken(library):
    rng = random.Random(3)
    word = "".join(rng.choices("abcdefgh", k=60_000))
    assert ByteCodec(ranks_path()).merge(word.encode()) == library.encode_ordinary(word)


def test_bpe_odd_rows_and_empty_tables(spark, library):
    df = docs(spark, ODD)
    got = {r.doc_id: r for r in encode_documents(df).collect()}
    assert len(got) == len(ODD) and encode_documents(df.limit(0)).count() == 0
    for i, t in enumerate(ODD):
        r = got[None if i == 2 else i]
        assert list(r.ids) == library.encode_ordinary(t or "") and bytes(r.decoded) == (t or "").encode()


def test_op12_against_the_library(spark, library):
    bodies = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    got = op12_byte_bpe(spark, SMOKE)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = {i: (ids := library.encode_ordinary(t)) and (len(ids), sha(" ".join(map(str, ids)).encode()), sha(t.encode())) or (0, sha(b""), sha(b"")) for i, t in bodies.items()}
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want

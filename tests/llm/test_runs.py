"""Common extensions and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import lce, periodic_runs, queries
from ledgerline.llm.common import ship

SF_DIR = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, words string, runs int, n_words string, collapsed long"


def plain_extension(text, a, b):
    n = 0
    while b + n < len(text) and text[a + n] == text[b + n]:
        n += 1
    return n


def plain_runs(words):
    """Every maximal stretch of each period, kept with its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            lo = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - lo >= max(12, 2 * q):
                found.setdefault((lo, i + q), q)
    return sorted((lo, hi - lo, q) for (lo, hi), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_cover_brings_any_two_places_together():
    covered = set(lce.COVER)
    for a in range(lce.V):
        for b in range(lce.V):
            d = lce.SHIFTS[a, b]
            assert (a + d) % lce.V in covered and (b + d) % lce.V in covered


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 3), st.integers(0, 400), st.integers(0, 2**32), st.integers(1, 90))
def test_extensions(letters, n, seed, period):
    rng = np.random.default_rng(seed)
    block = rng.integers(1, letters + 1, period)
    text = np.where(rng.random(n) < 0.01, letters + 1, np.resize(block, n)) if n else np.zeros(0, int)
    made = lce.Extensions(text)
    a = rng.integers(0, max(n, 1), 60)
    b = rng.integers(0, n + 1, 60)
    a, b = np.minimum(a, b), np.maximum(a, b)
    a, b = a[a < b], b[a < b]
    got = made.of(a, b)
    assert got.tolist() == [plain_extension(text.tolist(), x, y) for x, y in zip(a, b)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 120), st.integers(0, 2**32), st.integers(1, 40)), min_size=1, max_size=4))
def test_runs_of_joined_texts(shapes):
    texts = []
    for letters, n, seed, period in shapes:
        rng = np.random.default_rng(seed)
        block = rng.integers(0, letters, period)
        noise = rng.integers(0, letters + 1, n)
        values = np.where(rng.random(n) < 0.05, noise, np.resize(block, n)) if n else noise
        texts.append([b"%d" % v for v in values])
    for words, (count, rows, text) in zip(texts, periodic_runs._told(texts)):
        want = plain_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in rows] == want
        assert count == len(words) and text == b" ".join(collapsed(words, want))


def test_odd_rows(spark):
    ship(spark)
    phrase = " ".join(f"w{n}" for n in range(9))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (None, "a " * 12), (5, "a " * 11), (6, "é x " * 30),
        (6, "é x " * 30), (7, f"{phrase} {phrase}"), (8, " ".join(f"{n % 4000}" for n in range(100_000))), (None, None),
    ]
    frame = spark.createDataFrame([(d, t, "x", 1, "y", 2) for d, t in rows], CLASH)
    got = periodic_runs.runs(frame).collect()
    assert len(got) == len(rows)
    for row, (doc_id, text) in zip(got, rows):
        words = (text or "").encode().split()
        want = [(0, 100_000, 4000)] if doc_id == 8 else plain_runs(words)
        assert (row["doc_id"], row["n_words"]) == (doc_id, len(words))
        assert [tuple(r) for r in row["runs"]] == want
        assert row["collapsed"] == b" ".join(words[:4000] if doc_id == 8 else collapsed(words, want)).decode()
    assert periodic_runs.runs(frame.where("false")).collect() == []


def test_op11(spark):
    def sha(text):
        return hashlib.sha256(text).hexdigest()

    want = []
    for doc_id, text in duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall():
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(((-length, start, q) for start, length, q in runs), default=None)
        longest = (best[1], -best[0], best[2], -best[0] * 1000 // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want.append((doc_id, len(runs), *longest, sha(lines.encode()), sha(b" ".join(collapsed(words, runs)))))
    got = queries.op11_periodic_runs(spark, SF_DIR)
    assert got.columns[:3] == ["doc_id", "n_runs", "start"]
    assert sorted(map(tuple, got.collect())) == sorted(want)

"""Repeated passages against counting every window."""

from __future__ import annotations

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import queries, seed_extend
from ledgerline.llm.common import ship

SF_DIR = "/root/testdata/sf0.001"
CLASH = "doc_id long, text string, row long, spans string, anchor int, kind int, words string, first string"


def expected(rows):
    texts = [(text or "").encode().split() for _, text in rows]
    windows = lambda words: [tuple(words[i : i + 35]) for i in range(len(words) - 34)]
    seen = Counter(w for words in texts for w in windows(words))
    out = []
    for (doc_id, _), words in zip(rows, texts):
        gone = set()
        for i, w in enumerate(windows(words)):
            if seen[w] > 1:
                gone.update(range(i, i + 35))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), kept.decode()))
    return sorted(out, key=str)


def found(frame):
    got = seed_extend.without_passages(frame)
    assert got.columns == ["doc_id", "n_words", "n_removed", "n_spans", "kept"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got.collect()), key=str)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 200), st.integers(0, 2**32))
def test_pieces_hold_every_window_under_its_own_seed(n, seed):
    words = np.random.default_rng(seed).integers(0, 3, n).astype(np.uint64)
    firsts, lasts, ats, anchors = seed_extend.pieces_of(words)
    places = [p for a, b in zip(firsts, lasts) for p in range(a, b + 1)]
    assert places == list(range(max(0, n - 34)))
    seeds = seed_extend.seeds_of(words) >> np.uint64(32)
    for a, b, at, anchor in zip(firsts, lasts, ats, anchors):
        assert seeds[at] == anchor >> np.uint64(32)
        for p in range(a, b + 1):
            inside = seeds[p : p + 28]
            assert at == p + int(inside.argmin())


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 3), st.integers(0, 2**32))
def test_extension_equals_comparing_windows(m, groups, seed):
    rng = np.random.default_rng(seed)
    rows, group = [], []
    common = rng.integers(0, 2**60, 62).astype(np.uint64)
    for n in range(m):
        first, last = sorted(rng.integers(0, 28, 2).tolist())
        words = np.where(rng.random(62) < 0.02, rng.integers(0, 3, 62).astype(np.uint64), common)
        words[27:35] = common[27:35]
        at = 40 + n
        data = words[first : last + 35].tobytes()
        rows.append({"first": at - 27 + first, "last": at - 27 + last, "at": at, "words": data, "whole": words})
        group.append(n % groups)
    got = seed_extend.repeats_of(np.array(group), rows)
    for n, row in enumerate(rows):
        for j in range(28):
            place = row["at"] - 27 + j
            if not row["first"] <= place <= row["last"]:
                assert not got[n, j]
                continue
            window = row["whole"][j : j + 35].tolist()
            want = any(
                o is not row and group[k] == group[n] and o["first"] <= o["at"] - 27 + j <= o["last"]
                and o["whole"][j : j + 35].tolist() == window
                for k, o in enumerate(rows)
            )
            assert got[n, j] == want


def test_odd_rows(spark):
    ship(spark)
    copy = " ".join(f"copy{n}" for n in range(60))
    rows = [
        (1, copy), (1, copy), (2, None), (3, ""), (4, " \n"), (None, copy), (None, None),
        (5, "x " * 34), (6, "x " * 35), (7, "y " * 36), (8, " ".join(f"w{n % 700}" for n in range(60_000))),
        (9, "lead " + copy.replace("copy50", "other") + " tail"), (10, copy.replace(" ", "\t\r\n")),
    ]
    frame = spark.createDataFrame([(d, t, 1, "s", 2, 3, "w", "f") for d, t in rows], CLASH)
    assert found(frame) == expected(rows)
    assert found(frame.where("false")) == []


@pytest.mark.parametrize("most", [64, 3])
def test_very_common_passages(spark, monkeypatch, most):
    """Passages in every text, between different words and cut at different places."""
    monkeypatch.setattr(seed_extend, "MOST_KINDS", most)
    rng = np.random.default_rng(most)
    passage = [f"p{n}" for n in range(90)]
    rows = []
    for n in range(400):
        lo, hi = sorted(rng.integers(0, 90, 2).tolist()) if n % 3 else (0, 90)
        own = [f"o{x}" for x in rng.integers(0, 10**6, 50)]
        rows.append((n, " ".join(own[:25] + passage[lo:hi] + own[25:])))
    rows += [(n, " ".join(passage)) for n in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == expected(rows)


def test_op13(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    want = [(i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in expected(rows)]
    got = queries.op13_passages(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_op13_agrees_with_sql(spark):
    check = differences(queries.op13_passages(spark, SF_DIR), connect(SF_DIR), queries.CHECKS["op13_passages"])
    assert check == []

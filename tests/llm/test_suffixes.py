"""Suffix order and repeated strings against plain ones."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import repeats
from ledgerline.llm.suffix_array import repeated_places, suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_order(values):
    text = np.array(values, np.int64)
    plain = sorted(range(len(values)), key=lambda i: values[i:])
    assert suffix_array(text).tolist() == plain


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 2), min_size=8, max_size=60))
def test_repeated_places(values):
    text = np.array(values, np.int64)
    valid = np.arange(len(text)) + 4 <= len(text)
    found = repeated_places(text, suffix_array(text), valid, 4)
    strings = [tuple(values[i : i + 4]) for i in range(len(values) - 3)]
    assert found[: len(strings)].tolist() == [strings.count(s) > 1 for s in strings]


def test_smallest_of_each_window():
    values = np.random.default_rng(1).integers(0, 99, 500).astype(np.uint64)
    plain = [values[i : i + 7].min() for i in range(494)]
    assert repeats.first_smallest(values, 7).tolist() == plain


def test_equal_bytes_have_equal_hashes():
    data = np.random.default_rng(2).integers(0, 256, 3000).astype(np.uint8)
    data[2000:2500] = data[100:600]
    for length in (32, 400):
        hashes = repeats.rolled(data, length)
        assert len(hashes) == 3000 - length + 1
        assert (hashes[2000 : 2501 - length] == hashes[100 : 601 - length]).all()
        assert len(np.unique(hashes)) == len(hashes) - (501 - length)


def test_document_keys_need_no_python_worker(spark):
    docs = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "a"), (1, "b"), (None, "a"), (None, "a"), (0, "a"), (3, None), (3, "")],
        "doc_id int, text string",
    )
    keyed = repeats.with_key(docs)
    assert "InArrow" not in keyed._jdf.queryExecution().executedPlan().toString()
    rows = keyed.collect()
    assert len({r.doc_key for r in rows}) == len({(r.doc_id, r.text) for r in rows}) == 6
    assert len({(r.doc_id, r.text, r.doc_key) for r in rows}) == 6

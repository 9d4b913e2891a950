"""Schedules: every block once, in time, less than one block from its share."""

from __future__ import annotations

from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import mixing

WEIGHTS = st.dictionaries(st.text("abcdef", min_size=1, max_size=2), st.integers(1, 30), min_size=1, max_size=6)


@settings(max_examples=200, deadline=None)
@given(WEIGHTS)
def test_patterns_stay_less_than_one_block_off(weights):
    pattern, period = mixing.pattern_of(weights), sum(weights.values())
    assert sorted(s for slots in pattern.values() for s in slots) == list(range(period))
    for name, w in weights.items():
        for slot in range(period + 1):
            had = sum(s < slot for s in pattern[name])
            assert abs(had - Fraction(slot * w, period)) < 1


@settings(max_examples=100, deadline=None)
@given(WEIGHTS, st.data())
def test_phases_cover_every_block_once(weights, data):
    blocks = {name: data.draw(st.integers(0, 70)) for name in weights}
    taken, seen = [], {}
    for phase in mixing.phases(blocks, weights):
        seen[phase.first_slot] = phase
    plan = list(seen.values())
    for name, n in blocks.items():
        own = [p for p in plan if name in p.weights]
        for block in range(n):
            phase = [p for p in own if p.taken[name] <= block][-1]
            turn, inside = divmod(block - phase.taken[name], phase.weights[name])
            taken.append(phase.first_slot + turn * phase.period + phase.pattern[name][inside])
    assert sorted(taken) == list(range(sum(blocks.values())))


def test_default_weights_fill_the_period():
    weights = mixing.default_weights({"a": 1, "b": 10_000, "c": 400})
    assert sum(weights.values()) <= mixing.PERIOD and weights["b"] > weights["c"] > weights["a"] >= 1


def test_a_source_without_weight_is_refused(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, source string")
    with pytest.raises(ValueError, match="no weight"):
        mixing.mixed(frame, {"a": 2})

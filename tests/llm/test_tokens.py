"""Token ids, codes and files against the library and round trips."""

from __future__ import annotations

import heapq

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import huffman
from ledgerline.llm.tokens import default_vocabulary, encoder

PARTS = ["foo", "bar,", "it's", " ", "  ", "\n", "\t", "é", "ß1", "\x1c", "　", "a\nb",
         "²", "x_y", "don't!", "<|endoftext|>", "'s", "😀", "\r\n", "中文", "́"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(default_vocabulary())
    tokenizer.encode_special_tokens = True
    return tokenizer


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=12), st.sampled_from(["", " "]))
def test_pieces_give_the_ids_of_whole_texts(library, parts, between):
    text = between.join(parts)
    found = np.frombuffer(encoder(default_vocabulary()).encode(text), "<u2").tolist()
    assert found == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("longest,symbols", [(16, 50257), (4, 9), (5, 32), (16, 1), (16, 2)])
def test_lengths_are_limited_and_complete(longest, symbols):
    counts = np.random.default_rng(symbols).zipf(1.4, symbols).clip(max=10**9)
    lengths = huffman.code_lengths(counts, longest).astype(int)
    assert 1 <= lengths.min() and lengths.max() <= longest
    assert sum(2.0**-lengths) == (1 if symbols > 1 else 0.5)


def test_lengths_are_optimal_without_a_limit_in_reach():
    counts = np.random.default_rng(3).integers(1, 1000, 200)
    heap, best = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        best += both
        heapq.heappush(heap, both)
    assert (counts * huffman.code_lengths(counts)).sum() == best


def test_too_many_symbols_for_the_limit():
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


@pytest.mark.parametrize("symbols,skew", [(65_537, 1.01), (200_000, 1.2), (300_000, 3.0)])
def test_large_vocabularies_round_trip(symbols, skew):
    rng = np.random.default_rng(symbols)
    counts = rng.zipf(skew, symbols).clip(max=10**9)
    lengths = huffman.code_lengths(counts)
    assert 16 < lengths.max() <= huffman.longest_for(symbols) <= huffman.MOST_BITS
    assert sum(2.0 ** -lengths.astype(int)) == 1
    table = huffman.decoding_table(lengths)
    assert len(table.symbols) == 1 << huffman.LONGEST
    rare, common = np.argsort(counts)[:2000], np.argsort(counts)[-2000:]
    ids = [rng.permutation(np.r_[rare, common, rng.integers(0, symbols, 999)]).astype(np.uint32), np.array([0, symbols - 1], np.uint32)]
    block = huffman.pack_block([7, None], ids, huffman.canonical_codes(lengths), lengths)
    got = huffman.unpack_blocks([block, block], table)
    assert [(d, [x.tolist() for x in y]) for d, y in got] == [([7, None], [x.tolist() for x in ids])] * 2


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 3000))
def test_blocks_round_trip(seed, symbols):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 50, symbols)
    counts[rng.integers(symbols)] += 1
    lengths = huffman.code_lengths(counts)
    used = np.flatnonzero(counts)
    blocks, want = [], []
    for _ in range(rng.integers(1, 4)):
        ids = [rng.choice(used, rng.integers(0, 400)).astype(np.uint32) for _ in range(rng.integers(0, 6))]
        docs = [None if rng.random() < 0.2 else int(x) for x in rng.integers(-9, 2**40, len(ids))]
        blocks.append(huffman.pack_block(docs, ids, huffman.canonical_codes(lengths), lengths))
        want.append((docs, [x.tolist() for x in ids]))
    got = huffman.unpack_blocks(blocks, huffman.decoding_table(lengths))
    assert [(docs, [x.tolist() for x in ids]) for docs, ids in got] == want

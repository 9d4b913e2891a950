"""Canonical length-limited Huffman codes as arrays, and blocks of coded ids.

A block is self-contained given the code lengths: it holds whole documents, their ids
and token counts, the bit offset of every ``STEP``-th token, and the coded bits.  With
the offsets, all stretches of a block are decoded side by side by table look-up.

Layout, little endian: magic, documents (u4), tokens (u4), one validity byte and one
signed 8-byte id per document, one u4 token count per document, one u4 bit offset per
stretch, then the bits, first bit highest.

Codes have ``LONGEST`` bits at most while that many patterns are enough for the ids in use,
else ``SPARE`` bits more than the ids need.  The decoding table has two levels: canonical
codes beyond ``LONGEST`` bits come last, so one cut tells which patterns need more bits.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

MAGIC = b"HUF1"
LONGEST = 16
SPARE = 2
MOST_BITS = 25  # what a 32-bit window holds from any bit of its first byte
STEP = 128
TAIL = 4  # zero bytes behind the bits, so that a look-up never passes the end


def longest_for(symbols: int) -> int:
    """The limit of code lengths for so many ids in use."""
    needed = max(0, symbols - 1).bit_length()
    return LONGEST if needed <= LONGEST else min(needed + SPARE, max(needed, MOST_BITS))


def code_lengths(counts: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Optimal lengths of at most ``longest`` bits by package-merge; 0: never used."""
    used = np.flatnonzero(counts)
    longest = longest_for(len(used)) if longest is None else longest
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << min(longest, MOST_BITS):
        raise ValueError(f"{len(used)} symbols don't fit codes of {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    n = len(order)
    # Of each level: which entries of the merged list are packages of the level below.
    levels = []
    packages = np.empty(0)
    for _ in range(longest):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank >= n)
        merged = merged[rank]
        half = len(merged) // 2
        packages = merged[0 : 2 * half : 2] + merged[1 : 2 * half : 2]
    take = 2 * n - 2
    for is_package in reversed(levels):
        chosen = is_package[:take]
        leaves = take - int(chosen.sum())
        lengths[order[:leaves]] += 1
        take = 2 * int(chosen.sum())
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol: by length, then by symbol."""
    codes = np.zeros(len(lengths), np.uint32)
    code = 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        code <<= 1
        same = np.flatnonzero(lengths == bits)
        codes[same] = code + np.arange(len(same), dtype=np.uint32)
        code += len(same)
    return codes


class Table(NamedTuple):
    """Symbol and length for every pattern of ``LONGEST`` bits below ``cut``; from there
    on, for every pattern of ``more`` bits more."""

    symbols: np.ndarray
    bits: np.ndarray
    cut: int
    more: int
    far_symbols: np.ndarray
    far_bits: np.ndarray


def decoding_table(lengths: np.ndarray) -> Table:
    """The two-level table of a canonical code."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    sizes = lengths[order].astype(np.int64)
    near = order[sizes <= LONGEST]
    symbols = np.zeros(1 << LONGEST, np.uint32)
    bits = np.zeros(1 << LONGEST, np.uint8)
    spans = np.left_shift(1, LONGEST - lengths[near].astype(np.int64))
    cut = int(spans.sum())
    symbols[:cut] = np.repeat(near, spans)
    bits[:cut] = np.repeat(lengths[near], spans)
    far = order[sizes > LONGEST]
    longest = int(sizes.max(initial=LONGEST))
    spans = np.left_shift(1, max(longest, LONGEST) - lengths[far].astype(np.int64))
    return Table(
        symbols,
        bits,
        cut,
        max(longest - LONGEST, 0),
        np.repeat(far, spans).astype(np.uint32),
        np.repeat(lengths[far], spans),
    )


def pack_block(doc_ids, ids: list[np.ndarray], codes, lengths) -> bytes:
    """One block of whole documents; ``doc_ids`` may hold None."""
    tokens = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    sizes = lengths[tokens].astype(np.int64)
    ends = np.cumsum(sizes)
    at = ends - sizes
    # A code of up to 16 bits touches two 16-bit words at most, a longer one three.
    parts = 2 if lengths.max(initial=0) <= 16 else 3
    shifted = codes[tokens].astype(np.int64) << (16 * parts - sizes - (at & 15))
    words = np.zeros(int(ends[-1] if len(ends) else 0) // 16 + parts, np.int64)
    if len(tokens):
        word = at >> 4
        heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        for part in range(parts):
            own = (shifted >> 16 * (parts - 1 - part)) & 0xFFFF
            np.add.at(words, word[heads] + part, np.add.reduceat(own, heads))
    return b"".join(
        [
            MAGIC,
            np.array([len(doc_ids), len(tokens)], "<u4").tobytes(),
            np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([len(x) for x in ids], "<u4").tobytes(),
            at[::STEP].astype("<u4").tobytes(),
            words.astype(">u2").tobytes(),
        ]
    )


def unpack_blocks(blocks: list[bytes], table: Table) -> list[tuple[list, list[np.ndarray]]]:
    """Documents and ids of each block; all stretches are decoded side by side."""
    heads, places, counts, data, base = [], [], [], [], 0
    for block in blocks:
        if block[:4] != MAGIC:
            raise ValueError("not a block of coded ids")
        docs, tokens = (int(x) for x in np.frombuffer(block, "<u4", 2, 4))
        valid = np.frombuffer(block, np.uint8, docs, 12)
        doc_ids = np.frombuffer(block, "<i8", docs, 12 + docs)
        sizes = np.frombuffer(block, "<u4", docs, 12 + 9 * docs)
        steps = -(-tokens // STEP)
        offsets = np.frombuffer(block, "<u4", steps, 12 + 13 * docs).astype(np.int64)
        bits_at = 12 + 13 * docs + 4 * steps
        places.append(offsets + 8 * base)
        counts.append(np.minimum(STEP, tokens - STEP * np.arange(steps)))
        data += [block[bits_at:], bytes(TAIL)]
        base += len(block) - bits_at + TAIL
        heads.append(
            ([int(d) if v else None for d, v in zip(doc_ids, valid)], sizes, tokens)
        )
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    window, width = raw, 24
    if len(raw) > TAIL:
        window = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
        if table.more:
            window, width = (window[:-1] << 8) | raw[3:], 32
    beyond = table.cut << table.more
    at = np.concatenate(places) if places else np.empty(0, np.int64)
    left = np.concatenate(counts) if counts else np.empty(0, np.int64)
    out = np.zeros((len(at), STEP), np.uint32)
    full = int(left.min(initial=STEP))
    for step in range(STEP):
        if step >= full:
            live = left > step
            if not live.any():
                break
        held = window[at >> 3]
        key = (held >> (width - LONGEST - (at & 7)).astype(np.uint32)) & 0xFFFF
        found, taken = table.symbols[key], table.bits[key]
        if table.more:
            far = np.flatnonzero(key >= table.cut)
            shift = (width - LONGEST - table.more - (at[far] & 7)).astype(np.uint32)
            key = ((held[far] >> shift) & ((1 << LONGEST + table.more) - 1)) - beyond
            found[far], taken[far] = table.far_symbols[key], table.far_bits[key]
        out[:, step] = found
        at = at + (taken if step < full else np.where(live, taken, 0))
    result, row = [], 0
    for doc_ids, sizes, tokens in heads:
        steps = -(-tokens // STEP)
        ids = out[row : row + steps].reshape(-1)[:tokens]
        row += steps
        result.append((doc_ids, np.split(ids, np.cumsum(sizes.astype(np.int64))[:-1]) if len(sizes) else []))
    return result

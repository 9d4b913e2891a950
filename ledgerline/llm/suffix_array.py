"""Suffix arrays by the difference cover modulo 3, in arrays."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start places of all suffixes of ``text`` (integers of 1 or more) in order.

    Suffixes at places not divisible by 3 are sampled: their leading triples are sorted
    and named, and where names repeat, the order of the string of names is found by the
    same algorithm.  The rest is sorted by one character and the rank of the sampled
    suffix behind it, and merged in: against a sampled suffix, a comparison takes one
    or two characters and then meets two sampled ranks.
    """
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    s = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    # Where n % 3 == 1, an empty suffix is sampled too, to part the two halves of names.
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sampled = np.concatenate([ones, twos])
    names, unique = _named(s, sampled)
    if unique:
        order = np.argsort(names, kind="stable")
    else:
        order = suffix_array(names)
    rank = np.zeros(n + 3, np.int64)
    rank[sampled[order]] = np.arange(1, len(order) + 1)
    sorted12 = sampled[order]
    sorted12 = sorted12[sorted12 < n]

    zeros = np.arange(0, n, 3)
    base = n + 2
    sorted0 = zeros[np.argsort(s[zeros] * base + rank[zeros + 1], kind="stable")]
    # How many sampled suffixes of either kind come before each of the others.
    s1, s2 = sorted12[sorted12 % 3 == 1], sorted12[sorted12 % 3 == 2]
    one = np.searchsorted(s[s1] * base + rank[s1 + 1], s[sorted0] * base + rank[sorted0 + 1])
    key = lambda i: (s[i] * (int(s.max()) + 1) + s[i + 1]) * base + rank[i + 2]
    two = np.searchsorted(key(s2), key(sorted0))
    merged = np.full(n, -1, np.int64)
    merged[np.arange(len(sorted0)) + one + two] = sorted0
    merged[merged < 0] = sorted12
    return merged


def _named(s: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, bool]:
    """Rank of each place's triple among all, from 1; and whether all differ."""
    top = int(s.max()) + 1
    triples = (s[places] * top + s[places + 1]) * top + s[places + 2]
    order = np.argsort(triples, kind="stable")
    sorted_ = triples[order]
    new = np.r_[True, sorted_[1:] != sorted_[:-1]]
    names = np.empty(len(places), np.int64)
    names[order] = np.cumsum(new)
    return names, bool(new.all())


def repeated_places(
    data: np.ndarray, order: np.ndarray, valid: np.ndarray, length: int
) -> np.ndarray:
    """Valid places whose ``length`` characters equal those of a neighbour in order.

    Equal prefixes stand side by side in a suffix array, so only adjacent suffixes are
    compared.  ``valid`` places have that many characters before any separator.
    """
    places = order[valid[order]]
    a, b = places[:-1], places[1:]
    # A few probes leave the pairs that are worth a whole comparison.
    open_ = np.ones(len(a), bool)
    for probe in (0, length - 1, length // 2, length // 4, 3 * length // 4):
        open_ &= data[a + probe] == data[b + probe]
    pairs = np.flatnonzero(open_)
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    equal = np.zeros(len(pairs), bool)
    for at in range(0, len(pairs), 4096):
        part = pairs[at : at + 4096]
        equal[at : at + 4096] = (windows[a[part]] == windows[b[part]]).all(axis=1)
    both = pairs[equal]
    found = np.zeros(len(data), bool)
    found[a[both]] = True
    found[b[both]] = True
    return found

"""Words of whole texts, parted by ASCII white space, as bytes and as 64-bit numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from ledgerline.llm.common import kept_in_worker

# Distinct words whose numbers a worker keeps, about 60 MB; the table starts anew then.
MOST_WORDS = 300_000


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = made = xxhash.xxh3_64_intdigest(word)
        return made


def texts_of(column) -> list[bytes]:
    """UTF-8 bytes of a column of texts; null counts as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` in order: ``bytes.split`` parts at just those."""
    return text.split()


def numbers_of(words: list[bytes]) -> np.ndarray:
    """One 64-bit number per word, the same everywhere."""
    table = kept_in_worker("word numbers", _Numbers)
    if len(table) > MOST_WORDS:
        table.clear()
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def drop_mask(n: int, firsts, ends) -> np.ndarray:
    """Which of ``n`` places lie in one of the half-open spans ``firsts`` to ``ends``."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, np.asarray(firsts, np.int64), 1)
    np.add.at(edges, np.asarray(ends, np.int64), -1)
    return np.cumsum(edges[:n]) > 0

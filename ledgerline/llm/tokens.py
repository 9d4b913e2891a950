"""Token ids of whole texts, through the tokenizers library.

Byte-level vocabularies without a normalizer split a text at every single space that
stands between two other characters, so the ids of a text are those of its pieces in
turn.  Each distinct piece goes through the library's model once per worker and is
then kept in a bounded table; a text that doesn't split that plainly (runs of white
space, added tokens) is encoded whole.
"""

from __future__ import annotations

import json
import os

import numpy as np
import regex

from ledgerline.llm.common import kept_in_worker

# Pieces kept per worker in each of two tables, some 60 MB each; likewise the words of
# pieces that hold several, which are fewer.
MOST_PIECES = 300_000

# The published split of byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_ENDS = frozenset(",.;:!?")


def default_vocabulary() -> str:
    """The place of the 50k byte-level vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {byte: chr(byte) for byte in shown}
    hidden = (byte for byte in range(256) if byte not in letters)
    letters.update({byte: chr(256 + n) for n, byte in enumerate(hidden)})
    return [letters[byte] for byte in range(256)]


class _Odd(Exception):
    """A piece that is not parted from its neighbours by single spaces."""


class _Kept(dict):
    """What ``make`` gives for each key: the last ``MOST_PIECES`` keys that were new, and
    those before them that have been asked for since."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.before: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        made = self.before.get(key)
        if made is None:
            made = self.make(key)
        if len(self) >= MOST_PIECES:
            self.before = dict(self)
            self.clear()
        self[key] = made
        return made


class Encoder:
    """Ids of texts as packed little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = 1 + max(self.tokenizer.get_vocab().values(), default=-1)
        self.width = 2 if size <= 1 << 16 else 4
        shape = json.loads(self.tokenizer.to_str())
        before = shape["pre_tokenizer"] or {}
        self.plain = (
            before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
            and before.get("use_regex", True)
            and shape["normalizer"] is None
            and shape["model"]["type"] == "BPE"
        )
        self.added = [token["content"] for token in shape["added_tokens"]]
        self.split = regex.compile(SPLIT)
        self.letters = {n: letter for n, letter in enumerate(_byte_letters())}
        self.model = self.tokenizer.model
        self.packed = [n.to_bytes(self.width, "little") for n in range(size)]
        self.ends = {end: self._word(end) for end in PLAIN_ENDS} if self.plain else {}
        self.pieces = _Kept(self._piece)
        self.words = _Kept(self._word)

    def _word(self, word: str) -> bytes:
        """Ids of what the split leaves whole."""
        spelled = word.encode().decode("latin-1").translate(self.letters)
        packed = self.packed
        return b"".join([packed[token.id] for token in self.model.tokenize(spelled)])

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece and the space before it."""
        if piece.isalpha():
            return self._word(" " + piece)
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise _Odd
        end = self.ends.get(piece[-1])
        if end is not None and piece[:-1].isalpha():
            return self.pieces[piece[:-1]] + end
        # One line feed between other characters is a word of its own.
        head, feed, tail = piece.partition("\n")
        if feed and not (head[-1].isspace() or tail[0].isspace()):
            return self.pieces[head] + self.words[feed] + self._line(tail)
        return self._split(" " + piece)

    def _line(self, text: str) -> bytes:
        """Ids of what begins a line, up to its first space."""
        if text.isalpha():
            return self.words[text]
        end = self.ends.get(text[-1])
        if end is not None and text[:-1].isalpha():
            return self.words[text[:-1]] + end
        return self._split(text)

    def _split(self, text: str) -> bytes:
        """Ids of a text's words, each kept as it is or as the piece that it makes up."""
        return b"".join(
            [
                self.pieces[word[1:]]
                if word[0] == " " and word[1:].isalpha()
                else self.words[word]
                for word in self.split.findall(text)
            ]
        )

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, f"<u{self.width}").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.plain or any(token in text for token in self.added):
            return self._whole(text)
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return self._whole(text)
        try:
            return self._split(first) + b"".join(map(self.pieces.__getitem__, rest))
        except _Odd:
            return self._whole(text)


def encoder(path: str) -> Encoder:
    """The encoder that this process keeps for a vocabulary."""
    return kept_in_worker(("encoder", path), lambda: Encoder(path))

"""Encoding by pieces: a text is cut at spaces where the tokenizer cuts
anyway, and each distinct piece is encoded once as long as it is remembered."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """One tokenizer a Python worker, without truncation and padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


# Latin letters, ASCII and the usual white space: here the classes of all
# Unicode versions agree, so a piece can be cut into words as the library does.
_L = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\n\t -~{_L}]*\Z")
_CONTRACTED = "'(?:s|t|re|ve|m|ll|d)"  # fixed value of both vocabularies
_BYTE_LEVEL = re.compile(rf"{_CONTRACTED}| ?[{_L}]+| ?[0-9]+| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")
_LOWER_CASE = re.compile(rf"{_CONTRACTED}|[{_L}]+|[0-9]|[^\s{_L}0-9]+")


def byte_level_words(piece: str) -> list[str] | None:
    """Words of a piece, or None if the library has to find them."""
    letters = piece[1:] if piece[:1] == " " else piece
    if letters.isascii() and letters.isalpha():
        return [piece]
    if not _PLAIN.match(piece) or "<|" in piece:
        return None
    return _BYTE_LEVEL.findall(piece)


def lower_case_words(piece: str) -> list[str] | None:
    """The same for the vocabulary that lower-cases and drops white space."""
    lowered = piece.lower()
    if piece.isascii():  # so is the lowered one
        if piece.isalpha():
            return [lowered]
        if not _PLAIN.match(piece) or "<|" in piece:
            return None
    elif not _PLAIN.match(piece) or "<|" in piece or not _PLAIN.match(lowered):
        return None
    return _LOWER_CASE.findall(lowered)


def _byte_letters() -> list[str]:
    """The public byte-to-letter rule of byte-level vocabularies: printable
    bytes are themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PieceMemo(dict):
    """Piece to what ``convert`` makes of its token ids.

    A piece is cut into words; the library's model encodes each distinct word
    once. Pieces with rare characters are encoded by the library as a whole.
    Beyond the limits only what the current texts need is kept, and pieces
    longer than ``longest`` are kept for them alone; no result changes.
    """

    def __init__(self, tokenizer, words_of: Callable, convert: Callable, combine: Callable, prefix: str = "",
                 limit: int = 300_000, longest: int = 64, words: dict | None = None):
        super().__init__()
        self.tokenizer, self.words_of, self.convert, self.combine = tokenizer, words_of, convert, combine
        self.prefix, self.limit, self.longest, self.long = prefix, limit, longest, []
        self.words = {} if words is None else words
        self.model, self.letters = tokenizer.model, _byte_letters()

    def _word(self, word: str):
        if word.isascii() and word.isalpha():
            letters = word
        elif word[0] == " " and word.isascii() and word[1:].isalpha():
            letters = self.letters[32] + word[1:]
        else:
            letters = "".join([self.letters[b] for b in word.encode()])
        found = self.convert([t.id for t in self.model.tokenize(letters)])
        if len(word) <= self.longest:
            self.words[word] = found
        return found

    def forget(self) -> None:
        """Drop all that is remembered."""
        self.clear()
        self.words.clear()
        self.long = []

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode those pieces that aren't known."""
        for p in self.long:
            self.pop(p, None)
        needed = pieces if isinstance(pieces, set) else set(pieces)
        missing = [p for p in needed if p not in self]
        if len(self) + len(missing) > self.limit:
            kept = {p: self[p] for p in needed if p in self}
            self.clear()
            self.update(kept)
        if len(self.words) > self.limit:
            self.words.clear()
        longest, prefix, words_of, word = self.longest, self.prefix, self.words_of, self._word
        self.long = [p for p in missing if len(p) > longest]
        rare, known = [], self.words.get
        for p in missing:
            cut = words_of(prefix + p)
            if cut is None:
                rare.append(p)
            elif len(cut) == 1:
                cut = cut[0]
                self[p] = known(cut) or word(cut)
            else:
                self[p] = self.combine([known(w) or word(w) for w in cut])
        for i in range(0, len(rare), 2048):
            part = rare[i:i + 2048]
            encoded = self.tokenizer.encode_batch_fast([self.prefix + p for p in part], add_special_tokens=False)
            for p, e in zip(part, encoded):
                self[p] = self.convert(e.ids)


# White space and invisible characters, wider than any library's definition.
_UNSAFE = r"\s\x00-\x20\x7f-\xa0 ᠎ -‏ -  -⁤　﻿"
#: A space before one of these may belong to a longer run of white space.
UNSAFE_AFTER_SPACE = re.compile(f"[{_UNSAFE}]")
_SAFE_CUT = re.compile(rf" (?![{_UNSAFE}]|\Z)")


def safe_pieces(text: str) -> list[str]:
    """Cut a text before each space that surely starts a token of a byte-level
    vocabulary; the space itself is left out."""
    parts = text.split(" ")
    if any([not p or p[0] < "!" or (p[0] > "~" and UNSAFE_AFTER_SPACE.match(p)) for p in parts[1:]]):
        return _SAFE_CUT.split(text)
    return parts

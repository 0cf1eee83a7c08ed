"""Cutting a text into the pieces that a byte-level BPE merges one by one, and remembering their codes.

A worker keeps two bounded caches. The outer one is keyed by the run between two single spaces,
the inner one by the piece the tokenizer's own pattern yields. Most runs repeat, so a text costs
one ``str.split`` and one dictionary lookup for each run; the pattern and the merges run on new
runs and pieces only.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Hashable, Iterable, Iterator, Mapping
from typing import Any

import regex

# A space next to other white space: there the pattern looks across the space.
_MIXED = regex.compile(r" \s|\s ")
_OTHER_SPACE = re.compile("[\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SAFE_SPACE = regex.compile(r"(?<=\S) (?=\S)")

# Bytes of each cache, what an entry takes beside its key and value, and the longest run that is remembered.
CACHE_BYTES = 120 << 20
ENTRY_BYTES = 120
CACHED_LENGTH = 64


def mixed(text: str) -> bool:
    """Whether a space stands next to other white space."""
    if "  " in text or " \n" in text or "\n " in text:
        return True
    return bool(_OTHER_SPACE.search(text) and _MIXED.search(text))


class Recent:
    """Values by key in two generations: when the newer is full the older is forgotten."""

    def __init__(self, entries: int):
        self._half, self._newer, self._older = max(1, entries // 2), {}, {}
        self.get = self._newer.get

    def put(self, key: Hashable, value: Any) -> Any:
        """Remember a value that ``get`` does not give; one that the older generation has is kept."""
        if len(self._newer) >= self._half:
            self._older, self._newer = self._newer, {}
            self.get = self._newer.get
        self._newer[key] = self._older.get(key, value)
        return value


class Cache(dict):
    """Values by key, made on demand and bounded by bytes, in two generations, so that what is in use stays.

    ``known`` are values that are never forgotten.
    """

    def __init__(self, make: Callable[[str], Any], size: int = CACHE_BYTES, known: Mapping[str, Any] | None = None):
        super().__init__(known or {})
        self._make, self._half, self._known = make, size // 2, known or {}
        self._left, self._older = self._half, {}

    def __missing__(self, key: str) -> Any:
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        return self.keep(key, value)

    def recall(self, key: str) -> Any:
        """The value of a key that ``get`` does not give, from the older generation; None if it is not there either."""
        value = self._older.get(key)
        return value if value is None else self.keep(key, value)

    def keep(self, key: str, value: Any) -> Any:
        """Remember a value that is not in the newer generation."""
        if len(key) <= CACHED_LENGTH:
            self._left -= ENTRY_BYTES + len(key) + (33 + len(value) if isinstance(value, bytes) else 0)
            if self._left < 0:
                self._older, self._left = dict(self), self._half
                self.clear()
                self.update(self._known)
            self[key] = value
        return value


def _runs(text: str) -> list[str]:
    """The text without the spaces between its runs; all runs but the first have one before them."""
    # every piece with a space begins with it, so runs behind a space between other signs are independent
    return _SAFE_SPACE.split(text) if mixed(text) else text.split(" ")


class Runs:
    """The codes of all runs of a text, by ``encode`` of one run with the space before it and ``join`` of many codes.

    ``known`` are codes of frequent runs, each taken with the space before it.
    """

    def __init__(self, encode: Callable[[str], Any], join: Callable[[Any], Any], size: int = CACHE_BYTES, known: Mapping[str, Any] | None = None):
        self._encode, self._join = encode, join
        self._runs = Cache(lambda run: encode(" " + run), size, known)

    def code(self, text: str) -> Any:
        """The joined codes of the whole text."""
        first, *runs = _runs(text)
        return self._join((self._encode(first), self._join(map(self._runs.__getitem__, runs))))


# Fixed value: the pattern for which a word of letters, and all marks behind it, are known to be pieces.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_MARKS = string.punctuation


class Pieces(Runs):
    """The codes of all pieces of a text, by ``encode`` of many pieces; pieces of new runs are remembered too."""

    def __init__(self, pattern: str, encode: Callable[[list[str]], list], join: Callable[[Any], Any], size: int = CACHE_BYTES):
        self._plain = pattern == WORD_PATTERN
        for_pieces = size // 4 if self._plain else size  # words are remembered as runs, few pieces are left
        super().__init__(lambda text: self._join(map(self._pieces.__getitem__, self._cut(text))), join, 2 * size - for_pieces)
        self._split = regex.compile(pattern).findall
        self._encode_all = encode
        self._pieces = Cache(lambda piece: encode([piece])[0], for_pieces)

    def _is_word(self, run: str) -> bool:
        """Whether the run, with a space before it, is one piece: letters that no version of Unicode disputes."""
        return self._plain and run.isalpha() and (run.isascii() or max(run) < "\u0250")

    def _cut(self, text: str) -> list[str]:
        word = text.rstrip(_MARKS)
        if word[:1] == " " and self._is_word(word[1:]):
            return [word] if len(word) == len(text) else [word, text[len(word) :]]
        return self._split(text)

    def codes(self, texts: Iterable[str]) -> Iterator:
        """The joined codes of each text; pieces that are new in any of them are encoded in one call."""
        get, whole, new = self._runs.get, [], set()
        for text in texts:
            runs = _runs(text)
            codes = list(map(get, runs))
            codes[0] = self._encode(runs[0])
            gaps = [i for i, code in enumerate(codes) if code is None]
            names = [runs[i] for i in gaps]
            new.update(names)
            whole.append((codes, gaps, names))
        learned = self._learn(new)
        for codes, gaps, names in whole:
            for i, name in zip(gaps, names):
                codes[i] = learned[name]
            yield self._join(codes)

    def _learn(self, runs: Iterable[str]) -> dict[str, Any]:
        """The codes of runs that the newer generation does not have; what is short is remembered.

        A run that is a word is its only piece, so a word at the beginning of another run is looked up as a run.
        """
        learned, cuts, words, fresh = {}, {}, {}, set()
        for run in runs:
            code = self._runs.recall(run)
            if code is not None:
                learned[run] = code
                continue
            word = run.rstrip(_MARKS)
            if self._is_word(word):
                rest = [run[len(word) :]] if len(word) < len(run) else []
            else:
                rest = self._split(" " + run)
                word = rest[0][1:] if rest else ""
                if self._is_word(word):
                    del rest[0]
                else:
                    word = ""
            if word and word not in words:
                words[word] = self._runs.get(word) or self._runs.recall(word)
            if not word or word != run:
                cuts[run] = word, rest
                fresh.update([piece for piece in rest if piece not in self._pieces])
        missing = [piece for piece in fresh if len(piece) <= CACHED_LENGTH and self._pieces.recall(piece) is None]
        unknown = [word for word, code in words.items() if code is None]
        codes = iter(self._encode_all([*missing, *(" " + word for word in unknown)]))
        for piece in missing:
            self._pieces.keep(piece, next(codes))
        for word in unknown:
            words[word] = self._runs.keep(word, next(codes))
        get = self._pieces.__getitem__
        for run, (word, pieces) in cuts.items():
            learned[run] = self._runs.keep(run, self._join((words[word], *map(get, pieces)) if word else map(get, pieces)))
        return words | learned

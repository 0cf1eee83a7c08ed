"""Token ids and counts as the ``tokenizers`` library gives them for a byte-level BPE file.

A worker remembers the codes of the runs between two single spaces, up to a bound in bytes. Most
runs of a text are known, so a text costs one split and a lookup for each run. A new run is
merged by rank by ``tiktoken``, which does the same merges in a third of the time, where the file
is of the plain kind for which the two agree; what else there is goes to the library as it stands.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator, Mapping
from typing import Any

import regex
import tiktoken

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

from tokenizers import Tokenizer  # noqa: E402

from textloom.llm.pieces import CACHE_BYTES, Runs  # noqa: E402
from textloom.llm.worker import held  # noqa: E402

# Signs whose class no version of Unicode disputes; other runs are left to the library.
_CERTAIN = re.compile(r"[\t\n\r -~\u00A1-\u024F]*")

# The same signs where no white space stands next to other white space. There the byte-level pattern does
# without its look-ahead, and so without backtracking, which takes time and fails on a million signs of white
# space. Other texts are cut before the last white space of a stretch: that one goes with what follows.
_SINGLE = re.compile(r"(?:[\t\n\r ]?[!-~\u00A1-\u024F]++)*+[\t\n\r ]?")
_LAST_SPACE = re.compile(r"(?<=[\t\n\r ])(?=[\t\n\r ][^\t\n\r ])")
_SINGLE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

# tiktoken looks for special strings even where none is allowed; without any it would stop at every byte.
_NEVER = "\U0010FFFF"

# White space to the library and to Python alike but for these; a text with them is not cut.
_CONTROLS = regex.compile(r"[\x1C-\x1F]")


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: printable ones for themselves, then from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in set(own)]
    return {**{chr(byte): byte for byte in own}, **{chr(256 + i): byte for i, byte in enumerate(rest)}}


def plain_ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes to rank of a file whose merges are those of its ranks; None for any other kind of file.

    Its pieces are those of the byte-level pattern without a normaliser, every byte is a token,
    each merge makes a token of its own, and ids ascend in the order of merges.
    """
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, cut = whole["model"], whole.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or whole.get("normalizer") or whole.get("truncation") or whole.get("padding"):
        return None
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    if any(model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    signs, vocab = byte_signs(), model["vocab"]
    pairs = [tuple(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
    made = [vocab.get(a + b) for a, b in pairs]
    if None in made or any(x >= y for x, y in zip(made, made[1:])) or any(max(vocab[a], vocab[b]) >= m for (a, b), m in zip(pairs, made)):
        return None
    if {*signs, *(a + b for a, b in pairs)} != set(vocab) - {token["content"] for token in whole["added_tokens"]}:
        return None
    names = (*signs, *(a + b for a, b in pairs))
    return {bytes(map(signs.__getitem__, name)): vocab[name] for name in names}


class HfTokens:
    """One tokenizer file: the ids of texts, or their counts."""

    def __init__(self, path: str, counting: bool, known: Mapping[str, int] | None = None):
        self._library = Tokenizer.from_file(path)
        # strings of added tokens are found by the library before it cuts the text
        added = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self._code: Callable[[list[int]], Any] = len if counting else _packed
        join: Callable[[Any], Any] = sum if counting else b"".join
        ranks = plain_ranks(path)
        special = {_NEVER: max(ranks.values()) + 1} if ranks else {}
        core = tiktoken.Encoding("own", pat_str=_SINGLE_PATTERN, mergeable_ranks=ranks, special_tokens=special)._core_bpe if ranks else None

        def listed(text: str) -> Any:
            return self._code(core.encode_ordinary(text))

        def packed(text: str) -> Any:
            return bytes(core.encode_to_tiktoken_buffer(text, set()))

        merged = packed if not counting and sys.byteorder == "little" else listed

        def encode(text: str) -> Any:
            if core is not None and _SINGLE.fullmatch(text):
                return merged(text)
            if core is not None and _CERTAIN.fullmatch(text):
                return join(map(merged, _LAST_SPACE.split(text)))
            return self._ask(text)

        # ids of a whole text cost less than looking up all its runs; counts are looked up
        self._at_once = encode if merged is packed and core is not None else None
        self._runs = Runs(encode, join, 2 * CACHE_BYTES, known)

    def _ask(self, text: str) -> Any:
        return self._code(self._library.encode(text, add_special_tokens=False).ids)

    def code(self, text: str) -> Any:
        """The code of a text: ids as little-endian unsigned 32-bit integers, or their number."""
        if _CONTROLS.search(text) or self._added and self._added.search(text):
            return self._ask(text)
        if self._at_once is not None and _CERTAIN.fullmatch(text):
            return self._at_once(text)
        return self._runs.code(text)

    def codes(self, texts: list[str]) -> Iterator:
        return map(self.code, texts)


def _packed(ids: list[int]) -> bytes:
    codes = array("I", ids)
    if sys.byteorder == "big":
        codes.byteswap()
    return codes.tobytes()


def hf_tokens(path: str, counting: bool = False, known: Mapping[str, int] | None = None, name: str = "") -> HfTokens:
    """One for each worker process; what it remembers outlives a task. ``name`` tells first tiers apart."""
    return held(("library", path, counting, name), lambda: HfTokens(path, counting, known))

"""Byte-level BPE as a lazily determinised finite-state transducer, and a streaming decoder.

Two tokens may stand side by side if merging their joined bytes gives just these two again. A
byte string has exactly one segmentation in which all neighbours may stand side by side, and it
is the one the merges give. So the merges become a nondeterministic transducer: it walks the
trie of tokens, may step back to the root wherever a token ends that may follow the last one,
and notes that token. Its subset construction is made on demand: a deterministic state holds the
open walks, each with the token before it, and marks the place with the last token of what has
been read. The beginning of a segmentation is the segmentation of that beginning, so the marks
read from the end backwards are the tokens. A walk spans at most the longest token.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from textloom.llm.pieces import CACHE_BYTES, Pieces, Recent
from textloom.llm.worker import held, slices

# Deterministic states a worker keeps; half of them, the older ones, go when there are more.
STATES = 5 << 16

# The token before the first.
NOTHING = -1

# An open walk is one number: its node above these bits, the node of its last token in them (0: none).
NODE_BITS = 32
LAST_NODE = (1 << NODE_BITS) - 1

# Texts of a batch encoded at a time, and what a worker keeps in a stage that also writes whole id arrays:
# states, and bytes of each cache of pieces.
TEXTS_AT_ONCE = 512
LEAN_STATES = STATES // 2
LEAN_CACHE_BYTES = CACHE_BYTES // 2

# Characters of texts whose new pieces are encoded together (one text at least).
CHARS_AT_ONCE = 2 << 20

# Ids decoded at a time.
DECODE_IDS = 1 << 16


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with one base64 string and one rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(data: bytes, ranks: dict[bytes, int], least: int = 1) -> list[int]:
    """The definition: join the neighbours of lowest rank, the leftmost first, until none is left.

    Stops early at ``least`` parts.
    """
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > least:
        found = [(ranks.get(a + b, len(ranks) << 1), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(found)
        if rank > len(ranks):
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[part] for part in parts]


class State(dict):
    """Open walks, each as trie node and node of its last token, the one at the root first, then the later ones first.

    As a dictionary it gives the next state by byte; one that is not there yet is made.
    """

    __slots__ = ("walks", "last", "_made_by")

    def __init__(self, walks: tuple[int, ...], made_by: Transducer):
        self.walks, self.last, self._made_by = walks, walks[0], made_by

    def __missing__(self, byte: int) -> State:
        found = self[byte] = self._made_by._expand(self.walks, byte)
        return found


class Transducer:
    """From bytes to token ids by one table lookup a byte."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self._ranks, self._limit = ranks, states
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._pairs = Recent(2 * states)
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._spines: dict[tuple[int, int], tuple[int, ...] | None] = {}
        self._next: list[dict[int, int]] = [{}]
        self._token: list[int | None] = [NOTHING]
        self._size = [0]
        for token, rank in ranks.items():
            node = 0
            for size, byte in enumerate(token, 1):
                if byte not in self._next[node]:
                    self._next[node][byte] = len(self._next)
                    self._next.append({})
                    self._token.append(None)
                    self._size.append(size)
                node = self._next[node][byte]
            self._token[node] = rank
        self._start = State((0,), self)
        self._states: dict[tuple[int, ...], State] = {}
        self._older: dict[tuple[int, ...], State] = {}

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the last merge; None if the merges do not make it, or from a higher rank."""
        if token not in self._parts:
            parts = merge(self._bytes[token], self._ranks, 2)
            self._parts[token] = (parts[0], parts[1]) if len(parts) == 2 and max(parts) < token else None
        return self._parts[token]

    def _spine(self, token: int, side: int) -> tuple[int, ...] | None:
        """The token, then its part at one end (0 left, 1 right), and so on down to a byte; None as above."""
        key = (token, side)
        if key not in self._spines:
            spine: tuple[int, ...] | None = (token,)
            if len(self._bytes[token]) > 1:
                halves = self._halves(token)
                below = self._spine(halves[side], side) if halves else None
                spine = (token, *below) if below else None
            self._spines[key] = spine
        return self._spines[key]

    def _stays_apart(self, last: int, token: int) -> bool:
        """Whether no merge joins the end of ``last`` with the beginning of ``token``.

        Both grow from bytes at the border, in order of rank. While two parts face each other,
        a merge of both with a lower rank than those that will consume them comes first.
        """
        if last == NOTHING:
            return self._spine(token, 0) is not None or merge(self._bytes[token], self._ranks) == [token]
        left, right = self._spine(last, 1), self._spine(token, 0)
        if left is None or right is None:
            return merge(self._bytes[last] + self._bytes[token], self._ranks) == [last, token]
        i, j, ranks, endless = len(left) - 1, len(right) - 1, self._ranks, len(self._ranks) << 1
        while True:
            joined = ranks.get(self._bytes[left[i]] + self._bytes[right[j]])
            next_left = left[i - 1] if i else endless
            next_right = right[j - 1] if j else endless
            if joined is not None:
                if joined < max(left[i], right[j]):  # a rank below its parts: only the merges can tell
                    return merge(self._bytes[last] + self._bytes[token], ranks) == [last, token]
                if joined < next_left and joined <= next_right:
                    return False
            if not i and not j:
                return True
            if next_left <= next_right:
                i -= 1
            else:
                j -= 1

    def _expand(self, walks: tuple[int, ...], byte: int) -> State:
        nexts, tokens, root, open_walks = self._next, self._token, None, [0]
        for walk in walks:
            child = nexts[walk >> NODE_BITS].get(byte)
            if child is None:
                continue
            last = walk & LAST_NODE
            if root is None and tokens[child] is not None:  # a string has one segmentation
                key = last << NODE_BITS | child
                apart = self._pairs.get(key)
                if apart is None:
                    apart = self._pairs.put(key, self._stays_apart(tokens[last], tokens[child]))
                if apart:
                    root = open_walks[0] = child
            if nexts[child]:
                open_walks.append(child << NODE_BITS | last)
        if root is None:
            raise ValueError(f"byte {byte} cannot be encoded with this vocabulary")
        return self._state(tuple(open_walks))

    def _state(self, walks: tuple[int, ...]) -> State:
        """The state of these walks. When the newer half of the states is full, the older is dropped."""
        found = self._states.get(walks)
        if found is None:
            if len(self._states) >= self._limit // 2:
                gone = {id(old) for walks, old in self._older.items() if walks not in self._states}
                for old in self._older.values():
                    if id(old) in gone:
                        old.clear()
                for kept in (self._start, *self._states.values()):
                    for byte in [byte for byte, state in kept.items() if id(state) in gone]:
                        del kept[byte]
                self._older, self._states = self._states, {}
            found = self._older.get(walks)
            found = self._states[walks] = State(walks, self) if found is None else found
        return found

    def encode(self, data: bytes) -> list[int]:
        """Token ids of the bytes as one piece."""
        state, lasts = self._start, [0]
        for byte in data:
            state = state[byte]
            lasts.append(state.last)
        return self._read_back(lasts)

    def encode_sorted(self, pieces: Iterable[bytes]) -> Iterator[list[int]]:
        """Token ids of each piece; it starts from the state behind what it shares with the one before."""
        before, states, lasts = b"", [self._start], [0]
        for data in pieces:
            shared = 0
            for one, other in zip(before, data):
                if one != other:
                    break
                shared += 1
            del states[shared + 1 :], lasts[shared + 1 :]
            state = states[shared]
            for byte in data[shared:] if shared else data:
                state = state[byte]
                states.append(state)
                lasts.append(state.last)
            before = data
            yield self._read_back(lasts)

    def _read_back(self, lasts: list[int]) -> list[int]:
        """The tokens, from the nodes of the last token up to each place; the one that ends a text tells where the one before it ends."""
        out, end = [], len(lasts) - 1
        while end:
            node = lasts[end]
            out.append(self._token[node])
            end -= self._size[node]
        out.reverse()
        return out


# Bytes that may follow a lead byte, by the first byte they may have, and how many there are.
_LEADS = {
    **{b: (0x80, 0xBF, 1) for b in range(0xC2, 0xE0)},
    **{b: (0x80, 0xBF, 2) for b in range(0xE1, 0xF0)},
    **{b: (0x80, 0xBF, 3) for b in range(0xF1, 0xF4)},
    0xE0: (0xA0, 0xBF, 2),
    0xED: (0x80, 0x9F, 2),
    0xF0: (0x90, 0xBF, 3),
    0xF4: (0x80, 0x8F, 3),
}


class Utf8Machine:
    """UTF-8 byte by byte. State None: between characters; else the range and number of bytes due."""

    @staticmethod
    @lru_cache(maxsize=None)
    def step(state: tuple[int, int, int] | None, byte: int) -> tuple[int, int, int] | None:
        if state is not None and state[0] <= byte <= state[1]:
            return (0x80, 0xBF, state[2] - 1) if state[2] > 1 else None
        return _LEADS.get(byte)  # a lead byte opens a character; any other byte stands alone

    @classmethod
    def open_bytes(cls, data: bytes) -> int:
        """How many bytes at the end begin a character that may still be completed."""
        for size in range(1, min(3, len(data)) + 1):
            state = None
            for i, byte in enumerate(data[-size:]):
                state = cls.step(state, byte)
                if state is None or i and byte >= 0xC0:
                    break
            else:
                return size
        return 0


class TokenBytes:
    """The bytes of all tokens behind each other, to gather those of many ids at once."""

    def __init__(self, token_bytes: dict[int, bytes]):
        self._sizes = np.zeros(max(token_bytes, default=-1) + 1, np.int64)
        for token, data in token_bytes.items():
            self._sizes[token] = len(data)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._flat = np.frombuffer(b"".join(token_bytes[t] for t in sorted(token_bytes)), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        sizes = self._sizes[ids]
        if not sizes.all():
            raise ValueError("an id is outside the vocabulary")
        ends = np.cumsum(sizes)
        shifts = np.repeat(self._starts[ids] - ends + sizes, sizes)
        return self._flat[shifts + np.arange(len(shifts))].tobytes()


class StreamDecoder:
    """Text from token ids as they come; a character cut by a token's end waits for the rest."""

    def __init__(self, tokens: TokenBytes):
        self._tokens, self._open = tokens, b""

    def feed(self, ids: np.ndarray) -> str:
        data = self._open + self._tokens.join(ids)
        cut = len(data) - Utf8Machine.open_bytes(data)
        self._open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self._open = self._open, b""
        return rest.decode("utf-8", "replace")


def _packed(ids: list[int]) -> bytes:
    codes = array("I", ids)
    if sys.byteorder == "big":
        codes.byteswap()
    return codes.tobytes()


class RankTokens:
    """Encoding and decoding by one rank file and one pattern."""

    def __init__(self, path: str, pattern: str, states: int = STATES, cache_bytes: int = CACHE_BYTES):
        self.ranks = load_ranks(path)
        self._bytes = TokenBytes({rank: token for token, rank in self.ranks.items()})
        self.transducer = Transducer(self.ranks, states)
        self._pieces = Pieces(pattern, self._codes, b"".join, cache_bytes)

    def _codes(self, pieces: list[str]) -> list[bytes]:
        data = [piece.encode() for piece in pieces]
        # a piece that is a token is that token, whatever the merges say
        wholes = map(self.ranks.get, data)
        coded = {token: _packed([whole]) for token, whole in zip(data, wholes) if whole is not None}
        others = sorted(token for token in data if token not in coded)
        coded.update(zip(others, map(_packed, self.transducer.encode_sorted(others))))
        return [coded[token] for token in data]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self._pieces.code(text)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text; NULL counts as the empty one. New pieces of some texts are encoded together."""
        some, chars = [], 0
        for text in texts:
            some.append(text or "")
            chars += len(some[-1])
            if chars >= CHARS_AT_ONCE:
                yield from self._pieces.codes(some)
                some, chars = [], 0
        yield from self._pieces.codes(some)

    def decode(self, ids: bytes) -> Iterator[str]:
        numbers = np.frombuffer(ids, dtype="<u4")
        decoder = StreamDecoder(self._bytes)
        for i in range(0, len(numbers), DECODE_IDS):
            yield decoder.feed(numbers[i : i + DECODE_IDS])
        yield decoder.end()


def rank_tokens(path: str, pattern: str, states: int = STATES, cache_bytes: int = CACHE_BYTES) -> RankTokens:
    """One for each worker process; its caches outlive a task."""
    gc.set_threshold(1_000_000, 50, 50)  # walking millions of remembered tuples costs more than it frees
    return held(("ranks", path, pattern, states, cache_bytes), lambda: RankTokens(path, pattern, states, cache_bytes))


def encode_texts(docs: DataFrame, path: str, pattern: str, out: str = "ids", text_col: str = "text") -> DataFrame:
    """Add ``out``, the token ids of the whole text as an array of integers.

    Each match of ``pattern`` is encoded on its own, without special tokens. NULL and the empty
    text give an empty array. Rows keep all their columns, and equal rows stay rows of their own.
    A worker holds the ids of ``TEXTS_AT_ONCE`` texts, and smaller caches than where only digests are made.
    """

    @F.arrow_udf(ArrayType(IntegerType(), False))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = rank_tokens(path, pattern, LEAN_STATES, LEAN_CACHE_BYTES)
        for batch in (part for whole in batches for part in slices(whole, TEXTS_AT_ONCE)):
            coded = list(tokens.encode_all(batch.to_pylist()))
            ends = np.cumsum([0, *(len(ids) // 4 for ids in coded)], dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(coded), dtype="<u4").astype(np.int32)))

    return docs.withColumn(out, encode(F.col(text_col)))


def decode_ids(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """Add ``out``, the text of token ids; bytes that are no UTF-8 become the replacement character.

    NULL ids give NULL, no ids the empty text. An id outside the vocabulary is an error.
    """

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = rank_tokens(path, pattern)
        for batch in batches:
            texts = [None if ids is None else "".join(tokens.decode(np.array(ids, dtype="<u4").tobytes())) for ids in batch.to_pylist()]
            yield pa.array(texts, pa.string())

    return rows.withColumn(out, decode(F.col(ids_col)))


def round_trip_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of encoding a text and decoding its ids.

    Digests are those of the ids as little-endian unsigned 32-bit integers and of the decoded
    bytes. One pass: ids do not leave the worker. NULL counts as the empty text.
    """

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = rank_tokens(path, pattern)
        for batch in batches:
            sizes, of_ids, of_texts = [], [], []
            for ids in tokens.encode_all(batch.to_pylist()):
                decoded = hashlib.sha256()
                for part in tokens.decode(ids):
                    decoded.update(part.encode())
                sizes.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_texts.append(decoded.hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    done = docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("found"))
    return done.select("doc_id", "found.n_tokens", "found.ids_sha256", "found.decoded_sha256")

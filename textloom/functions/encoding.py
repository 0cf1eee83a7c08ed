"""Column functions over token and id arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved ids; vocabulary ids start after them.
PAD_ID = 0
UNK_ID = 1
CLS_ID = 2
SEP_ID = 3
RESERVED_IDS = 4

# Fixed value: sequence length used by the training programs.
MAX_LENGTH = 70

# A run of letters or digits, or one other character that is not a space.
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"

# Most tokens that one prefix pattern takes; its repetition is nested as deep.
PREFIX_TOKENS = 512

# Fixed value: smallest 32-bit float, the bias of a masked key.
MASKED_BIAS = -3.4028234663852886e38


def token_array(text: Column, pattern: str = TOKEN_PATTERN) -> Column:
    """All tokens of a text, lower-cased; NULL text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))


def first_tokens(text: Column, count: int, pattern: str = TOKEN_PATTERN) -> Column:
    """The first ``count`` tokens of a text, as ``token_array`` gives them.

    For the default pattern the text is cut behind its last wanted token first, so a long text
    costs as much as a short one.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    if pattern == TOKEN_PATTERN and 0 < count <= PREFIX_TOKENS:
        one = r"\s*+(?:[\p{L}\p{N}]++|[^\p{L}\p{N}\s])"
        low = F.regexp_extract(low, f"^(?:{one}){{0,{count}}}+", 0)
    return truncate(F.regexp_extract_all(low, F.lit(pattern), F.lit(0)), count)


def content_length(max_length: int, add_special: bool) -> int:
    """How many text tokens fit beside the two markers."""
    room = max_length - 2 if add_special else max_length
    if room < 0:
        raise ValueError(f"max_length {max_length} leaves no room for the markers")
    return room


def truncate(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def add_special_ids(ids: Column, cls_id: int = CLS_ID, sep_id: int = SEP_ID) -> Column:
    return F.concat(F.array(F.lit(cls_id)), ids, F.array(F.lit(sep_id)))


def pad(ids: Column, max_length: int, pad_id: int = PAD_ID) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(max_length) - F.size(ids)))


def attention_mask(length: Column, max_length: int) -> Column:
    """1 for the first ``length`` positions, 0 after; made from the length, not from the ids."""
    return F.concat(F.array_repeat(F.lit(1), length), F.array_repeat(F.lit(0), F.lit(max_length) - length))


def sequence_length(mask: Column) -> Column:
    return F.aggregate(mask, F.lit(0), lambda total, bit: total + bit)


def mask_bias(mask: Column) -> Column:
    """0 where the key may be attended, the smallest 32-bit float where it is masked."""
    return (F.lit(1) - mask) * F.lit(MASKED_BIAS)

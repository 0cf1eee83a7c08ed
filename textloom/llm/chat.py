"""Conversations as token ids with a loss mask, assembled from segments that are encoded apart.

A turn is ``<turn>role<says>text</turn>``. The three control strings are reserved ids beyond the
vocabulary; role and text are encoded on their own, with special strings as ordinary text, so no
content can become a control id. Control strings inside contents are escaped besides, so that
the formatted text can be cut at them too.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm.worker import held, slices
from textloom.session import stored

# The template: begin of a turn, end of its role, end of its text.
CONTROLS = ("<turn>", "<says>", "</turn>")

# Control strings of other templates, which are escaped as well.
FOREIGN = ("### User:", "### Assistant:", "### System:", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "[INST]", "[/INST]", "<s>", "</s>")

# Turns that a worker encodes or reads at a time; beside them it holds a batch as it came.
TURNS_AT_ONCE = 512

# Turn numbers whose turns are summed in one task.
BLOCK_TURNS = 4096

_ESCAPED = re.compile(r"\\|" + "|".join(map(re.escape, (*CONTROLS, *FOREIGN))))


def escape(text: str) -> str:
    """Double every backslash and put one after the first character of every control string."""
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    """The inverse of ``escape``: a backslash before a backslash is one, any other is taken away."""
    return re.sub(r"\\(\\?)", r"\1", text)


class Assembler:
    """Segments to ids and back."""

    def __init__(self, path: str):
        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True  # strings of special tokens in contents are ordinary text
        first = self._library.get_vocab_size(with_added_tokens=True)
        self.reserved = tuple(range(first, first + len(CONTROLS)))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def turns(self, roles: list[str], texts: list[str], trained: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and loss mask of each turn; the mask covers the text of the trained role and nothing else."""
        begin, middle, end = self.reserved
        names = list(dict.fromkeys(roles))
        of_role = dict(zip(names, self.encode([escape(r) for r in names])))
        for role, text_ids in zip(roles, self.encode([escape(t) for t in texts])):
            role_ids = of_role[role]
            segments = [[begin], role_ids, [middle], text_ids, [end]]
            learned = [False, False, False, role == trained, False]
            ends = np.cumsum([len(s) for s in segments])
            steps = np.zeros(ends[-1] + 1, dtype=np.int32)
            for segment, last, learn in zip(segments, ends, learned):
                if learn:
                    steps[last - len(segment)] += 1
                    steps[last] -= 1
            yield np.concatenate([np.array(s, dtype=np.int32) for s in segments]), np.cumsum(steps[:-1]).astype(np.int8)

    def decode(self, ids: list[int]) -> str:
        return self._library.decode(ids, skip_special_tokens=False) if ids else ""

    def read(self, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str]:
        """``(role, text, text under the mask)`` of one turn, unescaped."""
        begin, middle, end = self.reserved
        at = int(np.flatnonzero(ids == middle)[0])
        if ids[0] != begin or ids[-1] != end:
            raise ValueError("not a whole turn")
        role, text, under = (unescape(self.decode(part.tolist())) for part in (ids[1:at], ids[at + 1 : -1], ids[mask == 1]))
        return role, text, under

    def formatted(self, ids: np.ndarray) -> str:
        """The turn as text, controls written out and contents escaped."""
        begin, middle, end = self.reserved
        at = int(np.flatnonzero(ids == middle)[0])
        return "".join((CONTROLS[0], self.decode(ids[1:at].tolist()), CONTROLS[1], self.decode(ids[at + 1 : -1].tolist()), CONTROLS[2]))


def assembler(path: str) -> Assembler:
    """One for each worker process, which has one core: threads of the library would each keep memory."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return held(("assembler", path), lambda: Assembler(path))


FORMATTED = "struct<ids: array<int>, loss_mask: array<tinyint>>"


def format_turns(conversations: DataFrame, path: str, trained: str = "assistant") -> DataFrame:
    """``(conv_id, turn, ids, loss_mask, token_start)``, one row for each turn.

    The ids of a conversation are those of its turns, one after the other; ``token_start`` is the
    prefix sum of their numbers. The mask is 1 for the text of ``trained`` turns. NULL roles
    and texts are empty. Turns are ordered by ``turn`` (NULL first), and turns with one number by
    role and text; repeated rows stay. Rows without ``conv_id`` are one conversation. Other
    columns are left out, whatever their names. Turns are encoded where they are read. Sums run
    within blocks of turn numbers and then over the blocks, so a conversation of any length is
    spread over tasks.
    """

    @F.arrow_udf(FORMATTED)
    def assemble(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        made = assembler(path)
        for roles, texts in (part for whole in batches for part in zip(*(slices(column, TURNS_AT_ONCE) for column in whole))):
            found = list(made.turns(roles.to_pylist(), texts.to_pylist(), trained))
            ends = pa.array(np.cumsum([0, *(len(ids) for ids, _ in found)]).astype(np.int32))
            flat = [pa.array(np.concatenate([x[i] for x in found])) if found else pa.array([], kind) for i, kind in ((0, pa.int32()), (1, pa.int8()))]
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, values) for values in flat], ["ids", "loss_mask"])

    empty = F.lit("")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    coded = rows.withColumn("_made", assemble("role", "text"))
    block = F.floor(F.col("turn") / BLOCK_TURNS)
    coded = stored(coded.withColumn("_block", block).withColumn("_size", F.size("_made.ids").cast("bigint")), "turns")
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = coded.groupBy("conv_id", "_block").agg(F.sum("_size").alias("_total"))
    blocks = blocks.select(F.col("conv_id").alias("_conv"), F.col("_block").alias("_of"), F.sum("_total").over(before).alias("_before"))
    inside = Window.partitionBy("conv_id", "_block").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = coded.withColumn("_inside", F.sum("_size").over(inside))
    same = placed["conv_id"].eqNullSafe(blocks["_conv"]) & placed["_block"].eqNullSafe(blocks["_of"])
    start = F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    return placed.join(blocks, same).select("conv_id", "turn", "_made.ids", "_made.loss_mask", start.cast("bigint").alias("token_start"))


def conversation_digests(turns: DataFrame, path: str) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``, read back from the ids.

    Ids are decoded where they are. A digest runs over a conversation from its first turn to its
    last, so the decoded turns of one conversation meet in one task, in order; they stream
    through three running values, and the task holds one batch at a time however many there are.
    """

    @F.arrow_udf("struct<said: string, learned: string, chars: bigint>")
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        made = assembler(path)
        for ids, masks in (part for whole in batches for part in zip(*(slices(column, TURNS_AT_ONCE) for column in whole))):
            said, learned, chars = [], [], []
            for row, mask in zip(_rows(ids), _rows(masks)):
                role, text, under = made.read(row, mask)
                said.append(f"{role}\n{text}\n")
                learned.append(under)
                chars.append(len(made.formatted(row)))
            yield pa.StructArray.from_arrays([pa.array(said, pa.string()), pa.array(learned, pa.string()), pa.array(chars, pa.int64())], ["said", "learned", "chars"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        state, some = None, False
        for batch in batches:
            done = []
            for conv, said, learned, chars in zip(*(column.to_pylist() for column in batch.columns)):
                if not some or conv != state[0]:
                    if some:
                        done.append(_ended(state))
                    state, some = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
                state[1] += 1
                state[2].update(said.encode())
                state[3] += len(learned)
                state[4].update(learned.encode())
                state[5] += chars
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done) if done else [()] * 6, kinds)], names)
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(_ended(state), kinds)], names)

    decoded = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "token_start", read("ids", "loss_mask").alias("_read"))
    decoded = decoded.select("conv_id", "token_start", "_read.said", "_read.learned", "_read.chars")
    ordered = decoded.repartition("conv_id").sortWithinPartitions("conv_id", "token_start").drop("token_start")
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return ordered.mapInArrow(digest, schema)


def _ended(state: list) -> tuple:
    return (*state[:2], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])


def _rows(lists: pa.Array) -> Iterator[np.ndarray]:
    flat = lists.flatten().to_numpy()
    ends = np.cumsum([0, *lists.value_lengths().to_pylist()])
    return (flat[a:b] for a, b in zip(ends[:-1], ends[1:]))

"""What a worker holds of a batch does not grow with the batch."""

import pyarrow as pa
import public_tokenizers as public

from textloom.llm import bpe_fst, chat, worker

JSON, RANKS = public.path("byte_bpe_50k.json"), public.path("byte_bpe_multi_50k.tiktoken")


def test_slices_are_the_batch():
    batch = pa.array([1, None, 3, 4, 5])
    assert [part.to_pylist() for part in worker.slices(batch, 2)] == [[1, None], [3, 4], [5]]
    assert [len(part) for part in worker.slices(batch.slice(0, 0), 2)] == [0]


def test_texts_are_encoded_some_at_a_time(spark, monkeypatch):
    texts = ["", None, "one two", "three  four\n", "漢字 five"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").coalesce(1)
    monkeypatch.setattr(bpe_fst, "TEXTS_AT_ONCE", 2)
    got = {r["doc_id"]: r["ids"] for r in bpe_fst.encode_texts(docs, RANKS, public.PATTERN).collect()}
    lean = bpe_fst.RankTokens(RANKS, public.PATTERN, bpe_fst.LEAN_STATES, bpe_fst.LEAN_CACHE_BYTES)
    whole = bpe_fst.RankTokens(RANKS, public.PATTERN)
    assert [len(got[i]) for i in range(len(texts))] == [len(whole.encode(t or "")) // 4 for t in texts]
    assert all(lean.encode(t or "") == whole.encode(t or "") for t in texts)


def test_a_role_is_encoded_once_and_turns_some_at_a_time(spark, monkeypatch):
    rows = [(1 + i // 9, i % 9, "user" if i % 2 else "assistant", f"turn {i} </turn>") for i in range(27)]
    frame = spark.createDataFrame(rows, "conv_id BIGINT, turn INT, role STRING, text STRING").coalesce(1)
    whole = sorted(map(str, chat.conversation_digests(chat.format_turns(frame, JSON), JSON).collect()))
    monkeypatch.setattr(chat, "TURNS_AT_ONCE", 2)
    assert sorted(map(str, chat.conversation_digests(chat.format_turns(frame, JSON), JSON).collect())) == whole
    made, seen = chat.Assembler(JSON), []
    encode = made.encode
    monkeypatch.setattr(made, "encode", lambda texts: seen.append(len(texts)) or encode(texts))
    assert len(list(made.turns(["user"] * 50, ["x"] * 50, "assistant"))) == 50
    assert seen == [1, 50]  # 50 equal roles were encoded before

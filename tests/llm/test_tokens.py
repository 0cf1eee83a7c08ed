"""Counting, ORC output and byte-level BPE against the libraries."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import bpe_fst, hf_tokens, pieces, token_counts, token_orc

JSON, RANKS = public.path("byte_bpe_50k.json"), public.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = Tokenizer.from_file(JSON)
TOKENS, COUNTS = hf_tokens.HfTokens(JSON, counting=False), hf_tokens.HfTokens(JSON, counting=True)
ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
FORGETFUL = bpe_fst.RankTokens(RANKS, public.PATTERN, states=50, cache_bytes=1500)

texts = st.one_of(st.text(max_size=40), st.text(alphabet="abe t'sl \n\t0.é漢\u00a0\x1c<|endoftx>", max_size=60))


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def numbers(data):
    return np.frombuffer(data, dtype="<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(text=texts)
def test_ids_and_counts_are_the_librarys(text):
    ids = library_ids(text)
    assert numbers(TOKENS.code(text)) == ids and isinstance(TOKENS.code(text), bytes)
    assert COUNTS.code(text) == len(ids)


@settings(max_examples=300, deadline=None)
@given(text=texts)
def test_transducer_gives_the_librarys_ids_and_back(text):
    tokens = bpe_fst.rank_tokens(RANKS, public.PATTERN)
    ids = tokens.encode(text)
    assert numbers(ids) == TIKTOKEN.encode_ordinary(text)
    assert "".join(tokens.decode(ids)) == text


@settings(max_examples=200, deadline=None)
@given(data=st.binary(min_size=1, max_size=24))
def test_transducer_is_the_merges_on_any_bytes(data):
    assert bpe_fst.rank_tokens(RANKS, public.PATTERN).transducer.encode(data) == bpe_fst.merge(data, ranks)


def test_transducer_that_forgets_its_states(documents):
    small = bpe_fst.Transducer(ranks, states=50)
    for row in documents.select("text").limit(3).collect():
        for word in row["text"].split()[:200]:
            assert small.encode(word.encode()) == bpe_fst.merge(word.encode(), ranks)


def test_pieces_in_order_start_where_they_part_from_the_one_before(documents):
    words = {word.encode() for row in documents.select("text").limit(3).collect() for word in row["text"].split()[:200]}
    for machine in (bpe_fst.Transducer(ranks), bpe_fst.Transducer(ranks, states=50)):
        read = []
        step = machine._expand
        machine._expand = lambda walks, byte: read.append(byte) or step(walks, byte)
        pieces_in_order = [b"", *sorted(words), b"same", b"same"]
        assert list(machine.encode_sorted(pieces_in_order)) == [bpe_fst.merge(piece, ranks) if piece else [] for piece in pieces_in_order]
        assert 0 < len(read) < sum(map(len, words))  # shared beginnings are not read again


@settings(max_examples=200, deadline=None)
@given(some=st.lists(st.one_of(texts, st.none()), max_size=6))
def test_texts_encoded_together_have_the_librarys_ids(some):
    for tokens in (bpe_fst.rank_tokens(RANKS, public.PATTERN), FORGETFUL):
        assert [numbers(ids) for ids in tokens.encode_all(some)] == [TIKTOKEN.encode_ordinary(text or "") for text in some]


def test_a_new_piece_of_some_texts_is_encoded_once(monkeypatch):
    tokens, asked = bpe_fst.RankTokens(RANKS, public.PATTERN), []
    codes = tokens._pieces._encode_all
    monkeypatch.setattr(tokens._pieces, "_encode_all", lambda fresh: asked.append(fresh) or codes(fresh))
    some = ["a wxyzzy, wxyzzy&&& don's", "b wxyzzy wxyzzy.\nqwvx", "c (wxyzzy_ wxyzzy' 12 " + "y" * 90] * 2
    assert [numbers(ids) for ids in tokens.encode_all(some)] == [TIKTOKEN.encode_ordinary(text) for text in some]
    assert len(asked) == 1 and len(asked[0]) == len(set(asked[0])) and asked[0].count(" wxyzzy") == 1
    assert [len(ids) for ids in tokens.encode_all(some)] and asked[1:] == [[" " + "y" * 90]]  # too long to remember


@pytest.mark.parametrize("data", ["né漢🎉".encode(), b"a\xff\xc3", b"\xe6\xbc", b"\xf0\x9f\x8e", b"\xed\xa0\x80x", b"\xc3\xc3\xa9"])
def test_streaming_decoder_equals_decoding_at_once(data):
    single = bpe_fst.TokenBytes({i: bytes([i]) for i in range(256)})
    for size in (1, 2, 3, 100):
        decoder = bpe_fst.StreamDecoder(single)
        parts = [decoder.feed(np.frombuffer(data[i : i + size], np.uint8).astype(np.int64)) for i in range(0, len(data), size)]
        assert "".join(parts) + decoder.end() == data.decode("utf-8", "replace")


def test_counts_of_edge_cases(edge_docs, no_docs):
    rows = token_counts.count_tokens(edge_docs, JSON, limit=1024, table_size=3).collect()
    texts_by_id = sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in edge_docs.collect())
    want = sorted((n, i or 0, len(t.encode()), len(library_ids(t))) for n, i, t in texts_by_id)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows)
    assert token_counts.count_tokens(no_docs, JSON).count() == 0


def test_counts_of_documents(documents):
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(documents, JSON).collect()}
    assert got == {r["doc_id"]: len(library_ids(r["text"])) for r in documents.collect()}


def test_frequent_runs_are_counted(spark):
    docs = spark.createDataFrame([("x a b a c",), ("y a b c",), (None,)], "text string").coalesce(1)
    assert token_counts.frequent_runs(docs, size=2) == ["a", "b"]
    assert token_counts.frequent_runs(docs.limit(0)) == []


def test_frequent_runs_are_those_of_whole_texts_and_of_all_texts(spark):
    """Behind the first 2,000 texts, behind the first 8,000 signs of one, at the end of one, and in one partition only."""
    rows = ["first early early"] * 5 + [f"number{i}" for i in range(2_100)] + [None, ""]
    rows += ["x" + " padding" * 1_200 + " deep" * 30] + ["the last"] * 9 + ["x late" + " latest" * 3] * 20 + ["y " + "z" * 65] * 50 + ["once only"]
    seen = Counter(run for text in rows for run in (text or "").split(" ")[1:])
    want = [run for run, n in seen.most_common() if n > 1 and len(run) <= 64]
    assert want == ["padding", "latest", "deep", "late", "early", "last"]
    docs = spark.createDataFrame([(text,) for text in rows], "text string")
    for parts in (docs.coalesce(1), docs, docs.repartitionByRange(5, "text")):
        assert token_counts.frequent_runs(parts) == want
        assert token_counts.frequent_runs(parts, size=3) == want[:3]


def test_frequent_runs_of_documents_are_the_most_frequent(documents):
    seen = Counter(run for row in documents.select("text").collect() for run in row["text"].split(" ")[1:] if len(run) <= 64)
    found = token_counts.frequent_runs(documents.repartition(4), size=1_000)
    assert len(set(found)) == 1_000 and [seen[run] for run in found] == [n for _, n in seen.most_common(1_000)]


def test_runs_are_counted_in_bounded_parts(monkeypatch):
    monkeypatch.setattr(token_counts, "PART_SIGNS", 20)
    some = ["a b c b", None, "x" * 40 + " b", "a c", "d " + "e" * 65 + " c"]
    parts = list(token_counts._counts([pa.record_batch([pa.array(some[:2], pa.string())], ["text"]), pa.record_batch([pa.array(some[2:])], ["text"])]))
    assert parts == [{"b": 3, "c": 1}, {"c": 2}, {}]


def test_runs_that_moved_to_another_partition_are_found(spark):
    docs = spark.createDataFrame([("x one",), ("x two",)], "text string").repartitionByRange(2, "text")
    one, two = token_counts._digests(["one", "two"]).tolist()
    assert token_counts._names(docs, {one: 1, two: 0}) == {}
    assert token_counts._names(docs, {one: None, two: None}) == {one: "one", two: "two"}


def test_the_first_tier_never_changes_a_count(documents):
    counts = [sorted(token_counts.count_tokens(documents, JSON, table_size=n).collect()) for n in (1, 16_384)]
    assert counts[0] == counts[1]


def test_merges_by_rank_are_the_librarys():
    """Whole files of the plain kind only; there, any letters give the library's ids."""
    assert len(hf_tokens.plain_ranks(JSON)) == 50_256 and hf_tokens.plain_ranks(public.path("word_bpe_49k.json")) is None
    rng = random.Random(4)
    alphabets = ["ab", "aeinorst", "abcdefghijklmnopqrstuvwxyz", "éèüñß", "".join(map(chr, range(33, 127))), "".join(map(chr, range(0xA1, 0x250)))]
    words = [" " * rng.randint(0, 1) + "".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 24))) for _ in range(30_000)]
    for word, found in zip(words, LIBRARY.encode_batch(words, add_special_tokens=False)):
        assert numbers(TOKENS.code(word)) == found.ids, word


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="a'st \n\t\r0.é", max_size=40))
def test_white_space_in_any_order_is_the_librarys(text):
    assert numbers(TOKENS.code(text)) == library_ids(text) and COUNTS.code(text) == len(library_ids(text))


@pytest.mark.parametrize("space", [" ", "\n", "\r\n"])
def test_white_space_of_any_length_needs_no_backtracking(space):
    text = "it's" + space * 1_100_000 + "b"
    ids = library_ids(text)
    assert numbers(TOKENS.code(text)) == ids and COUNTS.code(text) == len(ids)


def test_the_pattern_has_no_look_around_and_no_byte_is_searched_for_nothing(monkeypatch):
    """Either took about a third of the time of encoding; an empty set of special strings is found at every byte."""
    made, encoding = [], tiktoken.Encoding
    monkeypatch.setattr(tiktoken, "Encoding", lambda *a, **how: made.append(how) or encoding(*a, **how))
    tokens = hf_tokens.HfTokens(JSON, counting=False)
    assert len(made) == 1 and "(?" not in made[0]["pat_str"]
    (special,) = made[0]["special_tokens"]
    text = f"one {special} two"
    assert special and numbers(tokens.code(text)) == library_ids(text)


def test_files_of_other_kinds_are_the_librarys():
    path = public.path("word_bpe_49k.json")
    library, tokens = Tokenizer.from_file(path), hf_tokens.HfTokens(path, counting=False)
    words = ["one", " one", "Two words"]
    assert [numbers(tokens._ask(w)) for w in words] == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_caches_are_bounded_by_bytes():
    cache = pieces.Cache(lambda key: key.encode() * 2, size=20_000, known={"k": b"known"})
    for i in range(1000):
        assert cache[f"w{i}"] == f"w{i}w{i}".encode() and cache["k"] == b"known"
    assert len(cache) + len(cache._older) < 20_000 // 120 + 3
    recent = pieces.Recent(10)
    for i in range(100):
        recent.put(i, str(i))
    assert recent.get(99) == "99" and recent.get(1) is None


def test_stretches_with_other_white_space_are_cut_too():
    text = "one two  three\nfour \n five\tsix seven"
    asked = []
    runs = pieces.Runs(lambda run: asked.append(run) or run, "".join)
    assert runs.code(text) == text
    assert asked == ["one", " two  three\nfour \n five\tsix", " seven"]


def test_orc_of_edge_cases(spark, edge_docs, no_docs, tmp_path):
    token_orc.write_token_orc(edge_docs, str(tmp_path / "a"), JSON)
    rows = token_orc.read_token_orc(spark, str(tmp_path / "a")).withColumn("crc", token_orc.ids_crc32("ids")).collect()
    by_id = {}
    for r in edge_docs.collect():
        by_id.setdefault(r["doc_id"], []).append([*library_ids(r["text"]), 0])
    rows.sort(key=lambda r: r["start"])
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k)) and len(rows) == edge_docs.count()
    start = 0
    for r in rows:
        assert r["ids"] in by_id[r["doc_id"]] and r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["crc"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        start += r["n_tokens"]
    token_orc.write_token_orc(no_docs, str(tmp_path / "b"), JSON)
    assert token_orc.read_token_orc(spark, str(tmp_path / "b")).count() == 0


def test_orc_lookup_reads_by_index(spark, documents, tmp_path):
    path = str(tmp_path / "orc")
    token_orc.write_token_orc(documents, path, JSON)
    found = token_orc.lookup_tokens(spark, path, [7, 11])
    assert sorted(r["doc_id"] for r in found.collect()) == [7, 11]
    assert "PushedFilters: [In(doc_id, [" in found._jdf.queryExecution().executedPlan().toString()
    files = [f for f in (tmp_path / "orc").iterdir() if f.suffix == ".orc"]
    assert files and all(b"ORC" in f.read_bytes()[-20:] for f in files)


def test_digests_of_edge_cases(edge_docs, no_docs):
    rows = bpe_fst.round_trip_digests(edge_docs, RANKS, public.PATTERN).collect()
    want = []
    for r in edge_docs.collect():
        text = r["text"] or ""
        ids = np.array(TIKTOKEN.encode_ordinary(text), dtype="<u4")
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == sorted(want)
    assert bpe_fst.round_trip_digests(no_docs, RANKS, public.PATTERN).count() == 0


def test_encoded_columns_and_back(edge_docs):
    coded = bpe_fst.encode_texts(edge_docs.drop("ids"), RANKS, public.PATTERN)
    assert coded.columns == ["doc_id", "text", "lang", "score", "found", "ids"]
    back = bpe_fst.decode_ids(coded, RANKS, public.PATTERN, out="again")
    assert back.where(~F.col("again").eqNullSafe(F.coalesce("text", F.lit("")))).count() == 0

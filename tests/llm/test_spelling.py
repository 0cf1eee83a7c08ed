"""Words one letter apart beside all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from textloom.llm import spelling
from textloom.llm.spelling import count_words, group_spellings, near_words, spelling_report


def plain_words(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def rows_of(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(8)
    words = {"".join(rng.choice("abcéÿ") for _ in range(rng.choice([1, 4, 5, 5, 6, 6, 7]))) for _ in range(500)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "abababab", "ababababab", "a" * 3000, "a" * 2999, "a" * 2998 + "bc", "×÷×÷×"}
    return {w: rng.choice([3, 4, 5, 9, 12, 40, 300]) for w in words}


@pytest.mark.parametrize("cells", [spelling.PASS_CELLS, 64])
def test_groups_beside_all_pairs(spark, vocabulary, cells):
    table = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    assert rows_of(group_spellings(table, pass_cells=cells)) == plain_groups(vocabulary)


def test_pairs_come_once(spark, vocabulary):
    table = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    pairs = [frozenset((r["word"], r["near"])) for r in near_words(table).collect()]
    assert len(pairs) == len(set(pairs)) and all(len(p) == 2 for p in pairs)


def test_report_on_documents(spark, documents):
    counts = plain_words([(r["doc_id"], r["text"]) for r in documents.collect()])
    lengths = Counter(map(len, counts))
    assert len(counts) > 1000 and len(lengths) > 8
    assert {(r["word"], r["n"]) for r in count_words(documents).collect()} == set(counts.items())
    assert rows_of(spelling_report(documents)) == plain_groups(counts)


def test_counts_in_small_pieces(spark, documents, monkeypatch):
    counts = {(r["word"], r["n"]) for r in count_words(documents).collect()}
    monkeypatch.setattr(spelling, "TASK_WORDS", 100)
    assert {(r["word"], r["n"]) for r in count_words(documents).collect()} == counts


def test_edges(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    rows += [(None, "Größe größe GRÖßE "), (3, "×÷×÷× " * 4), (3, "letter Letter LETTER lettre")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS near")
    assert rows_of(spelling_report(table)) == plain_groups(plain_words(rows))
    assert spelling_report(no_docs).collect() == []
    assert spelling_report(no_docs).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_repeated_and_missing_words(spark):
    table = spark.createDataFrame([("abcde", 2), ("abcde", 4), (None, 3), ("abcdx", 3), ("", 9), ("other", None)], "word string, n bigint")
    assert rows_of(group_spellings(table)) == plain_groups({"abcde": 6, "abcdx": 3})

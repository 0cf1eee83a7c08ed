"""Codes of vector parts beside a plain search of all entries."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textloom.llm.vector_codes import Codebook, compress_vectors, compression_report

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error bigint, _ints array<int>"


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_search_finds_the_first_nearest_entry(data):
    width, spread = data.draw(st.integers(0, 5)), data.draw(st.sampled_from([1, 3, 1000]))
    rows = st.lists(st.lists(st.integers(-spread, spread), min_size=width, max_size=width), min_size=1, max_size=20)
    drawn = [data.draw(rows) for _ in range(2)]
    entries, x = (np.array(own, dtype=np.int64).reshape(len(own), width) for own in drawn)
    number, distance = Codebook(entries).nearest(x)
    all_distances = ((x[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert number.tolist() == all_distances.argmin(axis=1).tolist()
    assert distance.tolist() == all_distances.min(axis=1).tolist()


def plain(vectors, parts, entries, rounds):
    """Codes and errors of ``(id, integers)`` rows with whole parts, in Python integers."""
    width = len(vectors[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in vectors]
    first = sorted(range(len(vectors)), key=lambda i: (vectors[i][0] is None, vectors[i][0] or 0, vectors[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def near(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), i) for i, entry in enumerate(books[p]))

    for _ in range(rounds):
        chosen = [[near(row[p], p)[1] for p in range(parts)] for row in cut]
        for p in range(parts):
            for i in range(len(books[p])):
                own = [row[p] for row, c in zip(cut, chosen) if c[p] == i]
                if own:
                    books[p][i] = [sum(column) // len(own) for column in zip(*own)]
    found = [[near(row[p], p) for p in range(parts)] for row in cut]
    return ["".join(f"{i:02x}" for _, i in row) for row in found], [sum(d for d, _ in row) for row in found]


def test_codes_beside_python_integers(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(size=(60, 8)), 1).astype(np.float32).tolist()
    rows = [(i % 50, v, None if i % 7 == 0 else i % 3, "x", -1, [1]) for i, v in enumerate([*values, values[0], values[0]])]
    got = compression_report_rows(spark, rows, parts=4, entries=6)
    ints = [(r[0], [int(np.floor(256 * float(x))) for x in r[1]]) for r in rows]
    codes, errors = plain(ints, 4, 6, 2)
    by_label = {}
    for r, error in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + error
    want = sorted((r[0], c, e, by_label[r[2]]) for r, c, e in zip(rows, codes, errors))
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == want
    assert len({r["codebooks_sha256"] for r in got}) == 1


def compression_report_rows(spark, rows, **settings):
    from textloom.llm import vector_codes

    coded, digests = compress_vectors(spark.createDataFrame(rows, SCHEMA), **settings)
    (digest,) = set(digests.values())
    return [{**r.asDict(), "codebooks_sha256": digest} for r in vector_codes.with_label_errors(coded).collect()]


def test_unusable_vectors_go_and_each_length_is_its_own(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0),
        (2, [1.0, None] + [0.0] * 14, 0),
        (3, [nan] * 16, 0),
        (4, [inf] + [0.0] * 15, 0),
        (5, [0.0] * 16, 0),
        (6, [-0.001] * 16, None),
        (7, [1.0, 2.0, 3.0], 1),
        (8, [], None),
        (None, [0.5] * 16, None),
        (5, [0.0] * 16, 0),
    ]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = compression_report(table).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"]) for r in got if r["vec_id"] is not None) == [(False, i) for i in (5, 5, 6, 7, 8)]
    assert len(got) == 6 and len({r["codebooks_sha256"] for r in got}) == 3
    assert all(r["error"] == 0 and r["label_error"] == 0 for r in got)
    assert {r["code"] for r in got if r["vec_id"] in (7, 8)} == {"00" * 16}


def test_no_vectors(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert compression_report(table).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert compression_report(table).count() == 0


def test_too_large_components_are_an_error(spark):
    table = spark.createDataFrame([(1, [1e30] * 16, 0)], "vec_id bigint, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large for codes"):
        compress_vectors(table)

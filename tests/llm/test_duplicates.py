"""Near duplicates of texts and vectors against all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textloom.llm import pq_dedup, simhash
from textloom.llm.components import connected_components, lowest_reachable


def lowest(count, links):
    label = list(range(count))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


def plain_fingerprint(text, shingle=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ")
    words = [w for w in words.replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(edge_docs, documents):
    rows = simhash.fingerprints(documents.limit(60).select("text").union(edge_docs.select("text"))).collect()
    assert all(r["fingerprint"] & (2**64 - 1) == plain_fingerprint(r["text"]) for r in rows)


def test_hash_is_sparks(spark):
    row = spark.createDataFrame([("größe x",)], "t string").select(F.xxhash64("t").alias("h")).first()
    assert row["h"] & (2**64 - 1) == xxhash.xxh64_intdigest("größe x".encode(), simhash.SEED)


@pytest.mark.parametrize("subtree, agree", [(1 << 20, 1), (1 << 20, 2), (6, 1)])
def test_links_connect_what_all_pairs_connect(spark, subtree, agree):
    draws = np.random.default_rng(3)
    values = set()
    for base in draws.integers(0, 2**63, 12, dtype=np.uint64).tolist():
        for _ in range(draws.integers(1, 25)):
            value = base
            for bit in draws.integers(0, 64, draws.integers(0, 7)).tolist():
                value ^= 1 << bit
            values.add(value)
    values = sorted(values)
    links = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    signed = [v - 2**64 if v >> 63 else v for v in values]
    rows = spark.createDataFrame([(v,) for v in signed] + [(signed[0],), (None,)], "f bigint")
    found = simhash.hamming_links(rows, "f", 4, subtree=subtree, agree=agree)
    named = {r["node"]: r["component"] for r in connected_components(found, "a", "b").collect()}
    want = lowest(len(values), links)
    got = [named.get(v, v) for v in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_dense_group_is_not_all_pairs(spark):
    values = sorted({(1 << a) | (1 << b) for a in range(64) for b in range(64)})
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    links = simhash.hamming_links(spark.createDataFrame(signed, "f bigint"), "f", 4)
    assert links.count() <= 5 * len(values)
    assert connected_components(links, "a", "b").agg(F.countDistinct("component")).first()[0] == 1


def test_groups_of_documents(documents):
    rows = sorted(simhash.near_duplicates(documents).collect(), key=lambda r: r["doc_id"])
    prints = [plain_fingerprint(r["text"]) for r in sorted(documents.collect(), key=lambda r: r["doc_id"])]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    ids = [r["doc_id"] for r in rows]
    assert [r["component_id"] for r in rows] == [ids[i] for i in lowest(len(ids), links)]
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(documents).collect()}
    assert kept == {r["component_id"] for r in rows}


def test_edge_cases_of_groups(edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    empty = {r["component_id"] for r in rows if r["fingerprint"] == 0}
    assert empty == {0}
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    kept = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(kept) == len(set(kept)) == len({r["cluster"] for r in rows})
    assert (None, "no id") in kept and (4, "word") in kept and (4, "another text of one id") in kept
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.drop_near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("limit", [200_000, 0])
def test_which_row_of_a_group_stays(spark, limit):
    """Ties go by all columns with an order; names that clash stay; large tables are joined."""
    text, other = "one two three four five six", "seven eight nine ten eleven"
    rows = [(2, text, "b", {"k": 1}), (2, text, "a", {"k": 2}), (2, text, None, None), (3, text, "a", None), (4, other, "z", None), (4, other, "z", None), (None, other, "a", None), (7, "a b c d e f g", "q", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, text_hash string, `_text_hash` map<string, int>")
    kept = simhash.drop_near_duplicates(docs, limit=limit)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(2, text, None, None), (4, other, "z", None), (7, "a b c d e f g", "q", None)]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_lowest_of_components(spark, limit):
    rows = [(i, i % 3 if i % 2 else None, 100 - i) for i in range(40)]
    table = spark.createDataFrame(rows, "key bigint, component bigint, low bigint")
    got = {r["key"]: r["least"] for r in lowest_reachable(table, "component", "low", "key", "least", limit).collect()}
    assert got == {k: low if c is None else min(x for _, d, x in rows if d == c) for k, c, low in rows}


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(7, 7), (None, 3)]
    rows = connected_components(spark.createDataFrame(chain, "a bigint, b bigint"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in rows} == {**{i: 100 for i in range(100, 161)}, 5: 5, **{i: 5 for i in range(200, 260)}}


def test_nearest_centre_in_steps():
    draws = np.random.default_rng(9)
    x, centres = draws.normal(size=(100, 3)), draws.normal(size=(7, 3))
    assert (pq_dedup._nearest(x, centres, cells=20) == pq_dedup._nearest(x, centres)).all()


def brute(vectors, threshold=0.9):
    units = [v / np.sqrt((v * v).sum()) for v in vectors]
    return [(i, j) for i in range(len(units)) for j in range(i) if units[i] @ units[j] >= threshold]


@pytest.mark.parametrize("block", [4096, 7])
def test_vectors_against_all_pairs(spark, block):
    draws = np.random.default_rng(5)
    base = draws.normal(size=(150, 16))
    near = base[draws.integers(0, 150, 150)] + draws.normal(size=(150, 16)) * 0.25
    vectors = np.concatenate((base, near, base[:20], base[:3])).astype(np.float32)
    rows = spark.createDataFrame([(i, [float(x) for x in v], "x") for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>, component_id string")
    got = {r["vec_id"]: r for r in pq_dedup.near_duplicate_vectors(rows, block=block).collect()}
    links = brute(vectors.astype(np.float64))
    degree = np.bincount(np.array(links).ravel(), minlength=len(vectors))
    assert [got[i]["n_links"] for i in range(len(vectors))] == degree.tolist()
    assert [got[i]["component_id"] for i in range(len(vectors))] == lowest(len(vectors), links)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


@pytest.mark.parametrize("rank", [3, 4])
def test_no_link_is_lost_on_low_rank(spark, rank):
    draws = np.random.default_rng(rank)
    vectors = draws.normal(size=(1500, rank)) @ draws.normal(size=(rank, 64))
    units = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    degree = (units @ units.T >= 0.9).sum(axis=1) - 1
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in pq_dedup.near_duplicate_vectors(rows).collect()}
    assert [got[i] for i in range(len(vectors))] == degree.tolist()


def test_vectors_of_each_length_are_a_group(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.1, 0.0]), (5, [0.0, 1.0, 0.0]), (6, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted(tuple(r) for r in pq_dedup.near_duplicate_vectors(frame).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False), (5, 0, 5, True), (6, 0, 6, True)]
    only = {r["vec_id"]: r["n_links"] for r in pq_dedup.near_duplicate_vectors(frame, dims=2).collect()}
    assert only == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0}


def test_vectors_that_cannot_be_compared(spark):
    bad = [None, [], [0.0, 0.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 2.0, 3.0]]
    good = [[1.0, 0.0], [2.0, 0.0], [0.0, 1e-30], [1.0, 0.0], [1e30, 1.0], [-1.0, 0.0]]
    rows = [(i, v) for i, v in enumerate(bad + good)] + [(None, [1.0, 0.0])]
    got = {r["vec_id"]: r for r in pq_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(len(bad)))
    assert [got[i]["n_links"] for i in range(7, 13)] == [4, 4, 0, 4, 4, 0]
    assert [got[i]["component_id"] for i in range(7, 13)] == [7, 7, 9, 7, 7, 12]
    assert got[None]["component_id"] == 7 and not got[None]["kept"]
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert pq_dedup.near_duplicate_vectors(none).count() == 0
    only = spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in pq_dedup.near_duplicate_vectors(only).collect()] == [(1, 0, 1, True)]

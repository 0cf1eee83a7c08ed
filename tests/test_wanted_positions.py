"""Only the positions that are asked for are pooled, with all keys in their reach."""

import numpy as np
import pytest

from textloom.operators import neighbours, vectors


@pytest.mark.parametrize("how", [{"w": 2, "block": 3}, {"block": 3}, {"max_len": 50}])
def test_wanted_positions_are_those_of_the_whole(spark, how):
    x = np.random.default_rng(4).normal(size=(40, 2))
    rows = [(i // 20, i % 20, x[i].tolist(), int(i % 4 > 0)) for i in range(40)]
    frame = spark.createDataFrame(rows, "g INT, pos BIGINT, vector ARRAY<DOUBLE>, mask INT")
    whole = {(r["g"], r["pos"]): r["pooled"] for r in neighbours.neighbour_pool(frame, "g", **how).collect()}
    for wanted in ((0, 0), (4, 9)):
        got = {(r["g"], r["pos"]): r["pooled"] for r in neighbours.neighbour_pool(frame, "g", wanted=wanted, **how).collect()}
        assert sorted(got) == sorted(k for k in whole if wanted[0] <= k[1] <= wanted[1])
        assert all(np.allclose(got[k], whole[k]) for k in got)


def test_an_id_without_vector_is_an_error_wherever_it_stands(spark):
    table = spark.createDataFrame([(1, [0.5]), (2, None)], "token_id INT, vector ARRAY<DOUBLE>")
    vectors.check_tokens(spark.createDataFrame([(1,), (1,), (None,)], "token_id INT"), table)
    for gone in (2, 3):
        with pytest.raises(ValueError, match=f"no vector for token {gone}"):
            vectors.check_tokens(spark.createDataFrame([(1,), (gone,)], "token_id INT"), table)

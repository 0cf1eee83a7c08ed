"""Worked examples: packing, optimiser traces, array functions, label cases, masking."""

import math
import warnings

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textloom.functions import dense, encoding
from textloom.functions import math as fm
from textloom.operators import batching, labels, losses, neighbours, optimizer, tokens, vectors
from textloom.operators.head import Head, predict, score_head
from textloom.operators.optimizer import AdamParams
from textloom.sources import metrics, parameters
from textloom.sources.corpus import read_documents

TEXTS = [
    "A lamp that charges in ten minutes goes on sale in May.",
    "Two villages share one fire engine from now on.",
    "Goats sleep less than sheep, a study of 40 farms finds.",
    "Rain fell on the last day of the open-air festival.",
]
CLASSES = ["News", "Entertainment", "Sports", "Technology"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id BIGINT, text STRING")


def values(spark, column, data):
    return spark.createDataFrame([(data,)], "x ARRAY<DOUBLE>").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("masks", "lengths", "longest", "offsets"),
    [
        (["1110", "1100"], [3, 2], 3, [0, 3, 5]),
        (["11111", "11100", "10000"], [5, 3, 1], 5, [0, 5, 8, 9]),
        (["111100"], [4], 4, [0, 4]),
    ],
)
def test_packing(spark, masks, lengths, longest, offsets):
    rows = [(0, i, [int(b) for b in m]) for i, m in enumerate(masks)]
    df = batching.seq_lengths(spark.createDataFrame(rows, "batch_id BIGINT, slot INT, attention_mask ARRAY<INT>"))
    assert [r["seqlen"] for r in df.sort("slot").collect()] == lengths
    assert batching.max_seqlen(df).first()["max_seqlen"] == longest
    assert batching.cu_seqlens(df, as_array=True).first()["cu_seqlens"] == offsets
    ends = [(r["cu_start"], r["cu_end"]) for r in batching.cu_seqlens(df).sort("slot").collect()]
    assert ends == list(zip(offsets, offsets[1:], strict=False))


def test_stride_offsets(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "batch_id BIGINT, slot INT")
    assert batching.stride_offsets(df, 4, as_array=True).first()["offsets"] == [0, 4, 8]


TRACES = {
    "none": (AdamParams(lr=0.1), [(0.900000002, 0.05, 0.00025), (0.865439418, 0.025, 0.00028975), (0.827500241, 0.0325, 0.00029946025)]),
    "l2": (
        AdamParams(lr=0.1, decay=("l2", 0.1)),
        [(0.900000002, 0.06, 0.00036), (0.847519063, 0.043, 0.00037174), (0.790162183, 0.057175191, 0.000405501527)],
    ),
    "decoupled": (
        AdamParams(lr=0.1, decay=("decoupled", 0.1)),
        [(0.890000002, 0.05, 0.00025), (0.846539418, 0.025, 0.00028975), (0.800134847, 0.0325, 0.00029946025)],
    ),
    "base_half": (AdamParams(lr=0.1, beta_2=0.5), [None, (0.860327458, 0.025, 0.0825), (0.8081645, 0.0325, 0.04625)]),
    "amsgrad": (
        AdamParams(lr=0.1, beta_2=0.5, amsgrad=True),
        [None, (0.867769875, 0.025, 0.0825, 0.125), (0.836040386, 0.0325, 0.04625, 0.125)],
    ),
}


def one_parameter(spark, theta=1.0):
    return spark.createDataFrame([("w", 0, 0, theta)], parameters.PARAMETER_SCHEMA)


def one_gradient(spark, grad):
    return spark.createDataFrame([("w", 0, 0, grad)], "param STRING, row INT, col INT, grad DOUBLE")


@pytest.mark.parametrize("name", TRACES)
def test_adam_trace(spark, name):
    hp, expected = TRACES[name]
    state = optimizer.init_state(one_parameter(spark), hp)
    for t, (grad, want) in enumerate(zip((0.5, -0.2, 0.1), expected, strict=True), start=1):
        rows = optimizer.adam_step(state, one_gradient(spark, grad), hp, t).collect()
        if want is not None:
            got = [rows[0][c] for c in ("theta", "m", "v", "vmax")[: len(want)]]
            assert got == pytest.approx(want, abs=1e-9)
        state = spark.createDataFrame(rows, state.schema)


def test_adam_state_reset_each_step(spark):
    hp = AdamParams(lr=0.1)
    theta, seen = one_parameter(spark), []
    for grad in (0.5, -0.2, 0.1):
        row = optimizer.adam_step(optimizer.init_state(theta, hp), one_gradient(spark, grad), hp, 1).first()
        theta = one_parameter(spark, row["theta"])
        seen.append((row["theta"], row["m"], row["v"]))
    assert seen[1] == pytest.approx((0.999999997, -0.02, 0.00004), abs=1e-9)
    assert seen[2] == pytest.approx((0.900000007, 0.01, 0.00001), abs=1e-9)


@pytest.mark.parametrize("decay", [None, ("l2", 0.1), ("decoupled", 0.1)])
@pytest.mark.parametrize("amsgrad", [False, True])
def test_missing_gradient_leaves_row_alone(spark, decay, amsgrad):
    hp = AdamParams(lr=0.1, decay=decay, amsgrad=amsgrad)
    start = spark.createDataFrame([("w", 0, 0, 1 / 3), ("w", 0, 1, 0.7)], parameters.PARAMETER_SCHEMA)
    grads = spark.createDataFrame([("w", 0, 1, 0.0)], "param STRING, row INT, col INT, grad DOUBLE")
    before = optimizer.init_state(start, hp).sort("col").collect()
    after = optimizer.adam_step(optimizer.init_state(start, hp), grads, hp, 5).sort("col").collect()
    assert after[0] == before[0]
    moved = after[1]["theta"] != 0.7
    assert moved == (decay is not None)  # a zero gradient is a gradient


def test_parameter_changes():
    hp = AdamParams(lr=0.004)
    assert hp.lr == 0.004
    hp = optimizer.change_params(hp, AdamParams(lr=0.002))
    assert hp == AdamParams(lr=0.002)
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        hp = optimizer.change_params(hp, AdamParams(lr=0.002, amsgrad=True))
    assert caught and hp == AdamParams(lr=0.002)
    hp = optimizer.change_params(hp, AdamParams(lr=0.002, beta_1=0.1, beta_2=0.1))
    assert hp == AdamParams(lr=0.002, beta_1=0.1, beta_2=0.1)
    with pytest.raises(ValueError):
        AdamParams(decay=("other", 0.1))


@pytest.mark.parametrize("amsgrad", [False, True])
def test_parameters_returned_unchanged(spark, tmp_path, amsgrad):
    rows = [("w", 0, 0, 3.0), ("w", 0, 1, 1.0), ("b", 0, 0, -2.0)]
    params = spark.createDataFrame(rows, parameters.PARAMETER_SCHEMA)
    state = optimizer.init_state(params, AdamParams(amsgrad=amsgrad))
    path = str(tmp_path / "params")
    parameters.write_parameters(state, path)
    stored = parameters.read_parameters(spark, path)
    assert stored.columns == ["param", "row", "col", "theta"]
    assert sorted(map(tuple, stored.collect())) == sorted(rows)
    assert parameters.matrix(stored, "w").tolist() == [[3.0, 1.0]]
    with pytest.raises(ValueError):
        parameters.read_parameters(spark, path, "w", (2, 2))
    assert parameters.read_parameters(spark, path, "w", (1, 2)).count() == 2
    with pytest.raises(KeyError):
        parameters.matrix(stored, "missing")


def test_only_float_parameters_train(spark):
    rows = [("w", 0, 0, 3.0), ("ids", 0, 0, 7.0)]
    params = spark.createDataFrame(rows, parameters.PARAMETER_SCHEMA)
    kinds = spark.createDataFrame([("w", "f32"), ("ids", "u32")], "param STRING, dtype STRING")
    assert [r["param"] for r in parameters.trainable(params, kinds).collect()] == ["w"]


def test_softmax(spark):
    want = [0.032059, 0.087144, 0.236883, 0.643914]
    x = [1.0, 2.0, 3.0, 4.0]
    assert values(spark, fm.softmax(F.col("x")), x) == pytest.approx(want, abs=1e-6)
    assert dense.softmax(np.array([x]))[0] == pytest.approx(want, abs=1e-6)


def test_log_softmax_of_softmax(spark):
    want = [-1.634675, -1.579589, -1.429851, -1.022819]
    got = values(spark, fm.log_softmax(fm.softmax(F.col("x"))), [1.0, 2.0, 3.0, 4.0])
    assert got == pytest.approx(want, abs=1e-6)


def test_layer_norm(spark):
    want = [-1.341635, -0.447212, 0.447212, 1.341635]
    x = [1.0, 2.0, 3.0, 4.0]
    assert values(spark, fm.layer_norm(F.col("x")), x) == pytest.approx(want, abs=1e-6)
    assert dense.layer_norm(np.array([x]), np.ones(4), 1e-5)[0] == pytest.approx(want, abs=1e-6)


def test_gelu(spark):
    x = [-2.0, -1.0, 0.0, 0.5, 1.0, 3.0]
    want = [-0.0455003, -0.1586553, 0.0, 0.3457312, 0.8413447, 2.9959503]
    assert values(spark, F.transform("x", fm.gelu), x) == pytest.approx(want, abs=1e-6)
    assert dense.gelu(np.array(x)) == pytest.approx(want, abs=1e-6)
    exact = [0.5 * v * (1 + math.erf(v / math.sqrt(2))) for v in x]
    assert want == pytest.approx(exact, abs=1e-6)


@pytest.mark.parametrize(("probs", "loss"), [([1.0, 0.0, 0.0, 0.0], 0.743668), ([0.25] * 4, 1.386294), ([0.0, 1.0, 0.0, 0.0], 1.743668)])
def test_loss_bounds(spark, probs, loss):
    df = spark.createDataFrame([(probs, 0)], "p ARRAY<DOUBLE>, label INT")
    assert losses.cross_entropy(df, "p", "label").first()["loss"] == pytest.approx(loss, abs=1e-6)


def test_nll_of_log_softmax_is_cross_entropy(spark):
    rows = [([1.0, 2.0, 3.0], 0), ([0.5, -1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "z ARRAY<DOUBLE>, label INT").withColumn("logp", fm.log_softmax(F.col("z")))
    a, b = losses.nll(df, "logp", "label").first(), losses.cross_entropy(df, "logp", "label").first()
    c = losses.cross_entropy(df, "z", "label").first()
    assert a["loss"] == pytest.approx(b["loss"], abs=1e-12) == pytest.approx(c["loss"], abs=1e-12)


@pytest.mark.parametrize("label", [4, -1, None])
def test_loss_rejects_label_out_of_range(spark, label):
    df = spark.createDataFrame([([0.25] * 4, label)], "p ARRAY<DOUBLE>, label INT")
    with pytest.raises(PySparkException, match="out of range"):
        losses.cross_entropy(df, "p", "label").collect()


def test_epoch_losses(spark):
    df = spark.createDataFrame([(0, 0, 2, 1.0), (0, 1, 1, 4.0)], "epoch INT, step INT, batch_size BIGINT, loss DOUBLE")
    assert losses.epoch_loss(df).first()["loss"] == 2.5
    assert losses.epoch_loss(df, weighted=True).first()["loss"] == 2.0


def test_sample_steps(spark):
    rows = [(e, s) for e, n in ((0, 23), (1, 4)) for s in range(n)]
    got = losses.sample_steps(spark.createDataFrame(rows, "epoch INT, step INT"))
    assert sorted(map(tuple, got.collect())) == [(0, 9), (0, 19), (0, 22), (1, 3)]


def test_metrics_append_per_run(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for run in ("a", "b"):
        metrics.write_metrics(spark.createDataFrame([(run, 0, 0, 2, 1.5)], metrics.METRIC_SCHEMA), path)
    assert metrics.read_metrics(spark, path).count() == 2
    assert metrics.read_metrics(spark, path, "b").select("run_id", "loss").collect() == [("b", 1.5)]


def test_metrics_written_twice_are_there_once(spark, tmp_path):
    path = str(tmp_path / "metrics")
    rows = [("a", 0, s, 2, float(s)) for s in range(4)] + [(None, None, 0, 2, 9.0)]
    table = spark.createDataFrame(rows + rows[:1], metrics.METRIC_SCHEMA)
    metrics.write_metrics(table.limit(0), path)
    for part in (table.where("step < 2"), table, table, table.withColumn("loss", F.lit(-1.0))):
        metrics.write_metrics(part, path)
    got = metrics.read_metrics(spark, path).select("run_id", "epoch", "step", "batch_size", "loss").collect()
    assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame(rows, metrics.METRIC_SCHEMA).collect()))


def test_metric_stream_that_starts_again(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "metrics")
    spark.createDataFrame([("a", 0, s, 2, float(s)) for s in range(4)], metrics.METRIC_SCHEMA).write.parquet(source)
    for start in ("first", "second"):  # without the first checkpoint the stream begins anew
        stream = spark.readStream.schema(metrics.METRIC_SCHEMA).parquet(source).writeStream.foreachBatch(metrics.metric_sink(path))
        stream.option("checkpointLocation", str(tmp_path / start)).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["step"] for r in metrics.read_metrics(spark, path).collect()) == [0, 1, 2, 3]


def test_label_map(spark):
    classes = labels.label_map(spark, CLASSES)
    assert [tuple(r) for r in classes.sort("label_id").collect()] == list(enumerate(CLASSES))
    assert labels.num_classes(classes) == 4 and labels.num_classes(None) == 0
    named = spark.createDataFrame([("Sports",), ("Cooking",)], "name STRING")
    assert dict(labels.encode_labels(named, classes, "name").collect()) == {"Sports": 2, "Cooking": None}
    ids = spark.createDataFrame([(3,), (9,)], "id INT")
    assert dict(labels.decode_labels(ids, classes, "id").collect()) == {3: "Technology", 9: None}


def test_label_map_of_any_column(spark):
    rows = labels.label_map_from(spark.range(30).select((F.col("id") % 20).alias("id")), "id").collect()
    assert sorted((r["label_id"], r["label"]) for r in rows) == list(enumerate(sorted(str(i) for i in range(20))))


def issues(docs, spark, rows, classes=4):
    given = spark.createDataFrame(rows, "doc_id BIGINT, label INT")
    return sorted(map(tuple, labels.audit_labels(docs, given, classes).collect()), key=str)


def test_audit_out_of_range(docs, spark):
    assert issues(docs, spark, [(0, 1), (1, 2), (2, 3), (3, 4)]) == [(3, 4, "out_of_range")]


def test_audit_missing(docs, spark):
    rows = [(0, 0), (1, 1), (2, 0)]
    assert issues(docs, spark, rows) == [(3, None, "missing")]
    given = spark.createDataFrame(rows, "doc_id BIGINT, label INT")
    attached = labels.attach_labels(docs, given).sort("doc_id").collect()
    assert [r["label"] for r in attached] == [0, 1, 0, None]


def test_audit_orphan_duplicate_null(docs, spark):
    rows = [(0, 0), (0, 1), (1, 1), (2, -1), (3, None), (9, 2)]
    assert issues(docs, spark, rows) == [
        (0, None, "duplicate"), (2, -1, "out_of_range"), (3, None, "out_of_range"), (9, None, "orphan"),
    ]


def test_batches_of_two(docs):
    rows = batching.assign_batches(docs, "doc_id", 2).sort("doc_id").collect()
    assert [(r["batch_id"], r["slot"]) for r in rows] == [(0, 0), (0, 1), (1, 0), (1, 1)]


@pytest.fixture(scope="module")
def odd_docs(spark):
    texts = [(0, "B a, a!"), (1, ""), (2, None), (3, "   "), (4, "x " * 100)]
    return spark.createDataFrame(texts, "doc_id BIGINT, text STRING")


@pytest.mark.parametrize("limit", [0, 1000])
def test_encode_edges(spark, odd_docs, limit):
    vocab = spark.createDataFrame([("a", 4), (",", 5), ("x", 6)], "token STRING, token_id INT")
    rows = tokens.encode(odd_docs, vocab, max_length=8, limit=limit).sort("doc_id").collect()
    got = {r["doc_id"]: (r["input_ids"], r["attention_mask"], r["seqlen"]) for r in rows}
    assert got[0] == ([2, 1, 4, 5, 4, 1, 3, 0], [1, 1, 1, 1, 1, 1, 1, 0], 7)
    for empty in (1, 2, 3):
        assert got[empty] == ([2, 3, 0, 0, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0, 0, 0], 2)
    assert got[4] == ([2, 6, 6, 6, 6, 6, 6, 3], [1] * 8, 8)
    plain = tokens.encode(odd_docs, vocab, max_length=3, add_special=False, limit=limit).sort("doc_id").collect()
    assert [r["input_ids"] for r in plain] == [[1, 4, 5], [0, 0, 0], [0, 0, 0], [0, 0, 0], [6, 6, 6]]


def test_build_vocab_order_and_limits(spark):
    df = spark.createDataFrame([(t,) for t in "b b a a c d d d e".split()], "token STRING")
    got = [tuple(r) for r in tokens.build_vocab(df, 3).sort("token_id").collect()]
    assert got == [("d", 4, 3), ("a", 5, 2), ("b", 6, 2)]
    assert tokens.build_vocab(df, 100).count() == 5
    assert tokens.build_vocab(df, 100, min_count=2).count() == 3


def test_csv_corpus(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,body,lang\n1,"two\nlines, ""quoted""",en\n2,plain,fr\n')
    rows = read_documents(spark, str(tmp_path), "csv", "id", "body", keep=("lang",), multi_line=True).sort("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, 'two\nlines, "quoted"', "en"), (2, "plain", "fr")]
    with pytest.raises(ValueError):
        read_documents(spark, str(tmp_path), "xml")


def test_pool_mean_of_masked_group_is_null(spark):
    rows = [(0, 0, [1.0, 3.0], 1), (0, 1, [3.0, 5.0], 1), (0, 2, [9.0, 9.0], 0), (1, 0, [1.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "g INT, pos INT, vector ARRAY<DOUBLE>, mask INT")
    assert dict(vectors.pool_mean(df, "g", 2).collect()) == {0: [2.0, 4.0], 1: None}
    assert dict(vectors.pool_cls(df, "g").collect()) == {0: [1.0, 3.0], 1: [1.0, 1.0]}


def test_embedding_of_unknown_token_fails(spark):
    table = spark.createDataFrame([(0, [1.0])], "token_id INT, vector ARRAY<DOUBLE>")
    rows = spark.createDataFrame([(0, 0, 7)], "doc_id INT, pos INT, token_id INT")
    with pytest.raises(PySparkException, match="no vector for token 7"):
        vectors.embed_tokens(rows, table, ["doc_id", "pos"]).collect()


def test_mask_bias(spark):
    df = spark.createDataFrame([(1,), (0,)], "mask INT").select("mask", encoding.mask_bias(F.col("mask")).alias("b"))
    assert dict(df.collect()) == {1: 0.0, 0: -3.4028234663852886e38}


def test_band_edge(spark):
    rows = spark.createDataFrame([(0, p) for p in range(6)], "g INT, pos INT")
    got = {(r["i"], r["j"]) for r in neighbours.band_pairs(rows, "g", "pos", 2).collect()}
    assert got == {(i, j) for i in range(6) for j in range(6) if abs(i - j) <= 2}


def pool(spark, masks, w, **options):
    rows = [(0, p, [float(p), 1.0], m) for p, m in enumerate(masks)]
    df = spark.createDataFrame(rows, "g INT, pos INT, vector ARRAY<DOUBLE>, mask INT")
    got = neighbours.neighbour_pool(df, "g", w=w, **options)
    return {r["pos"]: r["pooled"] for r in got.collect()}


@pytest.mark.parametrize("options", [{"w": None}, {"w": None, "max_len": 4}, {"w": None, "block": 2}, {"w": 10}])
def test_masked_keys_have_no_weight(spark, options):
    got = pool(spark, [1, 0, 0, 0], **options)
    assert all(v == pytest.approx([0.0, 1.0]) for v in got.values()) and len(got) == 4


@pytest.mark.parametrize("options", [{"w": None}, {"w": None, "max_len": 4}, {"w": None, "block": 2}, {"w": 10}])
def test_all_masked_is_uniform(spark, options):
    got = pool(spark, [0, 0, 0, 0], **options)
    assert all(v == pytest.approx([1.5, 1.0]) for v in got.values())


def test_all_masked_within_band_is_uniform_over_band(spark):
    got = pool(spark, [0, 0, 0, 1], 1)
    assert got[0] == pytest.approx([0.5, 1.0])
    assert got[1] == pytest.approx([1.0, 1.0])
    assert got[2] == pytest.approx([3.0, 1.0])


def test_max_len_is_checked(spark):
    with pytest.raises(PySparkException, match="not below max_len"):
        pool(spark, [1, 1, 1], None, max_len=2)


def test_null_vectors_stay_null(spark):
    head = Head(np.ones(2), np.eye(2), np.array([[1.0, 0.0], [0.0, 1.0]]), np.zeros(2))
    rows = [(0, [3.0, 1.0]), (1, None), (2, [1.0, 3.0])]
    df = spark.createDataFrame(rows, "id INT, v ARRAY<DOUBLE>").coalesce(1)
    got = predict(score_head(df, "v", head)).sort("id").collect()
    assert [r["predicted"] for r in got] == [0, None, 1]
    assert got[1]["probs"] is None and got[1]["logits"] is None
    ys = df.select("id", vectors.linear(F.col("v"), np.array([[1.0, 1.0]])).alias("y")).sort("id").collect()
    assert [r["y"] for r in ys] == [[4.0], None, [4.0]]
    nothing = df.where("id = 1").select(vectors.linear(F.col("v"), np.eye(2)).alias("y"))
    assert nothing.first()["y"] is None


def test_layer_norm_of_nothing_is_null(spark):
    assert values(spark, fm.layer_norm(F.col("x")), []) is None or values(spark, fm.layer_norm(F.col("x")), []) == []

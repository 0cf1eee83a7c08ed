"""Queries over the text tables, with the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import encoding as enc
from textloom.operators import batching, labels, losses, neighbours, sparse_update, tokens
from textloom.plans import workflows
from textloom.session import work_path
from textloom.sources import metrics
from textloom.sources.corpus import read_documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VOCAB_SIZE = 2000
LENGTH = enc.MAX_LENGTH
ROOM = enc.content_length(LENGTH, True)
BATCH = 32
BAND = 3
EVERY = 10

CLASSES = [f"class_{i}" for i in range(10)]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    return read_documents(spark, f"{sf}/documents.parquet", keep=keep)


def texts(spark: SparkSession, sf: str, *keep: str) -> DataFrame:
    """The same for queries that work on the text itself."""
    return documents(spark, sf, *keep)


def vocabulary(docs: DataFrame, size: int = VOCAB_SIZE) -> DataFrame:
    return tokens.build_vocab(tokens.tokenize(docs), size)


def encoded(docs: DataFrame) -> DataFrame:
    return tokens.encode(docs, vocabulary(docs), vocab_size=VOCAB_SIZE)


def batches(spark: SparkSession, sf: str) -> DataFrame:
    return workflows.packed_batches(texts(spark, sf), VOCAB_SIZE, BATCH)


def lengths(spark: SparkSession, sf: str) -> DataFrame:
    return workflows.packed_lengths(texts(spark, sf), BATCH)


def joined(ids: str | Column) -> Column:
    return F.array_join(F.col(ids).cast("array<string>") if isinstance(ids, str) else ids.cast("array<string>"), ",")


TOKENS_SQL = rf"""
toks AS (
  SELECT doc_id, generate_subscripts(ts, 1) - 1 AS pos, unnest(ts) AS token
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '{enc.TOKEN_PATTERN}') AS ts FROM documents))"""


def vocab_sql(size: int | str = VOCAB_SIZE) -> str:
    return f"""
vocab AS (
  SELECT token, (row_number() OVER (ORDER BY n DESC, token) + 3)::INT AS token_id, n
  FROM (SELECT token, count(*) AS n FROM toks GROUP BY token)
  QUALIFY row_number() OVER (ORDER BY n DESC, token) <= {size})"""


def encoded_sql(size: int | str = VOCAB_SIZE) -> str:
    return f"""
WITH {TOKENS_SQL}, {vocab_sql(size)},
content AS (
  SELECT t.doc_id, list(coalesce(v.token_id, 1) ORDER BY t.pos) AS ids
  FROM toks t LEFT JOIN vocab v USING (token) WHERE t.pos < {ROOM} GROUP BY t.doc_id),
marked AS (
  SELECT d.doc_id, list_concat([2], coalesce(c.ids, []), [3]) AS ids
  FROM documents d LEFT JOIN content c USING (doc_id)),
encoded AS (
  SELECT doc_id, list_resize(ids, {LENGTH}, 0) AS input_ids, len(ids) AS seqlen,
         list_transform(range({LENGTH}), lambda p: CASE WHEN p < len(ids) THEN 1 ELSE 0 END) AS attention_mask
  FROM marked),
batches AS (
  SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id,
         (row_number() OVER (ORDER BY doc_id) - 1) % {BATCH} AS slot
  FROM encoded)"""


ENCODED_SQL = encoded_sql()


# ---- sources and sinks


@query("s1_read_documents", "SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def _(spark, sf):
    return documents(spark, sf, "lang").select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("s1_read_documents_csv", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def _(spark, sf):
    path = work_path(spark, "corpus-csv")
    documents(spark, sf).write.option("header", True).option("escape", '"').csv(path)
    return read_documents(spark, path, fmt="csv", multi_line=True).select("doc_id", F.md5("text").alias("text_md5"))


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """One step per batch of documents, with the mean log of the text length in place of a loss."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars")
    rows = batching.assign_batches(docs, "doc_id", BATCH)
    return rows.groupBy("batch_id").agg(
        F.count("*").alias("batch_size"), F.avg(F.ln(F.col("n_chars") + 1)).alias("loss")
    ).select(
        F.lit("lengths").alias("run_id"),
        F.lit(0).alias("epoch"),
        F.col("batch_id").cast("int").alias("step"),
        "batch_size",
        "loss",
    )


STEPS_SQL = f"""
WITH numbered AS (
  SELECT n_chars, (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS step FROM documents),
steps AS (
  SELECT 'lengths' AS run_id, 0 AS epoch, step::INT AS step, count(*) AS batch_size, avg(ln(n_chars + 1)) AS loss
  FROM numbered GROUP BY step)"""


def step_log(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "metrics")
    metrics.write_metrics(steps(spark, sf), path)
    return metrics.read_metrics(spark, path, "lengths")


@query("s3_write_metrics", f"{STEPS_SQL} SELECT run_id, epoch, step, batch_size, round(loss, 6) AS loss FROM steps")
def _(spark, sf):
    return step_log(spark, sf).select("run_id", "epoch", "step", "batch_size", F.round("loss", 6).alias("loss"))


# ---- labels

LANG_SQL = """
WITH map AS (
  SELECT (row_number() OVER (ORDER BY lang) - 1)::INT AS label_id, lang AS label
  FROM (SELECT DISTINCT lang FROM documents))"""


@query("l1_label_map", f"{LANG_SQL} SELECT label_id, label FROM map")
def _(spark, sf):
    return labels.label_map_from(documents(spark, sf, "lang"), "lang")


@query(
    "l2_encode_labels",
    f"{LANG_SQL} SELECT d.doc_id, d.lang, m.label_id FROM documents d LEFT JOIN map m ON m.label = d.lang",
)
def _(spark, sf):
    docs = documents(spark, sf, "lang").select("doc_id", "lang")
    return labels.encode_labels(docs, labels.label_map_from(docs, "lang"), "lang")


@query(
    "l3_decode_labels",
    "SELECT vec_id, label AS label_id, 'class_' || label AS label, 10 AS n_classes FROM embeddings",
)
def _(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("label").alias("label_id"))
    classes = labels.label_map(spark, CLASSES)
    named = labels.decode_labels(rows, classes, "label_id")
    return named.withColumn("n_classes", F.lit(labels.num_classes(classes)))


@query(
    "l4_attach_labels",
    """SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def _(spark, sf):
    given = spark.read.parquet(f"{sf}/labels.parquet")
    rows = labels.attach_labels(documents(spark, sf).select("doc_id"), given)
    return rows.fillna(-1, ["quality", "toxic"])


AUDIT_SQL = """
WITH given AS (SELECT doc_id, quality AS label FROM labels)
SELECT doc_id, -1 AS label, 'missing' AS issue FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM given)
UNION ALL SELECT doc_id, -1, 'orphan' FROM given WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT doc_id, -1, 'duplicate' FROM given GROUP BY doc_id HAVING count(*) > 1
UNION ALL SELECT doc_id, label, 'out_of_range' FROM given WHERE label IS NULL OR label < 0 OR label >= 1"""


@query("l5_audit_labels", AUDIT_SQL)
def _(spark, sf):
    given = spark.read.parquet(f"{sf}/labels.parquet")
    return labels.audit_labels(documents(spark, sf), given, 1, "quality").fillna(-1, ["label"])


# ---- text to ids


@query(
    "t1_tokenize",
    f"""WITH {TOKENS_SQL} SELECT token, count(*) AS n, sum(pos)::BIGINT AS sum_pos,
        sum(doc_id * (pos + 1))::BIGINT AS sum_place FROM toks GROUP BY token""",
)
def _(spark, sf):
    place = F.col("doc_id") * (F.col("pos") + 1)
    return (
        tokens.tokenize(texts(spark, sf))
        .groupBy("token")
        .agg(F.count("*").alias("n"), F.sum("pos").alias("sum_pos"), F.sum(place).alias("sum_place"))
    )


@query("t2_build_vocab", f"WITH {TOKENS_SQL}, {vocab_sql()} SELECT token, token_id, n FROM vocab")
def _(spark, sf):
    return vocabulary(texts(spark, sf))


def id_places(spark: SparkSession, sf: str, **how) -> DataFrame:
    """Each id, how often it is there, and where."""
    docs = texts(spark, sf)
    ids = tokens.lookup_ids(tokens.tokenize(docs), vocabulary(docs), **how)
    place = F.sum(F.col("doc_id") * (F.col("pos") + 1))
    return ids.groupBy("token_id").agg(F.count("*").alias("n"), place.alias("sum_place"))


@query(
    "t3_lookup_ids",
    f"""WITH {TOKENS_SQL}, {vocab_sql()}
    SELECT coalesce(token_id, 1) AS token_id, count(*) AS n, sum(doc_id * (pos + 1))::BIGINT AS sum_place
    FROM toks LEFT JOIN vocab USING (token) GROUP BY 1""",
)
def _(spark, sf):
    return id_places(spark, sf, vocab_size=VOCAB_SIZE)


@query("t3_lookup_ids_stored", ORACLES["t3_lookup_ids"])
def _(spark, sf):
    """By the vocabulary that tasks read, as a large one is."""
    return id_places(spark, sf, limit=0)


def content_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of whole texts, without markers, truncation or padding."""
    docs = texts(spark, sf)
    to_ids = tokens.id_array_lookup(spark, tokens.small_vocab(vocabulary(docs)))
    return docs.select("doc_id", to_ids(enc.token_array(F.col("text"))).alias("ids"))


@query(
    "v1_token_gradient",
    f"""WITH {TOKENS_SQL}, {vocab_sql()},
sized AS (SELECT doc_id, token, count(*) OVER (PARTITION BY doc_id)::DOUBLE AS size FROM toks)
SELECT coalesce(token_id, 1) AS token_id, round(sum(1 / size), 6) AS plain, round(sum((doc_id % 7) / size), 6) AS weighted
FROM sized LEFT JOIN vocab USING (token) GROUP BY 1""",
)
def _(spark, sf):
    """What reaches the vector of each token from the mean of all vectors of a text."""
    grad = F.array(F.lit(1.0), (F.col("doc_id") % 7).cast("double"))
    parts = sparse_update.pooled_gradient(content_ids(spark, sf).withColumn("grad", grad))
    sums = [F.round(F.sum(F.col("grad")[i]), 6).alias(name) for i, name in enumerate(("plain", "weighted"))]
    return parts.groupBy(F.col("id").cast("int").alias("token_id")).agg(*sums)


WHOLE_SQL = f"""
WITH {TOKENS_SQL}, {vocab_sql()},
whole AS (
  SELECT d.doc_id, coalesce(c.ids, []) AS ids FROM documents d LEFT JOIN (
    SELECT t.doc_id, list(coalesce(v.token_id, 1) ORDER BY t.pos) AS ids
    FROM toks t LEFT JOIN vocab v USING (token) GROUP BY t.doc_id) c USING (doc_id))"""


@query(
    "t4_add_special",
    f"{WHOLE_SQL} SELECT doc_id, md5(array_to_string(list_concat([2], ids, [3]), ',')) AS ids_md5 FROM whole",
)
def _(spark, sf):
    marked = enc.add_special_ids(F.col("ids"))
    return content_ids(spark, sf).select("doc_id", F.md5(joined(marked)).alias("ids_md5"))


@query("t5_truncate", f"{WHOLE_SQL} SELECT doc_id, array_to_string(ids[1:{LENGTH}], ',') AS ids FROM whole")
def _(spark, sf):
    return content_ids(spark, sf).select("doc_id", joined(enc.truncate(F.col("ids"), LENGTH)).alias("ids"))


@query(
    "t6_pad",
    f"{WHOLE_SQL} SELECT doc_id, array_to_string(list_resize(ids[1:{LENGTH}], {LENGTH}, 0), ',') AS ids FROM whole",
)
def _(spark, sf):
    cut = content_ids(spark, sf).withColumn("ids", enc.truncate(F.col("ids"), LENGTH))
    return cut.select("doc_id", joined(enc.pad(F.col("ids"), LENGTH)).alias("ids"))


@query("t7_attention_mask", f"{ENCODED_SQL} SELECT doc_id, array_to_string(attention_mask, ',') AS mask FROM encoded")
def _(spark, sf):
    return tokens.encoded_lengths(texts(spark, sf)).select("doc_id", joined("attention_mask").alias("mask"))


@query(
    "t8_encode",
    f"""{ENCODED_SQL} SELECT doc_id, array_to_string(input_ids, ',') AS input_ids,
        array_to_string(attention_mask, ',') AS attention_mask, seqlen::INT AS seqlen FROM encoded""",
)
def _(spark, sf):
    return encoded(texts(spark, sf)).select(
        "doc_id",
        joined("input_ids").alias("input_ids"),
        joined("attention_mask").alias("attention_mask"),
        "seqlen",
    )


@query("t8_encode_large_vocab", ORACLES["t8_encode"])
def _(spark, sf):
    docs = texts(spark, sf)
    rows = tokens.encode(docs, vocabulary(docs), vocab_size=VOCAB_SIZE, limit=0)
    return rows.select(
        "doc_id",
        joined("input_ids").alias("input_ids"),
        joined("attention_mask").alias("attention_mask"),
        "seqlen",
    )


TURNS_SQL = """
documents AS (SELECT (conv_id, turn) AS doc_id, text FROM conversations)"""


@query(
    "t8_encode_conversations",
    ENCODED_SQL.replace("WITH", f"WITH {TURNS_SQL},", 1)
    + """ SELECT doc_id[1] AS conv_id, doc_id[2] AS turn, batch_id, slot::INT AS slot,
        array_to_string(input_ids, ',') AS input_ids, seqlen::INT AS seqlen FROM batches""",
)
def _(spark, sf):
    """Turns of conversations, which two columns name and order."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    vocab = vocabulary(turns.select(F.struct("conv_id", "turn").alias("doc_id"), "text"))
    rows = tokens.encode(turns, vocab, id_col=["conv_id", "turn"], vocab_size=VOCAB_SIZE)
    placed = batching.assign_batches(rows, ["conv_id", "turn"], BATCH)
    return placed.select("conv_id", "turn", "batch_id", "slot", joined("input_ids").alias("input_ids"), "seqlen")


# ---- batches and packing


@query("b1_assign_batches", f"{ENCODED_SQL} SELECT doc_id, batch_id, slot::INT AS slot FROM batches")
def _(spark, sf):
    rows = batching.assign_batches(documents(spark, sf).select("doc_id"), "doc_id", BATCH)
    return rows.select("doc_id", "batch_id", "slot")


@query("b2_seq_lengths", f"{ENCODED_SQL} SELECT doc_id, list_sum(attention_mask)::INT AS seqlen FROM encoded")
def _(spark, sf):
    return batching.seq_lengths(tokens.encoded_lengths(texts(spark, sf)).drop("seqlen")).select("doc_id", "seqlen")


@query("b3_max_seqlen", f"{ENCODED_SQL} SELECT batch_id, max(seqlen)::INT AS max_seqlen FROM batches GROUP BY batch_id")
def _(spark, sf):
    return batching.max_seqlen(lengths(spark, sf))


OFFSETS_SQL = f"""{ENCODED_SQL},
offsets AS (
  SELECT *, sum(seqlen) OVER (PARTITION BY batch_id ORDER BY slot)::BIGINT AS cu_end,
         sum(seqlen) OVER (ORDER BY doc_id)::BIGINT AS all_end
  FROM batches)"""


@query(
    "b4_cu_seqlens",
    f"{OFFSETS_SQL} SELECT doc_id, batch_id, slot::INT AS slot, cu_end - seqlen AS cu_start, cu_end FROM offsets",
)
def _(spark, sf):
    return batching.cu_seqlens(lengths(spark, sf)).select("doc_id", "batch_id", "slot", "cu_start", "cu_end")


@query(
    "b4_cu_seqlens_array",
    f"""{OFFSETS_SQL} SELECT batch_id, array_to_string(list_concat([0], list(cu_end ORDER BY slot)), ',') AS cu_seqlens
        FROM offsets GROUP BY batch_id""",
)
def _(spark, sf):
    rows = batching.cu_seqlens(lengths(spark, sf), as_array=True)
    return rows.select("batch_id", joined("cu_seqlens").alias("cu_seqlens"))


@query("b4_cu_seqlens_global", f"{OFFSETS_SQL} SELECT doc_id, all_end - seqlen AS cu_start, all_end AS cu_end FROM offsets")
def _(spark, sf):
    rows = tokens.encoded_lengths(texts(spark, sf)).select("doc_id", "seqlen")
    return batching.cu_seqlens(rows, by=None, order="doc_id").select("doc_id", "cu_start", "cu_end")


@query(
    "b5_stride_offsets",
    f"""{ENCODED_SQL} SELECT doc_id, batch_id, (slot * {LENGTH})::BIGINT AS "start",
        ((slot + 1) * {LENGTH})::BIGINT AS "end" FROM batches""",
)
def _(spark, sf):
    rows = batching.assign_batches(documents(spark, sf).select("doc_id"), "doc_id", BATCH)
    return batching.stride_offsets(rows, LENGTH).select("doc_id", "batch_id", "start", "end")


@query(
    "b5_stride_offsets_array",
    f"""{ENCODED_SQL} SELECT batch_id,
        array_to_string(list_transform(range(count(*) + 1), lambda i: i * {LENGTH}), ',') AS offsets
        FROM batches GROUP BY batch_id""",
)
def _(spark, sf):
    rows = batching.assign_batches(documents(spark, sf).select("doc_id"), "doc_id", BATCH)
    offsets = batching.stride_offsets(rows, LENGTH, as_array=True)
    return offsets.select("batch_id", joined("offsets").alias("offsets"))


CELLS_SQL = f"""{OFFSETS_SQL},
cells AS (
  SELECT batch_id, slot::INT AS slot, generate_subscripts(input_ids, 1) - 1 AS pos, unnest(input_ids) AS token_id,
         unnest(attention_mask) AS mask, cu_end - seqlen AS cu_start
  FROM offsets)"""


@query(
    "b6_flatten_tokens",
    f"""{CELLS_SQL} SELECT batch_id, slot, pos::INT AS pos, (slot * {LENGTH} + pos)::BIGINT AS flat_pos,
        token_id::INT AS token_id, mask::INT AS mask FROM cells""",
)
def _(spark, sf):
    return batching.flatten_tokens(batches(spark, sf), LENGTH)


@query(
    "b7_unpad",
    f"""{CELLS_SQL} SELECT batch_id, slot, pos::INT AS pos, (cu_start + pos)::BIGINT AS flat_pos,
        token_id::INT AS token_id FROM cells WHERE mask = 1""",
)
def _(spark, sf):
    return batching.unpad(batches(spark, sf))


@query(
    "b8_repad",
    f"""{ENCODED_SQL} SELECT batch_id, slot::INT AS slot, array_to_string(input_ids, ',') AS input_ids,
        array_to_string(attention_mask, ',') AS attention_mask FROM batches""",
)
def _(spark, sf):
    rows = batching.repad(batching.unpad(batches(spark, sf)), LENGTH)
    return rows.select(
        "batch_id", "slot", joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask")
    )


EMPTY_SQL = f"""
WITH {TOKENS_SQL}, {vocab_sql()},
content AS (
  SELECT t.doc_id, list(coalesce(v.token_id, 1) ORDER BY t.pos) AS ids
  FROM toks t LEFT JOIN vocab v USING (token) WHERE t.pos < {LENGTH} AND t.doc_id % 3 <> 0 GROUP BY t.doc_id),
plain AS (
  SELECT (row_number() OVER (ORDER BY d.doc_id) - 1) // {BATCH} AS batch_id,
         (row_number() OVER (ORDER BY d.doc_id) - 1) % {BATCH} AS slot, coalesce(c.ids, []) AS ids
  FROM documents d LEFT JOIN content c USING (doc_id))"""


@query(
    "b8_repad_empty",
    f"""{EMPTY_SQL} SELECT batch_id, slot::INT AS slot, array_to_string(list_resize(ids, {LENGTH}, 0), ',') AS input_ids,
        array_to_string(list_transform(range({LENGTH}), lambda p: CASE WHEN p < len(ids) THEN 1 ELSE 0 END), ',')
          AS attention_mask FROM plain""",
)
def _(spark, sf):
    """Without markers, every third text blank: rows that have no token at all come back too."""
    docs = texts(spark, sf)
    some = docs.withColumn("text", F.when(F.col("doc_id") % 3 != 0, F.col("text")))
    rows = tokens.encode(some, vocabulary(docs), add_special=False, vocab_size=VOCAB_SIZE)
    placed = batching.assign_batches(rows, "doc_id", BATCH)
    back = batching.repad(batching.unpad(placed), LENGTH, rows=placed)
    return back.select(
        "batch_id", "slot", joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask")
    )


@query(
    "b9_collect_batches",
    f"""{ENCODED_SQL} SELECT batch_id, string_agg(array_to_string(input_ids, ','), ';' ORDER BY slot) AS input_ids,
        string_agg(array_to_string(attention_mask, ','), ';' ORDER BY slot) AS attention_mask,
        string_agg(seqlen::VARCHAR, ',' ORDER BY slot) AS labels FROM batches GROUP BY batch_id""",
)
def _(spark, sf):
    rows = batching.collect_batches(batches(spark, sf), label="seqlen")

    def text(col: str) -> Column:
        return F.array_join(F.transform(col, joined), ";").alias(col)

    return rows.select("batch_id", text("input_ids"), text("attention_mask"), joined("labels").alias("labels"))


@query(
    "packing_report",
    f"""{ENCODED_SQL} SELECT batch_id, count(*) AS n_docs, sum(seqlen)::BIGINT AS total_tokens,
        max(seqlen)::INT AS max_seqlen FROM batches GROUP BY batch_id""",
)
def _(spark, sf):
    return workflows.packing_report(lengths(spark, sf))


# ---- neighbours of a token


@query(
    "n1_mask_bias",
    f"""{CELLS_SQL} SELECT pos::INT AS pos, CASE WHEN mask = 1 THEN 0 ELSE 1 END AS masked,
        count(*) AS n FROM cells GROUP BY 1, 2""",
)
def _(spark, sf):
    cells = batching.flatten_tokens(batches(spark, sf), LENGTH).withColumn("bias", enc.mask_bias(F.col("mask")))
    masked = F.when(F.col("bias") == 0, 0).when(F.col("bias") == enc.MASKED_BIAS, 1)
    return cells.groupBy("pos", masked.alias("masked")).agg(F.count("*").alias("n"))


@query(
    "n2_band_pairs",
    f"""WITH {TOKENS_SQL} SELECT a.doc_id, (b.pos - a.pos)::BIGINT AS distance, count(*) AS n,
        sum(CASE WHEN a.token = b.token THEN 1 ELSE 0 END)::BIGINT AS n_equal
        FROM toks a JOIN toks b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos - {BAND} AND a.pos + {BAND}
        GROUP BY 1, 2""",
)
def _(spark, sf):
    pairs = neighbours.band_pairs(tokens.tokenize(texts(spark, sf)), "doc_id", "pos", BAND, carry=("token",))
    equal = (F.col("token_i") == F.col("token_j")).cast("bigint")
    return pairs.groupBy("doc_id", (F.col("j") - F.col("i")).alias("distance")).agg(
        F.count("*").alias("n"), F.sum(equal).alias("n_equal")
    )


@query("n2_band_pairs_arrays", ORACLES["n2_band_pairs"])
def _(spark, sf):
    """The same from token arrays, which need no shuffle to pair their own places."""
    rows = texts(spark, sf).select("doc_id", enc.token_array(F.col("text")).alias("tokens"))
    pairs = neighbours.band_pairs_of_arrays(rows, "doc_id", "tokens", BAND)
    equal = (F.col("item_i") == F.col("item_j")).cast("bigint")
    return pairs.groupBy("doc_id", (F.col("j") - F.col("i")).alias("distance")).agg(
        F.count("*").alias("n"), F.sum(equal).alias("n_equal")
    )


# ---- step log


@query(
    "m5_sample_steps",
    f"""{STEPS_SQL} SELECT epoch, step, batch_size, round(loss, 6) AS loss FROM steps
        WHERE (step + 1) % {EVERY} = 0 OR step = (SELECT max(step) FROM steps)""",
)
def _(spark, sf):
    logged = losses.sample_steps(step_log(spark, sf), EVERY)
    return logged.select("epoch", "step", "batch_size", F.round("loss", 6).alias("loss"))

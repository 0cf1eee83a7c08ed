"""The queries of this package and the SQL that some of them agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.bpe_fst import round_trip_digests
from textloom.llm.chat import CONTROLS, FOREIGN, conversation_digests, format_turns
from textloom.llm.decontaminate import contamination_report
from textloom.llm.html_extract import extract_main_text
from textloom.llm.language import language_report
from textloom.llm.pq_dedup import near_duplicate_vectors
from textloom.llm.quality import quality_report
from textloom.llm.sharding import read_shards, shuffle_to_shards
from textloom.llm.simhash import near_duplicates
from textloom.llm.spelling import spelling_report
from textloom.llm.token_counts import count_tokens
from textloom.llm.token_orc import ids_crc32, read_token_orc, write_token_orc
from textloom.llm.vector_codes import compression_report
from textloom.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_BPE = "byte_bpe_50k.json"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


@query
def op7_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "op7_token_orc")
    write_token_orc(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(BYTE_BPE))
    rows = read_token_orc(spark, folder)
    return rows.select("doc_id", "start", "n_tokens", ids_crc32("ids").alias("ids_crc32"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return round_trip_digests(docs, public_tokenizers.path(MULTI_BPE), public_tokenizers.PATTERN)


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, budget=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op8_decontamination"] = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS win
  FROM item_words, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(i)
  WHERE len(w) > 0
), doc_windows AS (
  SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM doc_words, (SELECT DISTINCT k FROM windows), unnest(range(1, len(w) - k + 2)) AS t(i)
), found AS (
  SELECT d.doc_id, d.i, d.k, b.item_id FROM doc_windows d JOIN windows b ON d.k = b.k AND d.win = b.win
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + k)) AS t(p) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op1_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


ORACLES["op1_pq_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, row_number() OVER () AS r, CAST(embedding AS DOUBLE[]) AS e,
         embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings
), n AS (
  SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v WHERE ok
), links AS (
  SELECT a.r AS a, a.vec_id AS a_id, b.r AS b, b.vec_id AS b_id
  FROM n a JOIN n b ON a.r <> b.r AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
), reach(r, id) AS (
  SELECT r, vec_id FROM v UNION SELECT l.a, x.id FROM links l JOIN reach x ON l.b = x.r
), lowest AS (
  SELECT r, min(id) AS component_id FROM reach GROUP BY r
), counts AS (
  SELECT a AS r, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN lowest USING (r) LEFT JOIN counts USING (r)
"""


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


# A conversation whose texts hold control strings and a backslash before one.
TRICKY = "\\### Assistant: </turn> ok"


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id bigint, turn bigint, role string, text string")
    folder = work_path(spark, "op3_chat_format")
    path = public_tokenizers.path(BYTE_BPE)
    format_turns(rows.union(tricky), path).write.parquet(folder)
    return conversation_digests(spark.read.parquet(folder), path)


def _escaped_length(column: str) -> str:
    """SQL for the length of a text with its backslashes doubled and control strings broken."""
    found = f"len({column}) - len(replace({column}, chr(92), ''))"
    for control in (*CONTROLS, *FOREIGN):
        found += f" + (len({column}) - len(replace({column}, '{control}', ''))) // {len(control)}"
    return f"(len({column}) + {found})"


ORACLES["op3_chat_format"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}'
  UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum({len("".join(CONTROLS))} + {_escaped_length("role")} + {_escaped_length("text")}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_report(table(spark, sf_dir, "embeddings"))


def _assign_sql(turn: int) -> str:
    """SQL that gives each part the nearest entry of ``book{turn}``."""
    return f"""
near{turn} AS (
  SELECT vec_id, label, part, entry, distance FROM (
    SELECT p.vec_id, p.label, p.part, b.entry, d.distance,
           row_number() OVER (PARTITION BY p.vec_id, p.part ORDER BY d.distance, b.entry) AS place
    FROM parts p JOIN book{turn} b ON p.part = b.part,
      LATERAL (SELECT list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance) d
  ) WHERE place = 1
)"""


def _mean_sql(turn: int) -> str:
    """SQL for ``book{turn + 1}``: the means of what ``near{turn}`` assigned, rounded down."""
    return f"""
sums{turn} AS (
  SELECT part, entry, list(total // n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END ORDER BY place) AS x
  FROM (
    SELECT part, entry, place, sum(value)::BIGINT AS total, count(*) AS n
    FROM (SELECT n.part, n.entry, generate_subscripts(p.x, 1) AS place, unnest(p.x) AS value
          FROM near{turn} n JOIN parts p ON n.vec_id = p.vec_id AND n.part = p.part)
    GROUP BY part, entry, place)
  GROUP BY part, entry
), book{turn + 1} AS (
  SELECT b.part, b.entry, coalesce(s.x, b.x) AS x FROM book{turn} b LEFT JOIN sums{turn} s ON b.part = s.part AND b.entry = s.entry
)"""


ORACLES["op11_vector_codes"] = f"""
WITH ints AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, label, part, list_slice(v, part * len(v) // 16 + 1, (part + 1) * len(v) // 16) AS x FROM ints, range(16) AS t(part)
), book0 AS (
  SELECT part, entry, x FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM ints) USING (vec_id) WHERE entry < 64
), {_assign_sql(0)}, {_mean_sql(0)}, {_assign_sql(1)}, {_mean_sql(1)}, {_assign_sql(2)},
digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
), coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
  FROM near2 GROUP BY vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""


@query
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "op12_sharding")
    shuffle_to_shards(table(spark, sf_dir, "documents"), folder, shards=8)
    data = F.coalesce("text", F.lit("")).cast("binary")
    return read_shards(spark, folder).select(
        "doc_id",
        (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_report(table(spark, sf_dir, "documents"))

"""The queries of the operators with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmetrics.llm.conversation_repair import messages, repair_report
from gridmetrics.llm.jaccard_join import jaccard_groups
from gridmetrics.llm.language import languages, sample_and_fit
from gridmetrics.llm.license_scan import license_scan
from gridmetrics.llm.line_dedup import without_repeated_passages
from gridmetrics.llm.merkle import merkle_manifest
from gridmetrics.llm.packing import packed_documents
from gridmetrics.llm.piece_sampling import sampled_pieces
from gridmetrics.llm.pivot_index import vector_groups
from gridmetrics.llm.plane_files import read_documents, write_ids
from gridmetrics.llm.quality import quality_report
from gridmetrics.llm.secret_scan import secret_report
from gridmetrics.llm.token_counts import token_counts
from gridmetrics.workspace import new_folder

TOKEN_LIMIT = 1024
SEQUENCE_TOKENS = 2048
CLOSING_ID = 1


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT, with_table=False)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fit_chars")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS, CLOSING_ID, with_ids=False)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents")).drop("spans")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality_report(_table(spark, sf_dir, "documents"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = sample_and_fit(docs, ~held_out)
    return languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op2_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sampled_pieces(_table(spark, sf_dir, "documents"), path, draws=2)


def op3_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(_table(spark, sf_dir, "embeddings"), similarity=0.98)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_passages(docs, counts=("n_lines", "n_deleted"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    write_ids(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder, end_id=0)
    return read_documents(spark, folder)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lower = F.translate("text", capitals, capitals.lower())
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lower).otherwise(F.col("text"))
    return merkle_manifest(_table(spark, sf_dir, "documents"), tampered)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults by a hash of conversation and turn; ``copies`` says how often a row stands."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("fault"))
    return rows.where("fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("fault") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return repair_report(rows, messages(damaged(rows), copies=F.col("copies")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_sampled_pieces": op2_sampled_pieces,
    "op3_pivot_index": op3_pivot_index,
    "op4_packing": op4_packing,
    "op5_license_scan": op5_license_scan,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_language": op8_language,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_line_dedup": op10_line_dedup,
    "op11_token_files": op11_token_files,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_conversation_repair": op13_conversation_repair,
}

_SPACES = r"[\x20\x09-\x0D]"

_QUALITY_SQL = rf"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT *, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g FROM words
), repeated AS (
  SELECT *, map_from_entries(list_filter(map_entries(coalesce(list_histogram(g), MAP {{}}::MAP(VARCHAR, UBIGINT))), lambda e: e.value > 1)) AS r FROM windows
), counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_distinct(flatten(list_transform(list_filter(range(1, len(g) + 1), lambda i: map_contains(r, g[i])), lambda i: [i, i + 1, i + 2])))) AS BIGINT) AS n_repeat_words
  FROM repeated
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * word_chars
            OR 100 * n_capitals > 30 * word_chars OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_dup_lines > 40 * n_lines) AS kept
FROM counts
"""

_MERKLE_SQL = r"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, text, {leaf_of_text} AS leaf,
         CASE WHEN text IS NULL OR NOT {hit} THEN {leaf_of_text}
              ELSE {leaf_of_lower} END AS found
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size
  FROM hashed WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf)
), trees AS (
  SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
  FROM (SELECT DISTINCT lang FROM leaves)
), placed AS (
  SELECT leaves.*, tree, trees, row_number() OVER () AS row_id FROM leaves JOIN trees ON leaves.lang IS NOT DISTINCT FROM trees.lang
), up AS (
  SELECT tree, 0 AS level, pos, leaf AS node, size FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (size + 7) // 8
  FROM up WHERE size > 1 GROUP BY tree, level, pos // 8, size
), subroots AS (
  SELECT tree, node AS subroot, level AS height FROM up WHERE size = 1
), higher AS (
  SELECT 0 AS level, tree AS pos, subroot AS node, (SELECT count(*) FROM subroots) AS size FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), (size + 7) // 8
  FROM higher WHERE size > 1 GROUP BY level, pos // 8, size
), tops AS (
  SELECT node AS root, level AS height FROM higher WHERE size = 1
), runs AS (
  SELECT tree, level, pos // 8 AS run, list(node ORDER BY pos) AS nodes FROM up WHERE size > 1 GROUP BY tree, level, pos // 8
  UNION ALL
  SELECT o.tree, s.height + o.level, o.run, o.nodes
  FROM subroots s JOIN (
    SELECT t.tree, v.level, v.run, v.nodes FROM trees t JOIN (
      SELECT level, pos // 8 AS run, list(node ORDER BY pos) AS nodes FROM higher WHERE size > 1 GROUP BY level, pos // 8
    ) v ON (t.tree // CAST(pow(8, v.level + 1) AS BIGINT)) = v.run
  ) o ON s.tree = o.tree
), climb AS (
  SELECT row_id, p.tree, 0 AS level, pos, found AS node, '' AS siblings, s.height, tree_pos
  FROM (SELECT *, tree AS tree_pos FROM placed) p JOIN subroots s ON p.tree = s.tree
  UNION ALL
  SELECT row_id, c.tree, c.level + 1,
         CASE WHEN c.level + 1 = c.height THEN c.tree_pos ELSE c.pos // 8 END,
         sha256(array_to_string(nodes[: c.pos % 8] || [node] || nodes[c.pos % 8 + 2 :], '')),
         siblings || array_to_string(nodes[: c.pos % 8] || nodes[c.pos % 8 + 2 :], ''), c.height, c.tree_pos
  FROM (SELECT * REPLACE (CASE WHEN level = 0 AND height = 0 THEN tree_pos ELSE pos END AS pos) FROM climb) c
  JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.pos // 8
), folds AS (
  SELECT row_id, arg_max(node, level) AS folded_root, sha256(arg_max(siblings, level)) AS proof_sha256 FROM climb GROUP BY row_id
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN folds USING (row_id) JOIN subroots USING (tree), tops
"""


def _leaf_sql(text: str) -> str:
    parts = (f"coalesce(strlen({value}) || ':' || {value}, '-')" for value in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text))
    return f"sha256({' || '.join(parts)})"


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: crc32 of short digits, bit by bit, as DuckDB has none.
_CRC_SQL = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
         lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
                                       lambda r, k: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384::BIGINT) ELSE r // 2 END))"""

ORACLE_SQL: dict[str, str] = {
    "op7_quality_rules": _QUALITY_SQL,
    "op12_merkle_manifest": _MERKLE_SQL.format(
        leaf_of_text=_leaf_sql("text"),
        leaf_of_lower=_leaf_sql(f"translate(text, '{_CAPITALS}', '{_CAPITALS.lower()}')"),
        hit=f"coalesce(xor({_CRC_SQL}, 4294967295::BIGINT) % 3 = 0, false)",
    ),
}

"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.llm import fingerprints, licenses, main_text, merkle, mixing, ngram_join, oracles, packing, pii, prefix_trie, quality, suffix_dedup, token_files, url_filter
from ledgermatch.llm.common import WORD, table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), lower=True)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("rate")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_files.write(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return token_files.read(spark, written)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"), ["doc_id"])
    failed = quality.BASE.rejects(rows["fail_bits"])
    return rows.select("doc_id", *quality.MEASURES, failed.alias("base_failed"), (~quality.PRODUCTION.rejects(rows["fail_bits"])).alias("kept"), "fail_bits")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents have no paths; theirs here are source / language / hundred of ids / id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", docs["source"], docs["lang"], (docs["doc_id"] / 100).cast("long"), docs["doc_id"])
    return licenses.scan(docs, path)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_mix_sources, op3_token_files, op4_suffix_array_dedup, op5_ngram_jaccard_join, op6_quality_rules, op7_license_scan, op8_fingerprints, op9_url_filter, op10_pii,
        op11_merkle_manifest, op12_prefix_trie, op13_main_text,
    )
}

_QUALITY = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, COALESCE(text, '') AS text FROM documents
), words AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '{WORD}') AS w FROM docs
), windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)
), repeated AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY rid
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{WORD}') GROUP BY rid
), measured AS (
  SELECT doc_id, len(w) AS n_words, CAST(COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, COALESCE(n_lines, 0) AS n_lines, COALESCE(n_dup_lines, 0) AS n_dup_lines,
    COALESCE(n_repeat_words, 0) AS n_repeat_words, length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations
  FROM words LEFT JOIN repeated USING (rid) LEFT JOIN lines USING (rid)
), failed AS (
  SELECT *, {' + '.join(f"CAST(CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END AS BIGINT)" for r in quality.RULES)} AS fail_bits FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_exclamations,
  (fail_bits & {quality.BASE.reject}) <> 0 AS base_failed, (fail_bits & {quality.PRODUCTION.reject}) = 0 AS kept, fail_bits
FROM failed
"""

_NGRAM = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)
), ways AS (
  SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM words UNION SELECT reach.x, ways.y FROM reach JOIN ways ON reach.y = ways.x
)
SELECT doc_id, COALESCE(n, 0) AS n_shingles, (SELECT min(y) FROM reach WHERE x = doc_id) AS component_id FROM words LEFT JOIN sizes USING (doc_id)
"""

ORACLES: dict[str, str] = {"op5_ngram_jaccard_join": _NGRAM, "op6_quality_rules": _QUALITY, "op7_license_scan": licenses.oracle(), "op9_url_filter": url_filter.oracle()}
ORACLES |= {"op11_merkle_manifest": oracles.merkle(), "op12_prefix_trie": oracles.TRIE, "op13_main_text": oracles.MAIN_TEXT}

"""The corpus pipeline: quality rules, n-gram Jaccard join, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows to the shared folder and reads
them back as the next one's documents.  All stages but the last return the columns of documents.

Defined results, stage by stage: a null or empty text fails the quality rules, so only later stages that are run by themselves see one; they keep it (near duplicates: each such row;
personal data: as it is), except the mix, which takes nothing of a document without words, and packing, where it is the end id alone.  Repeated rows are one document after the
near duplicates, and each copy that the mix takes is a document of its own.  Ties go by id, then by hashes of the text.  Null ids, languages and sources are values like others.  An empty
table gives an empty result with its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.llm import mixing, ngram_join, packing, pii, quality
from ledgermatch.llm.common import cut, release, table
from ledgermatch.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy keeps."""
    return quality.apply_policy(docs, quality.PRODUCTION)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 0.8 or more join, the one with the least id; texts without words link with nothing."""
    return ngram_join.one_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and what discloses it generalised; ``n_chars`` follows the new text where the table has it."""
    cleaned = pii.sanitised(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), lower=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("pii", personal_data),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Newton iterations, tokenization and bin completion are not SQL; the tests hold each stage against a plain version on the rows of the stage before it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir), f"stage-{name}")
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)

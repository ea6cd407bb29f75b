"""What the operators of this subpackage share: the shared scratch folder, written cuts of the lineage, the word pattern."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.sources.scratch import cut as written
from ledgermatch.sources.scratch import path_for as scratch_path
from ledgermatch.sources.scratch import release

__all__ = ["BATCH_BYTES", "WORD", "cut", "named", "release", "scratch_path", "small_batches", "table"]

#: A word: a maximal run of characters other than space and \t-\r.  The same text serves Java, RE2 and Python patterns.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of an Arrow batch to Python workers: whole texts, few at a time, so that a worker's memory doesn't follow the table.
BATCH_BYTES = 8_000_000


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bounds Arrow batches to Python workers by BATCH_BYTES where the session's bound is above it, as long as an action runs."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    now = before.lower().rstrip("b")
    lower = now.isdigit() and int(now) > BATCH_BYTES
    if lower:
        spark.conf.set(name, f"{BATCH_BYTES}b")
    try:
        yield
    finally:
        if lower:
            spark.conf.set(name, before)


def named(docs: DataFrame, key: str, text: str) -> list[Column]:
    """Two longs that name a row by its key and text.  Together they are 128 bits, so that among 10^12 rows no two names agree by chance."""
    return [F.xxhash64(docs[key], docs[text]).alias("h"), F.xxhash64(F.lit(7), docs[text], docs[key], F.length(docs[text])).alias("g")]


def cut(frame: DataFrame, name: str) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads them back: the lineage ends here.

    Unlike a local checkpoint the table outlives executors, and unlike ``checkpoint()`` the rows are computed once.  ``release`` deletes it.
    """
    with small_batches(frame.sparkSession):
        return written(frame, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

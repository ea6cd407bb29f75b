"""Quality of the inputs: fill rates, address completeness, overlap of phones, score and verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.functions.text import address_completeness, junk_address, normalize_phone, valid_phone


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (field, filled, distinct, pct), from one pass over all columns."""
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    aggs = [F.struct(F.lit(c).alias("field"), F.count(F.when(text(c) != "", 1)).alias("filled"), F.count_distinct(F.when(text(c) != "", text(c))).alias("n_distinct")).alias(f"s{i}") for i, c in enumerate(columns)]
    one = df.agg(F.count("*").alias("n"), *aggs)
    rows = one.select("n", F.explode(F.array(*[f"s{i}" for i in range(len(columns))])).alias("s"))
    return rows.select("s.field", "s.filled", "s.n_distinct", F.when(F.col("n") > 0, F.round(F.col("s.filled") / F.nullif(F.col("n"), F.lit(0)) * 100, 2)).otherwise(0.0).alias("pct"))


def address_quality(df: DataFrame, column: str = "address", sample: int = 2000) -> DataFrame:
    """Completeness over a sample of addresses, drawn by hash so that reruns agree; the share of junk is over all rows."""
    drawn = df.select(F.col(column).alias("a")).where(~junk_address(F.col("a"))).orderBy(F.xxhash64("a"), "a").limit(sample)
    mean = drawn.agg(F.round(F.avg(address_completeness(F.col("a"))), 4).alias("completeness"))
    junk = df.agg(F.round(F.avg(F.when(junk_address(F.col(column)), 100.0).otherwise(0.0)), 2).alias("junk_pct"))
    return junk.join(F.broadcast(mean))


def phone_overlap(ours: DataFrame, theirs: DataFrame, our_column: str, their_column: str) -> DataFrame:
    """One row: distinct valid phones of either side and of both."""
    side = lambda df, c: df.select(normalize_phone(F.col(c)).alias("p")).where(valid_phone(F.col("p"))).distinct()
    a, b = side(ours, our_column), side(theirs, their_column)
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(a, "ours").join(F.broadcast(n(b, "theirs"))).join(F.broadcast(n(a.intersect(b), "shared")))


def verdict(fields_missing: int, valid_phone_pct: float, overlap_pct: float, completeness: float, invalid_geometry_pct: float, thin_fields: int) -> tuple[int, str]:
    """The score out of 100 and GO, CAUTION or NO-GO."""
    score = 100 - 30 * fields_missing - 10 * thin_fields
    score -= 15 if valid_phone_pct < 50 else 0
    score -= 30 if overlap_pct < 10 else 15 if overlap_pct < 30 else 0
    score -= 20 if completeness < 0.30 else 0
    score -= 10 if invalid_geometry_pct > 10 else 0
    score = max(0, score)
    return score, "GO" if score >= 70 else "CAUTION" if score >= 40 else "NO-GO"

"""Quality rules as a ledger of failure bits.

Each text is measured once and each rule is evaluated once; the ledger keeps the measurements and one long in
which bit ``b`` says that rule ``b`` failed.  Policies (versioned masks) and ablations then read bits alone:
no text is touched again, and an ablation is a count over the few distinct bit patterns.

Defined results: a null or empty text has no words and every measurement is 0, so it fails ``few_words``.
Repeated rows are measured row by row.  An empty table gives an empty ledger.  Other columns pass through unless a
ledger column has their name, in which case the ledger's wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.common import WORD

_WORD = re.compile(WORD)
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclamations")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements, in whole numbers, so that every engine agrees on it."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "duplicate_lines", "n_dup_lines >= 5 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule(5, "exclamations", "100 * n_exclamations > 30 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """Rejects a document with any bit of ``reject``; ``version`` tells revisions of one policy apart."""

    name: str
    version: int
    reject: int

    def rejects(self, bits: Column) -> Column:
        return bits.bitwiseAND(F.lit(self.reject)) != 0


def mask(*names: str, rules: tuple[Rule, ...] = RULES) -> int:
    by_name = {r.name: 1 << r.bit for r in rules}
    return sum(by_name[n] for n in names)


BASE = Policy("base", 1, mask("few_words", "repeated_windows"))
PRODUCTION = Policy("production", 1, mask(*(r.name for r in RULES)))
POLICIES = {(p.name, p.version): p for p in (BASE, PRODUCTION)}


def measure_text(text: str | None) -> tuple[int, ...]:
    """The MEASURES of one text."""
    if not text:
        return (0,) * len(MEASURES)
    words = _WORD.findall(text)
    n = len(words)
    repeated = 0
    if n >= 4:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(seen := set(windows)) < len(windows):
            counts = Counter(windows) if len(seen) > 1 else {windows[0]: len(windows)}
            reach = 0  # the first position not yet counted
            for i, w in enumerate(windows):
                if counts[w] > 1:
                    repeated += i + 3 - max(reach, i)
                    reach = i + 3
    lines = Counter(x for x in text.split("\n") if _WORD.search(x))
    n_lines = sum(lines.values())
    return (n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), n_lines, n_lines - len(lines), repeated, text.count("!"))


def _measured(batches: Iterator[pa.RecordBatch], text_at: int, drop: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure_text(t.as_py()) for t in batch.column(text_at)]
        columns = zip(*rows, strict=True) if rows else [()] * len(MEASURES)
        kept = [(batch.schema.field(i), batch.column(i)) for i in range(batch.num_columns) if i != text_at or not drop]
        added = [(pa.field(name, pa.int64()), pa.array(c, pa.int64())) for name, c in zip(MEASURES, columns, strict=True)]
        yield pa.RecordBatch.from_arrays([a for _, a in kept + added], schema=pa.schema([f for f, _ in kept + added]))


def ledger(docs: DataFrame, keep: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: the columns ``keep``, the MEASURES and ``fail_bits``."""
    from pyspark.sql import types as T

    keep = [c for c in dict.fromkeys(keep) if c not in (*MEASURES, "fail_bits")]
    rows = docs.select(*keep, docs[text].alias("__text"))
    schema = T.StructType([f for f in rows.schema if f.name != "__text"] + [T.StructField(m, T.LongType()) for m in MEASURES])
    at = len(keep)
    return _with_bits(rows.mapInArrow(lambda batches: _measured(batches, at, True), schema), rules)


def _with_bits(measured: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits + F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long")
    return measured.withColumn("fail_bits", bits)


def apply_policy(docs: DataFrame, policy: Policy = PRODUCTION, text: str = "text") -> DataFrame:
    """The documents that the policy keeps, with their own columns unchanged."""
    from pyspark.sql import types as T

    cols = docs.columns
    at = cols.index(text)
    renamed = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(cols)])
    schema = T.StructType([*renamed.schema, *[T.StructField(m, T.LongType()) for m in MEASURES]])
    judged = _with_bits(renamed.mapInArrow(lambda batches: _measured(batches, at, False), schema), RULES)
    return judged.where(~policy.rejects(F.col("fail_bits"))).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])


def ablation(rows: DataFrame, policy: Policy = PRODUCTION, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of the policy: documents that fail it, documents that fail it alone (a policy without it would keep them).

    Works on counts per distinct bit pattern, of which there are at most 2 ** len(rules).
    """
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.reject)).alias("bits")).agg(F.count("*").alias("n"))
    parts = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.lit(1 << r.bit)) != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.lit(1 << r.bit), F.col("n"))), F.lit(0)).alias("n_only"),
        )
        for r in rules
        if policy.reject >> r.bit & 1
    ]
    return patterns.agg(F.array(*parts).alias("a")).select(F.explode("a").alias("r")).select("r.*")

"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions alone.

A sketch is the ascending array of the k least distinct hashes of a text's five-word shingles.  Sketches of parts merge into
the sketch of the whole, and two sketches estimate resemblance, containment and the number of distinct shingles.

Defined results: words are lower-cased in A-Z only.  A text of one to four words has one shingle; a null or empty
text has an empty sketch.  Two empty sketches resemble each other fully, an empty and a filled one not at all.  Sets of fewer
than k shingles are compared exactly.  Repeated rows get equal sketches; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.llm.common import WORD

K = 128
WIDTH = 5
#: Hashes keep 48 bits: no sign, so numbers and fixed-width hex sort alike.
HASH_BITS = 48
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def shingle_hashes(words: Column, width: int = WIDTH) -> Column:
    """Hashes of all shingles of an array of words, repeats included."""
    masked = lambda h: h.bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    each = F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: masked(F.xxhash64(*[F.get(words, i + k) for k in range(width)])))
    return F.when(F.size(words) >= width, each).when(F.size(words) > 0, F.array(masked(F.xxhash64(words)))).otherwise(F.array().cast("array<bigint>"))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return bottom(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both sketches hold."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact under k."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float((k - 1) << HASH_BITS)) / F.element_at(a, -1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    inside = resemblance(a, b, k) * distinct_count(merge(a, b, k), k) / distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), inside))


def digest(a: Column) -> Column:
    """A sketch as text: base64 of its hashes, 48 bits each, big-endian."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), HASH_BITS // 4, "0")), "")))


def sketch(frame: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """Adds the sketch of column ``text`` as column ``name``."""
    made = frame.withColumn("__words", words_of(F.col(text)))
    return made.withColumn(name, bottom(shingle_hashes(F.col("__words")), k)).drop("__words")


def corpus_sketch(frame: DataFrame, sketches: str, by: list[str], k: int = K) -> DataFrame:
    """Merges sketches of groups.  Each group's least k distinct hashes are found by rank, not gathered in one array."""
    hashes = frame.select(*by, F.explode(sketches).alias("x")).distinct()
    ranked = hashes.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("x"))).where(F.col("r") <= k)
    return ranked.groupBy(*by).agg(F.sort_array(F.collect_list("x")).alias(sketches))


def with_next(docs: DataFrame, key: str, columns: list[str], parts: int | None = None, derive: Callable[[DataFrame], DataFrame] = lambda df: df, derived: Sequence[str] = ()) -> DataFrame:
    """Adds ``next_<c>`` for each column: its value in the next row by descending key (null last), the last row's next being the first.

    ``derive`` adds the columns ``derived``, functions of the others, once a row; they get their ``next_<c>`` too.

    Rows are dealt to ranges of the key; the first row of each range, a row a range, is put behind the range before it, so that
    one window over ranges suffices.  Rows of one key follow each other by a hash of ``columns``, equal rows in any order; a key or a row that fills more than a range is dealt out by
    the hash, then by row.  Keys are numbers, texts or anything else that has an order.
    """
    spark = docs.sparkSession
    parts = parts or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the last tells equal rows apart; only its spread matters, so it may be another one each time
    rows = docs.select(F.col(key), *columns).withColumns({"__h": F.xxhash64(*columns), "__r": F.xxhash64(F.monotonically_increasing_id())})
    rows = rows.withColumn("__b", _dealt(rows, key, parts))
    heads = rows.groupBy("__b").agg(F.max(F.struct(F.col(key).alias("k"), F.col("__h").alias("h"))).alias("head"))
    # a row a range from here on
    order = Window.orderBy(F.col("__b").asc())
    heads = heads.withColumn("to", F.coalesce(F.lead("__b").over(order), F.min("__b").over(Window.partitionBy())))
    heads = heads.select(F.col("__b").alias("hb"), F.col("head.k").alias("hk"), F.col("head.h").alias("hh"), "to")
    behind = rows.join(F.broadcast(heads), (F.col("__b") == F.col("hb")) & F.col(key).eqNullSafe(F.col("hk")) & (F.col("__h") == F.col("hh")))
    behind = behind.dropDuplicates(["__b"]).select(key, *columns, "__h", "__r", F.col("to").alias("__b"), F.lit(1).alias("__last"))
    window = Window.partitionBy("__b").orderBy(F.col("__last"), F.col(key).desc_nulls_last(), F.col("__h").desc(), F.col("__r").desc())
    both = derive(rows.withColumn("__last", F.lit(0)).unionByName(behind))
    led = both.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in (*columns, *derived)])
    return led.where(F.col("__last") == 0).drop("__h", "__r", "__b", "__last")


#: Keys drawn, for each range, where keys are no numbers.
DRAWN = 100


def _cuts(rows: DataFrame, key: str, parts: int) -> list:
    """Keys that cut the rows into about ``parts`` ranges: approximate quantiles of numbers, those of a bounded draw of other keys.

    A key that is several of the quantiles gets a range of its own, up to the next number or text.
    """
    some, kind = rows.where(F.col(key).isNotNull()).select(key), rows.schema[key].dataType
    if isinstance(kind, T.NumericType):
        found = [float(x) for x in some.select(F.col(key).cast("double").alias("x")).approxQuantile("x", [i / parts for i in range(1, parts)], 1 / (20 * parts))]
        after = lambda x: math.nextafter(x, math.inf)
    else:
        drawn = sorted(r[0] for r in some.orderBy(F.xxhash64(F.monotonically_increasing_id())).limit(DRAWN * parts).collect())
        found = [drawn[i * len(drawn) // parts] for i in range(1, parts)] if drawn else []
        after = lambda x: x + "\0" if isinstance(kind, T.StringType) else x
    return sorted({*found, *(after(x) for x, n in Counter(found).items() if n > 1)})


def _dealt(rows: DataFrame, key: str, parts: int) -> Column:
    """The range of a row, as a struct in ascending order of key (null first), hash and row.

    Ranges of one key that hold over twice their share are cut by the hash, at even steps and around each hash that alone holds more than a share; what is one hash
    then is cut by ``__r``.  All cuts together are a few times ``parts``.
    """
    cuts = _cuts(rows, key, parts)
    found = F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x <= F.col(key))) if cuts else F.lit(0)
    b = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(found)
    held = rows.withColumn("b", b)
    sizes = held.groupBy("b").agg(F.count("*").alias("n"), F.min(key).eqNullSafe(F.max(key)).alias("one")).collect()
    share = max(1, sum(r.n for r in sizes) // parts)
    crowded = {r.b: r.n for r in sizes if r.one and r.n > 2 * share}
    none = F.lit(0).cast("long")
    if not crowded:
        return F.struct(b.alias("b"), none.alias("s"), none.alias("t"))
    heavy: dict[int, dict[int, int]] = {k: {} for k in crowded}
    for r in held.where(F.col("b").isin(*crowded)).groupBy("b", "__h").agg(F.count("*").alias("n")).where(F.col("n") > share).collect():
        heavy[r.b][r["__h"]] = r.n
    steps, spread = {}, {}
    for k, n in crowded.items():
        m = -(-n // share)
        steps[k] = sorted({-(2**63) + i * 2**64 // m for i in range(1, m)} | set(heavy[k]) | {h + 1 for h in heavy[k] if h + 1 < 2**63})
        spread |= {(k, sum(c <= h for c in steps[k])): -(-n_h // share) for h, n_h in heavy[k].items()}
    by_b = F.create_map(*[x for k, v in steps.items() for x in (F.lit(k), F.array(*[F.lit(c).cast("long") for c in v]))])
    s = F.when(b.isin(*crowded), F.size(F.filter(F.element_at(by_b, b), lambda c: c <= F.col("__h")))).otherwise(0).cast("long")
    t: Column = none
    for (k, at), m in spread.items():
        t = F.when((b == k) & (s == at), F.floor((F.col("__r") / F.lit(2.0**64) + 0.5) * m).cast("long")).otherwise(t)
    return F.struct(b.alias("b"), s.alias("s"), t.alias("t"))


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many of the next document.
    """
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(rows, key, ["text"], derive=lambda df: sketch(df, "text", "own", k), derived=["own"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select(key, n.cast("long").alias("n_chars"), edited.alias("edited"), "own", "next_own")
    rows = sketch(rows, "edited", "edited_own", k)
    return rows.select(
        key,
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("own")).alias("fingerprint"),
        digest(F.col("edited_own")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("edited_own"), k).alias("near_edited"),
        resemblance(F.col("own"), F.col("next_own"), k).alias("near_next"),
    )

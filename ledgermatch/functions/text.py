"""Normalising text and identifiers: Column expressions, so that they stay inside code generation."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Fixed values, in the order in which they apply: honorifics that become a space wherever they occur.
HONORIFICS = (
    "shri ", "smt ", "smt. ", "mr ", "mr. ", "mrs ", "mrs. ", "dr ", "dr. ", "s/o ", "w/o ", "d/o ", "c/o ", "sh ", "sh. ", "late ", "ms ", "ms. ",
    "s/o", "w/o", "d/o", "c/o",
)

#: Fixed values, in order: address words and their replacements.
ADDRESS_WORDS = (
    ("house number", "house no"), ("h no", "house no"), ("hno", "house no"), ("ward number", "ward"), ("street number", "street"),
    ("road number", "road"), ("rd", "road"), ("mohala", "mohalla"), ("mohallaa", "mohalla"),
)

#: Fixed values, in order: house number patterns over upper case.
HOUSE_PATTERNS = (r"(SHOP[\-\s]?\d+[A-Z]*)", r"(SCO[\-\s]?\d+[A-Z]*)", r"(MC[\-\s]?\d+[A-Z]*)", r"(\d+[A-Z]?\/?\d*)")

#: What separates a holder from a relative, in order.
RELATIONS = (" S/O ", " s/o ", " W/O ", " w/o ", " D/O ", " d/o ", " C/O ", " c/o ")

#: Blanks of the source tables.
SENTINELS = ("NA", "None", "0", "nan", "N/A", "")

#: Entries of an exemption column that mean "not exempt".
NOT_EXEMPT = ("", "na", "n/a", "none", "null", "0", "no", "n", "false", "taxable", "taxable property")

#: Placeholder addresses.
JUNK_ADDRESSES = (
    "na", "n/a", "nil", "none", "-", "--", "...", ".", "same", "same as above", "test", "abc", "xyz", "dummy", "temp", "null", "unknown", "not available",
    "address", "no address",
)
#: Numbers that stand for no number.
JUNK_PHONES = ("1234567890", "0123456789", "9876543210")
#: What names the parts of an address, over lower case.
ADDRESS_PARTS = {
    "house_no": r"(?:h\.?\s*no\.?|house\s*no\.?|plot\s*no\.?|flat\s*no\.?|door\s*no\.?|khasra\s*no\.?)\s*[-:.]?\s*(\S+)",
    "house_no_plain": r"^(\d+[/-]?\d*[a-z]?)\s*[,\s]",
    "building": "apartment|society|complex|tower|bhawan|mansion|plaza|arcade|court|residency|enclave|villa",
    "street": "road|rd|street|st|gali|marg|lane|path|cross|main|chowk|bazaar|bazar|market|mandi",
    "locality": "nagar|colony|mohalla|pura|basti|vihar|kunj|enclave|sector|phase|block|ward|wala|park|garden",
    "ward": r"(?:ward|zone|circle|block)\s*[-:.]?\s*(\d+)",
}

#: Punctuation that becomes a space.
PUNCTUATION = ",.\\-/()';:\"_#|"


def blank(c: Column) -> Column:
    """'' for null and the sources' sentinels, else the trimmed text."""
    t = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(t.isin(*SENTINELS), F.lit("")).otherwise(t)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_phone(c: Column) -> Column:
    """Digits alone, the last ten where there are more; one trailing ``.0`` of a number read as a float goes first."""
    digits = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), r"\.0$", ""), "[^0-9]", "")
    return F.right(digits, F.lit(10))


def valid_phone(c: Column) -> Column:
    return c.rlike("^[6-9][0-9]{9}$")


def junk_phone(c: Column) -> Column:
    """Blank, at most two distinct digits, a well-known filler, or no mobile number."""
    distinct = F.size(F.array_distinct(F.filter(F.split(c, ""), lambda x: x != "")))
    return (c == "") | (distinct <= 2) | c.isin(*JUNK_PHONES) | ~valid_phone(c)


def normalize_name(c: Column) -> Column:
    lowered = F.trim(F.lower(F.coalesce(c.cast("string"), F.lit(""))))
    without = reduce(lambda acc, h: F.replace(acc, F.lit(h), F.lit(" ")), HONORIFICS, lowered)
    return squeeze(F.regexp_replace(without, r"(?U)[^\p{L}\p{N}_\s]", " "))


def normalize_locality(c: Column, city: str = "") -> Column:
    out = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    if city:
        out = F.regexp_replace(out, rf"(?U)\b\Q{city.lower()}\E\b", " ")
    out = F.regexp_replace(out, r"(?U)\bblock\s*\d+[a-z]?\b", " ")
    return squeeze(F.regexp_replace(out, r"(?U)[^\p{L}\p{N}_\s]", " "))


@F.pandas_udf(StringType())
def nfkd(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unicode compatibility decomposition; Spark has no function for it."""
    for s in parts:
        yield s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def clean_text(c: Column, decompose: bool = False) -> Column:
    """Lower case, punctuation to spaces, single spaces.  ``decompose`` adds NFKD, the only part that leaves the JVM."""
    lowered = F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))
    lowered = nfkd(lowered) if decompose else lowered
    return squeeze(F.translate(lowered, PUNCTUATION, " " * len(PUNCTUATION)))


def normalize_address(c: Column, decompose: bool = False) -> Column:
    return squeeze(reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), ADDRESS_WORDS, clean_text(c, decompose)))


def house_number(c: Column) -> Column:
    """The first house number pattern that hits, or ''."""
    upper = F.upper(F.coalesce(c.cast("string"), F.lit("")))
    return F.coalesce(*[F.nullif(F.regexp_extract(upper, p, 1), F.lit("")) for p in HOUSE_PATTERNS], F.lit(""))


def clean_identifier(c: Column) -> Column:
    upper = F.regexp_replace(F.upper(F.trim(F.coalesce(c.cast("string"), F.lit("")))), r"\.0$", "")
    return F.translate(upper, "-/_ ", "")


def tokenize(c: Column) -> Column:
    """Words of two characters or more, of a cleaned text."""
    return F.filter(F.split(clean_text(c), " "), lambda x: F.length(x) >= 2)


def words(c: Column) -> Column:
    """Distinct words of a normalised name."""
    return F.array_distinct(F.filter(F.split(c, " "), lambda x: x != ""))


def first_word(c: Column, least: int = 3) -> Column:
    """The first word if it is long enough, else null."""
    w = F.get(F.split(c, " "), F.lit(0))
    return F.when(F.length(w) >= least, w)


def holder(c: Column) -> Column:
    """struct(owner, relative): a meter's holder split at the first relation in list order."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    out = F.struct(F.trim(text).alias("owner"), F.lit("").alias("relative"))
    for sep in reversed(RELATIONS):
        at = F.instr(text, sep)
        split = F.struct(F.trim(F.substring_index(text, sep, 1)).alias("owner"), F.trim(F.substring(text, at + len(sep), F.length(text))).alias("relative"))
        out = F.when(at > 0, split).otherwise(out)
    return out


def present_status(c: Column) -> Column:
    t = F.upper(F.trim(F.coalesce(c.cast("string"), F.lit(""))))
    return (
        F.when(t == "", "UNKNOWN")
        .when(t.rlike("VAC|PLOT|VANC"), "VACANT")
        .when(t.rlike("BUIL|BUIT|BIU|TIN SHED|UNDER CONSTRUCT|RESIDENTIAL|SINGLE OWNER"), "BUILT_UP")
        .when(t.contains("GREEN"), "GREEN_BELT")
        .when(t.contains("PARK"), "PARK")
        .when(t.contains("NON"), "NON_PRODUCTIVE")
        .otherwise("OTHER")
    )


def exempt(c: Column) -> Column:
    return ~F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("")))).isin(*NOT_EXEMPT)


def confidence_level(score: Column) -> Column:
    return F.when(score >= 95, "VERY HIGH").when(score >= 90, "HIGH").when(score >= 80, "MEDIUM").when(score >= 70, "LOW").otherwise("VERY LOW")


def junk_address(c: Column) -> Column:
    t = F.lower(F.trim(F.coalesce(c.cast("string"), F.lit(""))))
    return t.isin(*JUNK_ADDRESSES) | (F.length(t) < 3) | t.rlike("^[0-9]{1,5}$")


@F.pandas_udf(StringType())
def nfc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for p in parts:
        yield p.str.normalize("NFC")


def clean_address(c: Column) -> Column:
    """Composed characters, separators as single spaces.  Only texts with a combining mark go to Python to be composed."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    composed = F.coalesce(nfc(F.when(text.rlike(r"\p{M}"), text)), text)
    return F.trim(F.regexp_replace(composed, r"[\s,;:\-./]+", " "))


def duplicated_address(c: Column) -> Column:
    """Whether the parts between wide gaps are all one text; a text without such gaps is no repetition."""
    parts = F.split(F.coalesce(c.cast("string"), F.lit("")), r"\s{2,}")
    said = F.array_distinct(F.filter(F.transform(parts, lambda p: F.lower(F.trim(p))), lambda p: p != ""))
    return (F.size(parts) >= 2) & (F.size(said) == 1)


def address_components(c: Column) -> Column:
    """struct of flags: what an address names."""
    a = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    has = lambda name: a.rlike(ADDRESS_PARTS[name])
    return F.struct((has("house_no") | has("house_no_plain")).alias("house_no"), *[has(k).alias(k) for k in ("building", "street", "locality", "ward")])


def address_completeness(c: Column) -> Column:
    parts = address_components(c)
    weight = lambda name, w: F.when(parts[name], F.lit(w)).otherwise(F.lit(0.0))
    return F.round(weight("ward", 0.05) + weight("locality", 0.45) + weight("street", 0.25) + weight("house_no", 0.25), 2)


def full_address(address: Column, locality: Column, road: Column | None = None) -> Column:
    return F.trim(F.concat_ws(" ", address, locality, *([] if road is None else [road])))

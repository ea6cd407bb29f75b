"""Similarity of names, addresses and vectors.  All but the edit score are Column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgermatch.functions.text import words

#: Features of the weighted score and their weights.
WEIGHTS = {"address": 25, "owner": 15, "locality": 10, "house_number": 15, "owner_tokens": 10, "address_tokens": 5, "survey": 10, "old_property": 5, "guardian": 10}


def token_set_ratio(a: Column, b: Column) -> Column:
    """Jaccard of the word sets of two normalised texts, in percent, cut to a whole number; 0 if either is blank."""
    return word_ratio(words(a), words(b))


def word_ratio(x: Column, y: Column) -> Column:
    """The same of two arrays of distinct words."""
    shared = F.size(F.array_intersect(x, y))
    ratio = (shared / (F.size(x) + F.size(y) - shared) * 100).cast("int")
    return F.when((F.size(x) > 0) & (F.size(y) > 0), ratio).otherwise(F.lit(0))


def token_overlap(x: Column, y: Column) -> Column:
    """Shared tokens over the larger set, in percent, of two arrays."""
    a, b = F.array_distinct(x), F.array_distinct(y)
    most = F.greatest(F.size(a), F.size(b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.round(F.size(F.array_intersect(a, b)) / most * 100, 2)).otherwise(F.lit(0.0))


def exact_match(a: Column, b: Column) -> Column:
    x, y = F.lower(F.trim(F.coalesce(a, F.lit("")))), F.lower(F.trim(F.coalesce(b, F.lit(""))))
    return F.when((x != "") & (x == y), F.lit(100.0)).otherwise(F.lit(0.0))


def best_name_score(owner: Column, guardian: Column, owners: Column, guardians: Column, other_owner: Column, other_guardian: Column) -> Column:
    """struct(score, tag): owner, all owners, guardian, all guardians, then the mean of owner and guardian if both reach 50; a later
    one wins on a greater score alone.

    All names are normalised.  Normalising a list of names turns its pipes into spaces, so all owners (or guardians) are one set of words.
    """
    return best_words_score(*map(words, (owner, guardian, owners, guardians, other_owner, other_guardian)))


def best_words_score(owner: Column, guardian: Column, owners: Column, guardians: Column, other_owner: Column, other_guardian: Column) -> Column:
    """The same of arrays of distinct words."""
    o, ao = word_ratio(owner, other_owner), word_ratio(owners, other_owner)
    g, ag = word_ratio(guardian, other_guardian), word_ratio(guardians, other_guardian)
    both = F.when((o >= 50) & (g >= 50), ((o + g) / 2).cast("int")).otherwise(F.lit(0))
    best = F.greatest(o, ao, g, ag, both)
    tag = F.when(best == 0, "").when(o == best, "OWNER_MATCH").when(ao == best, "ALL_OWNERS_MATCH").when(g == best, "GUARDIAN_MATCH").when(ag == best, "ALL_GUARDIANS_MATCH").otherwise("OWNER+GUARDIAN_COMBINED")
    return F.struct(best.alias("score"), tag.alias("tag"))


def name_tier(o: Column, g: Column) -> Column:
    """struct(value, tag) by owner and guardian scores, null below every tier."""
    tier = lambda value, tag: F.struct(value.cast("int").alias("value"), F.lit(tag).alias("tag"))
    return (
        F.when((o >= 60) & (g >= 60), tier(o + g, "VERIFIED_BOTH"))
        .when((o >= 75) & (g >= 30), tier(o + g, "VERIFIED_OWNER+GUARD"))
        .when((g >= 75) & (o >= 30), tier(o + g, "VERIFIED_GUARD+OWNER"))
        .when(F.greatest(o, g) >= 90, tier(F.greatest(o, g), "STRONG_SINGLE"))
    )


def meter_tier(o: Column, g: Column) -> Column:
    tier = lambda value, tag: F.struct(value.cast("int").alias("value"), F.lit(tag).alias("tag"))
    return (
        F.when((o >= 60) & (g >= 60), tier(o + g, "ELEC_BOTH"))
        .when((o >= 80) & (g >= 30), tier(o + g, "ELEC_OWNER+GUARD"))
        .when(o >= 90, tier(o, "ELEC_OWNER_STRONG"))
    )


def weighted_score(scores: dict[str, Column], weights: dict[str, int] = WEIGHTS) -> Column:
    """The weighted mean over the features that scored at all, two decimals."""
    live = {k: F.when(s > 0, F.lit(weights[k])).otherwise(F.lit(0)) for k, s in scores.items()}
    total, mass = sum(live.values(), F.lit(0)), sum((F.when(s > 0, s * weights[k]).otherwise(F.lit(0.0)) for k, s in scores.items()), F.lit(0.0))
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(mass / F.when(total != 0, total), 2))


def cosine(a: Column, b: Column) -> Column:
    """Inner product of two unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def token_sort_score(a: str | None, b: str | None) -> float:
    """Of the words in order, 100 * 2 * common subsequence / both lengths."""
    x, y = " ".join(sorted((a or "").split())), " ".join(sorted((b or "").split()))
    return 200.0 * common_subsequence(x, y) / (len(x) + len(y)) if x and y else 0.0


#: Bits of a machine word: texts up to this length are compared many at once.
WORD = 64


def _points(texts: list[str]) -> np.ndarray:
    """Code points of texts, padded by zeros."""
    width = max(map(len, texts), default=0) or 1
    return np.array(texts, dtype=f"<U{width}").view(np.uint32).reshape(len(texts), width)


def common_subsequences(a: list[str], b: list[str]) -> np.ndarray:
    """``common_subsequence`` of pairs of texts of at most WORD characters without a NUL: a machine word is a row of each pair's table, and all pairs go on by one character at once."""
    x, y = _points(a), _points(b)
    most = max(x.max(initial=0), y.max(initial=0))
    code = np.zeros(int(most) + 1, dtype=np.int64)
    code[x], code[y], code[0] = 1, 1, 0
    code = np.cumsum(code) * code  # padding is 0
    x, y = code[x].T, code[y].T
    lengths = np.fromiter(map(len, a), dtype=np.uint64, count=len(a))
    out = np.empty(len(a), dtype=np.int64)
    step = max(1, (1 << 22) // (int(code.max()) + 1))
    for at in range(0, len(a), step):
        u, w, n = x[:, at : at + step], y[:, at : at + step], lengths[at : at + step]
        every = np.arange(len(n))
        where = np.zeros((len(n), int(code.max()) + 1), dtype=np.uint64)
        for i in range(int(n.max(initial=0))):
            where[every, u[i]] |= np.uint64(1 << i)
        where[:, 0] = 0
        row = np.full(len(n), np.iinfo(np.uint64).max)
        for j in range(len(w)):
            hit = row & where[every, w[j]]
            row = (row + hit) | (row - hit)
        used = np.where(n >= WORD, np.iinfo(np.uint64).max, (np.uint64(1) << np.minimum(n, np.uint64(WORD - 1))) - np.uint64(1))
        out[at : at + step] = n.astype(np.int64) - np.bitwise_count(row & used)
    return out


def token_sort_scores(a: pd.Series, b: pd.Series) -> np.ndarray:
    """``token_sort_score`` of pairs; equal pairs are scored once."""
    x, ours = pd.factorize(a.fillna(""))
    y, theirs = pd.factorize(b.fillna(""))
    in_order = lambda texts: [" ".join(sorted(t.split())) for t in texts]
    ours, theirs = in_order(ours), in_order(theirs)
    pairs, back = np.unique(x * np.int64(len(theirs) + 1) + y, return_inverse=True)
    p, q = [ours[i] for i in pairs // (len(theirs) + 1)], [theirs[i] for i in pairs % (len(theirs) + 1)]
    score = np.zeros(len(pairs))
    short = [i for i, (s, t) in enumerate(zip(p, q, strict=True)) if 0 < len(s) <= WORD and 0 < len(t) <= WORD and "\0" not in s and "\0" not in t]
    if short:
        s, t = [p[i] for i in short], [q[i] for i in short]
        score[short] = 200.0 * common_subsequences(s, t) / np.array([len(u) + len(w) for u, w in zip(s, t, strict=True)])
    for i in sorted(set(range(len(pairs))) - set(short)):
        score[i] = token_sort_score(p[i], q[i])
    return score[back]


@F.pandas_udf(DoubleType())
def token_sort_ratio(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """``token_sort_score`` of cleaned texts; equal pairs of a batch are scored once.  Score distinct pairs and join back."""
    for a, b in parts:
        yield pd.Series(token_sort_scores(a, b), dtype="float64")

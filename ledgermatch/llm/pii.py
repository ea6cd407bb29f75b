"""Personal data: base patterns, and terms that the corpus shows to reveal what the patterns found, in DataFrame functions alone.

Base spans (emails, IP addresses, payment cards, phone numbers) are protected entities.  Information-theoretic sanitisation then
looks at the words of the texts that hold them.  For an entity e and a word t in a text with it the corpus gives

    IC(e) = log2(N / n_e)    PMI(t; e) = log2(N * c_te / (c_t * n_e))

with N distinct texts, n_e of them with e, c_t with t, and c_te with both.  A word discloses e if PMI(t; e) >= ``disclosure`` * IC(e):
whoever reads it learns nearly all of e.  Exact copies of a text are one text in every count; texts that differ at all are several.

In few texts many words are rare by chance alone.  So a word counts only if chance would hardly make any word like it: with M(c) words in c texts, the expected
number of words of t's frequency that fall into c_te of the n_e texts, were they spread at random, is at most

    chance(t; e) = M(c_t) * 2 ** (c_t * H(c_te / c_t)) * (n_e / N) ** c_te

(H is the binary entropy; the power of two bounds the ways to choose c_te of c_t texts), and t is judged if that is at most ``chance``, so the bound on false
disclosures is that many per entity and frequency.  Of a word that stands in a text with e as a name, with a capital inside a sentence, M counts only words that do so somewhere.
The rule is the same for entities in one text and in a million, for any script and any place in the sentence.  An entity in one text has evidence only where
words in one text are themselves rare.  Disclosing words are spans of the kind ``term`` in every document that holds e.

Defined results: null and empty texts have no spans.  Positions are code points, ends exclusive.  Base matches of a kind are leftmost and
do not overlap; those that fail their check are dropped and not tried again.  Repeated rows get equal spans.  An
empty table gives an empty result.  Texts are told apart by their MD5.  A word is two letters or more, with marks, apostrophes or hyphens inside, and no part of an
address or number; words are the same if their lower-case forms are, of whatever length those are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, release

#: Each stands for the plain pattern in the comment.  Possessive repeats and lookbehinds keep Java's matcher from recursing and
#: from trying again inside a run that has failed; the matches are the same.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What every base span has.
HINT = r"@|[0-9]\.[0-9]|(?:[0-9][\x20-]?){13}|\+[0-9]"
KINDS = (*PATTERNS, "term")
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
DISCLOSURE, CHANCE = 0.95, 0.1
SPREAD = 16
#: A word with a capital after a letter, digit, comma or semicolon and one space: inside a sentence, so written as a name.
NAME = r"(?<=[\p{L}\p{M}\p{N},;][ ])\p{Lu}[\p{L}\p{M}'-]+(?<=[\p{L}\p{M}])(?![\p{L}\p{M}\p{N}@_]|[\p{L}\p{N}._%+-]*+@)"
TERM = r"(?<![\p{L}\p{M}\p{N}@._+-])\p{L}[\p{L}\p{M}'-]+(?<=[\p{L}\p{M}])(?![\p{L}\p{M}\p{N}@_]|[\p{L}\p{N}._%+-]*+@)"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)
    at = lambda i: F.substring(back, i, F.lit(1)).cast("int")
    value = lambda i: F.when(i % 2 == 1, at(i)).otherwise(F.when(at(i) > 4, at(i) * 2 - 9).otherwise(at(i) * 2))
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        n = F.length(_digits(match))
        return F.when(n.between(13, 19), luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _matches(kind: str, text: Column) -> Column:
    """All matches of a kind, in order: gap before it (characters), the match."""
    pattern = F.lit(PATTERNS[kind])
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    return F.zip_with(found, F.slice(parts, 1, F.size(found)), lambda m, p: F.struct(F.length(p).alias("gap"), m.alias("match")))


def _text_name(docs: DataFrame, text: str) -> Column:
    return F.md5(F.coalesce(docs[text].cast("string"), F.lit(""))).alias("th")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans).  rows: rid, key, th (names the text); spans: rid, th, k (the kind's place), start, end, entity, for base spans that hold."""
    clean = F.coalesce(F.col("t"), F.lit(""))
    # a cheap look before each kind's passes
    hint = {"email": clean.contains("@"), "ip": clean.rlike(r"[0-9]\.[0-9]"), "card": clean.rlike("[0-9][ -]?[0-9]"), "phone": clean.contains("+")}
    found = [F.when(hint[k], _matches(k, clean)).alias(k) for k in PATTERNS]
    named = docs.select(docs[key].alias("key"), _text_name(docs, text), docs[text].cast("string").alias("t"))
    rows = cut(named.select(F.monotonically_increasing_id().alias("rid"), "key", "th", *found), "pii-rows")
    each = None
    for i, k in enumerate(PATTERNS):
        one = rows.select("rid", "th", F.lit(i).alias("k"), F.posexplode(k).alias("at", "m"))
        each = one if each is None else each.union(one)
    order = Window.partitionBy("rid", "k").orderBy("at")
    end = F.sum(F.col("m.gap") + F.length("m.match")).over(order)
    placed = each.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.length("m.match"))
    holds = F.lit(False)
    for i, k in reversed(list(enumerate(PATTERNS))):
        holds = F.when(F.col("k") == i, _holds(k, F.col("m.match"))).otherwise(holds)
    entity = F.concat_ws(":", F.col("k"), F.when(F.col("k").isin(2, 3), _digits(F.col("m.match"))).otherwise(F.lower("m.match")))
    spans = placed.where(holds).select("rid", "th", "k", "start", "end", entity.alias("entity"))
    return rows.select("rid", "key", "th"), cut(spans, "pii-spans")


def _terms(text: Column, pattern: str = TERM) -> Column:
    """Distinct words that may disclose something, lower-cased."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lower))


def _most_texts(n: int, n_e: Column, disclosure: float) -> Column:
    """In how many texts a word may be that discloses an entity of n_e texts: from PMI >= disclosure * IC and c_te <= n_e."""
    return F.floor(n_e * F.pow(F.lit(float(n)) / n_e, F.lit(1.0 - disclosure)) + 1e-9)


def _chance(n: int, m: Column, c_t: Column, n_e: Column, c_te: Column) -> Column:
    """The bound of the module's text, as a power of two."""
    share = c_te / c_t
    entropy = F.when(c_te >= c_t, F.lit(0.0)).otherwise(-share * F.log2(share) - (1 - share) * F.log2(1 - share))
    return F.log2(m) + c_t * entropy + c_te * F.log2(n_e / F.lit(float(n)))


def scores(docs: DataFrame, spans: DataFrame, text: str = "text", disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """Rows (entity, term, n, n_e, c_t, c_te, content, pmi, chance) of the words that chance doesn't explain and that are rare enough to disclose, by counts over
    all distinct texts.
    """
    holders = spans.select("th", "entity").distinct()
    held = cut(holders.join(holders.groupBy("entity").agg(F.count("*").alias("n_e")), "entity"), "pii-held")
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    # texts that can't hold an entity are counted, but stay out of the join with entities
    # a name that TERM doesn't take for a word (there's an address sign before it) is none
    # words travel as one spaced text, which takes half the room of an array
    texts = docs.select(_text_name(docs, text), F.array_join(_terms(body), " ").alias("terms"), F.array_join(F.array_intersect(_terms(body, NAME), _terms(body)), " ").alias("names"), body.rlike(HINT).alias("maybe"))
    kept = texts = cut(texts.dropDuplicates(["th"]), "pii-texts")
    n = texts.count()
    of = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    texts = texts.select("th", "maybe", of("terms").alias("terms"), of("names").alias("names"))
    words = cut(texts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("c_t")), "pii-words")
    named = texts.select(F.explode("names").alias("term")).distinct().join(words, "term")
    # rows by frequency: no more than the square root of twice all words' counts
    like = words.groupBy("c_t").agg(F.count("*").alias("m_all")).join(named.groupBy("c_t").agg(F.count("*").alias("m_named")), "c_t", "left")
    most = held.groupBy("th").agg(F.max(_most_texts(n, F.col("n_e"), disclosure)).alias("most"))
    # only words that are rare enough for some entity of their text meet the entities
    own = F.transform("terms", lambda t: F.struct(t.alias("term"), F.array_contains("names", t).alias("name")))
    inside = texts.where("maybe").join(most, "th").select("th", "most", F.explode(own).alias("w")).select("th", "most", "w.*")
    # most words are in one text, so frequencies are dealt out SPREAD times
    like = like.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    rare = inside.join(words, "term").where(F.col("c_t") <= F.col("most")).withColumn("deal", F.pmod(F.xxhash64("th", "term"), F.lit(SPREAD)).cast("int")).join(like, ["c_t", "deal"]).drop("most", "deal")
    c, e = F.col("c_t"), F.col("n_e")
    m = F.when(F.col("name"), F.col("m_named")).otherwise(F.col("m_all"))
    able = (c <= _most_texts(n, e, disclosure)) & (_chance(n, m, c, e, F.least(c, e)) <= F.log2(F.lit(chance)))
    together = rare.join(held, "th").where(able).groupBy("entity", "n_e", "term", "c_t").agg(F.count("*").alias("c_te"), F.min(m).alias("m"))
    content = F.log2(F.lit(float(n)) / e)
    pmi = F.log2(F.lit(float(n)) * F.col("c_te") / (c * e))
    judged = together.select("entity", "term", F.lit(n).cast("long").alias("n"), "n_e", "c_t", "c_te", content.alias("content"), pmi.alias("pmi"), F.pow(F.lit(2.0), _chance(n, F.col("m"), c, e, F.col("c_te"))).alias("chance"))
    made = cut(judged.where(F.col("chance") <= chance), "pii-scores")
    release(held, kept, words)
    return made


def disclosing(docs: DataFrame, spans: DataFrame, text: str = "text", disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """Rows (entity, term): words of the texts with an entity that reveal it."""
    judged = scores(docs, spans, text, disclosure, chance)
    return judged.where((F.col("content") > 0) & (F.col("pmi") >= F.lit(disclosure) * F.col("content"))).select("entity", "term")


def term_spans(docs: DataFrame, spans: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """Spans (th, k, start, end) of disclosing words in the texts that hold the entity, by the places of the words themselves."""
    wanted = spans.select("th", "entity").distinct().join(terms, "entity").groupBy("th").agg(F.collect_set("term").alias("terms"))
    texts = docs.select(_text_name(docs, text), docs[text].cast("string").alias("t")).join(wanted, "th").dropDuplicates(["th"])
    found = texts.select("th", "terms", F.split("t", TERM, -1).alias("parts"), F.regexp_extract_all("t", F.lit(TERM), F.lit(0)).alias("found"))
    pieces = F.zip_with("found", F.slice("parts", 1, F.size("found")), lambda w, p: F.struct(F.length(p).alias("gap"), F.length(w).alias("n"), F.array_contains("terms", F.lower(w)).alias("hit")))
    each = found.select("th", F.posexplode(pieces).alias("at", "m"))
    end = F.sum(F.col("m.gap") + F.col("m.n")).over(Window.partitionBy("th").orderBy("at")).cast("long")
    return each.withColumn("end", end).where("m.hit").select("th", F.lit(len(PATTERNS)).alias("k"), (F.col("end") - F.col("m.n")).alias("start"), "end")


def spans_of(docs: DataFrame, key: str = "doc_id", text: str = "text", disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """Per row: key, th (names the text) and spans, an array of (k, start, end) in order: base kinds, then terms."""
    rows, spans = find(docs, key, text)
    terms = disclosing(docs, spans, text, disclosure, chance)
    base = spans.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("k", "start", "end"))).alias("base"))
    more = term_spans(docs, spans, terms, text).groupBy("th").agg(F.sort_array(F.collect_set(F.struct("k", "start", "end"))).alias("more"))
    none = F.array().cast("array<struct<k:int,start:bigint,end:bigint>>")
    joined = rows.join(base, "rid", "left").join(more, "th", "left")
    return joined.select(F.col("key").alias(key), "th", F.concat(F.coalesce("base", none), F.coalesce("more", none)).alias("spans"))


def _shown(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["start"], s["end"])), ",")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, counts of base spans, base_sha256, spans and n_term."""
    made = spans_of(docs, key, text)
    count = lambda i: F.size(F.filter("spans", lambda s: s["k"] == i)).cast("long")
    base = F.filter("spans", lambda s: s["k"] < len(PATTERNS))
    return made.select(key, *[count(i).alias(f"n_{k}") for i, k in enumerate(PATTERNS)], F.sha2(_shown(base), 256).alias("base_sha256"), _shown(F.col("spans")).alias("spans"), count(len(PATTERNS)).alias("n_term"))


def sanitised(docs: DataFrame, key: str = "doc_id", text: str = "text", disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """The documents with each span generalised to its kind in brackets; spans that overlap become one, of the first one's kind.

    Rows without spans are unchanged.
    """
    cols = docs.columns
    found = spans_of(docs, key, text, disclosure, chance).where(F.size("spans") > 0)
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["k"].alias("k"))))
    found = cut(found.select("th", by_start.alias("s")).dropDuplicates(["th"]), "pii-found")
    rows = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(cols)], _text_name(docs, text)).join(found, "th", "left")
    body = F.col(f"c{cols.index(text)}")
    names = F.array(*[F.lit(k) for k in KINDS])
    # fold the spans, in order of start: text so far, and where the next piece begins
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(F.substring(body, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), F.get(names, s["k"]), F.lit("]"))
        return F.struct(F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(new))).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    folded = F.aggregate("s", start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(body, (acc["at"] + 1).cast("int"), F.length(body))))
    new_text = F.when(F.col("s").isNull(), body).otherwise(folded)
    return rows.select(*[(new_text if c == text else F.col(f"c{i}")).alias(c) for i, c in enumerate(cols)])

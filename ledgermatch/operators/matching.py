"""The match cascade: direct ids, phones, meters, names and localities.  Every layer sees the rows that layers before it left.

Rows: a register has pid, row_idx and its fields; parcels have uid, row_idx and theirs.  A layer returns at most one match a pid:
pid, matched_uid, match_method, confidence.  All ties are broken by rows' order, so results don't depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.functions.similarity import best_words_score, meter_tier, name_tier, token_set_ratio, word_ratio
from ledgermatch.functions.text import clean_identifier, first_word, junk_phone, normalize_locality, normalize_phone, words

#: (parcel column, register column, label), in order of precedence.
DIRECT_IDS = (("uid", "surveyid", "DIRECT_SURVEY_ID"), ("uid_old", "oldpropertyid", "DIRECT_OLD_UID"), ("property_id", "propertyid", "DIRECT_PROPERTY_ID"), ("uid_old", "surveyid", "DIRECT_OLD_UID"))


def best(df: DataFrame, key: str, score: Column, ties: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Per key the row of the greatest score, among equals the first by ``ties``: an aggregation, so it combines before it shuffles."""
    order = F.struct((-score).alias("s"), *[t.alias(f"t{i}") for i, t in enumerate(ties)], F.struct(*columns).alias("row"))
    return df.groupBy(key).agg(F.min(order).alias("b")).select(key, "b.row.*")


def direct_ids(register: DataFrame, parcels: DataFrame, passes: Sequence[tuple[str, str, str]] = DIRECT_IDS) -> DataFrame:
    """Equal cleaned identifiers.  The last parcel with an id wins it; a pid takes its earliest pass, in it its first row."""
    made = []
    for i, (theirs, ours, label) in enumerate(passes):
        p = parcels.select(clean_identifier(F.col(theirs)).alias("id"), F.col("uid").alias("matched_uid"), F.col("row_idx").alias("p")).where(F.col("id") != "")
        p = p.groupBy("id").agg(F.max_by("matched_uid", "p").alias("matched_uid"))
        r = register.select("pid", clean_identifier(F.col(ours)).alias("id"), F.col("row_idx").alias("r")).where(F.col("id") != "")
        made.append(r.join(p, "id").select("pid", "matched_uid", "r", F.lit(label).alias("match_method"), F.lit(i).alias("pass")))
    every = reduce(DataFrame.unionByName, made)
    out = best(every, "pid", F.lit(0), [F.col("pass"), F.col("r")], ["matched_uid", "match_method"])
    return out.withColumn("confidence", F.lit(100.0))


def phone_numbers(df: DataFrame, columns: Sequence[str]) -> Column:
    """All normalised numbers of the columns, split at pipes."""
    parts = F.flatten(F.array(*[F.split(F.coalesce(F.col(c), F.lit("")), r"\|") for c in columns]))
    return F.filter(F.transform(parts, normalize_phone), lambda x: x != "")


def phones(register: DataFrame, parcels: DataFrame, ours: Sequence[str] = ("mobileno", "all_mobilenos"), theirs: Sequence[str] = ("mobile", "mobile2"), most: int = 5, name_score: int = 40) -> DataFrame:
    """Equal phone numbers.  One parcel: a match.  Several: the best name, ``+NAME`` from ``name_score``, else ``_WEAK``; none if no name agrees.

    A number that parcels hold more than ``most`` times is nobody's.  The counts are also what keeps the join small: no number has
    more than ``most`` parcels.
    """
    names = parcels.select("uid", "row_idx", words(F.col("owner_n")).alias("o"), words(F.col("guardian_n")).alias("g"), phone_numbers(parcels, theirs).alias("phones"))
    held = names.select("uid", "row_idx", "o", "g", F.explode("phones").alias("phone")).where(~junk_phone(F.col("phone")))
    held = held.withColumn("n", F.count("*").over(Window.partitionBy("phone"))).where(F.col("n") <= most)
    asked = register.select("pid", *_name_words(register), F.explode(F.array_distinct(phone_numbers(register, ours))).alias("phone")).where(~junk_phone(F.col("phone")))
    pairs = asked.join(held, "phone").select("pid", *NAMES, "uid", "row_idx", "o", "g").distinct()
    score = best_words_score(*[F.col(n) for n in NAMES], F.col("o"), F.col("g"))["score"]
    scored = pairs.withColumn("score", score).groupBy("pid").agg(F.count_distinct("uid").alias("n"), F.min(F.struct((-F.col("score")).alias("s"), "row_idx", "uid")).alias("b"))
    score = -F.col("b.s")
    method = F.when(F.col("n") == 1, "TEXT_MOBILE").when(score >= name_score, "TEXT_MOBILE+NAME").otherwise("TEXT_MOBILE_WEAK")
    return scored.where((F.col("n") == 1) | (score > 0)).select("pid", F.col("b.uid").alias("matched_uid"), method.alias("match_method"), score.cast("double").alias("confidence"))


def meter_candidates(register: DataFrame, meters: DataFrame) -> DataFrame:
    """The best meter of each pid: first words block, tiers score.  Meters: meter_idx, owner_n, relative_n and their place.

    Each pair of names is compared once, whatever the claims and meters that have it; of meters of one pair the first speaks.  Every tier takes a ratio of 60 or more of the owners,
    so beside the first word they share one of the longest words of each, and a common first word alone brings nothing together.
    """
    asked = register.select("owner_n", "guardian_n").distinct()
    asked = asked.withColumn("w", F.explode(F.array_distinct(F.array(first_word(F.col("owner_n")), first_word(F.col("guardian_n")))))).where(F.col("w").isNotNull())
    asked = asked.withColumn("p", F.explode(_first(words(F.col("owner_n")))))
    held = meters.groupBy(F.col("owner_n").alias("mo"), F.col("relative_n").alias("mr")).agg(F.min(F.struct("meter_idx", "x", "y")).alias("m"))
    held = held.select("mo", "mr", "m.*", first_word(F.col("mo")).alias("w"), F.explode(_first(words(F.col("mo")))).alias("p")).where(F.col("w").isNotNull())
    owner, relative = token_set_ratio(F.col("owner_n"), F.col("mo")), F.when(F.col("mr") != "", token_set_ratio(F.col("guardian_n"), F.col("mr"))).otherwise(0)
    scored = asked.join(held, ["w", "p"]).select(F.struct("owner_n", "guardian_n").alias("names"), "meter_idx", "x", "y", owner.alias("so"), relative.alias("sg"))
    scored = scored.withColumn("tier", meter_tier(F.col("so"), F.col("sg")))
    # no filter on the tier below the aggregation: it would work out both ratios again for each of the tier's branches
    order = F.struct((-F.col("tier.value")).alias("s"), "meter_idx", F.struct("meter_idx", "tier", "x", "y").alias("row"))
    found = scored.groupBy("names").agg(F.min(F.when(F.col("tier").isNotNull(), order)).alias("b")).where(F.col("b").isNotNull()).select("names", "b.row.*")
    return register.select("pid", F.struct("owner_n", "guardian_n").alias("names")).join(found, "names").drop("names")


def crosswalk(ours: DataFrame, theirs: DataFrame, least: float = 0.7) -> DataFrame:
    """Localities of the two sides whose words agree: rows (locality, other).  Blocked by shared word, so no cross product."""
    split = lambda df, c, n: df.select(F.col(c).alias(n)).where(F.col(c) != "").distinct().withColumn(f"{n}_w", words(F.col(n)))
    a, b = split(ours, "locality_n", "locality"), split(theirs, "locality_n", "other")
    shared = a.select("locality", F.size("locality_w").alias("size"), F.explode("locality_w").alias("w")).join(b.select("other", F.explode("other_w").alias("w")), "w")
    return shared.groupBy("locality", "other", "size").agg(F.count("*").alias("n")).where(F.col("n") / F.col("size") >= least).select("locality", "other")


def names_and_localities(register: DataFrame, parcels: DataFrame, pairs: DataFrame, most: int | None = None, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> DataFrame:
    """Within a locality and those of ``pairs``, the best name tier among all parcels, ties in order of exactness, locality and row.

    The owner's score is the better of the owner and all owners, the guardian's of the guardian and all guardians.

    ``most`` takes only the first parcels of a locality in that order; without it none is left out.  Names of few words meet by the words they share: a score follows from what is shared and how
    many words there are, so of the parcels of equal shared words and sizes the first speaks, and a common name doesn't bring each claim together with each parcel.  Pairs with a longer name are
    compared one by one.
    """
    own = register.select(F.col("locality_n").alias("locality")).where(F.col("locality") != "").distinct().select("locality", F.col("locality").alias("other"), F.lit(0).alias("far"))
    reach = own.unionByName(pairs.where(F.col("locality") != F.col("other")).withColumn("far", F.lit(1)))
    held = parcels.select("uid", F.col("row_idx").alias("p"), F.col("owner_n").alias("o"), F.col("guardian_n").alias("g"), F.col("locality_n").alias("other"))
    near = reach.join(held, "other").withColumn("r", F.row_number().over(Window.partitionBy("locality").orderBy("far", "other", "p")))
    if most is not None:
        near = near.where(F.col("r") <= most)
    # of parcels of one locality and names the first speaks
    near = near.groupBy("locality", "o", "g").agg(F.min(F.struct("r", "uid", "far")).alias("first"))
    near = keep(near.select("locality", "first.*", words(F.col("o")).alias("o"), words(F.col("g")).alias("g")), "near")
    # claims of equal names in one locality are one question
    texts = [c for c in _NAME_TEXTS if c in register.columns]
    every = register.select("pid", F.col("locality_n").alias("locality"), *[F.coalesce(c, F.lit("")).alias(c) for c in texts])
    asked = every.select("locality", *texts).distinct().join(near.select("locality").distinct(), "locality", "left_semi")
    asked = asked.select("locality", *texts, *_name_words(every)).where(F.size("w_owner") + F.size("w_guardian") > 0)
    asked = keep(asked.select(F.struct("locality", *texts).alias("names"), "locality", *NAMES), "asked")
    # columns of their own, and no filter on the tier below the aggregation: both would work out the ratios again for each of the tier's branches
    scored = _by_shared_words(asked, near).unionByName(_one_by_one(asked, near)).select("names", "r", "uid", "far", name_tier(F.col("so"), F.col("sg")).alias("tier"))
    order = F.struct((-F.col("tier.value")).alias("s"), "r", F.struct(F.col("uid").alias("matched_uid"), "r", "tier", "far").alias("row"))
    found = keep(scored.groupBy("names").agg(F.min(F.when(F.col("tier").isNotNull(), order)).alias("b")).where(F.col("b").isNotNull()).select("names.*", "b.row.*"), "named")
    method = F.concat(F.lit("TEXT_NAME_"), F.col("tier.tag"), F.when(F.col("far") == 1, "_CROSSWALK").otherwise(""))
    rows = every.join(found, ["locality", *texts]).select("pid", "r", "matched_uid", method.alias("match_method"), F.col("tier.value").alias("value"))
    rows = rows.withColumn("confidence", F.col("value").cast("double"))
    return best(rows, "pid", F.col("value"), [F.col("r")], ["matched_uid", "match_method", "confidence"])


#: Names of up to so many words meet by all the sets of words they share: 92 at most of a parcel's owner and guardian.
FEW = 4


def _few(*sets: str) -> Column:
    return F.greatest(F.lit(0), *[F.size(s) for s in sets]) <= FEW


def _parts(words_: Column) -> Column:
    """All sets of some of few words: structs of their text, their number and the number of all."""
    in_order, n = F.array_sort(words_), F.size(words_)
    some = lambda mask: F.filter(in_order, lambda w, i: F.getbit(mask, i) == 1)
    every = F.transform(F.sequence(F.lit(1), F.pow(F.lit(2), n).cast("int") - 1), lambda mask: F.struct(F.array_join(some(mask), " ").alias("s"), F.bit_count(mask).alias("k"), n.alias("n")))
    return F.when(n.between(1, FEW), every).otherwise(F.array().cast("array<struct<s:string,k:int,n:int>>"))


def _shared(owners: Column, guardians: Column) -> Column:
    """What a tier may take of the parts of the owners' and the guardians' words: 60 percent of one and 30 of the other, or 90 of one alone."""
    holds = lambda x, percent: x["k"] * 100 >= x["n"] * percent
    row = lambda x, y: F.struct(x["s"].alias("s"), x["k"].alias("sk"), x["n"].alias("sn"), y["s"].alias("t"), y["k"].alias("tk"), y["n"].alias("tn"))
    none = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"), F.lit(0).alias("n"))
    weak = F.filter(guardians, lambda y: holds(y, 30))
    both = F.flatten(F.transform(F.filter(owners, lambda x: holds(x, 30)), lambda x: F.transform(F.filter(weak, lambda y: holds(x, 60) | holds(y, 60)), lambda y: row(x, y))))
    alone = F.concat(F.transform(F.filter(owners, lambda x: holds(x, 90)), lambda x: row(x, none)), F.transform(F.filter(guardians, lambda y: holds(y, 90)), lambda y: row(none, y)))
    return F.array_distinct(F.concat(both, alone))


def _by_shared_words(asked: DataFrame, near: DataFrame) -> DataFrame:
    """Names of few words on both sides: scores by sets of shared words and sizes, of whose parcels the first speaks.  A set that leaves out some of what is shared scores less than the whole of it, so the best score is exact."""
    theirs = near.where(_few("o", "g")).select("locality", F.struct("r", "uid", "far").alias("parcel"), F.explode(_shared(_parts(F.col("o")), _parts(F.col("g")))).alias("x"))
    theirs = theirs.groupBy("locality", F.col("x.s").alias("s"), F.col("x.t").alias("t"), F.col("x.sn").alias("on"), F.col("x.tn").alias("gn")).agg(F.min("parcel").alias("first"))
    either = lambda a, b: F.concat(_parts(F.col(a)), _parts(F.col(b)))
    ours = asked.where(_few(*NAMES)).select("names", "locality", F.explode(_shared(either("w_owner", "w_owners"), either("w_guardian", "w_guardians"))).alias("x")).select("names", "locality", "x.*")
    ratio = lambda k, n, m: F.when(F.col(k) > 0, (F.col(k) / (F.col(n) + F.col(m) - F.col(k)) * 100).cast("int")).otherwise(F.lit(0))
    return ours.join(theirs, ["locality", "s", "t"]).select("names", "first.*", ratio("sk", "sn", "on").alias("so"), ratio("tk", "tn", "gn").alias("sg"))


def _one_by_one(asked: DataFrame, near: DataFrame) -> DataFrame:
    """The pairs with a longer name on either side.  Every tier takes a ratio of 60 or more of the owners or the guardians: such sets share one of the first words of each, in an order common to both."""
    theirs = F.array_union(_marked("o", _first(F.col("o"))), _marked("g", _first(F.col("g"))))
    near = near.withColumns({"few": _few("o", "g"), "w": F.explode(theirs)})
    ours = F.array_union(_marked("o", _first(F.col("w_owner")), _first(F.col("w_owners"))), _marked("g", _first(F.col("w_guardian")), _first(F.col("w_guardians"))))
    asked = asked.withColumn("few", F.explode(F.when(_few(*NAMES), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))).withColumn("w", F.explode(ours))
    owner = F.greatest(word_ratio(F.col("w_owner"), F.col("o")), word_ratio(F.col("w_owners"), F.col("o")))
    guardian = F.greatest(word_ratio(F.col("w_guardian"), F.col("g")), word_ratio(F.col("w_guardians"), F.col("g")))
    return asked.join(near, ["locality", "few", "w"]).select("names", "r", "uid", "far", owner.alias("so"), guardian.alias("sg"))


#: Normalised names of a register; the lists of all owners and guardians may be missing.
_NAME_TEXTS = ("owner_n", "guardian_n", "owners_n", "guardians_n")
NAMES = ("w_owner", "w_guardian", "w_owners", "w_guardians")


def _name_words(register: DataFrame) -> list[Column]:
    """Words of the owner, the guardian and, where the register has them, of all owners and all guardians."""
    columns = dict(zip(NAMES, _NAME_TEXTS, strict=True))
    return [(words(F.col(c)) if c in register.columns else F.array().cast("array<string>")).alias(n) for n, c in columns.items()]


def _first(words_: Column, percent: int = 60) -> Column:
    """The words of a set, longest first, that a set of this ratio or more can't miss all of: n - ceil(ratio * n) + 1."""
    by_length = F.reverse(F.sort_array(F.transform(words_, lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))))
    n = F.size(words_)
    return F.when(n > 0, F.transform(F.slice(by_length, 1, n - F.ceil(n * percent / 100).cast("int") + 1), lambda x: x["w"])).otherwise(F.array().cast("array<string>"))


def _marked(side: str, *sets: Column) -> Column:
    return F.transform(F.flatten(F.array(*sets)), lambda w: F.concat(F.lit(side + ":"), w))


def prepared(df: DataFrame, owner: str, guardian: str, locality: str, city: str = "") -> DataFrame:
    """Adds owner_n, guardian_n and locality_n (of the parsed locality where the table has one), and owners_n and guardians_n of all_ownernames
    and all_guardiannames where it has them."""
    from ledgermatch.functions.text import normalize_name

    place = "parsed_locality" if "parsed_locality" in df.columns else locality
    added = {"owner_n": normalize_name(F.col(owner)), "guardian_n": normalize_name(F.col(guardian)), "locality_n": normalize_locality(F.col(place), city)}
    lists = {"owners_n": "all_ownernames", "guardians_n": "all_guardiannames"}
    return df.withColumns(added | {n: normalize_name(F.col(c)) for n, c in lists.items() if c in df.columns})


def cascade(register: DataFrame, layers: Sequence[Callable[[DataFrame], DataFrame]], keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Runs layers in order, each over the rows whose pid no layer before it matched, and unites their matches.

    ``keep`` may write a layer's matches and read them back, so that the plan doesn't grow with the layers.
    """
    found: DataFrame | None = None
    for i, layer in enumerate(layers):
        left = register if found is None else register.join(found.select("pid"), "pid", "left_anti")
        made = layer(left).select("pid", "matched_uid", "match_method", "confidence")
        made = keep(made, f"layer-{i}") if keep else made
        found = made if found is None else found.unionByName(made)
    assert found is not None
    return found


def phone_coverage(register: DataFrame, column: str = "mobileno") -> Column:
    """Share of rows whose phone has ten characters or more."""
    return F.avg(F.when(F.length(F.trim(F.coalesce(F.col(column), F.lit("")))) >= 10, 1.0).otherwise(0.0))


def matches_of(geocoded: DataFrame, mode: str = "memory") -> DataFrame:
    """A geocoded table as matches.  ``memory``: raw scores, the first row of a pid, coordinates needed; ``file``: scores of a
    hundred, the last row, no coordinates needed.  Rows of locality centroids carry no uid and drop out."""
    usable = ~F.lower(F.trim(F.coalesce("Matched_UID", F.lit("")))).isin("", "nan", "none") & ~F.coalesce("Match_Type", F.lit("")).isin("", "UNMATCHED", "LOCALITY_CENTROID") & (F.coalesce("pid", F.lit("")) != "")
    rows = geocoded.where(usable)
    if mode == "memory":
        rows = rows.where(F.col("Latitude").isNotNull() & F.col("Longitude").isNotNull())
    by = F.col("row_idx").asc() if mode == "memory" else F.col("row_idx").desc()
    score = F.col("Match_Score") if mode == "memory" else F.col("Match_Score") / 100
    first = rows.withColumn("__r", F.row_number().over(Window.partitionBy("pid").orderBy(by))).where("__r = 1")
    return first.select("pid", F.col("Matched_UID").alias("matched_uid"), F.concat(F.lit("GEOAI_"), "Match_Type").alias("match_method"), score.alias("confidence"))

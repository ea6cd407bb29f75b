"""The layers of the match cascade that place a claim: by a meter's position, and by its address.

Both take what ``matching`` takes and add columns of their own.  All ties are broken by rows' order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.functions import geo, text
from ledgermatch.functions.similarity import exact_match, token_overlap, token_set_ratio, token_sort_ratio, weighted_score
from ledgermatch.operators import vector_index, vector_scan
from ledgermatch.operators.matching import best, direct_ids, meter_candidates
from ledgermatch.operators.polygons import covered, points_in_polygons
from ledgermatch.operators.spatial import confirmations, largest_overlaps
from ledgermatch.operators.vectors import gram_vectors

Keep = Callable[[DataFrame, str], DataFrame]
#: Cells of the index that a search of addresses looks into; the tests measure its recall.
PROBES = 16


def _as_is(frame: DataFrame, name: str) -> DataFrame:
    return frame


# --- meters -----------------------------------------------------------------------------------------------------------------


def within_bounds(meters: DataFrame, register: DataFrame, margin: float = 0.05) -> DataFrame:
    """Meters inside the bounds of the register's places, widened by ``margin`` degrees; all of them where the register has no places."""
    if not {"latitude", "longitude"} <= set(register.columns):
        return meters
    known = register.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    ends = {f"__{c[:3]}_{n}": f(c) for c in ("latitude", "longitude") for n, f in (("least", F.min), ("most", F.max))}
    bounds = known.agg(*[e.alias(n) for n, e in ends.items()])
    inside = lambda c: F.col(c).between(F.col(f"__{c[:3]}_least") - margin, F.col(f"__{c[:3]}_most") + margin)
    rows = meters.join(F.broadcast(bounds)).where(F.col("__lat_least").isNull() | (inside("latitude") & inside("longitude")))
    return rows.drop(*ends)


def prepared_meters(meters: DataFrame, zone: int) -> DataFrame:
    """Meters (meter_idx, name, latitude, longitude) with the holder's and the relative's normalised names and a place in metres.

    ``plain_n`` is the holder up to the first ' S/O ' alone: what a parcel's owner is held against when the meter stands beside the parcel.
    """
    h = text.holder(F.col("name"))
    at = geo.wgs84_to_utm(F.col("latitude"), F.col("longitude"), F.lit(zone))
    return meters.select(
        "meter_idx", text.normalize_name(h["owner"]).alias("owner_n"), text.normalize_name(h["relative"]).alias("relative_n"),
        text.normalize_name(F.substring_index(F.coalesce("name", F.lit("")), " S/O ", 1)).alias("plain_n"), at["easting"].alias("x"), at["northing"].alias("y"),
        "latitude", "longitude", (F.coalesce("account", F.lit("")) if "account" in meters.columns else F.lit("")).alias("account"), F.coalesce("name", F.lit("")).alias("holder"),
    )


def meter_layer(register: DataFrame, meters: DataFrame, parcels: DataFrame, radius: float = 30.0, least: int = 40, keep: Keep = _as_is, made: DataFrame | None = None) -> DataFrame:
    """A claim's best meter by name, and the parcel that it stands in; else the parcel that takes most of a disc of ``radius`` around it, if
    the names agree by ``least``.

    Register: pid, owner_n, guardian_n.  Meters: as ``prepared_meters`` makes them.  Parcels: uid, row_idx, owner_n, rings.  A claim whose
    best meter has no place gets no match.  Each meter is placed once, however many claims it has.  ``made`` is the parcels' cover, if it is there.
    """
    found = keep(meter_candidates(register, meters).select("pid", "meter_idx", F.col("tier.tag").alias("tag")), "meter-claims")
    placed = meters.where(F.col("x").isNotNull() & F.col("y").isNotNull()).join(found.select("meter_idx").distinct(), "meter_idx", "left_semi")
    placed = placed.select("meter_idx", "plain_n", "x", "y")
    inside = keep(points_in_polygons(placed, parcels, lambda df: keep(df, "parcels-cover"), "meter_idx", made).select("meter_idx", "uid"), "meters-inside")
    outside = placed.join(inside, "meter_idx", "left_anti")
    owners = parcels.groupBy("uid").agg(F.min_by("owner_n", "row_idx").alias("owner_n"))
    beside = largest_overlaps(outside, parcels, radius, "meter_idx").join(outside.select("meter_idx", "plain_n"), "meter_idx").join(owners, "uid")
    beside = beside.where(token_set_ratio(F.col("plain_n"), F.col("owner_n")) >= least)
    how = inside.select("meter_idx", "uid", F.lit("ELEC_PIP_").alias("how")).unionByName(beside.select("meter_idx", "uid", F.lit("ELEC_BUFFER_").alias("how")))
    return found.join(how, "meter_idx").select("pid", F.col("uid").alias("matched_uid"), F.concat("how", "tag").alias("match_method"), F.lit(0.0).alias("confidence"))


def meter_evidence(register: DataFrame, left: DataFrame, meters: DataFrame, parcels: DataFrame, matches: DataFrame, keep: Keep = _as_is) -> tuple[DataFrame, DataFrame]:
    """(matches of the meter layer, parcels that meters confirm as occupied).

    The layer takes the claims ``left`` by the layers before it and the meters within the bounds of the register's places; a parcel that no layer matched and that any
    meter stands in is occupied (``spatial.confirmations``).  Meters: as ``prepared_meters`` makes them, with latitude, longitude, account and holder.
    """
    made = keep(covered(parcels), "parcels-cover")
    found = keep(meter_layer(left, within_bounds(meters, register), parcels, keep=keep, made=made), "meter-matches")
    matched = matches.select("matched_uid").unionByName(found.select("matched_uid"))
    return found, confirmations(meters.select("meter_idx", "x", "y", "account", "holder"), parcels, matched, lambda df: keep(df, "meters-cover"), made)


# --- addresses --------------------------------------------------------------------------------------------------------------

FEATURES = ("owner", "guardian", "locality", "address", "house", "owner_tokens", "address_tokens", "survey", "old")


def addressed(df: DataFrame, owner: str, guardian: str, locality: str, address: str, survey: str, old: str, road: str | None = None, decompose: bool = True) -> DataFrame:
    """Adds ``f_...`` for what the score compares, and ``full``, the text that the vectors stand for.  Null texts are ''."""
    clean = lambda c: text.clean_text(F.col(c), decompose)
    place = text.normalize_address(F.col(address), decompose)
    df = df.withColumns({"f_owner": clean(owner), "f_guardian": clean(guardian), "f_locality": clean(locality), "f_address": place})
    df = df.withColumns({
        "f_house": text.house_number(F.col("f_address")), "f_owner_tokens": text.tokenize(F.col("f_owner")), "f_address_tokens": text.tokenize(F.col("f_address")),
        "f_survey": text.clean_identifier(F.col(survey)), "f_old": text.clean_identifier(F.col(old)),
    })
    return df.withColumn("full", text.full_address(F.col("f_address"), F.col("f_locality"), None if road is None else clean(road)))


def address_scores(a: str = "a", b: str = "b") -> dict[str, Column]:
    """The scores of two structs of features, for ``weighted_score``.

    The guardian is the best of guardian and guardian, guardian and owner, owner and guardian, as sources swap them.
    """
    ours, theirs = (lambda n: F.col(f"{a}.f_{n}")), (lambda n: F.col(f"{b}.f_{n}"))
    fuzzy = lambda x, y: token_sort_ratio(ours(x), theirs(y))
    return {
        "address": fuzzy("address", "address"), "owner": fuzzy("owner", "owner"), "locality": fuzzy("locality", "locality"), "house_number": exact_match(ours("house"), theirs("house")),
        "owner_tokens": token_overlap(ours("owner_tokens"), theirs("owner_tokens")), "address_tokens": token_overlap(ours("address_tokens"), theirs("address_tokens")),
        "survey": exact_match(ours("survey"), theirs("survey")), "old_property": exact_match(ours("old"), theirs("old")),
        "guardian": F.greatest(fuzzy("guardian", "guardian"), fuzzy("guardian", "owner"), fuzzy("owner", "guardian")),
    }


def like_localities(names: DataFrame, localities: DataFrame, least: float = 75.0) -> DataFrame:
    """For each distinct ``f_locality`` the known locality of the best word-sorted ratio, from ``least``; the first of equals.

    Localities: locality, row_idx, x, y.  A ratio of r percent needs lengths in a proportion of r / (200 - r) or more, so lengths are the key of
    the join, and texts of other lengths never meet.
    """
    share = least / (200 - least)
    n = F.length("f_locality")
    lengths = F.sequence(F.ceil(n * share).cast("int"), F.floor(n / share).cast("int"))
    asked = names.select("f_locality").where(n > 0).distinct().withColumn("n", F.explode(lengths))
    known = localities.where(F.col("locality") != "").withColumn("n", F.length("locality"))
    scored = asked.join(known, "n").withColumn("ratio", token_sort_ratio("f_locality", "locality")).where(F.col("ratio") >= least)
    return best(scored, "f_locality", F.col("ratio"), [F.col("row_idx")], ["x", "y"])


def by_address(
    register: DataFrame, parcels: DataFrame, localities: DataFrame, k: int = 20, sure: float = 80.0, likely: float = 70.0, encode: Callable[[Column], Column] = gram_vectors, keep: Keep = _as_is, probes: int | None = None
) -> DataFrame:
    """The best of the ``k`` parcels whose addresses' vectors are nearest: pid, uid, type, latitude, longitude, score, owner and locality.

    From ``sure`` TOP5_WEIGHTED, from ``likely`` TOP10_WEIGHTED, below it the centre of the locality most like the claim's (no uid), if there is one.
    Parcels without an owner are no candidates, but take their places among the ``k``.  Equal addresses are searched once, on both sides: the ``k`` nearest parcels are among those
    of the ``k`` nearest addresses, each known by its first parcel.  The search is exact (``vector_scan``).  With ``probes`` it goes through an index of
    the parcels' vectors instead, and looks into the cells of that many centroids.
    """
    asked = keep(register.groupBy("full").agg(F.min("row_idx").alias("vec_id")), "addresses")
    place = Window.partitionBy("full").orderBy("row_idx")
    held = keep(parcels.select("full", F.col("row_idx").alias("parcel"), F.min("row_idx").over(place).alias("match_id"), F.row_number().over(place).alias("at")).where(F.col("at") <= k), "places")
    embedded = lambda df: df.select("vec_id", encode(F.col("full")).alias("embedding"))
    ours, theirs = embedded(asked), embedded(held.where("at = 1").select("full", F.col("match_id").alias("vec_id")))
    step = lambda df: keep(df, "index")
    found = vector_scan.top_k(ours, theirs, keep, k) if probes is None else vector_index.search(vector_index.build(theirs, step), ours, step, k, probes)
    found = keep(found.select(F.col("query_id").alias("vec_id"), "match_id", F.round("score", vector_scan.DIGITS).alias("likeness")), "nearest-addresses")
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.col("likeness").desc(), "parcel"))
    near = keep(found.join(held.select("match_id", "parcel"), "match_id").withColumn("rank", rank).where(F.col("rank") <= k).select("vec_id", "parcel", "rank"), "nearest")
    features = lambda df: F.struct(*[c for c in df.columns if c.startswith("f_")])
    ours = register.join(asked, "full").select("pid", "row_idx", "vec_id", features(register).alias("a"))
    theirs = parcels.where(F.trim("f_owner") != "").select(F.col("row_idx").alias("parcel"), "uid", "latitude", "longitude", features(parcels).alias("b"))
    scores = {f"s_{n}": s for n, s in address_scores().items()}
    # columns of their own: the mean names each score several times
    pairs = ours.join(near, "vec_id").join(theirs, "parcel").select(
        "row_idx", "pid", "uid", "latitude", "longitude", "rank", F.col("a.f_locality").alias("f_locality"), F.col("b.f_owner").alias("gis_owner"), F.col("b.f_locality").alias("gis_locality"),
        *[s.alias(n) for n, s in scores.items()],
    )
    pairs = pairs.withColumn("score", weighted_score({n.removeprefix("s_"): F.col(n) for n in scores}))
    top = best(pairs, "row_idx", F.col("score"), [F.col("rank")], ["pid", "uid", "latitude", "longitude", "score", "f_locality", "gis_owner", "gis_locality"])
    top = keep(top, "best-addresses").where(F.col("score") > 0)  # of the best alone: a filter below them would score each pair twice
    matched = top.where(F.col("score") >= likely).withColumn("type", F.when(F.col("score") >= sure, "TOP5_WEIGHTED").otherwise("TOP10_WEIGHTED")).drop("f_locality")
    vague = top.where(F.col("score") < likely)
    centres = like_localities(vague, localities)
    vague = vague.join(centres, "f_locality").select(
        "row_idx", "pid", F.lit("").alias("uid"), F.col("y").alias("latitude"), F.col("x").alias("longitude"), "score", F.lit("").alias("gis_owner"), F.lit("").alias("gis_locality"),
        F.lit("LOCALITY_CENTROID").alias("type"),
    )
    rows = matched.unionByName(vague.select(*[F.col(c).cast(matched.schema[c].dataType) for c in matched.columns]))
    # the first row of a pid that has an answer speaks for all its rows
    return best(rows, "pid", F.lit(0), [F.col("row_idx")], [c for c in matched.columns if c not in ("pid", "row_idx")])


def geocoded(register: DataFrame, parcels: DataFrame, localities: DataFrame, keep: Keep = _as_is, **search) -> DataFrame:
    """The register with Matched_UID, Match_Type, Latitude, Longitude, Match_Score, Confidence, GIS_Owner and GIS_Locality: direct ids first,
    addresses for the rest, UNMATCHED where neither answers.  ``matching.matches_of`` makes matches of it.

    Both tables are as ``addressed`` makes them; a blank or null pid gets no answer by ids and is judged by its address like any other.
    """
    direct = keep(direct_ids(register, parcels).select("pid", F.col("matched_uid").alias("uid"), F.col("match_method").alias("type")), "direct")
    places = parcels.groupBy("uid").agg(F.max_by(F.struct("latitude", "longitude", F.col("f_owner").alias("gis_owner"), F.col("f_locality").alias("gis_locality")), "row_idx").alias("p"))
    direct = direct.join(places, "uid").select("pid", "uid", "type", "p.*", F.lit(100.0).alias("score"))
    left = register.join(direct.select("pid"), "pid", "left_anti")
    found = direct.unionByName(by_address(left, parcels, localities, keep=keep, **search))
    level = F.when(F.col("type") == "LOCALITY_CENTROID", "VERY LOW").otherwise(text.confidence_level(F.col("score")))
    plain = register.drop("full", *[c for c in register.columns if c.startswith("f_")])
    answers = found.select(
        F.col("pid"), F.col("uid").alias("Matched_UID"), F.col("type").alias("Match_Type"), F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"),
        F.col("score").alias("Match_Score"), level.alias("Confidence"), F.col("gis_owner").alias("GIS_Owner"), F.col("gis_locality").alias("GIS_Locality"),
    )
    blanks = {c: F.coalesce(c, F.lit("")) for c in ("Matched_UID", "Confidence", "GIS_Owner", "GIS_Locality")}
    missing = {"Match_Type": F.coalesce("Match_Type", F.lit("UNMATCHED")), "Match_Score": F.coalesce("Match_Score", F.lit(0.0))}
    return plain.drop(*[c for c in answers.columns if c != "pid"]).join(answers, "pid", "left").withColumns(blanks | missing)

"""Registers, unclaimed parcels, summaries and checks of the outputs against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.functions.text import exempt, present_status
from ledgermatch.operators.schema import parcel_key, property_key

TAX_STATUSES = ("IN_TAX_NET", "SUSPECTED", "EXEMPT")
GEO_STATUSES = ("SHAPE", "DOT", "NONE")


def city_centres(register: DataFrame, least: int = 100, digits: int = 4) -> DataFrame:
    """Rounded places that stand for a whole city: approximate geocodes that ``least`` rows share."""
    crowded = register.where(F.col("geocode_accuracy") == "APPROXIMATE").groupBy("latitude", "longitude").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return crowded.select(F.round("latitude", digits).alias("lat4"), F.round("longitude", digits).alias("lon4")).distinct()


def match_register(register: DataFrame, matches: DataFrame, parcels: DataFrame, centres: DataFrame | None = None) -> DataFrame:
    """One row per register row: the match, or why there is none."""
    theirs = parcels.groupBy(F.col("uid").alias("matched_uid")).agg(*[F.min_by(c, "row_idx").alias(f"gis_{n}") for c, n in (("owner_name", "owner_name"), ("mobile", "mobile"), ("locality", "locality")) if c in parcels.columns])
    rows = register.join(matches.drop("confidence"), "pid", "left").join(theirs, "matched_uid", "left")
    reason: Column = F.lit("UNMATCHED")
    if "latitude" in register.columns:
        reason = F.when(F.col("latitude").isNull() | F.col("longitude").isNull(), "UNMATCHED_NO_COORDS").otherwise(reason)
        if centres is not None:
            marked = centres.withColumn("centre", F.lit(True))
            rows = rows.withColumns({"lat4": F.round("latitude", 4), "lon4": F.round("longitude", 4)}).join(marked, ["lat4", "lon4"], "left").drop("lat4", "lon4")
            reason = F.when(F.coalesce("centre", F.lit(False)), "UNMATCHED_CITY_CENTER").otherwise(reason)
    rows = rows.withColumn("match_method", F.when(F.col("matched_uid").isNull(), reason).otherwise(F.col("match_method")))
    blanks = {c: F.coalesce(c, F.lit("")) for c in ("matched_uid", "gis_owner_name", "gis_mobile", "gis_locality") if c in rows.columns}
    return rows.withColumns(blanks | {"property_uid": property_key(F.col("pid"))}).drop("centre")


def parcel_register(parcels: DataFrame, matches: DataFrame, confirmed: DataFrame | None = None) -> DataFrame:
    """One row per parcel: EXEMPT, MATCHED, CONFIRMED_OCCUPIED or POTENTIAL.  Exemption goes before a match."""
    claimed = matches.select(F.col("matched_uid").alias("uid")).distinct().withColumn("claimed", F.lit(True))
    rows = parcels.join(claimed, "uid", "left")
    seen: Column = F.lit(False)
    if confirmed is not None:
        rows = rows.join(confirmed.withColumn("seen", F.lit(True)), "uid", "left")
        seen = F.coalesce("seen", F.lit(False))
    claimed_, exempt_ = F.coalesce("claimed", F.lit(False)), exempt(F.col("exempt"))
    status = F.when(exempt_, "EXEMPT").when(claimed_, "MATCHED").when(seen, "CONFIRMED_OCCUPIED").otherwise("POTENTIAL")
    tax = F.when(exempt_, "EXEMPT").when(claimed_, "IN_TAX_NET").otherwise("SUSPECTED")
    added = {"status": status, "tax_status": tax, "property_uid": parcel_key(F.col("uid"))}
    if "present_status" in parcels.columns:
        added["present_status"] = present_status(F.col("present_status"))
    if "rings" in parcels.columns:
        added["geo_status"] = F.when(F.col("rings").isNotNull(), "SHAPE").otherwise("NONE")
    if confirmed is not None:  # a meter speaks for parcels alone that are taxed and that nobody claims
        added |= {c: F.when(seen & ~exempt_ & ~claimed_, F.coalesce(c, F.lit(""))).otherwise("") for c in ("electricity_account_no", "electricity_holder_name")}
    return rows.withColumns(added).drop("claimed", "seen")


def unclaimed(parcels: DataFrame, matches: DataFrame) -> DataFrame:
    return parcels.join(matches.select(F.col("matched_uid").alias("uid")), "uid", "left_anti")


def actionable(parcels: DataFrame) -> DataFrame:
    """Suspected and built up."""
    return parcels.where((F.col("tax_status") == "SUSPECTED") & (F.col("present_status") == "BUILT_UP"))


def counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def summary(register: DataFrame, parcels: DataFrame) -> DataFrame:
    """One row of totals."""
    r = register.agg(
        F.count("*").alias("total_mseva"),
        F.count(F.when(F.col("matched_uid") != "", 1)).alias("matched_count"),
        F.count_distinct(F.when(F.col("matched_uid") != "", F.col("matched_uid"))).alias("unique_gis_matched"),
    )
    p = parcels.agg(
        F.count("*").alias("total_gis"),
        F.count(F.when(F.col("tax_status") == "EXEMPT", 1)).alias("total_gis_exempted"),
        F.count(F.when(F.col("tax_status") == "SUSPECTED", 1)).alias("potential_defaulters"),
    )
    rate = F.when(F.col("total_mseva") > 0, F.round(F.col("matched_count") / F.nullif(F.col("total_mseva"), F.lit(0)) * 100, 2)).otherwise(0.0)
    return r.join(F.broadcast(p)).withColumns({"unmatched_count": F.col("total_mseva") - F.col("matched_count"), "total_gis_taxable": F.col("total_gis") - F.col("total_gis_exempted"), "match_rate": rate})


def as_map(counted: DataFrame, column: str) -> DataFrame:
    """Counts as one map; the keys are labels of a fixed set."""
    return counted.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(column, "n")))).alias("counts"))


def reconcile(register: DataFrame, parcels: DataFrame, totals: DataFrame) -> DataFrame:
    """Rows (rule, ok, detail): the outputs against each other, one aggregation a relation."""
    blank = lambda c: F.count(F.when(F.coalesce(F.trim(c), F.lit("")) == "", 1))
    r = register.agg(F.count("*").alias("rows"), blank("pid").alias("blank"), F.count_distinct("pid").alias("keys"), F.count(F.when(F.col("property_uid") != property_key(F.col("pid")), 1)).alias("bad_key"), F.count(F.when(F.col("matched_uid") != "", 1)).alias("matched"))
    p = parcels.agg(F.count("*").alias("prows"), blank("uid").alias("pblank"), F.count_distinct("uid").alias("pkeys"), F.count(F.when(F.col("property_uid") != parcel_key(F.col("uid")), 1)).alias("pbad_key"), F.count(F.when(~F.col("tax_status").isin(*TAX_STATUSES), 1)).alias("bad_status"), F.count(F.when(F.col("tax_status") == "SUSPECTED", 1)).alias("suspected"))
    one = r.join(F.broadcast(p)).join(F.broadcast(totals))
    rules = {
        "register_rows": F.col("rows") == F.col("total_mseva"),
        "register_key_blank": F.col("blank") == 0,
        "register_key_unique": F.col("keys") == F.col("rows"),
        "register_key_form": F.col("bad_key") == 0,
        "matched_total": F.col("matched") == F.col("matched_count"),
        "parcel_rows": F.col("prows") == F.col("total_gis"),
        "parcel_key_blank": F.col("pblank") == 0,
        "parcel_key_unique": F.col("pkeys") == F.col("prows"),
        "parcel_key_form": F.col("pbad_key") == 0,
        "tax_status_known": F.col("bad_status") == 0,
        "suspected_total": F.col("suspected") == F.col("potential_defaulters"),
    }
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("ok")) for k, v in rules.items()])).alias("r")).select("r.*")


def anomalies(now: DataFrame, before: DataFrame, fields: tuple[str, ...], percent: float = 25.0) -> DataFrame:
    """Fields of two summaries that changed by more than ``percent``; a former 0 tells nothing."""
    long = lambda df, n: df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias(n)) for f in fields])).alias("x")).select("x.*")
    both = long(now, "now").join(long(before, "before"), "field").where(F.col("before") != 0)
    change = F.round(F.abs(F.col("now") - F.col("before")) / F.abs(F.col("before")) * 100, 2)
    return both.withColumn("change", change).where(F.col("change") > percent)


def corrections_applied(corrections: DataFrame, parcels: DataFrame) -> DataFrame:
    """One row: corrections that apply, that aren't approved, that name no parcel."""
    known = parcels.select(F.col("uid").alias("gis_uid")).distinct().withColumn("known", F.lit(True))
    rows = corrections.join(known, "gis_uid", "left")
    approved = F.col("status") == "APPROVED"
    return rows.agg(F.count(F.when(approved & F.col("known"), 1)).alias("applied"), F.count(F.when(~approved, 1)).alias("not_approved"), F.count(F.when(approved & F.col("known").isNull(), 1)).alias("no_match"))

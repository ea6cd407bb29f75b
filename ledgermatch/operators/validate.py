"""Checks of published outputs: required columns, and the register, the parcels, their features and the summary against each other.

Every relation is one aggregation or one equi-join that ends in a count of what is wrong; a result is a row a rule, never the rows themselves.

Inputs of ``reconcile``: register (propertyid, property_uid); parcels (n, their order; gis_uid, property_uid, tax_status, geo_status, month,
run_id, schema_version); features (n, property_uid, tax_status, geo_status, geometry, null if there is none); header and totals, one row each.  Nulls
count as blank; ids are compared without blanks around them, everything else as it stands.  Without features the rules on them hold, except that of their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.operators.register import GEO_STATUSES, TAX_STATUSES
from ledgermatch.operators.schema import parcel_key, property_key

#: The columns that outputs must have.
REGISTER_COLUMNS = ("propertyid", "matched_uid", "match_method", "gis_owner_name", "gis_mobile", "gis_locality", "property_uid", "month", "run_id", "schema_version")
PARCEL_COLUMNS = (
    "gis_uid", "gis_owner_name", "gis_guardian_name", "gis_mobile", "gis_locality", "latitude", "longitude", "property_usage", "property_type", "status", "electricity_account_no",
    "electricity_holder_name", "property_uid", "tax_status", "geo_status", "ward_id", "month", "run_id", "schema_version",
)
FEATURE_PROPERTIES = tuple(c for c in PARCEL_COLUMNS if c not in ("latitude", "longitude"))
SUMMARY_KEYS = (
    "city", "total_mseva", "total_gis", "matched_count", "unmatched_count", "match_rate", "layer_breakdown", "emitted_gis_rows", "potential_defaulters", "tax_status_counts", "month", "run_id",
    "schema_version",
)
VERSION = "1.0"
MONTH = r"^\d{4}-(0[1-9]|1[0-2])$"

RULES = (
    "parcel_rows", "feature_rows", "emitted_rows", "register_rows", "parcel_id_blank", "parcel_key_unique", "parcel_key_form", "register_key_blank", "register_key_form", "tax_status_known",
    "geo_status_known", "tax_status_total", "suspected_total", "tax_status_counts", "month_form", "month_agrees", "run_id_agrees", "version", "feature_version", "feature_run_id", "feature_month",
    "feature_order", "feature_tax_counts", "feature_geo_status", "no_geometry_for_none", "geometry_for_others",
)


def missing_columns(columns: Sequence[str], required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in set(columns)]


def _text(c: str) -> Column:
    """An id, without the blanks around it."""
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))


def _plain(c: str) -> Column:
    """A status, month, run or version as it stands."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _wrong(condition: Column) -> Column:
    """How many rows are wrong; a null is."""
    return F.count_if(F.coalesce(condition, F.lit(True)))


def _one(*frames: DataFrame) -> DataFrame:
    """Frames of one row side by side."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(F.broadcast(f))
    return out


def _differ(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """One row: how many keys of two frames (key, v) are in one alone or have other values."""
    both = a.select(key, F.col("v").alias("x")).join(b.select(key, F.col("v").alias("y")), key, "full")
    return both.agg(F.count_if(~F.col("x").eqNullSafe(F.col("y"))).alias(name))


def reconcile(register: DataFrame, parcels: DataFrame, features: DataFrame, header: DataFrame, totals: DataFrame) -> DataFrame:
    """Rows (rule, ok), one for each of RULES."""
    r = register.agg(
        F.count("*").alias("register_n"),
        _wrong((_text("propertyid") == "") | (_text("property_uid") == "")).alias("register_blank"),
        _wrong(_text("property_uid") != property_key(_text("propertyid"))).alias("register_form"),
    )
    per = ("month", "run_id", "schema_version")
    p = parcels.agg(
        F.count("*").alias("parcel_n"),
        _wrong(_text("gis_uid") == "").alias("id_blank"),
        _wrong(_text("property_uid") == "").alias("key_blank"),
        F.count_distinct(_text("property_uid")).alias("keys"),
        _wrong(_text("property_uid") != parcel_key(_text("gis_uid"))).alias("key_form"),
        _wrong(~_plain("tax_status").isin(*TAX_STATUSES)).alias("tax_unknown"),
        _wrong(~_plain("geo_status").isin(*GEO_STATUSES)).alias("geo_unknown"),
        F.count_if(_plain("tax_status") == "SUSPECTED").alias("suspected"),
        *[f(_plain(c)).alias(f"{n}_{c}") for c in per for n, f in (("least", F.min), ("most", F.max))],
    )
    f = features.agg(
        F.count("*").alias("feature_n"),
        F.count_if((_plain("geo_status") == "NONE") & F.col("geometry").isNotNull()).alias("too_many"),
        F.count_if(_plain("geo_status").isin("SHAPE", "DOT") & F.col("geometry").isNull()).alias("too_few"),
    )
    h = header.select(*[_plain(c).alias(f"h_{c}") for c in per])
    t = totals.select("total_gis", "emitted_gis_rows", "total_mseva", "potential_defaulters", *[_plain(c).alias(f"t_{c}") for c in per])
    status = lambda df: df.groupBy(_plain("tax_status").alias("s")).agg(F.count("*").alias("v"))
    stated = totals.select(F.explode("tax_status_counts").alias("s", "v"))
    by_place = lambda df, c: df.select("n", c.alias("v"))
    one = _one(
        r, p, f, h, t,
        _differ(status(parcels), stated, "s", "counts_off"), _differ(status(parcels), status(features), "s", "feature_counts_off"),
        _differ(by_place(parcels, _text("property_uid")), by_place(features, _plain("property_uid")), "n", "order_off"),
        _differ(by_place(parcels, _plain("geo_status")), by_place(features, _plain("geo_status")), "n", "geo_off"),
    )
    c = F.col
    alike = lambda x: (c(f"least_{x}") == c(f"most_{x}")) & (c(f"least_{x}") == c(f"t_{x}"))
    bare = c("feature_n") == 0
    ok = {
        "parcel_rows": c("parcel_n") == c("total_gis"),
        "feature_rows": c("feature_n") == c("total_gis"),
        "emitted_rows": c("emitted_gis_rows") == c("total_gis"),
        "register_rows": c("register_n") == c("total_mseva"),
        "parcel_id_blank": c("id_blank") == 0,
        "parcel_key_unique": (c("key_blank") == 0) & (c("keys") == c("parcel_n")),
        "parcel_key_form": c("key_form") == 0,
        "register_key_blank": c("register_blank") == 0,
        "register_key_form": c("register_form") == 0,
        "tax_status_known": c("tax_unknown") == 0,
        "geo_status_known": c("geo_unknown") == 0,
        "tax_status_total": c("parcel_n") == c("total_gis"),
        "suspected_total": c("suspected") == c("potential_defaulters"),
        "tax_status_counts": c("counts_off") == 0,
        "month_form": (c("least_month") == c("most_month")) & c("least_month").rlike(MONTH),
        "month_agrees": alike("month"),
        "run_id_agrees": alike("run_id") & (c("least_run_id") != ""),
        "version": alike("schema_version") & (c("t_schema_version") == VERSION),
        "feature_version": c("h_schema_version") == VERSION,
        "feature_run_id": c("h_run_id") == c("t_run_id"),
        "feature_month": c("h_month") == c("t_month"),
        "feature_order": bare | (c("order_off") == 0),
        "feature_tax_counts": bare | (c("feature_counts_off") == 0),
        "feature_geo_status": bare | (c("geo_off") == 0),
        "no_geometry_for_none": c("too_many") == 0,
        "geometry_for_others": c("too_few") == 0,
    }
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.coalesce(ok[k], F.lit(False)).alias("ok")) for k in RULES])).alias("r")).select("r.*")

"""Headers to logical columns, renaming, coalescing duplicates, stamping."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.functions.text import SENTINELS, blank

#: Logical fields and the headers they go by in the sources, compared in lower case; the first that a table has wins.
HEADERS = {
    "owner": ("ownername", "owner_name", "owner_nam", "property_o", "name", "owner"),
    "guardian": ("guardianname", "guardian_name", "father_hus", "guardianna", "father_name", "father_nam", "husband_na", "guardian", "fathername"),
    "mobile": ("mobileno", "mobile_no", "mobile", "phone", "contact"),
    "address": ("proper_address", "formatted_address", "full_address", "address", "property address", "address_1", "propertyaddress"),
    "locality": ("localityname", "locality_name", "locality", "localityna", "locality_n", "mohalla", "colony"),
    "ward": ("ward", "wardname", "ward_no", "blockname", "zonename", "ward_number"),
    "property_id": ("propertyid", "property_id", "prop_id", "propertytaxuniqueid"),
    "old_property_id": ("oldpropertyid", "old_property_id", "old_uid", "old uid", "oldpropert"),
    "survey_id": ("surveyid", "survey_id"),
    "uid": ("uid", "unique_id"),
    "uid_old": ("uid_old", "old_uid", "old uid"),
    "latitude": ("latitude", "lat", "y"),
    "longitude": ("longitude", "lon", "lng", "long", "x"),
    "all_owners": ("all_ownernames", "all_owners"),
    "all_guardians": ("all_guardiannames", "all_guardians"),
    "all_mobiles": ("all_mobilenos", "all_mobiles"),
    "geocode_accuracy": ("geocode_accuracy", "accuracy", "location_type"),
    "electricity": ("electricity", "elec_conn", "electric_m", "meter"),
    "occupancy": ("occupancy", "occup_stat", "status"),
    "exempted": ("exempted", "exempt", "tax_status", "taxable", "exempted_c"),
    "property_usage": ("usages_typ", "usage_typ", "property_u", "property_usage", "land_use", "usage_type", "property_use"),
    "property_type": ("bldg_type", "building_type", "type_of_pr", "property_type", "type", "property_t"),
    "present_status": ("present_st", "present_status", "current_status", "status_present"),
}


def _fields(**names: str) -> dict[str, tuple[str, ...]]:
    return {ours: HEADERS[field] for ours, field in names.items()}


#: The library's own names of a register's and a parcel layer's columns.
REGISTER_FIELDS = _fields(
    propertyid="property_id", oldpropertyid="old_property_id", surveyid="survey_id", ownername="owner", guardianname="guardian", mobileno="mobile", all_ownernames="all_owners",
    all_guardiannames="all_guardians", all_mobilenos="all_mobiles", localityname="locality", address="address", ward="ward", latitude="latitude", longitude="longitude",
    geocode_accuracy="geocode_accuracy",
)
PARCEL_FIELDS = _fields(
    uid="uid", uid_old="uid_old", property_id="property_id", owner_name="owner", guardian="guardian", mobile="mobile", locality="locality", ward_id="ward", electricity="electricity",
    occupancy="occupancy", exempt="exempted", property_usage="property_usage", property_type="property_type", present_status="present_status",
) | {"mobile2": ("mobile_no_",)}

METER_FIELDS = _fields(name="owner", latitude="latitude", longitude="longitude", mobile="mobile")


def detect_columns(names: Sequence[str], patterns: dict[str, Sequence[str]], overrides: dict[str, str] | None = None) -> dict[str, str]:
    """Logical name to actual header, for those found; headers compare trimmed and lower-cased, overrides win."""
    by_name: dict[str, str] = {}
    for n in names:
        by_name.setdefault(n.strip().lower(), n)
    found = {k: next((by_name[c] for c in candidates if c in by_name), None) for k, candidates in patterns.items()}
    return {k: v for k, v in found.items() if v is not None} | (overrides or {})


def to_logical(df: DataFrame, columns: dict[str, str], absent: Sequence[str] = ()) -> DataFrame:
    """Logical columns alone; those of ``absent`` that weren't found become ''."""
    chosen = [F.col(f"`{actual}`").alias(name) for name, actual in columns.items()]
    return df.select(*chosen, *[F.lit("").alias(n) for n in absent if n not in columns])


def clean_column_names(names: Sequence[str]) -> list[str]:
    return [n.strip().replace("\n", " ").replace("  ", " ") for n in names]


def rename_and_coalesce(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Renames headers; where several take one name, the first that isn't null wins, left to right."""
    cleaned = clean_column_names(df.columns)
    plain = df.toDF(*[f"__{i}" for i in range(len(cleaned))])
    targets: dict[str, list[str]] = {}
    for i, name in enumerate(cleaned):
        targets.setdefault(mapping.get(name, name), []).append(f"__{i}")
    return plain.select(*[(F.coalesce(*map(F.col, cols)) if len(cols) > 1 else F.col(cols[0])).alias(name) for name, cols in targets.items()])


def blank_sentinels(df: DataFrame) -> DataFrame:
    """All columns as text, the sources' sentinels as ''."""
    assert SENTINELS
    return df.select(*[blank(F.col(f"`{c}`")).alias(c) for c in df.columns])


def numbers(df: DataFrame, *names: str) -> DataFrame:
    """Text to numbers; what is none becomes null."""
    return df.withColumns({n: F.col(n).try_cast("double") for n in names})


def stamp(df: DataFrame, city: str, state: str, month: str, run_id: str, version: str = "1.0") -> DataFrame:
    """Drops the five stamp columns and puts them first, as constants."""
    made = {"City": city, "State": state, "month": month, "run_id": run_id, "schema_version": version}
    lower = {k.lower() for k in made}
    return df.select(*[F.lit(v).alias(k) for k, v in made.items()], *[F.col(f"`{c}`") for c in df.columns if c.lower() not in lower])


def keep_first(df: DataFrame, key: str, order: str, blanks_stay: bool = True, last: bool = False) -> DataFrame:
    """One row a key, the first (or last) by ``order``.  Blank keys are no duplicates of each other unless ``blanks_stay`` is off."""
    by = F.col(order).desc() if last else F.col(order).asc()
    # blank keys don't meet in one task: they are spread by their order
    spread = F.when(F.coalesce(F.col(key), F.lit("")) == "", F.col(order)) if blanks_stay else F.lit(None)
    rank = F.row_number().over(Window.partitionBy(F.coalesce(F.col(key), F.lit("")), spread).orderBy(by))
    return df.withColumn("__r", rank).where("__r = 1").drop("__r")


def valid_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.where(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180))


def property_key(c: Column) -> Column:
    return F.concat(F.lit("PT:"), c)


def parcel_key(c: Column) -> Column:
    return F.concat(F.lit("GIS:"), c)


def page(df: DataFrame, order: str, offset: int, limit: int) -> DataFrame:
    return df.orderBy(order).offset(offset).limit(limit)


def page_with_total(df: DataFrame, order: str, offset: int, limit: int) -> DataFrame:
    """A page whose rows carry ``total``, the number of all rows; it comes from its own count, so the page itself stays a top-k."""
    return page(df, order, offset, limit).join(F.broadcast(df.agg(F.count("*").alias("total")))).orderBy(order)


def month_ok(month: str) -> bool:
    return bool(re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", month))

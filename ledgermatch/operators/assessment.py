"""The quality run: fill rates, phones, addresses, geometry and overlap of the inputs, with score and verdict.

Each source is read once: its measures are collected by ``observe`` while ``keep`` writes the rows that later steps read.  Distinct values are counted by mergeable sketches
(HyperLogLog++, a relative deviation of RSD), so no measure shuffles the rows; phones are compared exactly, from the written rows.  All rows count, none are sampled.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgermatch.functions.text import SENTINELS, address_completeness, clean_address, duplicated_address, junk_address, normalize_phone, valid_phone
from ledgermatch.operators import validity
from ledgermatch.operators.quality import verdict

Keep = Callable[[DataFrame, str], DataFrame]
RSD = 0.02
REGISTER, PARCELS = ("ownername", "mobileno", "address"), ("uid", "owner_name")
CATEGORIES = ("property_usage", "property_type")


class Assessment(NamedTuple):
    """``measures``: by source and name.  ``fields``: rows (source, field, filled, pct, n_distinct).  Numbers of fields are those of the tables' columns."""

    score: int
    verdict: str
    issues: list[str]
    warnings: list[str]
    measures: dict[str, float]
    fields: list[tuple[str, str, int, float, int]]

    def report(self) -> str:
        return json.dumps(self._asdict(), indent=2)


def observed(rows: DataFrame, name: str, measures: Sequence[Column], keep: Keep) -> tuple[DataFrame, dict]:
    """The rows as written, and measures of them collected on the way."""
    watch = Observation(f"quality-{name}")
    kept = keep(rows.observe(watch, F.count("*").alias("n"), *measures).drop("__address"), name)
    return kept, watch.get


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")))


def _field_measures(columns: Sequence[str], blanks: Sequence[str]) -> list[Column]:
    filled = lambda c: F.when(~_text(c).isin(*blanks), _text(c))
    return [m for i, c in enumerate(columns) for m in (F.count(filled(c)).alias(f"filled_{i}"), F.approx_count_distinct(filled(c), RSD).alias(f"distinct_{i}"))]


def _pct(part: float, n: int, digits: int = 1) -> float:
    return round(part / n * 100, digits) if n else 0.0


def overlap_pct(ours: DataFrame, theirs: DataFrame, our_column: str, their_column: str) -> float:
    """Share of our distinct phones, of any form, that are theirs too; one join of distinct phones."""
    side = lambda df, c: df.select(normalize_phone(F.col(c)).alias("p")).where("p <> ''").distinct()
    both = side(ours, our_column).join(side(theirs, their_column).withColumn("shared", F.lit(1)), "p", "left")
    row = both.agg(F.count("*").alias("n"), F.count("shared").alias("m")).first()
    return _pct(row.m, row.n)


def has_phone_coverage(register: DataFrame, column: str = "mobileno", least: float = 0.3) -> tuple[bool, float]:
    """Whether enough rows have a phone, and their share; 0, nan, None and null are none."""
    if column not in register.columns:
        return False, 0.0
    share = register.agg(F.avg(F.when(_text(column).isin("", "0", "nan", "None", "null"), 0.0).otherwise(1.0)).alias("r")).first().r or 0.0
    return share >= least, share


def municipality(parcels: DataFrame) -> DataFrame:
    """One row: parcels, and distinct localities, roads and wards as far as the layer has them."""
    count = lambda c: F.approx_count_distinct(F.col(c), RSD) if c in parcels.columns else F.lit(0).cast("long")
    return parcels.agg(F.count("*").alias("total_properties"), *[count(c).alias(n) for c, n in (("locality", "unique_localities"), ("road_name", "unique_roads"), ("ward_no", "unique_wards"))])


def unmapped_localities(register: DataFrame, pairs: DataFrame, known: DataFrame, most: int = 10) -> DataFrame:
    """The localities of most claims that neither the parcels (``known``: locality_n) nor the crosswalk (``pairs``: locality) have: locality, n."""
    there = known.select(F.col("locality_n").alias("locality")).unionByName(pairs.select("locality")).distinct()
    lost = register.where(F.coalesce("locality_n", F.lit("")) != "").groupBy(F.col("locality_n").alias("locality")).agg(F.count("*").alias("n")).join(there, "locality", "left_anti")
    return lost.orderBy(F.col("n").desc(), "locality").limit(most)


def assess(register: DataFrame, parcels: DataFrame, keep: Keep, meters: DataFrame | None = None) -> Assessment:
    """Assesses a register and a parcel layer in the library's own columns, and meters (latitude, longitude) where there are any.

    A column that a source lacks is an issue where it is critical.  Sources without rows score as if nothing in them were filled.
    """
    issues: list[str] = []
    warnings: list[str] = []
    out: dict[str, float] = {}
    fields: list[tuple[str, str, int, float, int]] = []

    def filled(source: str, columns: Sequence[str], got: dict) -> dict[str, float]:
        shares = {c: _pct(got[f"filled_{i}"], got["n"]) for i, c in enumerate(columns)}
        fields.extend((source, c, got[f"filled_{i}"], shares[c], got[f"distinct_{i}"]) for i, c in enumerate(columns))
        out[f"{source}_total"] = got["n"]
        return shares

    columns = [c for c in register.columns if c != "row_idx"]
    more = []
    if "mobileno" in columns:
        more += [F.count(F.when(valid_phone(normalize_phone(F.col("mobileno"))), 1)).alias("phones")]
    if "address" in columns:
        register, a = register.withColumn("__address", clean_address(F.col("address"))), F.col("__address")
        good = ~junk_address(a)
        more += [F.count(F.when(~good, 1)).alias("junk"), F.count(F.when(duplicated_address(a), 1)).alias("twice"), F.sum(F.when(good, address_completeness(a))).alias("complete"), F.count(F.when(good, 1)).alias("good")]
    claims, got = observed(register, "register", [*_field_measures(columns, ("",)), *more], keep)
    shares = filled("register", columns, got)
    for c in REGISTER:
        if c not in shares:
            issues.append(f"register: no column {c}")
        elif c != "address" and shares[c] < 50:
            issues.append(f"register: {c} is filled in {shares[c]} % only")
    if "phones" in got:
        out["register_valid_phone_pct"] = _pct(got["phones"], got["n"])
        if out["register_valid_phone_pct"] < 50:
            issues.append(f"register: {out['register_valid_phone_pct']} % of phones are valid")
    if "junk" in got:
        out |= {"register_address_junk_pct": _pct(got["junk"], got["n"]), "register_address_twice_pct": _pct(got["twice"], got["n"]), "register_address_completeness": round((got["complete"] or 0.0) / (got["good"] or 1), 2)}

    columns = [c for c in parcels.columns if c not in ("row_idx", "rings")]
    lots, got = observed(parcels, "parcels", _field_measures(columns, SENTINELS), keep)
    shares = filled("parcels", columns, got)
    issues += [f"parcels: no column {c}" for c in PARCELS if c not in shares]
    issues += [f"parcels: {c} is filled in {shares[c]} % only" for c in ("uid", "owner_name", "mobile") if shares.get(c, 100.0) < 50]
    thin = [c for c in CATEGORIES if shares.get(c, 0.0) < 20]
    warnings += [f"parcels: {c} is filled in {shares.get(c, 0.0)} %, so there is no breakdown by it" for c in thin]
    if "rings" in lots.columns:
        counted = {r.problem: r.n for r in validity.shares(validity.checked(lots.select(F.lit(0).alias("row_idx"), "rings"))).collect()}  # a row a kind of problem
        empty = counted["missing"] + counted["empty"]
        out |= {"parcels_empty_geometry_pct": _pct(empty, got["n"]), "parcels_invalid_geometry_pct": _pct(got["n"] - empty - counted["valid"], got["n"])}
    if meters is not None:
        placed = F.count(F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), 1)).alias("placed")
        _, got = observed(meters, "meters", [placed], keep)
        out |= {"meters_total": got["n"], "meters_gps_pct": _pct(got["placed"], got["n"])}
    out["phone_overlap_pct"] = overlap_pct(claims, lots, "mobileno", "mobile") if "mobileno" in claims.columns and "mobile" in lots.columns else 0.0
    missing = sum(c not in claims.columns for c in REGISTER) + sum(c not in lots.columns for c in PARCELS)
    score, word = verdict(missing, out.get("register_valid_phone_pct", 0.0), out["phone_overlap_pct"], out.get("register_address_completeness", 0.0), out.get("parcels_invalid_geometry_pct", 0.0), len(thin))
    return Assessment(score, word, issues, warnings, out | {"score": score}, fields)

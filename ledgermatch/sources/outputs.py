"""Checks of a city's published files, read back by Spark from wherever they lie."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.operators import validate
from ledgermatch.sources import sinks

_FEATURE = "struct<properties: map<string, string>, geometry: string>"


class Checked(NamedTuple):
    """What a file was found to be: ``missing`` columns, keys or properties, and a note where more is wrong."""

    file: str
    ok: bool
    missing: tuple[str, ...] = ()
    note: str = ""


def write(register: DataFrame, parcels: DataFrame, summary: DataFrame, folder: str, city: str, month: str, run_id: str, order: str = "n") -> None:
    """A city's bundle: register and parcels as CSV, features as lines in order with a header, and the summary as JSON.

    Parcels have their order, ``geometry`` (GeoJSON as text, or null) and the columns of ``validate.PARCEL_COLUMNS``; the summary is one row.
    """
    sinks.write_csv(register, f"{folder}/{city}_Match_Register")
    sinks.write_csv(parcels.drop("geometry").orderBy(order), f"{folder}/{city}_Defaulters")
    sinks.write_features(parcels, f"{folder}/{city}_Defaulters.geojson", F.col("geometry"), [order, *validate.FEATURE_PROPERTIES], order)
    spark = parcels.sparkSession
    spark.createDataFrame([("FeatureCollection", validate.VERSION, run_id, month)], "type string, schema_version string, run_id string, month string").write.mode("overwrite").json(f"{folder}/{city}_Defaulters_Header")
    summary.write.mode("overwrite").json(f"{folder}/{city}_Summary")


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=False, escape='"').na.fill("")


def _tried(file: str, check: Callable[[], Checked]) -> Checked:
    try:
        return check()
    except PySparkException as e:
        return Checked(file, False, note=f"could not read: {(e.getCondition() or type(e).__name__)}")


def check(spark: SparkSession, folder: str, city: str, order: str = "n") -> dict[str, Checked]:
    """Required columns, properties and keys of each file, and the 26 rules between them.  A file that isn't there or can't be read is not ok."""
    at = {n: f"{folder}/{city}_{n}" for n in ("Match_Register", "Defaulters", "Defaulters.geojson", "Defaulters_Header", "Summary")}

    def columns(name: str, required: tuple[str, ...], read: Callable[[str], DataFrame]) -> Checked:
        lost = validate.missing_columns(read(at[name]).columns, required)
        return Checked(name, not lost, tuple(lost))

    def features() -> DataFrame:
        rows = spark.read.text(at["Defaulters.geojson"]).select(F.from_json("value", _FEATURE).alias("f"))
        return rows.select(F.col("f.properties").alias("p"), F.col("f.geometry").alias("geometry"))

    def properties() -> Checked:
        lacking = [F.count_if(~F.array_contains(F.map_keys("p"), c)).alias(c) for c in validate.FEATURE_PROPERTIES]
        row = features().agg(F.count("*").alias("n"), *lacking).first()
        if not row.n:
            return Checked("Defaulters.geojson", True, note="no features to validate")
        lost = tuple(c for c in validate.FEATURE_PROPERTIES if row[c])
        return Checked("Defaulters.geojson", not lost, lost)

    def rules() -> Checked:
        summary = spark.read.json(at["Summary"])
        counts = F.from_json(F.to_json("tax_status_counts"), "map<string, long>").alias("tax_status_counts")
        totals = summary.select(*[c for c in summary.columns if c != "tax_status_counts"], counts)
        parcels = _csv(spark, at["Defaulters"]).withColumn("n", F.col(order).cast("long"))
        f = features().select(F.col("p")[order].cast("long").alias("n"), *[F.col("p")[c].alias(c) for c in ("property_uid", "tax_status", "geo_status")], "geometry")
        made = validate.reconcile(_csv(spark, at["Match_Register"]), parcels, f, spark.read.json(at["Defaulters_Header"]), totals)
        broken = sorted(r.rule for r in made.where("NOT ok").collect())
        return Checked("bundle", not broken, note="; ".join(broken))

    json = spark.read.json
    return {
        "match_register": _tried("Match_Register", lambda: columns("Match_Register", validate.REGISTER_COLUMNS, lambda p: _csv(spark, p))),
        "defaulters_csv": _tried("Defaulters", lambda: columns("Defaulters", validate.PARCEL_COLUMNS, lambda p: _csv(spark, p))),
        "defaulters_geojson": _tried("Defaulters.geojson", properties),
        "summary_json": _tried("Summary", lambda: columns("Summary", validate.SUMMARY_KEYS, json)),
        "reconciliation": _tried("bundle", rules),
    }


def all_ok(results: dict[str, Checked]) -> bool:
    return all(r.ok for r in results.values())


def report(results: dict[str, Checked]) -> str:
    said = lambda r: r.note or ("missing: " + ", ".join(r.missing) if r.missing else "")
    return "\n".join(f"[{'OK' if r.ok else 'FAIL'}] {name}" + (f" - {said(r)}" if said(r) else "") for name, r in results.items())

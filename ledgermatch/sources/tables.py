"""Reading registers, meters, crosswalks, corrections and runs."""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.functions import geo, text
from ledgermatch.operators import schema, validity
from ledgermatch.sources import shapefile

CORRECTION = T.StructType([T.StructField(n, T.StringType()) for n in ("correction_id", "field_name", "corrected_value", "status", "checked_by_officer", "checked_at", "source_check_id", "gis_uid", "mseva_property_id", "approved_by_supervisor", "approved_at", "applied_in_run_id", "notes")])


def encoding_of(spark: SparkSession, path: str) -> str:
    """UTF-8 if all of the file's bytes are, else Latin-1, which takes any bytes.  Read by Spark, so any store will do."""
    bad = spark.read.text(path).where(~F.expr("is_valid_utf8(value)"))
    return "UTF-8" if bad.isEmpty() else "ISO-8859-1"


def read_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """All columns as text, so that ids and phones stay as written; a byte order mark is no part of the first header."""
    df = spark.read.csv(path, header=True, inferSchema=False, encoding=encoding or encoding_of(spark, path), multiLine=True, escape='"')
    return df.toDF(*[re.sub("^(﻿|ï»¿)", "", c) for c in df.columns])


def read_meters(spark: SparkSession, path: str, overrides: dict[str, str] | None = None, encoding: str | None = None) -> DataFrame:
    """A file of meters: meter_idx, account, name, latitude, longitude, mobileno_norm; columns that it lacks are empty.

    The account is the first column with that word in its header, unless ``overrides`` names it or another field's header.  Places that are no numbers are null.
    """
    df = read_csv(spark, path, encoding)
    columns = schema.detect_columns(df.columns, schema.METER_FIELDS, overrides)
    columns.setdefault("account", next((c for c in df.columns if "account" in c.lower()), None))
    of = lambda c: F.col(f"`{columns[c]}`") if columns.get(c) in df.columns else F.lit(None).cast("string")
    places = {c: of(c).try_cast("double") for c in ("latitude", "longitude")}
    rows = df.select(*[F.coalesce(of(c), F.lit("")).alias(c) for c in ("account", "name")], *[v.alias(c) for c, v in places.items()], F.coalesce(text.normalize_phone(of("mobile")), F.lit("")).alias("mobileno_norm"))
    return with_row_index(rows).withColumnRenamed("row_idx", "meter_idx")


def with_row_index(df: DataFrame, order: str | None = None) -> DataFrame:
    """Rows' order as row_idx: of a column if one tells it, else of Spark's partitions (write the result before it is read twice)."""
    return df.withColumn("row_idx", F.col(order).cast("long") if order else F.monotonically_increasing_id())


def read_crosswalk(spark: SparkSession, path: str, least: int = 60) -> DataFrame:
    """Rows (locality, other) of a score of ``least`` or more; columns by parts of their names, else by position."""
    df = read_csv(spark, path)
    pick = lambda part, i: next((c for c in df.columns if part in c.lower()), df.columns[i])
    a, b, s = pick("mseva", 0), pick("gis", 1), pick("score", 2)
    return df.where(F.col(s).try_cast("double") >= least).select(F.trim(a).alias("locality"), F.trim(b).alias("other"))


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, schema=CORRECTION, multiLine=True)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Features of a GeoJSON collection, of a single feature or of a bare geometry: (properties, geometry as text)."""
    whole = spark.read.text(path, wholetext=True)
    kind = F.get_json_object("value", "$.type")
    each = F.when(kind == "FeatureCollection", F.from_json(F.get_json_object("value", "$.features"), "array<struct<properties:map<string,string>,geometry:string>>"))
    one = F.from_json("value", "struct<properties:map<string,string>,geometry:string>")
    bare = F.struct(F.lit(None).cast("map<string,string>").alias("properties"), F.col("value").alias("geometry"))
    features = F.coalesce(each, F.array(F.when(kind == "Feature", one).otherwise(bare)))
    return whole.select(F.explode(features).alias("f")).select("f.*")


def read_change_polygons(spark: SparkSession, path: str, zone: int | None = None) -> DataFrame:
    """A shapefile of new construction: row_idx, est_bldgs, the layer's other columns in lower case, rings.  ``zone`` takes rings in degrees to that UTM zone.

    A layer without counts of buildings is none of this kind.
    """
    shapefile.register(spark)
    rows = spark.read.format("shapefile").load(path)
    rows = rows.toDF(*[c.strip().lower() for c in rows.columns])
    if "est_bldgs" not in rows.columns:
        raise ValueError(f"{path}: the layer has no column Est_Bldgs")
    rows = rows.withColumn("est_bldgs", F.expr("try_cast(trim(est_bldgs) AS double)"))
    return rows.withColumn("rings", geo.to_utm(F.col("rings"), F.lit(zone))) if zone else rows


#: Headers under which a layer of localities may hold their names, the first that it has.
LOCALITY_HEADERS = ("locality", "locality_name", "colony", "name")


def read_localities(spark: SparkSession, path: str, zone: int | None = None) -> DataFrame:
    """An official shapefile of localities: row_idx, locality (cleaned), rings, repaired where they need it.  Shapes without points are left out; a layer without names is an error."""
    shapefile.register(spark)
    rows = spark.read.format("shapefile").load(path)
    found = next((c for c in rows.columns if c.strip().lower() in LOCALITY_HEADERS), None)
    if found is None:
        raise ValueError(f"{path}: the layer names its localities by none of {', '.join(LOCALITY_HEADERS)}")
    rows = rows.select("row_idx", text.clean_text(F.col(f"`{found}`")).alias("locality"), "rings")
    whole = validity.checked(rows, fix=True).where(F.size("rings") > 0).drop("problem").join(rows.drop("rings"), "row_idx")
    whole = whole.withColumn("rings", geo.to_utm(F.col("rings"), F.lit(zone))) if zone else whole
    return whole.select("row_idx", "locality", "rings")


def region(spark: SparkSession, path: str | None, bounds: tuple[float, float, float, float]) -> DataFrame:
    """The geometry (GeoJSON as text) of a city's file, or the rectangle of its bounds (west, south, east, north) where there is none that can be read."""
    w, s, e, n = bounds
    box = spark.createDataFrame([(json.dumps({"type": "Polygon", "coordinates": [[[w, s], [e, s], [e, n], [w, n], [w, s]]]}),)], "geometry string")
    try:
        first = read_features(spark, path).where(F.get_json_object("geometry", "$.type").isin("Polygon", "MultiPolygon")).select("geometry").limit(1) if path else None
        return box if first is None or first.isEmpty() else first
    except AnalysisException:
        return box


def latest(spark: SparkSession, pointer: str) -> str:
    """The published folder that a pointer file names."""
    return spark.read.json(pointer, multiLine=True, schema="path string").first()["path"]


def utm_zone_of(prj: str, xs: list[float]) -> int:
    """The zone of a layer from its projection text, else from coordinates."""
    if m := re.search(r"UTM_Zone_(\d+)[NS]", prj, re.I):
        return int(m[1])
    if m := re.search(r'Central_Meridian"?\s*,\s*(-?[\d.]+)', prj, re.I):
        return int((float(m[1]) + 183) / 6)
    mean = sum(xs) / len(xs) if xs else 0.0
    return 43 if mean > 100_000 else int((mean + 180) / 6) + 1

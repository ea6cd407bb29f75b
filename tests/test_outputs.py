"""A city's published bundle, written and checked, whole and with one thing wrong."""

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import validate
from ledgermatch.sources import outputs


def bundle(spark, change=lambda register, parcels, summary: (register, parcels, summary)):
    stamp = {"month": "2026-09", "run_id": "run1", "schema_version": "1.0"}
    blank = lambda df, names: df.withColumns({c: F.lit("") for c in names if c not in df.columns})
    register = spark.createDataFrame([("PT-1", "GIS-1", "TEST", "PT:PT-1")], "propertyid string, matched_uid string, match_method string, property_uid string").withColumns({k: F.lit(v) for k, v in stamp.items()})
    rows = [(0, "GIS-1", "MATCHED", "IN_TAX_NET", "SHAPE", '{"type":"Point","coordinates":[1,2]}'), (1, "GIS-2", "POTENTIAL", "SUSPECTED", "NONE", None)]
    parcels = spark.createDataFrame(rows, "n long, gis_uid string, status string, tax_status string, geo_status string, geometry string")
    parcels = parcels.withColumns({"property_uid": F.concat(F.lit("GIS:"), "gis_uid"), **{k: F.lit(v) for k, v in stamp.items()}})
    summary = spark.createDataFrame([("Town", 1, 2, 1, 0, 100.0, 2, 1)], "city string, total_mseva long, total_gis long, matched_count long, unmatched_count long, match_rate double, emitted_gis_rows long, potential_defaulters long")
    counts = F.create_map(F.lit("IN_TAX_NET"), F.lit(1), F.lit("SUSPECTED"), F.lit(1))
    summary = summary.withColumns({"layer_breakdown": F.create_map(F.lit("TEST"), F.lit(1)), "tax_status_counts": counts, **{k: F.lit(v) for k, v in stamp.items()}})
    register, parcels, summary = change(register, parcels, summary)
    return blank(register, validate.REGISTER_COLUMNS), blank(parcels, validate.PARCEL_COLUMNS), summary


def checked(spark, path, change=lambda *x: x):
    outputs.write(*bundle(spark, change), str(path), "Town", "2026-09", "run1")
    return outputs.check(spark, str(path), "Town")


def test_whole_bundle(spark, tmp_path):
    got = checked(spark, tmp_path)
    assert outputs.all_ok(got), outputs.report(got)
    assert outputs.report(got).count("[OK]") == 5


@pytest.mark.parametrize(
    ("change", "file", "said"),
    [
        (lambda r, p, s: (r, p.withColumn("tax_status", F.when(F.col("n") == 1, "SUSPECTED ").otherwise(F.col("tax_status"))), s), "reconciliation", "tax_status_known"),
        (lambda r, p, s: (r, p.withColumn("run_id", F.lit("run1 ")), s), "reconciliation", "run_id_agrees"),
        (lambda r, p, s: (r.withColumn("property_uid", F.lit("PT:PT-2")), p, s), "reconciliation", "register_key_form"),
        (lambda r, p, s: (r, p, s.drop("city")), "summary_json", "missing: city"),
    ],
)
def test_broken_bundles(spark, tmp_path, change, file, said):
    got = checked(spark, tmp_path, change)
    assert not got[file].ok and said in outputs.report(got) and not outputs.all_ok(got)


def test_blanks_around_ids_and_absent_files(spark, tmp_path):
    got = checked(spark, tmp_path / "a", lambda r, p, s: (r.withColumn("propertyid", F.lit(" PT-1 ")), p, s))
    assert got["reconciliation"].ok
    none = outputs.check(spark, str(tmp_path / "nowhere"), "Town")
    assert not any(r.ok for r in none.values()) and "could not read" in outputs.report(none)

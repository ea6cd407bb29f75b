"""Geometry repair, the quality run, kept steps, pixel files and patches."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermatch.functions import geo, text
from ledgermatch.operators import assessment, matching, raster, schema, validity
from ledgermatch.operators.polygons import inside, ring_edges
from ledgermatch.sources import checkpoints, knowledge, pixels, tables
from ledgermatch.sources.scratch import cut

keep = lambda df, name="t": cut(df, name)
SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]


def signed(ring):
    x, y = np.asarray(ring, float).T
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


@pytest.mark.parametrize(
    ("rings", "problem", "areas"),
    [
        ([SQUARE], None, [16]), ([SQUARE[::-1]], None, [16]), ([[(0, 0), (4, 4), (4, 0), (0, 4)]], "self_intersection", [4, 4]), ([[(0, 0), (4, 0), (4, 4), (4, 8), (4, 4), (0, 4)]], "spike", [16]),
        ([SQUARE, [(1, 1), (2, 1), (2, 2), (1, 2)]], None, [16, -1]), ([SQUARE, [(1, 1), (3, 1), (3, 3), (1, 3)], [(1.5, 1.5), (2, 1.5), (2, 2), (1.5, 2)]], None, [16, -4, 0.25]), ([], "empty", []), ([[]], "empty", []),
        ([[(0, 0), (1, 1)]], "few_points", []), (None, "missing", None), ([SQUARE, SQUARE], "self_intersection", []), ([SQUARE, [(2, 2), (6, 2), (6, 6), (2, 6)]], "self_intersection", [12, 12]),
        ([SQUARE, [(4, 4), (6, 4), (6, 6), (4, 6)]], None, [16, 4]), ([SQUARE, [(4, 0), (8, 0), (8, 4), (4, 4)]], "self_intersection", [32]), ([[(0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4)]], "self_intersection", [4, 4]),
        ([[(0, 0), (1, 0), (2, 0)]], "spike", []), ([[*SQUARE, (0, 0)]], None, [16]),
    ],
)
def test_problems_and_repair(rings, problem, areas):
    given = None if rings is None else [np.array(r, float).reshape(-1, 2) for r in rings]
    assert validity.problem_of(given) == problem
    if given is not None:
        assert [round(signed(r), 9) for r in validity.repair(given)] == areas


def test_repair_of_random_rings():
    rng = np.random.default_rng(0)
    for t in range(25):
        rings = [rng.uniform(0, 10, (int(rng.integers(4, 14)), 2)) for _ in range(int(rng.integers(1, 3)))]
        rings = [np.round(r) for r in rings] if t % 3 == 0 else rings
        fixed = validity.repair(rings)
        assert all(validity.problem_of([r]) is None for r in fixed)
        given, made = ring_edges(rings), ring_edges(fixed)
        places = rng.uniform(0, 10, (400, 2))
        assert [inside(given, *p) for p in places] == [inside(made, *p) for p in places]
        # outer rings and holes run so that their areas add up to the region's
        assert abs(sum(map(signed, fixed)) - 100 * np.mean([inside(given, *p) for p in rng.uniform(0, 10, (4000, 2))])) < 5


def test_checked(spark):
    rows = [(0, [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]]), (1, [[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0)]]), (2, None), (3, []), (4, [[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]]), (5, [[(0.0, 0.0), (1.0, 1.0)]])]
    df = spark.createDataFrame([(*r, "x") for r in rows], f"row_idx long, rings {validity.RINGS}, problem string")
    made = validity.checked(df, fix=True)
    got = {r.row_idx: (r.problem, r.area) for r in made.select("row_idx", "problem", geo.oriented_area(F.col("rings")).alias("area")).collect()}
    assert got == {0: (None, 0.5), 1: ("self_intersection", 8.0), 2: ("missing", None), 3: ("empty", None), 4: ("spike", None), 5: ("few_points", None)}
    assert {r.problem: r.n for r in validity.shares(validity.checked(df)).collect()} == {"valid": 1, "missing": 1, "empty": 1, "few_points": 1, "spike": 1, "self_intersection": 1}
    assert {(r.n, r.pct) for r in validity.shares(validity.checked(df.limit(0))).collect()} == {(0, 0.0)}


def test_addresses(spark):
    row = spark.createDataFrame([("12,école -- road", "a  A   a", "a  b", None)], "a string, b string, c string, d string")
    got = row.select(text.clean_address(F.col("a")), text.duplicated_address(F.col("b")), text.duplicated_address(F.col("c")), text.duplicated_address(F.col("d")), text.clean_address(F.col("d"))).first()
    assert tuple(got) == ("12 école road", True, False, False, "")


def test_assessment(spark):
    claims = spark.createDataFrame([("A", "9876500001", "House No. 4, Gali 2, Model Colony"), ("B", "9876500002", "na"), (None, "", "Gali 9"), ("C", "12", None)], "ownername string, mobileno string, address string")
    lots = spark.createDataFrame([("u1", "A", "9876500001", "Home", [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]]), ("u2", "0", "", "NA", [[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0)]])], f"uid string, owner_name string, mobile string, property_usage string, rings {validity.RINGS}")
    meters = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "latitude double, longitude double")
    got = assessment.assess(claims, lots, keep, meters)
    m = got.measures
    assert (m["register_total"], m["register_valid_phone_pct"], m["register_address_junk_pct"], m["register_address_completeness"]) == (4, 50.0, 50.0, 0.6)
    assert (m["parcels_invalid_geometry_pct"], m["parcels_empty_geometry_pct"], m["meters_gps_pct"], m["phone_overlap_pct"]) == (50.0, 0.0, 50.0, 33.3)
    # a tenth for shapes, a tenth for the missing type
    assert (got.score, got.verdict) == (80, "GO") and got.warnings == ["parcels: property_type is filled in 0.0 %, so there is no breakdown by it"] and not got.issues
    assert ("register", "ownername", 3, 75.0, 3) in got.fields and json.loads(got.report())["score"] == 80
    none = assessment.assess(claims.limit(0), lots.select("property_usage").limit(0), keep)
    assert (none.score, none.verdict) == (0, "NO-GO") and len(none.issues) >= 3
    assert assessment.has_phone_coverage(claims) == (True, 0.75) and assessment.has_phone_coverage(claims.select("address")) == (False, 0.0)
    assert assessment.municipality(lots.withColumn("locality", F.lit("x"))).first().asDict() == {"total_properties": 2, "unique_localities": 1, "unique_roads": 0, "unique_wards": 0}
    named = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",), ("",)], "locality_n string")
    lost = assessment.unmapped_localities(named, spark.createDataFrame([("c",)], "locality string"), spark.createDataFrame([("b",)], "locality_n string"))
    assert [tuple(r) for r in lost.collect()] == [("a", 3)]
    # the source is read once, by the write that observes it
    plan = claims.observe(assessment.Observation("x"), F.count("*").alias("n"))._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" in plan


def test_resumed_cascade(spark, tmp_path):
    register = spark.range(30).select(F.col("id").cast("string").alias("pid"), F.col("id").alias("row_idx"))
    ran = spark.sparkContext.accumulator(0)

    def layer(k, broken=False):
        def count(rows):
            for r in rows:
                ran.add(1)
                if broken:
                    raise ValueError("stopped")
                yield r

        def made(left):
            some = left.where(F.col("row_idx") % 5 == k)
            return spark.createDataFrame(some.rdd.mapPartitions(count), some.schema).select("pid", F.lit(f"u{k}").alias("matched_uid"), F.lit(f"L{k}").alias("match_method"), F.lit(1.0).alias("confidence"))

        return made

    mark = knowledge.fingerprint(register, parameters={"least": 40})
    first = checkpoints.Checkpoints(spark, str(tmp_path), mark)
    with pytest.raises(Exception, match="stopped"):
        matching.cascade(register, [layer(0), layer(1), layer(2, broken=True)], first.keep)
    assert first.made == ["layer-0-1", "layer-1-1"] and ran.value >= 12
    before = ran.value
    again = checkpoints.Checkpoints(spark, str(tmp_path), mark)
    found = matching.cascade(register, [layer(0, broken=True), layer(1, broken=True), layer(2)], again.keep)
    assert again.found == ["layer-0-1", "layer-1-1"] and again.made == ["layer-2-1"] and ran.value == before + 6
    assert {(r.pid, r.match_method) for r in found.collect()} == {(str(i), f"L{i % 5}") for i in range(30) if i % 5 < 3}
    again.export("layer-0", str(tmp_path / "csv"))
    assert tables.read_csv(spark, str(tmp_path / "csv")).count() == 6
    other = checkpoints.Checkpoints(spark, str(tmp_path), knowledge.fingerprint(register, parameters={"least": 41}))
    matching.cascade(register, [layer(0)], other.keep)
    assert other.found == []


def test_meters_and_pages(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Account_ID,Name,LAT,Long,Phone\nA-1,Jo S/O Al,30.5,75.5,+91-98765 00001\n,,x,,\n")
    got = [tuple(r)[1:] for r in tables.read_meters(spark, str(tmp_path / "m.csv")).orderBy("meter_idx").collect()]
    assert {r for r in got} == {("Jo S/O Al", 30.5, 75.5, "9876500001", 0), ("", None, None, "", 1)} or [r[:4] for r in got] == [("Jo S/O Al", 30.5, 75.5, "9876500001"), ("", None, None, "")]
    over = tables.read_meters(spark, str(tmp_path / "m.csv"), {"account": "Phone"}).where("name <> ''").first()
    assert over.account == "+91-98765 00001"
    (tmp_path / "n.csv").write_text("x1\n5\n")
    bare = tables.read_meters(spark, str(tmp_path / "n.csv")).first()
    assert (bare.account, bare["name"], bare.latitude, bare.mobileno_norm) == ("", "", None, "")
    rows = schema.page_with_total(spark.range(25), "id", 20, 10).collect()
    assert [(r.id, r.total) for r in rows] == [(i, 25) for i in range(20, 25)]


def test_region(spark, tmp_path):
    bounds = (75.0, 30.0, 76.0, 31.0)
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}))
    (tmp_path / "b.json").write_text("no geometry")
    of = lambda p: json.loads(tables.region(spark, p, bounds).first().geometry)["coordinates"][0]
    assert len(of(str(tmp_path / "a.json"))) == 4
    assert of(None) == of(str(tmp_path / "b.json")) == of(str(tmp_path / "none.json")) == [[75.0, 30.0], [76.0, 30.0], [76.0, 31.0], [75.0, 31.0], [75.0, 30.0]]


def test_patches(spark):
    rng = np.random.default_rng(3)
    mask = rng.random((50, 70)) < 0.38
    mask[5:20, 30:45] = True
    mask[8:12, 33:40] = False
    mask[9, 35] = True
    y, x = np.nonzero(mask)
    x, y = x - 20, y - 13
    here = set(zip(x.tolist(), y.tolist(), strict=True))
    patch = {}
    for p in sorted(here, key=lambda p: (p[1], p[0])):
        todo = [p] if p not in patch else []
        while todo:
            a, b = todo.pop()
            if (a, b) not in patch:
                patch[a, b] = p
                todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (a + i, b + j) in here and (a + i, b + j) not in patch]
    rows = spark.createDataFrame([(int(a), int(b)) for a, b in here] * 2 + [(None, 1)], "x int, y int")
    labelled = keep(raster.patches(rows, keep, tile=16))
    assert {(r.x, r.y): (r.patch.x, r.patch.y) for r in labelled.collect()} == patch
    n = {p: sum(q == p for q in patch.values()) for p in set(patch.values())}
    large = {(r.patch.x, r.patch.y): (r.pixels, round(r.area_ha, 4)) for r in raster.sizes(labelled).collect()}
    assert large == {p: (k, round(k * 0.04, 4)) for p, k in n.items() if k * 0.04 > 0.5} and large
    for r in raster.outlines(labelled, 20.0, 1000.0).collect():
        rings = [[(p.x, p.y) for p in ring] for ring in r.rings]
        own = {q for q, p in patch.items() if p == (r.patch.x, r.patch.y)}
        assert abs(sum(map(signed, rings)) - 400 * len(own)) < 1e-6 and all(len(set(ring)) == len(ring) for ring in rings)
        e = ring_edges([np.array(ring) for ring in rings])
        box = [(a, b) for a in range(-20, 50, 3) for b in range(-13, 37, 2)]
        assert all(inside(e, 1000 + 20 * a + 10, 20 * b + 10) == ((a, b) in own) for a, b in box)
    assert raster.patches(rows.limit(0), keep).count() == 0


def test_pixel_files(spark, tmp_path):
    rows = spark.range(40000).select(
        (F.col("id") % 200 * 60).alias("x"), (F.floor(F.col("id") / 200) % 100 * 100).alias("y"), F.expr("date_add(DATE'2020-01-15', CAST(id % 3 * 31 AS INT))").alias("taken"), (F.col("id") % 50).cast("double").alias("cloud"), F.rand(1).alias("nir")
    )
    path = str(tmp_path / "pixels")
    pixels.write(rows, path, 8)
    whole, some = pixels.read(spark, path, most_cloud=None), pixels.read(spark, path, (0, 0, 3000, 3500), ("2020-01-01", "2020-02-01"))
    assert whole.count() == 40000
    want = rows.where("x <= 3000 and y <= 3500 and taken < DATE'2020-02-01' and cloud < 20")
    assert some.count() == want.count() > 0

    def files(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        scans = [plan] if plan.children().isEmpty() else []
        todo = [plan]
        while todo:
            p = todo.pop()
            if "Scan" in p.nodeName():
                scans.append(p)
            todo += [p.children().apply(i) for i in range(p.children().size())]
        return sum(p.metrics().apply("numFiles").value() for p in scans)

    assert 0 < files(some) * 5 < files(whole)

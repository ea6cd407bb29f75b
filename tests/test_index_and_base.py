"""The vector index against the exact search, and the knowledge base's versions and plans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import layers, vector_index, vectors
from ledgermatch.sources import knowledge
from ledgermatch.sources.scratch import cut

keep = lambda df: cut(df, "t")


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.match_id, round(r.score, 9)) for r in df.collect())


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    v = centres[rng.integers(0, 30, 3000)] + 0.35 * rng.normal(size=(3000, 16))
    v[2000:] = v[2000]  # a third of all vectors are one
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(None, [1.0] * 16), (9999, None)], "vec_id long, embedding array<double>").cache()


def test_index(spark, corpus, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK", 128)
    known = corpus.where("vec_id is not null and embedding is not null")
    asked = known.where("vec_id % 20 = 0")
    truth = vectors.top_k(asked, known, 20).cache()
    index = vector_index.build(corpus, keep)
    assert index.postings.agg(F.sum(F.size("ids"))).first()[0] == 3000 and index.postings.agg(F.max(F.size("ids"))).first()[0] < 400
    near = vector_index.search(index, asked, keep, probes=6)
    assert vector_index.recall(near, truth).first().recall >= 0.9 and near.count() == asked.count() * 20
    assert rows_of(vector_index.search(index, asked, keep, probes=1, exact=True)) == rows_of(truth)
    vector_index.save(index, str(tmp_path / "index"))
    again = vector_index.load(spark, str(tmp_path / "index"))
    assert rows_of(vector_index.search(again, asked, keep, probes=6)) == rows_of(near)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    few = vector_index.build(known.limit(3), keep)
    assert vector_index.search(few, asked, keep, k=5, exact=True).where("query_id = 0").count() == 3
    assert vector_index.search(vector_index.build(known.limit(0), keep), asked, keep).count() == 0


def test_index_of_addresses(spark):
    """Addresses' hashed grams, as the address layer searches them."""
    rng = np.random.default_rng(7)
    streets = ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(60)]
    homes = spark.createDataFrame([(i, f"House {rng.integers(1, 900)} {streets[rng.integers(60)]} {streets[rng.integers(60)]}") for i in range(2000)], "vec_id long, a string")
    encoded = homes.select("vec_id", vectors.gram_vectors(F.col("a")).alias("embedding")).cache()
    asked = encoded.where("vec_id % 20 = 0")
    index = vector_index.build(encoded, keep)
    assert vector_index.recall(vector_index.search(index, asked, keep, probes=layers.PROBES), vectors.top_k(asked, encoded, 20)).first().recall >= 0.9


def test_knowledge_base(spark, tmp_path):
    path, built = str(tmp_path / "base"), []
    houses = spark.range(5000).select(F.concat(F.lit("u"), F.col("id")).alias("uid"), (F.col("id") % 17).cast("string").alias("locality"))
    shapes = spark.range(17).select(F.col("id").cast("string").alias("locality"), (F.col("id") * 2.5).alias("area"))

    def build():
        built.append(1)
        return {"houses": knowledge.Table(houses, "uid"), "owners": knowledge.Table(houses.select("uid", F.upper("uid").alias("owner")), "uid"), "localities": knowledge.Table(shapes, "locality")}

    one = knowledge.base(spark, path, [houses, shapes], build, buckets=4)
    two = knowledge.base(spark, path, [houses.orderBy(F.rand(3)), shapes], build, buckets=4)
    assert built == [1] and sorted(two["houses"].collect()) == sorted(houses.collect())
    claims = spark.range(20000).select(F.concat(F.lit("u"), F.col("id") % 7000).alias("uid"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        direct, through = claims.join(houses, "uid"), claims.join(one["houses"], "uid")
        assert sorted(through.select(*direct.columns).collect()) == sorted(direct.collect())
        inner = one["houses"].join(one["owners"], "uid")
        assert inner.count() == 5000
        assert "Exchange" not in inner._jdf.queryExecution().sparkPlan().toString() and "Exchange" not in inner._jdf.queryExecution().executedPlan().toString()
        assert through._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # other inputs, parameters or a version without its manifest are other bases
    more = houses.unionByName(spark.createDataFrame([("new", "1")], houses.schema))
    knowledge.base(spark, path, [more, shapes], build, buckets=4)
    knowledge.base(spark, path, [houses, shapes], build, {"eps": 50}, buckets=4)
    assert built == [1, 1, 1]
    mark = knowledge.fingerprint(houses, shapes, parameters={"buckets": 4})
    assert knowledge.is_valid(spark, path, mark) and not knowledge.is_valid(spark, path, "0" * 64)
    with pytest.raises(FileNotFoundError):
        knowledge.load(spark, path, "0" * 64)
    assert knowledge.fingerprint(houses) != knowledge.fingerprint(houses.unionByName(houses)) != knowledge.fingerprint(houses.limit(0))


def test_driver_gathers_no_sample(spark, corpus, monkeypatch):
    """The driver sees sums of cells, not the vectors that centroids are fitted on, and the index still answers exactly."""
    seen = []
    real = type(corpus).toLocalIterator

    def rows(df, *args, **kwargs):
        for r in real(df, *args, **kwargs):
            seen.append(r)
            yield r

    monkeypatch.setattr(type(corpus), "toLocalIterator", rows)
    monkeypatch.setattr(vector_index, "fit", lambda *_: pytest.fail("fitted by the driver"))
    known = corpus.where("vec_id is not null and embedding is not null")
    asked = known.where("vec_id % 100 = 0")
    index = vector_index.build(corpus, keep)
    assert 0 < len(seen) < 300 and len(index.centroids) == 54 and (index.radius >= 0).sum() > 20
    assert rows_of(vector_index.search(index, asked, keep, exact=True)) == rows_of(vectors.top_k(asked, known, 20))


def test_blocks_and_fit_hold_few_scores():
    """Products of blocks and the fit of centroids never hold all scores at once; ties go by id."""
    import tracemalloc

    from ledgermatch.operators import vectors

    rng = np.random.default_rng(3)
    q, c, ids = rng.integers(-2, 3, (300, 3)).astype(float), rng.integers(-2, 3, (900, 3)).astype(float), rng.permutation(900)
    got = [tuple(r) for part in vectors.best_of_blocks(np.arange(300), list(q), ids, list(c), 20) for r in part.itertuples(index=False)]
    s = q @ c.T
    assert got == [(i, ids[j], s[i, j]) for i in range(300) for j in np.lexsort((ids, -s[i]))[:20]]
    v = rng.normal(size=(20_000, 8))
    tracemalloc.start()
    try:
        vector_index.fit(v, 1000, 1)
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()


def test_polygons_are_dealt_out(spark):
    """One partition of many polygons is checked by many tasks; what a batch tells convex has no problem point by point."""
    from ledgermatch.operators import validity

    one = spark.range(0, 100, 1, 1).select(F.col("id").alias("row_idx"), F.lit(None).cast(validity.RINGS).alias("rings"))
    assert one.rdd.getNumPartitions() == 1 and validity.checked(one).rdd.getNumPartitions() >= 4
    rng = np.random.default_rng(4)
    rings = [[rng.integers(0, 6, (n, 2)).astype(float)] for n in (3, 4) for _ in range(400)] + [None, [], [np.zeros((4, 2))]]
    told = validity._convex(rings)
    assert 100 < told.sum() < 700 and all(validity.problem_of(r) is None for r, t in zip(rings, told, strict=True) if t)


def test_scan_is_exact(spark, monkeypatch):
    """Against brute force: equal vectors, cells of fewer than k, and less multiplied than all pairs."""
    from ledgermatch.operators import vector_scan

    rng = np.random.default_rng(5)
    middles = rng.normal(size=(30, 24))
    v = middles[rng.integers(0, 30, 3000)] + 0.2 * rng.normal(size=(3000, 24))
    v[::7] = v[0]
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    q = np.vstack([v[:150] + 0.05 * rng.normal(size=(150, 24)), rng.normal(size=(20, 24))])
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    monkeypatch.setattr(vector_scan, "ASKED", 64)
    monkeypatch.setattr(vector_scan, "HELD", 500)
    frame = lambda m: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], "vec_id long, embedding array<double>")
    for cells in (1, 40):
        got = vector_scan.top_k(frame(q), frame(v), cut, 20, cells=cells).collect()
        score = np.round(q @ v.T, vector_scan.DIGITS)
        want = {(i, int(j), r) for i, s in enumerate(score) for r, j in enumerate(np.lexsort((np.arange(3000), -s))[:20], 1)}
        assert {(r.query_id, r.match_id, r["rank"]) for r in got} == want
    assert vector_scan.top_k(frame(q), frame(v[:3]), cut).count() == 3 * len(q) and vector_scan.top_k(frame(q[:0]), frame(v), cut).count() == 0
    centroids = np.eye(24)[:2]
    near, far = np.eye(24)[:1], np.eye(24)[1:2]
    left_out = list(vector_scan._nearest(np.array([1]), near, np.array([0.9]), np.array([2]), np.array([1], dtype=np.int32), far, centroids, 20))
    assert left_out == []

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermatch.functions import geo, similarity, text


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in values.items())).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "want"), [("8557004043.0", "8557004043"), ("+91-9876543210", "9876543210"), (None, ""), ("123", "123"), ("  98 76 54 32 10 ", "9876543210")])
def test_phone(spark, raw, want):
    assert one(spark, text.normalize_phone(F.col("a")), a=raw) == want


@pytest.mark.parametrize(("raw", "want"), [("Harish Kumar", "hari kumar"), ("Mrs. Kaur", "kaur"), (None, ""), ("A|B, S/O C", "a b c"), ("ਗੁਰ", "ਗ ਰ")])
def test_name(spark, raw, want):
    assert one(spark, text.normalize_name(F.col("a")), a=raw) == want


@pytest.mark.parametrize(("a", "b", "want"), [("gurpreet singh", "gurpreet kaur", 33), ("x y", "y x", 100), ("", "x", 0), (None, "x", 0)])
def test_token_set_ratio(spark, a, b, want):
    assert one(spark, similarity.token_set_ratio(F.col("a"), F.col("b")), a=a, b=b) == want


@pytest.mark.parametrize(("raw", "want"), [("Non residential", "BUILT_UP"), ("PARKING", "PARK"), ("", "UNKNOWN"), ("vacant park", "VACANT"), ("shop", "OTHER")])
def test_present_status(spark, raw, want):
    assert one(spark, text.present_status(F.col("a")), a=raw) == want


def test_holder(spark):
    got = one(spark, text.holder(F.col("a")), a="Ram Lal S/O Sham w/o X")
    assert (got["owner"], got["relative"]) == ("Ram Lal", "Sham w/o X")


@pytest.mark.parametrize(("zone", "east", "north"), [(43, 536513.53, 3359846.72), (44, -40440.18, 3373213.15)])
def test_utm(spark, zone, east, north):
    got = one(spark, geo.wgs84_to_utm(F.col("a"), F.col("b"), F.lit(zone)), a=30.37, b=75.38)
    assert (round(got["easting"], 2), round(got["northing"], 2)) == (east, north)


@pytest.mark.parametrize(("x", "y", "inside"), [(1.0, 1.0, True), (3.0, 3.0, False), (0.0, 0.0, True), (2.0, 4.0, True), (5.0, 5.0, False), (4.0, 2.0, True)])
def test_covers_concave(spark, x, y, inside):
    ring = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]
    rings = F.array(F.array(*[F.struct(F.lit(float(a)).alias("x"), F.lit(float(b)).alias("y")) for a, b in ring]))
    assert one(spark, geo.covers(rings, F.col("a"), F.col("b")), a=x, b=y) is inside
    assert one(spark, geo.area(rings), a=x) == 12.0


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_common_subsequence(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
    assert similarity.common_subsequence(a, b) == table[-1, -1]
    assert similarity.token_sort_score(a, a) in (0.0, 100.0)


def test_many_scores_at_once():
    """Pairs by machine words against one pair at a time: blank, equal, long and other texts."""
    import random

    import pandas as pd

    from ledgermatch.functions import similarity

    rng = random.Random(3)
    texts = [None, "", "x" * 64, "y" * 65, "ab c\0d", "ring bolt " * 9] + ["".join(rng.choice("abc dé") for _ in range(rng.randint(0, 70))) for _ in range(60)]
    a, b = [rng.choice(texts) for _ in range(800)], [rng.choice(texts) for _ in range(800)]
    got = similarity.token_sort_scores(pd.Series(a, dtype=object), pd.Series(b, dtype=object))
    assert got.tolist() == [similarity.token_sort_score(x, y) for x, y in zip(a, b, strict=True)]

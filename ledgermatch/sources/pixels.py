"""Pixel tables in files that bounds and dates prune.

Rows (x, y, taken, cloud and bands) lie in folders of a month and an area, a square of AREA pixels; within them they go by a space-filling key of small squares, so that row groups are
compact too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AREA, SQUARE = 4096, 64


def morton(x: Column, y: Column, bits: int = 24) -> Column:
    """The bits of two whole numbers in turn: squares that lie together have keys that do."""
    key = F.lit(0).cast("long")
    for i in range(bits):
        for v, at in ((x, 2 * i), (y, 2 * i + 1)):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(v.cast("long"), i).bitwiseAND(F.lit(1).cast("long")), at))
    return key


def _area(c: Column, size: int) -> Column:
    return F.floor(c / size).cast("long")


def write(pixels: DataFrame, path: str, files: int | None = None) -> None:
    """Writes a pixel table; each file holds pixels of one month and area."""
    areas = F.concat_ws("_", _area(F.col("x"), AREA), _area(F.col("y"), AREA))
    # places within an area, so the key needs few bits whatever the coordinates
    key = morton(F.floor(F.pmod("x", F.lit(AREA)) / SQUARE), F.floor(F.pmod("y", F.lit(AREA)) / SQUARE), 6)
    rows = pixels.withColumns({"month": F.date_format("taken", "yyyy-MM"), "area": areas, "__z": key})
    order = ["month", "area", "__z", "y", "x"]
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).drop("__z").write.mode("overwrite").partitionBy("month", "area").parquet(path)


def read(spark: SparkSession, path: str, bounds: tuple[float, float, float, float] | None = None, dates: tuple[str, str] | None = None, most_cloud: float | None = 20.0) -> DataFrame:
    """Pixels within bounds (minx, miny, maxx, maxy) taken from the first date up to before the second, of scenes with less cloud than ``most_cloud``.

    Bounds and dates become conditions on folders first, so files elsewhere are not opened.
    """
    rows = spark.read.option("basePath", path).parquet(path)
    if dates:
        rows = rows.where((F.col("month") >= dates[0][:7]) & (F.col("month") <= dates[1][:7]) & (F.col("taken") >= F.lit(dates[0]).cast("date")) & (F.col("taken") < F.lit(dates[1]).cast("date")))
    if bounds:
        span = lambda lo, hi: [str(i) for i in range(int(lo // AREA), int(hi // AREA) + 1)]
        xs, ys = span(bounds[0], bounds[2]), span(bounds[1], bounds[3])
        rows = rows.where(F.substring_index("area", "_", 1).isin(xs) & F.substring_index("area", "_", -1).isin(ys))
        rows = rows.where(F.col("x").between(bounds[0], bounds[2]) & F.col("y").between(bounds[1], bounds[3]))
    return rows.where(F.col("cloud") < most_cloud) if most_cloud is not None else rows

"""Places of rows within groups, without one task for a group: rows are dealt to ranges, and only counts of ranges are summed up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut, release


def ranked(frame: DataFrame, by: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Adds ``pos``, the place from 0 on within the group ``by`` in ascending ``order`` (null first), and ``n``, the group's size.

    Rows go to ranges of (by, order); a group of any size, even of equal rows, is spread over as many ranges as its share asks for.
    Equal rows follow each other in any order.  The rows come from a table written in the shared folder, so places stay as they are.  An empty
    frame gives an empty one.  ``by`` may be empty: all rows are one group then.
    """
    spark = frame.sparkSession
    parts = parts or 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (*by, *order)]
    rows = cut(frame, "rank-rows")
    tied = rows.withColumn("__tie", F.monotonically_increasing_id())
    dealt = cut(tied.repartitionByRange(parts, *keys, F.col("__tie")).withColumn("__part", F.spark_partition_id()), "rank-parts")
    release(rows)
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each group and range from here on: no more than groups and ranges together
    counts = dealt.groupBy(*by, "__part").agg(F.count("*").alias("__c"))
    counts = counts.withColumn("__base", F.coalesce(F.sum("__c").over(before), F.lit(0))).withColumn("n", F.sum("__c").over(Window.partitionBy(*by)))
    counts = counts.select(*[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)], F.col("__part").alias("__range"), "__base", "n")
    within = Window.partitionBy("__part", *by).orderBy(*[F.col(c).asc_nulls_first() for c in order], F.col("__tie"))
    placed = dealt.withColumn("__w", F.row_number().over(within))
    same = F.col("__part") == F.col("__range")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"__by{i}"))
    return placed.join(counts, same).select(*frame.columns, (F.col("__base") + F.col("__w") - 1).alias("pos"), "n")

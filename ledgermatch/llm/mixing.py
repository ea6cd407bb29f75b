"""Mixing sources to target weights by entropy balancing.

Document ``i`` of source ``s`` gets the rate ``r_i`` that keeps sum(r log r - r) least under the source's token constraint
sum(size_i * r_i) = target_s and 0 <= r_i <= cap.  The dual has one variable a source and the solution is an exponential
tilt, r_i = min(cap, exp(lambda_s * z_i)) with z_i = size_i / mean size of the source's words.  Newton iterations on the convex
dual run for all sources at once as aggregations over the counts of (source, size), which hold all the dual needs;
a bracket, found by doubling lambda and halved when Newton is slow, guards them, and each iteration ends in a written table.  They run
until every source meets the tolerance; a source that can't meet it is an error.  Rates are then rounded to copies by error diffusion over
buckets of documents from the largest down, so what a source takes stays within the smallest documents of its target.

Defined results: a null or empty text has size 0 and takes nothing.  The null source is a source, the last one.  A source
without words has target 0.  Rows of one key, text and source get the
same copies; one key and text in several sources is a row of each, with that source's rate.  Equal inputs give equal results.  An empty table gives an empty mix.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import WORD, cut, named, release

WEIGHTS = (1.0, 2.0, 3.0)
CAP = 3.0


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def exact_sum(x: Column, places: int = 6) -> Column:
    """A sum of doubles that doesn't depend on the order of rows: of decimals with so many places."""
    return F.sum(x.cast(f"decimal(38,{places})")).cast("double")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to one row a source (source, source_size).

    Weights repeat over the sources by code point, null last.  A target over ``cap`` times its source's size stops there and the
    excess goes to the others by weight: in order of cap / weight the saturated sources are a prefix, and the
    level of the rest follows from two running sums.
    """
    # windows over one row a source, not over documents
    order = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "utf-8"))
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(n)) + 1).cast("int"))
    most = F.col("source_size") * F.lit(float(cap))
    rows = sources.withColumn("w", weight).withColumn("most", most).withColumn("ratio", F.col("most") / F.col("w"))
    upto = Window.orderBy("ratio", F.col("source").isNull(), F.encode(F.col("source"), "utf-8")).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    rows = rows.withColumn("total", F.sum("source_size").over(all_rows) * F.lit(float(share))).withColumn("all_w", F.sum("w").over(all_rows))
    rows = rows.withColumn("full", F.coalesce(F.sum("most").over(upto), F.lit(0.0))).withColumn("full_w", F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
    rows = rows.withColumn("level", (F.col("total") - F.col("full")) / (F.col("all_w") - F.col("full_w")))
    # the level where the first source isn't saturated holds for all after it
    level = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(all_rows)["level"]
    rows = rows.withColumn("final", level)
    target = F.when(F.col("final").isNull() | (F.col("ratio") <= F.col("final")), F.col("most")).otherwise(F.col("final") * F.col("w"))
    return rows.select("source", "source_size", target.alias("target"))


def dual(counts: DataFrame, goals: DataFrame, cap: float = CAP, patience: int = 8, tolerance: float = 1e-9) -> DataFrame:
    """Lambda for each source.  ``counts``: sid, size, n with size over 0; ``goals``: sid, source_size, source_squares, target.

    Sources whose target is all that the cap allows have no finite lambda; their rate is the cap.  After ``patience`` rounds every other
    step doubles lambda or halves the bracket, so the rounds end: a source whose rates are all at the cap and too little, or whose
    bracket closes before it meets the tolerance, raises ``ArithmeticError``.
    """
    scale = F.col("source_squares") / F.col("source_size")
    solve = goals.where((F.col("source_size") > 0) & (F.col("target") < cap * F.col("source_size")))
    start = {"lam": F.lit(0.0), "low": F.lit(float("-inf")), "high": F.lit(float("inf")), "done": F.lit(False), "stuck": F.lit(False)}
    state = cut(solve.select("sid", "target", scale.alias("scale"), *[v.alias(k) for k, v in start.items()]), "dual")
    z = F.col("size") / F.col("scale")
    tilted = F.exp(F.least(F.col("lam") * z, F.lit(float(np.log(cap)))))
    turn, open_ = 0, True
    while open_:
        free = tilted < cap
        # places enough for the tolerance of a source of few words
        columns = ["sid", "target", "scale", "lam", "low", "high", "done"]
        step = counts.join(state.select(columns), "sid").groupBy(columns).agg(
            exact_sum(F.col("n") * F.col("size") * tilted, 12).alias("got"),
            exact_sum(F.when(free, F.col("n") * F.col("size") * z * tilted).otherwise(0.0), 12).alias("slope"),
        )
        off = F.col("got") - F.col("target")
        low, high = F.when(off < 0, F.col("lam")).otherwise(F.col("low")), F.when(off > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.when(F.col("slope") > 0, F.col("lam") - off / F.col("slope"))
        reach = F.greatest(F.abs("lam"), F.lit(8.0))
        middle = F.when(low == float("-inf"), F.col("lam") - reach).when(high == float("inf"), F.col("lam") + reach).otherwise((low + high) / 2)
        trusted = F.lit(turn < patience or turn % 2 == 0)
        done = F.col("done") | (F.abs(off) <= tolerance * F.greatest(F.col("target"), F.lit(1.0)))
        lam = F.when(done, F.col("lam")).when(trusted & (newton > low) & (newton < high), newton).otherwise(middle)
        # all rates are at the cap and too little, or the bracket has closed
        stuck = ~done & (((off < 0) & (F.col("slope") == 0)) | (lam <= low) | (lam >= high))
        values = {"lam": lam, "low": low, "high": high, "done": done, "stuck": stuck}
        before, state = state, cut(step.select("sid", "target", "scale", *[v.alias(k) for k, v in values.items()]), "dual")
        release(before)
        # one row: how many sources are open, and one that can't be solved if there is any
        open_, failed = state.agg(F.count_if(~F.col("done")), F.min(F.when(F.col("stuck"), F.struct("sid", "target", "lam")))).first()
        if failed:
            raise ArithmeticError(f"no tilt meets the target of this source: {failed}")
        turn += 1
    return state.select("sid", "scale", "lam")


def diffuse(size: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Copies, each the rate rounded down or up, from the largest document down so that the words taken follow the words due."""
    copies = np.floor(rate + 1e-9).astype(np.int64)
    part = np.clip(rate - copies, 0.0, 1.0)
    owed = 0.0
    for i in range(len(size)):
        owed += part[i] * size[i]
        if part[i] > 1e-9 and owed >= size[i] / 2:
            copies[i] += 1
            owed -= size[i]
    return copies


def _sid(source: Column) -> Column:
    """A source's name without nulls, for joins: behind a mark."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def rates(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, cap: float = CAP) -> DataFrame:
    """Per row: key, h and g (they name the row by key and text), size, sid, source_size, target, docs, rate."""
    rows = cut(docs.select(docs[key].alias("key"), *named(docs, key, text), docs[source].cast("string").alias("source"), size_of(docs[text]).alias("size")), "mix-sizes")
    counts = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    mass = F.col("n") * F.col("size")
    per = counts.groupBy("source").agg(F.sum(mass).cast("long").alias("source_size"), exact_sum(mass.cast("double") * F.col("size")).alias("source_squares"), F.sum("n").alias("docs"))
    sid = _sid(F.col("source"))
    goals = cut(targets(per.select("source", "source_size"), weights, share, cap).withColumn("sid", sid).join(per.select(sid.alias("sid"), "source_squares", "docs"), "sid").drop("source"), "mix-goals")
    lam = dual(counts.where(F.col("size") > 0).select(sid.alias("sid"), "size", "n"), goals, cap)
    tilt = F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(float(np.log(cap)))))
    rate = F.when((F.col("size") == 0) | (F.col("target") == 0), 0.0).when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(tilt)
    # a rate for each (source, size), so that a source's documents are dealt out by size and not all to one task
    table = counts.select(sid.alias("sid"), "size").join(goals.join(lam, "sid", "left"), "sid").select("sid", "size", "source_size", "target", "docs", rate.alias("rate"))
    return rows.select("key", "h", "g", "size", sid.alias("sid")).join(table, ["sid", "size"]).select("key", "h", "g", "size", "sid", "source_size", "target", "docs", "rate")


def copies(rated: DataFrame, per_bucket: int = 5_000) -> DataFrame:
    """Rows (h, g, sid, copies): rates rounded to whole copies in buckets of a source's documents.

    Rows of one key, text and source are one unit and get the same copies.
    """
    units = rated.groupBy("h", "g", "sid").agg(F.min("size").alias("size"), F.min("rate").alias("rate"), F.min("docs").alias("docs"), F.count("*").alias("m"))
    dealt = units.withColumn("bucket", F.pmod(F.col("h"), (F.col("docs") / F.lit(per_bucket)).cast("long") + 1))

    def rounded(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(mass=frame["size"] * frame["m"]).sort_values(["mass", "h", "g"], ascending=[False, True, True])
        made = diffuse(frame["mass"].to_numpy().astype(float), frame["rate"].to_numpy())
        return pd.DataFrame({"h": frame["h"], "g": frame["g"], "sid": frame["sid"], "copies": made})

    return dealt.select("h", "g", "sid", "bucket", "size", "m", "rate").groupBy("sid", "bucket").applyInPandas(rounded, "h long, g long, sid string, copies long")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, cap: float = CAP) -> DataFrame:
    """Per row: key, size, source_size, target (its source's), rate, copies and taken (words the mix takes from it)."""
    rated = rates(docs, key, source, text, weights, share, cap)
    out = rated.join(copies(rated), ["h", "g", "sid"])
    return out.select(F.col("key").alias(key), "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, cap: float = CAP) -> DataFrame:
    """The documents of the mix: each row as often as its copies, with its own columns."""
    cols = docs.columns
    taken = cut(copies(rates(docs, key, source, text, weights, share, cap)), "mix-copies").where(F.col("copies") > 0)
    rows = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(cols)], *named(docs, key, text), _sid(docs[source]).alias("sid"))
    repeated = rows.join(taken, ["h", "g", "sid"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])

"""Merkle manifest of a dataset: a leaf per row, a tree per group (source), a tree over the groups' roots, and a proof per row.

Leaves ascend by key within their group.  Fixed-size blocks of BLOCK leaves are ordered arrays; ``sequence`` and ``slice`` cut a level into runs
of ARITY, ``transform`` hashes the runs, and ``aggregate`` goes from level to level until a block is one root.  Block roots are the leaves of the next
round, so rounds grow with the logarithm of a group's size to the base BLOCK.  The subroots of the groups, in order, are one more such tree.
Proofs go down the same blocks: a block's rows get the siblings in their own block and then those that its root has above.

No task holds more than a block; places of leaves come from counts of ranges (``ranks.ranked``), so a group may hold any share of the rows.

Defined results: a null field counts as ``-``, which no value can be, as values start with their length; a null key comes first, a null group is a
group of its own and comes first too.  Equal rows have equal leaves, so their order doesn't show; rows of one key go by leaf.  An empty table gives no rows.
Other columns of the table, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.common import cut
from ledgermatch.llm.ranks import ranked

ARITY = 16
#: Levels that one round collapses, and so the leaves of a block.
LEVELS = 3
BLOCK = ARITY**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value: no two lists of values give one text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _runs(nodes: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int")), lambda r: F.slice(nodes, r * ARITY + 1, ARITY))


def _levels(nodes: Column, depth: Column) -> Column:
    """The nodes of each level from 0 to depth, in runs of ARITY."""
    steps = F.slice(F.sequence(F.lit(1), F.lit(LEVELS)), F.lit(1), depth)
    up = lambda done, _: F.concat(done, F.array(_let(F.transform(F.element_at(done, -1), lambda run: F.sha2(F.array_join(run, ""), 256)), _runs)))
    return F.aggregate(steps, F.array(_let(nodes, _runs)), up)


def _collapse(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Rounds of blocks: g, block, n (nodes of the group in this round), depth, items (struct of h and payload), levels, root.

    ``nodes`` has g, pos, n, h and a struct ``payload``.  Groups of one block end with that round, the others hand on their block roots.
    """
    rounds = []
    while True:
        depth = F.when(F.col("n") <= 1, 0).when(F.col("n") <= ARITY, 1).when(F.col("n") <= ARITY**2, 2).otherwise(LEVELS)
        item = F.struct("pos", "h", "payload")
        blocks = nodes.groupBy("g", F.floor(F.col("pos") / BLOCK).alias("block"), "n").agg(F.sort_array(F.collect_list(item)).alias("items"))
        made = _levels(F.transform("items", lambda x: x["h"]), F.col("depth"))
        blocks = blocks.withColumn("depth", depth).withColumn("levels", made).withColumn("root", F.col("levels")[F.col("depth")][0][0])
        rounds.append(cut(blocks, f"{name}-{len(rounds)}"))
        # a row a block
        more = rounds[-1].where(F.col("n") > BLOCK)
        if more.isEmpty():
            return rounds
        nodes = more.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("root").alias("h"), F.struct(F.lit(0).alias("none")).alias("payload"))


def _siblings(i: Column, depth: Column, levels: Column) -> Column:
    """Per level of a block the text of the digests left and right of the node's own in its run."""

    def at(k: Column) -> Column:
        own = F.floor(i / F.pow(F.lit(float(ARITY)), k)).cast("int")
        place = F.pmod(own, F.lit(ARITY))
        run = F.element_at(F.element_at(levels, k + 1), F.floor(own / ARITY).cast("int") + 1)
        return F.struct(F.array_join(F.slice(run, F.lit(1), place), "").alias("left"), F.array_join(F.slice(run, place + 2, F.lit(ARITY)), "").alias("right"))

    return F.transform(F.slice(F.sequence(F.lit(0), F.lit(LEVELS - 1)), F.lit(1), depth), at)


def _down(blocks: DataFrame) -> DataFrame:
    """A row per node of a round: g, pos, h, payload, siblings (its own block's, then ``above``) and the columns ``kept`` of its block."""
    each = F.transform("items", lambda x, i: F.struct(x.alias("x"), _siblings(i, F.col("depth"), F.col("levels")).alias("s")))
    rows = blocks.select("g", "kept", "above", F.explode(each).alias("e"))
    return rows.select("g", F.col("e.x.pos").alias("pos"), F.col("e.x.h").alias("h"), F.col("e.x.payload").alias("payload"), F.concat("e.s", "above").alias("siblings"), "kept")


def _expand(rounds: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The rows of the first round with all siblings up to what ``ends`` (g, above, kept) has above each group's root."""
    ends = ends.select(F.col("g").alias("eg"), "above", "kept")
    rows = None
    for blocks in reversed(rounds):
        last = blocks.where(F.col("n") <= BLOCK).join(ends, F.col("g").eqNullSafe(F.col("eg"))).drop("eg")
        if rows is not None:
            over = rows.select(F.col("g").alias("og"), F.col("pos").alias("at"), F.col("siblings").alias("above"), "kept")
            inner = blocks.where(F.col("n") > BLOCK).join(over, F.col("g").eqNullSafe(F.col("og")) & (F.col("block") == F.col("at"))).drop("og", "at")
            last = last.unionByName(inner)
        rows = _down(last)
    return rows


class Manifest(NamedTuple):
    """``rows``: payload columns, g (the group), pos, leaf, subroot, root, siblings (array of left and right, bottom up).  ``groups``: g, n, subroot."""

    rows: DataFrame
    groups: DataFrame


def manifest(leaves: DataFrame) -> Manifest:
    """The manifest of leaves with columns g (group), k (order within it), leaf and a struct ``payload``."""
    placed = ranked(leaves, ["g"], ["k", "leaf"]).select("g", "pos", "n", F.col("leaf").alias("h"), "payload")
    rounds = _collapse(placed, "merkle-blocks")
    groups = None
    for r, blocks in enumerate(rounds):
        ended = blocks.where(F.col("n") <= BLOCK).select("g", F.col("root").alias("subroot"))
        groups = ended if r == 0 else groups.unionByName(ended)
    sizes = rounds[0].groupBy("g").agg(F.max("n").alias("n")).withColumnRenamed("g", "sg")
    groups = cut(groups.join(sizes, F.col("g").eqNullSafe(F.col("sg"))).drop("sg"), "merkle-groups")
    top = ranked(groups.select(F.col("g").alias("source"), "subroot"), [], ["source"])
    top = top.select(F.lit(0).alias("g"), "pos", "n", F.col("subroot").alias("h"), F.struct("source", "subroot").alias("payload"))
    above = _collapse(top, "merkle-top")
    root = above[-1].where(F.col("n") <= BLOCK).select("g", F.expr("CAST(array() AS array<struct<left: string, right: string>>)").alias("above"), F.col("root").alias("kept"))
    ends = _expand(above, root).select(F.col("payload.source").alias("g"), F.col("siblings").alias("above"), F.struct(F.col("payload.subroot").alias("subroot"), F.col("kept").alias("root")).alias("kept"))
    rows = _expand(rounds, cut(ends, "merkle-ends"))
    return Manifest(rows.select("payload.*", "g", "pos", F.col("h").alias("leaf"), "kept.subroot", "kept.root", "siblings"), groups)


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(siblings, leaf, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]), 256))


def proof_digest(siblings: Column) -> Column:
    """One digest for a whole proof: of all siblings, bottom up, left to right."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def verify_documents(docs: DataFrame, every: int = 5, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", by: str = "source", text: str = "text") -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, and what a verifier finds who gets the row tampered with: folded_root and verified.

    Rows whose key's CRC-32 (of its decimal text) ``every`` divides come with the letters A-Z of their text lower-cased; a null key is never
    tampered with, and a text without such letters, null included, still verifies.
    """
    tampered = F.pmod(F.crc32(docs[key].cast("string")), F.lit(every)) == 0
    altered = [F.translate(docs[f], _UPPER, _LOWER) if f == text else docs[f] for f in fields]
    leaves = docs.select(
        docs[by].alias("g"), docs[key].alias("k"), leaf_of(*[docs[f] for f in fields]).alias("leaf"), F.struct(docs[key].alias("key"), F.when(tampered, leaf_of(*altered)).alias("shown")).alias("payload")
    )
    rows = manifest(leaves).rows.withColumn("folded_root", folded(F.coalesce("shown", "leaf"), F.col("siblings")))
    return rows.select(F.col("key").alias(key), "leaf", "subroot", "root", proof_digest(F.col("siblings")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))

"""Conversation prefix trie by partition refinement.

All conversations start in one class.  Classes split by the next turn; a class of one conversation retires, and the rest of that conversation
comes out as a unary chain.  So the work follows the turns that conversations share, not their lengths.  One round splits classes turn by turn over a
stride of turns: within it a class is named by the digests of its turns since the round began, and its members are counted by (depth, name).  Strides
double up to STRIDE, so rounds grow with the deepest shared prefix divided by STRIDE.  A class is known by its depth and its smallest member.

Folding back: each shared node belongs to its smallest member.  A conversation's own values, summed from its end towards its start, give at every
depth what that conversation adds to the node it passes there; one aggregation by node gives all subtrees' sums, without a pass per level.

No task holds a class: members are only counted, and the ids that end at a node are joined in chunks of CHUNK, in order.  A group of equal conversations
and a conversation of any length are split; the turns of one stride of one conversation are what one row holds.

Defined results: rows without a conversation id belong to no conversation.  Turns go by number, null first; rows of one number by role and digest of
role and text, so repeated rows are turns of their own.  A null role or text is empty.  An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermatch.llm.common import WORD, cut, release
from ledgermatch.llm.ranks import ranked

FIRST_STRIDE, STRIDE = 4, 256
CHUNK = 4096
PERIOD, LONGEST = 20, 4
_EMPTY = hashlib.sha256(b"").hexdigest()


def _name(value: Column) -> Column:
    """128 bits of a digest."""
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def turns_of(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per turn: c, p (place from 1 on), x (digest of role and text), w (words), n (turns of the conversation)."""
    t = conversations
    r, s = F.coalesce(t[role], F.lit("")), F.coalesce(t[text], F.lit(""))
    x = _name(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, s))
    rows = t.where(t[conv].isNotNull()).select(t[conv].cast("long").alias("c"), t[turn].alias("turn"), r.alias("role"), x.alias("x"), F.regexp_count(s, F.lit(WORD)).cast("long").alias("w"))
    return ranked(rows, ["c"], ["turn", "role", "x"]).select("c", (F.col("pos") + 1).alias("p"), "x", "w", "n")


def with_borrowed_openings(turns: DataFrame, period: int = PERIOD, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Conversations (c, len) and their turns (c, p, len, x, w), each rebuilt on the opening of another.

    Conversation c begins with the first h turns of conversation c - c % period (as far as it has them; none if it isn't there), and goes on with its own turns after
    its first h; h is the CRC-32 of c's decimal text modulo ``longest``.
    """
    original = turns = cut(turns.withColumn("h", F.crc32(F.col("c").cast("string")) % longest), "trie-original")
    opening = turns.where((F.col("c") % period == 0) & (F.col("p") < longest)).select(F.col("c").alias("b"), F.col("p").alias("q"), "x", "w", F.col("n").alias("bn"))
    convs = turns.where("p = 1").select("c", "n", "h", (F.col("c") - F.col("c") % period).alias("b"))
    convs = convs.join(opening.where("q = 1").select("b", "bn"), "b", "left").withColumn("k", F.least("h", F.coalesce("bn", F.lit(0))))
    convs = cut(convs.select("c", "b", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "trie-conversations")
    borrowed = convs.join(opening, "b").where(F.col("q") <= F.col("h")).select("c", F.col("q").alias("p"), "len", "x", "w")
    own = turns.where(F.col("p") > F.col("h")).drop("h", "n").join(convs.select("c", "h", "k", "len"), "c").select("c", (F.col("p") - F.col("h") + F.col("k")).alias("p"), "len", "x", "w")
    made = cut(borrowed.unionByName(own), "trie-turns")
    release(original)
    return convs.select("c", "len"), made


def _steps(rows: DataFrame) -> DataFrame:
    """Per conversation and turn of a stride: c, cls, p, len, w, key (names the class after that turn), prev (the class before it)."""
    held = rows.groupBy("c", "cls", "len").agg(F.sort_array(F.collect_list(F.struct("p", "x", "w"))).alias("t"))
    begin = F.expr("CAST(array() AS array<struct<p: bigint, w: bigint, prev: binary, key: binary>>)")

    def split(done: Column, t: Column) -> Column:
        before = F.coalesce(F.try_element_at(done, F.lit(-1))["key"], F.encode(F.col("cls").cast("string"), "UTF-8"))
        return F.concat(done, F.array(F.struct(t["p"].alias("p"), t["w"].alias("w"), before.alias("prev"), _name(F.concat(before, t["x"])).alias("key"))))

    return held.select("c", "cls", "len", F.explode(F.aggregate("t", begin, split)).alias("e")).select("c", "cls", "len", "e.*")


def _ends(members: DataFrame) -> DataFrame:
    """Per node (p, label): the SHA-256 of the ascending ids c, joined by commas.

    Chunks of CHUNK ids are joined in parallel; a node with more than one chunk has its digest fed chunk by chunk, one chunk held at a time.
    """
    chunks = ranked(members, ["p", "label"], ["c"]).groupBy("p", "label", "n", F.floor(F.col("pos") / CHUNK).alias("chunk"))
    chunks = cut(chunks.agg(F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids")), "trie-ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for p, label, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (p, label) == node:
                    digest.update(b",")
                else:
                    done += [(*node, digest.hexdigest())] if node else []
                    node, digest = (p, label), hashlib.sha256()
                digest.update(ids.encode())
            yield _batch(done)
        yield _batch([(*node, digest.hexdigest())] if node else [])

    def _batch(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
        p, label, ends = zip(*done, strict=True) if done else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(label, pa.int64()), pa.array(ends, pa.string())], ["p", "label", "ends"])

    small = chunks.where(F.col("n") <= CHUNK).select("p", "label", F.sha2("ids", 256).alias("ends"))
    large = chunks.where(F.col("n") > CHUNK).repartition("p", "label").sortWithinPartitions("p", "label", "chunk").select("p", "label", "ids")
    return small.unionByName(large.mapInArrow(run, "p long, label long, ends string"))


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations (c, len) with turns (c, p, len, x, w): see the module.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    all_of = convs.agg(F.min("c").alias("c"), F.count("*").alias("n"), F.sum((F.col("len") == 0).cast("long")).alias("turnless")).first()
    root, some = all_of.c, all_of.n
    rest = turns.select("c", F.lit(root).cast("long").alias("cls"), "p", "len", "x", "w")
    unary = lambda df: df.select("p", F.col("c").alias("label"), F.col("c").alias("parent"), F.lit(1).cast("long").alias("n"), "w", (F.col("p") == F.col("len")).cast("long").alias("ended"))
    chains, split, shared, depth, stride = [], [], [], 0, FIRST_STRIDE
    while some > 1:
        to = depth + stride
        steps = cut(_steps(rest.where(F.col("p") <= to)), "trie-steps")
        ended = F.sum((F.col("p") == F.col("len")).cast("long"))
        nodes = cut(steps.groupBy("p", "key").agg(F.min("c").alias("label"), F.count("*").alias("n"), F.min("w").alias("w"), F.min("prev").alias("prev"), F.min("cls").alias("cls"), ended.alias("ended")), "trie-nodes")
        over = nodes.select((F.col("p") + 1).alias("p"), F.col("key").alias("prev"), F.col("label").alias("over"))
        found = nodes.join(over, ["p", "prev"], "left")
        split.append(found.select("p", "label", F.when(F.col("p") == depth + 1, F.col("cls")).otherwise(F.col("over")).alias("parent"), "n", "w", "ended"))
        with_label = steps.select("c", "p", "len", "key").join(nodes.where("n > 1").select("p", "key", "label", "n", "w", "ended"), ["p", "key"]).drop("key")
        shared.append(cut(with_label, "trie-shared"))
        later = rest.where(F.col("p") > to)
        active = shared[-1].where((F.col("p") == to) & (F.col("len") > to)).select("c", F.col("label").alias("cls"))
        chains.append(unary(later.join(active, "c", "left_anti")))
        some = 2 if not active.isEmpty() else 0
        if some:
            rest = cut(later.drop("cls").join(active, "c").select("c", "cls", "p", "len", "x", "w"), "trie-rest")
        release(steps)
        depth, stride = to, min(2 * stride, STRIDE)
    if not split:  # one conversation at most
        chains.append(unary(rest))
    return _folded(convs, split, chains, shared, root, all_of)


def _folded(convs: DataFrame, split: list[DataFrame], chains: list[DataFrame], shared: list[DataFrame], root: int | None, all_of) -> DataFrame:
    spark, nothing = convs.sparkSession, "p long, label long, parent long, n long, w long, ended long"
    nodes, passed = spark.createDataFrame([], nothing), spark.createDataFrame([], "c long, p long, len long, label long, n long, w long, ended long")
    for part in split:
        nodes = nodes.unionByName(part)
    for part in shared:
        passed = passed.unionByName(part.select(*passed.columns))
    nodes = cut(nodes, "trie-split")
    # what a conversation adds to each shared node on its way: a leaf at its end, and the tokens of its own nodes from there on
    own = F.col("label") == F.col("c")
    leaf = F.when(F.col("p") == F.col("len"), (own & (F.col("ended") == F.col("n"))).cast("long"))
    added = passed.withColumn("leaf", F.coalesce(F.max(leaf).over(Window.partitionBy("c")), F.lit(1)))
    added = added.withColumn("saved", F.sum(F.when(own, (F.col("n") - 1) * F.col("w")).otherwise(0)).over(Window.partitionBy("c").orderBy(F.desc("p"))))
    sums = added.groupBy("p", "label").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    children = nodes.groupBy((F.col("p") - 1).alias("p"), F.col("parent").alias("label")).agg(F.count("*").alias("n_children"))
    ends = _ends(passed.where(F.col("p") == F.col("len")).select("p", "label", "c").unionByName(convs.where("len = 0").select(F.lit(0).cast("long").alias("p"), F.lit(root).cast("long").alias("label"), "c")))
    ends = cut(ends, "trie-ended")
    joint = nodes.where("n > 1").join(sums, ["p", "label"]).join(children, ["p", "label"], "left").join(ends, ["p", "label"], "left")
    alone = nodes.where("n = 1")
    for part in chains:
        alone = alone.unionByName(part)
    alone = alone.withColumns({"n_children": 1 - F.col("ended"), "n_leaves": F.lit(1).cast("long"), "saved_tokens": F.lit(0).cast("long"), "ends": F.when(F.col("ended") == 1, F.sha2(F.col("label").cast("string"), 256))})
    made = ["label", "p", "parent", "n", "n_children", "n_leaves", "saved_tokens", "ends"]
    below = cut(joint.select(*made).unionByName(alone.select(*made)), "trie-below")
    if root is None:
        return _named(below)
    first = below.where("p = 1").agg(F.count("*").alias("n_children"), F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"))
    top = first.select(F.lit(root).cast("long").alias("label"), F.lit(0).cast("long").alias("p"), F.lit(None).cast("long").alias("parent"), F.lit(all_of.n).cast("long").alias("n"), "n_children", "n_leaves", "saved_tokens")
    return _named(below.unionByName(top.join(ends.where("p = 0").select("ends"), F.lit(True), "left").select(*made)))


def _named(nodes: DataFrame) -> DataFrame:
    number = lambda c, name: F.col(c).cast("long").alias(name)
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    return nodes.select(number("label", "conv_id"), number("p", "depth"), number("parent", "parent_conv_id"), number("n", "n_convs"), *counts, F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table with conv_id, turn, role and text."""
    return trie(*with_borrowed_openings(turns_of(conversations)))

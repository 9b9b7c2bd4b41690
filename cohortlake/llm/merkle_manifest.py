"""Merkle manifest of a dataset by time-forward processing.

Each document is a leaf; the leaves of a language form a tree of ``fanout`` children a node, and the roots of
the languages form one more tree above. A node's label is its level, its tree and its place there, so that
labels ascend from the leaves to the root. Nodes send their digests, labelled with the receiving parent, through
an external priority queue: written messages that a shuffle orders by label. The messages of one level are all
sent before the next level's first node is due, so a whole level leaves the queue at once and each parent meets
its children in order, at most ``fanout`` of them. The root of a small tree waits in the queue until the
tree of languages is due. The reversed sweep hands the siblings on the way to the root down the same labels: a
node passes to each child what it got itself and the child's siblings.

Leaves are numbered by a sort over ranges of (language, id, digest, row), with the counts of the partitions
before; no language is sorted in one task, whatever its share. The driver sees one count for each partition.

Defined cases: a null column is hashed as ``-``; a null language is a tree of its own, before the others; null
ids come last in their tree; rows with one id follow each other by their digests; equal rows are leaves of their
own; an empty table gives an empty result; only the five named columns are hashed, others are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import written

FANOUT = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(values: list[Column]) -> Column:
    """Hash of the values, each with its length in bytes before it, so that no two rows run together."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; a text of one byte a letter has no other letters to change."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def leaves(docs: DataFrame, tampered: Column, changed: Column) -> DataFrame:
    """lang, doc_id, leaf, shown (the digest with ``changed`` as text where ``tampered``, else null), row."""
    values = [F.col(c).cast("string") for c in COLUMNS]
    shown = F.when(tampered, leaf_digest([*values[:-1], changed]))
    return docs.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(values).alias("leaf"), shown.alias("shown"), F.monotonically_increasing_id().alias("row"))


def numbered(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Adds ``at``: 0, 1, ... in this order. ``rows`` is read twice, so a written table is best."""
    ordered = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), label)
    held = ordered.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # one row for each partition
    before, starts = 0, []
    for r in held:
        starts.append((r["part"], before))
        before += r["n"]
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "part long, before long"))
    return ordered.join(starts, F.shiftright("at", 33) == F.col("part"), "left").withColumn("at", F.expr(f"(at & {2**33 - 1}L) + before")).drop("part", "before")


def _level(messages: DataFrame, fanout: int, label: str) -> DataFrame:
    """tree, at, n (nodes of the tree below), children in order, digest. ``messages``: tree, at, n, child (a struct with digest)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col("at").alias("slot"), F.col("child"))))
    due = messages.groupBy("tree", "n", F.expr(f"at div {fanout}").alias("to")).agg(ordered.alias("children"))
    due = due.withColumn("children", F.transform("children", lambda c: c["child"]))
    digest = F.sha2(F.array_join(F.col("children.digest"), ""), 256)
    return written(due.select("tree", F.col("to").alias("at"), "n", "children", F.when(F.col("n") > 1, digest).otherwise(F.col("children")[0]["digest"]).alias("digest")), label)


def climb(messages: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees, lowest first, and tree, digest, height of their roots. A tree of one node has a level of one child that isn't hashed again."""
    levels, roots = [], []
    while True:
        level = _level(messages, fanout, f"merkle-level-{len(levels) + 1}")
        levels.append(level)
        roots.append(level.where(F.col("n") <= fanout).select("tree", "digest", F.lit(len(levels)).alias("height")))
        messages = level.where(F.col("n") > fanout).select("tree", "at", F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), F.struct("digest").alias("child"))
        if messages.isEmpty():
            return levels, reduce(DataFrame.unionByName, roots)


def _handed(level: DataFrame, state: DataFrame, fanout: int, *keep: str) -> DataFrame:
    """What the nodes of a level hand to their children: the same columns as in ``state``, of the children. ``steps``: (left, right) siblings from here to the root."""
    named = state.select(F.col("tree").alias("to_tree"), F.col("at").alias("to"), "steps", *keep)
    met = level.join(named, (F.col("tree") == F.col("to_tree")) & (F.col("at") == F.col("to")))
    met = met.select("tree", F.col("at").alias("to"), "n", "steps", *keep, F.col("children.digest").alias("all"), F.posexplode("children").alias("slot", "child"))
    side = lambda begin, length: F.array_join(F.slice("all", begin, length), "")
    step = F.struct(side(F.lit(1), F.col("slot")).alias("left"), side(F.col("slot") + 2, F.lit(fanout)).alias("right"))
    steps = F.when(F.col("n") > 1, F.concat(F.array(step), "steps")).otherwise(F.col("steps"))
    return met.select("tree", F.expr(f"to * {fanout} + slot").alias("at"), steps.alias("steps"), *keep, "child")


NO_STEPS = "cast(array() AS array<struct<left: string, right: string>>)"


def manifest(docs: DataFrame, tampered: Column | None = None, changed: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, steps (siblings to the left and right, from the leaf to the root), shown (the leaf as tampered with, or null)."""
    rows = written(leaves(docs, F.lit(False) if tampered is None else tampered, F.col("text") if changed is None else changed), "merkle-leaves")
    placed = numbered(rows, [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_last(), F.col("leaf").asc(), F.col("row").asc()], "merkle-order")
    langs = written(placed.groupBy("lang").agg(F.min("at").alias("first"), F.count("*").alias("n")), "merkle-langs")
    # Leaves are in the order of their languages, so the languages are in the order of their first leaves.
    trees = written(numbered(langs, [F.col("first")], "merkle-trees").select(F.col("lang").alias("of"), "first", "n", F.col("at").alias("tree")), "merkle-trees")
    sent = placed.join(trees, F.col("lang").eqNullSafe(F.col("of"))).select("tree", (F.col("at") - F.col("first")).alias("at"), "n", F.struct(F.col("leaf").alias("digest"), "doc_id", "shown").alias("child"))
    levels, subroots = climb(sent, fanout)
    count = trees.count()
    above, roots = climb(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("at"), F.lit(count).cast("long").alias("n"), F.struct("digest").alias("child")), fanout)
    # The reversed sweep, first through the tree of languages, then through the languages' trees of the heights they have.
    state = roots.select("tree", F.lit(0).cast("long").alias("at"), F.expr(NO_STEPS).alias("steps"), F.col("digest").alias("root"))
    for level in reversed(above):
        state = _handed(level, state, fanout, "root")
    tops = state.select(F.col("at").alias("tree"), "steps", "root", F.col("child.digest").alias("subroot")).join(subroots.select("tree", "height"), "tree")
    tops = written(tops.select("tree", F.lit(0).cast("long").alias("at"), "steps", "root", "subroot", "height"), "merkle-tops")
    state = None
    for height in range(len(levels), 0, -1):
        due = tops.where(F.col("height") == height).drop("height")
        due = due if state is None else due.unionByName(state)
        state = _handed(levels[height - 1], due, fanout, "root", "subroot")
        if height > 1:
            state = written(state.drop("child"), f"merkle-steps-{height - 1}")
    return state.select("child.doc_id", F.col("child.digest").alias("leaf"), "subroot", "root", "steps", "child.shown")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def proof_digest(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def verified_manifest(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, after a change of every third text (by crc32 of the id) to lower case."""
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string")) % 3 == 0
    out = manifest(docs, tampered, lower_ascii(F.col("text").cast("string")), fanout)
    out = out.withColumn("folded_root", folded(F.coalesce("shown", "leaf"), F.col("steps")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))

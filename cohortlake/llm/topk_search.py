"""Exact top-k by integer inner product with dual-tree cover-tree search.

Equal vectors are one point, with the ``k + 1`` smallest ids among them: more can't be among any query's ``k``
best. The top of the tree is fitted on the ``PIVOTS`` points of each length with the smallest hashes: every point
goes to the cell of its nearest pivot, in one pass. Cells that lie together are packed into blocks of bounded size, a
larger cell is dealt to several. A task holds the cover tree of one block; queries come to it in groups,
each with a cover tree of its own. A node's children are taken farthest first, so that they lie farther apart than the radius
at which they cover the node. A pair of nodes is left if no point below the one can reach the worst k-th
score of the queries below the other: the product of the centers, and of radii and lengths, bounds all scores below.
Each query first searches the block of its own cell, which gives that score; then it goes to each other block
that has a cell it could still gain from. That is all blocks where distances say little, as for random vectors of many
dimensions: a stated query set against all points, in blocks.

Defined cases: vectors that are null or hold null or non-finite components take no part; rows equal in id and
vector count once, and such a row is no candidate of its own; rows that share an id but not the vector are
queries and candidates of their own; only vectors of the query's length are its candidates; null ids are no
queries and come last in ties; fewer than ``k`` candidates are all given; an empty table gives an empty result; other columns
are left out. Scores must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import released, written

PIVOTS = 256  # points of each length that the top of the tree is fitted on; lengths are few
BLOCK = 65_536  # points or queries that a task holds, at most about twice as many
SMALL_BLOCK = 1024  # below it more tasks don't pay
LEAF, FAN, QUERIES = 64, 32, 4096
LEAST = -(2**63)


def _vector_batches(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), 4096):
                column = batch.column("vector")[begin : begin + 4096]
                ends = np.r_[0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))].astype(np.int64)
                flat = column.flatten().cast(pa.float64())
                values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
                bad = np.r_[0, np.cumsum(~np.isfinite(values))]
                fine = np.flatnonzero((bad[ends[1:]] == bad[ends[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False))
                with np.errstate(invalid="ignore"):
                    whole = np.floor(scale * values)
                    whole = np.where(np.isfinite(whole), whole, 0).astype("<i8")
                packed = [whole[ends[i] : ends[i + 1]].tobytes() for i in fine]
                yield pa.RecordBatch.from_arrays([batch.column("id")[begin : begin + 4096].take(pa.array(fine)), pa.array(packed, pa.binary())], ["id", "v"])

    return run


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """Vectors of one length as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), length) if length else np.zeros((len(column), 0), np.int64)


def farthest_first(points: np.ndarray, most: int, first: int = 0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centers, each the farthest from those before, until they cover at half the first radius; the nearest center of each point, and how far it is."""
    chosen, of = [first], np.zeros(len(points), np.int64)
    away = np.linalg.norm(points - points[first], axis=1)
    enough = away.max() / 2
    while len(chosen) < most and away.max() > enough:
        new = int(away.argmax())
        d = np.linalg.norm(points - points[new], axis=1)
        closer = d < away
        of[closer], away[closer] = len(chosen), d[closer]
        chosen.append(new)
    return chosen, of, away


class CoverTree:
    """Nodes with a center, the radius at which it covers all points below, and the places of these points in ``order``."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        self.order = np.arange(len(points))
        centers, radius, begin, end, children = [], [], [], [], []
        todo = [(0, len(points), -1, 0)]  # places, parent, place of the center among them
        for at, (low, high, parent, first) in enumerate(todo):
            own = self.order[low:high]
            below = points[own]
            chosen, of, away = farthest_first(below, 1 if high - low <= leaf else fan, first)
            centers.append(below[first])
            radius.append(np.linalg.norm(below - below[first], axis=1).max() if len(chosen) > 1 else away.max())
            begin.append(low)
            end.append(high)
            children.append([])
            if parent >= 0:
                children[parent].append(at)
            if len(chosen) > 1:
                rank = np.argsort(of, kind="stable")
                self.order[low:high] = own[rank]
                cuts = np.r_[0, np.cumsum(np.bincount(of))]
                todo += [(low + a, low + b, at, int(np.flatnonzero(rank[a:b] == c)[0])) for a, b, c in zip(cuts[:-1].tolist(), cuts[1:].tolist(), chosen, strict=True)]
        self.centers, self.radius, self.begin, self.end = np.array(centers), np.array(radius), np.array(begin), np.array(end)
        self.length = np.linalg.norm(self.centers, axis=1)
        self.first_child = np.r_[0, np.cumsum([len(c) for c in children])]
        self.child = np.array([c for some in children for c in some], np.int64)

    def is_leaf(self, node: np.ndarray) -> np.ndarray:
        return self.first_child[node + 1] == self.first_child[node]

    def below(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each child of the nodes the place of its node in ``node``, and the child."""
        count = self.first_child[node + 1] - self.first_child[node]
        which = np.repeat(np.arange(len(node)), count)
        step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        return which, self.child[self.first_child[node][which] + step]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows: as doubles where all sums stay below 2**53."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def search(tree: CoverTree, points: np.ndarray, least: np.ndarray, queries: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, score): for each query the ``k`` points of the highest scores that reach its bound, of equal ones those with the smallest ``least``."""
    asked = CoverTree(queries.astype(float), LEAF // 2)
    worst_of = bound.copy()  # of each query
    # All pairs of nodes at once: there are few nodes, a leaf holds dozens of points.
    reach = asked.centers @ tree.centers.T + asked.radius[:, None] * tree.length + np.outer(asked.length, tree.radius) + np.outer(asked.radius, tree.radius)
    reach += 1 + 1e-9 * np.outer(asked.length + asked.radius, tree.length + tree.radius)
    worst = np.array([worst_of[asked.order[a:b]].min() for a, b in zip(asked.begin, asked.end, strict=True)])
    q, c = np.zeros(1, np.int64), np.zeros(1, np.int64)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    while len(q):
        keep = reach[q, c] >= worst[q]
        q, c = q[keep], c[keep]
        q_leaf, c_leaf = asked.is_leaf(q), tree.is_leaf(c)
        done = q_leaf & c_leaf
        pairs.append((q[done], c[done]))
        open_q = ~q_leaf & (c_leaf | (asked.radius[q] >= tree.radius[c]))
        open_c = ~done & ~open_q
        which, child = asked.below(q[open_q])
        which_c, child_c = tree.below(c[open_c])
        q, c = np.r_[child, q[open_c][which_c]], np.r_[c[open_q][which], child_c]
    q, c = (np.concatenate(x) for x in zip(*pairs, strict=True))
    out = []
    rank = np.lexsort((-reach[q, c], q))
    q, c = q[rank], c[rank]
    for leaf in np.unique(q):
        rows = asked.order[asked.begin[leaf] : asked.end[leaf]]
        nodes = c[np.searchsorted(q, leaf) : np.searchsorted(q, leaf, "right")]
        best = (np.empty(0, np.int64),) * 3  # row, point, score
        at, step = 0, 8
        while at < len(nodes) and reach[leaf, nodes[at]] >= worst_of[rows].min():  # the first reaches farthest
            some = nodes[at : at + step]
            at, step = at + step, step * 2
            place = np.concatenate([tree.order[tree.begin[n] : tree.end[n]] for n in some])
            score = products(queries[rows], points[place])
            row, column = np.nonzero(score >= worst_of[rows][:, None])
            best = tuple(np.r_[b, new] for b, new in zip(best, (row, place[column], score[row, column]), strict=True))
            order = np.lexsort((least[best[1]], -best[2], best[0]))
            best = tuple(b[order] for b in best)
            first = np.searchsorted(best[0], np.arange(len(rows)))
            nth = np.arange(len(best[0])) - first[best[0]]
            full = np.flatnonzero(nth == k - 1)
            worst_of[rows[best[0][full]]] = np.maximum(worst_of[rows[best[0][full]]], best[2][full])
            best = tuple(b[nth < k] for b in best)
        out.append((rows[best[0]], best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 3


class Block:
    """The points of one block, and then its queries, as they come in order."""

    def __init__(self, key: tuple, k: int):
        self.key, self.k, self.parts, self.waiting, self.n, self.tree = key, k, [], [], 0, None

    def take(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        is_query = rows.column("asks").to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(is_query, True))
        if cut:
            self.parts.append(rows.slice(0, cut))
        if cut < len(rows):
            self.waiting.append(rows.slice(cut))
            self.n += len(rows) - cut
            if self.n >= QUERIES:
                yield from self.answers()

    def answers(self) -> Iterator[pa.RecordBatch]:
        if self.n and (self.parts or self.tree):
            length = self.key[2]
            if self.tree is None:
                held = pa.Table.from_batches(self.parts)
                self.points = matrix(held.column("v").combine_chunks(), length)
                self.pid, self.ids = held.column("pid").to_numpy(), held.column("ids").combine_chunks()
                self.least = np.array([2**63 - 1 if i[0] is None else i[0] for i in self.ids.to_pylist()], np.int64)
                self.tree, self.parts = CoverTree(self.points.astype(float)), []
            asked = pa.Table.from_batches(self.waiting)
            q, p, score = search(self.tree, self.points, self.least, matrix(asked.column("v").combine_chunks(), length), asked.column("bound").to_numpy().copy(), self.k)
            yield pa.RecordBatch.from_arrays([pa.array(asked.column("pid").to_numpy()[q]), pa.array(self.pid[p]), pa.array(score), self.ids.take(pa.array(p))], ["query", "pid", "score", "ids"])
        self.waiting, self.n = [], 0


FOUND = "query long, pid long, score long, ids array<long>"


def _search_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("block", "part", "length")])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for low, high in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(keys)].tolist(), strict=True):
                if low == high:
                    continue
                key = tuple(keys[low].tolist())
                if block is None or block.key != key:
                    if block is not None:
                        yield from block.answers()
                        released()
                    block = Block(key, k)
                yield from block.take(batch.slice(low, high - low))
        if block is not None:
            yield from block.answers()

    return run


def searched(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query, pid, score, ids: the ``k`` best points of the query's block and part, that reach its bound. Both inputs: block, part, length, pid, v; points: ids; queries: bound."""
    both = points.select("block", "part", "length", F.lit(False).alias("asks"), "cell", "pid", "v", "ids", F.lit(LEAST).alias("bound"))
    both = both.unionByName(queries.select("block", "part", "length", F.lit(True).alias("asks"), "cell", "pid", "v", F.expr("cast(array() AS array<bigint>)").alias("ids"), "bound"))
    return both.repartition("block", "part").sortWithinPartitions("block", "part", "length", "asks", "cell").mapInArrow(_search_batches(k), FOUND)


def _cell_batches(pivots: dict[int, tuple[list[int], np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            cell, away = np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for length in np.unique(lengths).tolist():
                own, (cells, centers) = np.flatnonzero(lengths == length), pivots[length]
                for begin in range(0, len(own), 4096):
                    some = own[begin : begin + 4096]
                    points = matrix(batch.column("v").take(pa.array(some)), length).astype(float)
                    # The nearest by squares; its distance then from the difference, which doesn't cancel.
                    near = (np.square(centers).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
                    cell[some], away[some] = np.array(cells)[near], np.linalg.norm(points - centers[near], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], [*batch.schema.names, "cell", "away"])

    return run


def packed_cells(counts: list[tuple[int, int]], size: int) -> tuple[dict[int, tuple[int, int]], int]:
    """For each cell its first block and over how many blocks it is dealt; the number of blocks. Cells in this order share a block while they fit."""
    out, block, held = {}, 0, 0
    for cell, n in counts:
        if held and held + n > size:
            block, held = block + 1, 0
        parts = max(1, -(-n // size))
        out[cell] = (block, parts)
        if parts > 1:
            block, held = block + parts, 0
        else:
            held += n
    return out, block + (held > 0)


def _sent_batches(cells: dict[int, list[tuple[np.ndarray, float, list[int]]]]):
    """Adds ``others``: the blocks, but a query's own, with a cell that reaches the query's bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, bound, own = (batch.column(c).to_numpy() for c in ("length", "bound", "block"))
            others: list[list[int]] = [[] for _ in range(len(batch))]
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                queries = matrix(batch.column("v").take(pa.array(rows)), length).astype(float)
                size = np.linalg.norm(queries, axis=1)
                centers, radius = np.array([c for c, _, _ in cells[length]]), np.array([r for _, r, _ in cells[length]])
                reach = queries @ centers.T + np.outer(size, radius) + 1 + 1e-9 * np.outer(size, np.linalg.norm(centers, axis=1) + radius)
                for i, hit in zip(rows.tolist(), reach >= bound[rows][:, None], strict=True):
                    others[i] = sorted({b for h in np.flatnonzero(hit) for b in cells[length][h][2]} - {int(own[i])})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(others, pa.list_(pa.int32()))], [*batch.schema.names, "others"])

    return run


def first_rows(rows: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key, with ``rank``: what exceeds them is left before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= most)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of each row for which ``queries``, a condition on ``id``, holds. Components are floor(scale * x)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = written(rows.mapInArrow(_vector_batches(scale), "id long, v binary"), "vectors")
    by_id = [F.col("id").asc_nulls_last()]
    several = first_rows(rows.distinct(), ["v"], by_id, k + 1)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda s: s["id"])
    points = several.groupBy("v").agg(ids.alias("ids")).select(F.monotonically_increasing_id().alias("pid"), F.expr("cast(octet_length(v) div 8 AS int)").alias("length"), "v", "ids")
    points = written(points, "points")
    asking = written(rows.where(queries).distinct().join(points.select("pid", F.col("v").alias("w")), F.col("v") == F.col("w")).select(F.col("id").alias("query_id"), "pid"), "queries")

    drawn = first_rows(points.select("length", "v"), ["length"], [F.xxhash64("v"), F.col("v")], PIVOTS).collect()
    pivots, n = {}, 0
    for length in sorted({r["length"] for r in drawn}):
        sample = matrix(pa.array([bytes(r["v"]) for r in drawn if r["length"] == length], pa.binary()), length).astype(float)
        tree = CoverTree(sample, 1)  # cells that lie together follow each other
        pivots[length] = (list(range(n, n + len(sample))), sample[tree.order])
        n += len(sample)
    schema = "pid long, length int, v binary, ids array<long>, asked boolean, cell int, away double"
    asked = asking.select("pid").distinct().withColumn("asked", F.lit(True))
    placed = points.join(asked, "pid", "left").select("pid", "length", "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked"))
    placed = written(placed.mapInArrow(_cell_batches(pivots), schema), "placed-points")
    stats = placed.groupBy("length", "cell").agg(F.count("*").alias("n"), F.sum(F.col("asked").cast("int")).alias("asked"), F.max("away").alias("radius")).orderBy("cell").collect()
    total = sum(r["n"] for r in stats)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, _ = packed_cells([(r["cell"], r["n"]) for r in stats], min(BLOCK, max(SMALL_BLOCK, -(-total // tasks))))
    groups, _ = packed_cells([(r["cell"], r["asked"]) for r in stats], BLOCK)
    dealt = spark.createDataFrame([(c, *blocks[c], *groups[c]) for c in blocks], "at int, base int, shares int, group_base int, group_shares int")
    placed = placed.join(F.broadcast(dealt), F.col("cell") == F.col("at"))
    share = lambda base, shares: (F.col(base) + F.pmod(F.xxhash64("pid"), F.col(shares))).cast("int")
    placed = placed.select("pid", "length", "v", "ids", "asked", "cell", share("base", "shares").alias("block"), share("group_base", "group_shares").alias("part"))

    own = placed.withColumn("part", F.lit(0))
    near = written(searched(own, own.where("asked").withColumn("bound", F.lit(LEAST)), k + 1), "near")
    named = lambda found: found.select("query", "score", (F.col("pid") == F.col("query")).alias("own"), F.explode("ids").alias("vec_id"))
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    bounds = first_rows(named(near), ["query"], order, k + 1).where(F.col("rank") == k + 1).select("query", F.col("score").alias("bound"))
    bounded = placed.where("asked").drop("ids", "asked").join(bounds, F.col("pid") == F.col("query"), "left").drop("query").withColumn("bound", F.coalesce("bound", F.lit(LEAST)))
    cells: dict[int, list] = {length: [] for length in pivots}
    for r in stats:
        place, centers = pivots[r["length"]]
        base, shares = blocks[r["cell"]]
        cells[r["length"]].append((centers[r["cell"] - place[0]], r["radius"], list(range(base, base + shares))))
    sent = bounded.mapInArrow(_sent_batches(cells), "pid long, length int, v binary, cell int, block int, part int, bound long, others array<int>")
    sent = written(sent, "bounded-queries").withColumn("block", F.explode("others")).drop("others")
    met = sent.select("block", "part").distinct()
    far = searched(placed.drop("part").join(met, "block"), sent, k + 1)
    best = first_rows(named(near).unionByName(named(far)), ["query"], order, k + 1).drop("rank")
    best = written(best, "best")
    results = asking.join(best, F.col("pid") == F.col("query")).where(~(F.col("own") & F.col("vec_id").eqNullSafe(F.col("query_id"))))
    results = first_rows(results, ["query_id", "query"], order, k)
    return results.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

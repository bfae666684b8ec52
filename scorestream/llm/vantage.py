"""Nearest neighbours by cosine, with a vantage-point tree per shard.

Scaled to length one, vectors lie on a sphere, where the angle is a metric.
Every shard has a tree: a node halves its rows at the median angle to a vantage
point and keeps the range of angles of either half.  By the triangle inequality
a half is passed over if the least angle its rows can have, times ``relax``,
exceeds the angle of the k-th best row so far.  Factor 1 is exact search; with
more, more is passed over and a little may be lost.

The shards are the leaves of one such tree above them, fitted on a bounded
sample.  A query asks the shard it would belong to first; with the k-th best
angle found there it goes to those other shards only that the triangle
inequality does not rule out.  Where vectors form clusters these are few.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorestream.workspace import materialize

#: Vectors of one shard take at most about this much in doubles.
SHARD_BYTES = 32 << 20
#: Fewer rows are not worth a task of their own.
SHARD_ROWS = 4096
#: Rows that the tree above the shards is fitted on: per leaf, and in all.
LEAF_SAMPLE = 32
SAMPLE_ROWS = 50_000
#: The last partitions are for rows of widths that the sample has not met.
SPARE = 8
LEAF = 128
QUERY_ROWS = 512
#: Scores this close to the k-th best are computed exactly; far above the rounding of one sum.
SLACK = 1e-9


@dataclass
class Node:
    rows: slice
    vantage: int = -1
    near: "Node | None" = None
    far: "Node | None" = None
    ranges: tuple = ()


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of paired rows in double precision, summed from the first component to the last.

    The fixed order makes equal vectors score equally wherever they are stored.
    """
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for d in range(a.shape[1]):
        x, y = a[:, d], b[:, d]
        dot += x * y
        aa += x * x
        bb += y * y
    return dot / (np.sqrt(aa) * np.sqrt(bb))


class VantageTree:
    """Tree over the vectors of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.leaf = leaf
        self.unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.order = np.arange(len(ids))
        self.root = self._grown(0, len(ids))
        self.ids, self.vectors, self.unit = ids[self.order], vectors[self.order], self.unit[self.order]
        self.place = np.empty(len(ids), np.int64)
        self.place[self.order] = np.arange(len(ids))

    def _angles(self, rows: np.ndarray, to: int) -> np.ndarray:
        return np.arccos(np.clip(self.unit[rows] @ self.unit[to], -1, 1))

    def _grown(self, start: int, stop: int) -> Node:
        node = Node(slice(start, stop))
        if stop - start <= self.leaf:
            return node
        rows = self.order[start:stop]
        node.vantage = int(rows[self._angles(rows, rows[0]).argmax()])
        angles = self._angles(rows, node.vantage)
        by_angle = np.argsort(angles, kind="stable")
        self.order[start:stop], angles = rows[by_angle], angles[by_angle]
        half = (stop - start) // 2
        node.ranges = (angles[0], angles[half - 1], angles[half], angles[-1])
        node.near, node.far = self._grown(start, start + half), self._grown(start + half, stop)
        return node

    def search(
        self, query_ids, queries, k: int, relax: float = 1.0, floor: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's position, id, score) of the k best rows of each query, its own id left out.

        Rows below ``floor``, the score of a k-th best row known from elsewhere, may be left out.
        """
        found = Best(query_ids, queries, k, floor)
        unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
        everyone = np.arange(len(queries))
        done = np.full(len(queries), -1)
        self._descend(self.root, everyone, unit, found, done)
        self._sweep(self.root, everyone, unit, found, done, relax)
        return found.rows()

    def _vantage_angles(self, node: Node, unit: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(unit @ self.unit[self.place[node.vantage]], -1, 1))

    def _descend(self, node: Node, who, unit, found, done) -> None:
        """Look into the one leaf that each query would belong to, for a first bound."""
        if not len(who):
            return
        if node.near is None:
            found.offer(who, self, node.rows, unit)
            done[who] = node.rows.start
            return
        inner = self._vantage_angles(node, unit[who]) <= node.ranges[1]
        self._descend(node.near, who[inner], unit, found, done)
        self._descend(node.far, who[~inner], unit, found, done)

    def _sweep(self, node: Node, who, unit, found, done, relax: float) -> None:
        """Look into every leaf that the bounds do not rule out."""
        if not len(who):
            return
        if node.near is None:
            found.offer(who[done[who] != node.rows.start], self, node.rows, unit)
            return
        angle = self._vantage_angles(node, unit[who])
        for child, low, high in ((node.near, *node.ranges[:2]), (node.far, *node.ranges[2:])):
            least = np.maximum(np.maximum(low - angle, angle - high), 0)
            self._sweep(child, who[relax * least <= found.reach(who)], unit, found, done, relax)


def reach_of(score: np.ndarray) -> np.ndarray:
    """Angle of a score, a little widened; no bound for minus infinity."""
    # near a cosine of 1 an angle is the root of the cosine's rounding
    return np.where(np.isinf(score), np.inf, np.arccos(np.clip(score - SLACK, -1, 1)) + 1e-6)


class Best:
    """The k best rows so far of every query of a block."""

    def __init__(self, query_ids, queries, k: int, floor: np.ndarray | None = None):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.floor = np.full(len(queries), -np.inf) if floor is None else floor
        self.score = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)

    def reach(self, who: np.ndarray) -> np.ndarray:
        """Angle of the k-th best row, a little widened; no bound before there are k rows."""
        return reach_of(self.worst(who))

    def worst(self, who: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[who, -1], self.floor[who])

    def offer(self, who: np.ndarray, tree: VantageTree, rows: slice, unit: np.ndarray) -> None:
        if not len(who):
            return
        about = unit[who] @ tree.unit[rows].T
        good = about >= self.worst(who)[:, None] - SLACK
        good &= self.query_ids[who][:, None] != tree.ids[rows]
        at, column = np.nonzero(good)
        if not len(at):
            return
        place = column + rows.start
        scores = exact_cosine(self.queries[who[at]], tree.vectors[place])
        touched = np.unique(at)
        k = self.k
        owner = np.concatenate([np.repeat(touched, k), at])
        all_scores = np.concatenate([self.score[who[touched]].ravel(), scores])
        all_ids = np.concatenate([self.ids[who[touched]].ravel(), tree.ids[place]])
        order = np.lexsort((all_ids, -all_scores, owner))
        owner = owner[order]
        begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        top = order[(begins[:, None] + np.arange(k)).ravel()]
        self.score[who[touched]] = all_scores[top].reshape(-1, k)
        self.ids[who[touched]] = all_ids[top].reshape(-1, k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, column = np.nonzero(~np.isinf(self.score))
        return at, self.ids[at, column], self.score[at, column]


@dataclass
class Branch:
    """A node of the tree above the shards; one without a vantage point is the leaf ``leaf``."""

    leaf: int = -1
    vantage: np.ndarray | None = None
    cut: float = 0.0
    near: "Branch | None" = None
    far: "Branch | None" = None


class ShardTree:
    """The tree above the shards of one width, fitted on sampled vectors.

    Every leaf has a centre, and once the rows are placed a radius and its
    shards: ``parts`` of them from ``first`` on, so that a leaf of many rows, all
    of them equal perhaps, is shared out.
    """

    def __init__(self, sample: np.ndarray, leaves: int, leaf_from: int = 0):
        self.leaf_from = leaf_from
        self.centres: list = []
        self.root = self._grown(sample / np.linalg.norm(sample, axis=1, keepdims=True), leaves)
        self.centres = np.array(self.centres)
        self.radius = np.full(len(self.centres), np.pi)
        self.first = np.zeros(len(self.centres), np.int64)
        self.parts = np.zeros(len(self.centres), np.int64)

    def _grown(self, unit: np.ndarray, leaves: int) -> Branch:
        if leaves > 1 and len(unit) > 1:
            vantage = unit[_angles(unit, unit[0]).argmax()]
            angles = _angles(unit, vantage)
            ordered = np.sort(angles)
            cut = (ordered[(len(unit) - 1) // 2] + ordered[(len(unit) - 1) // 2 + 1]) / 2
            inner = angles <= cut
            if not inner.all():
                near, far = self._grown(unit[inner], -(-leaves // 2)), self._grown(unit[~inner], leaves // 2)
                return Branch(vantage=vantage, cut=cut, near=near, far=far)
        middle = unit.mean(axis=0)
        length = np.linalg.norm(middle)
        self.centres.append(middle / length if length > 1e-3 else unit[0])
        return Branch(leaf=len(self.centres) - 1)

    def place(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, angle to its centre) of every vector."""
        leaf = np.zeros(len(unit), np.int64)
        waiting = [(self.root, np.arange(len(unit)))]
        while waiting:
            node, who = waiting.pop()
            if not len(who):
                continue
            if node.vantage is None:
                leaf[who] = node.leaf
                continue
            inner = _angles(unit[who], node.vantage) <= node.cut
            waiting += [(node.near, who[inner]), (node.far, who[~inner])]
        return leaf, np.arccos(np.clip(np.einsum("ij,ij->i", unit, self.centres[leaf]), -1, 1))

    def settle(self, rows: dict[int, tuple[int, float]], most: int, first: int) -> int:
        """Take (number of rows, radius) per leaf, number the shards from ``first``; the next free number."""
        for leaf in range(len(self.centres)):
            count, self.radius[leaf] = rows.get(leaf + self.leaf_from, (0, -np.inf))
            self.first[leaf], self.parts[leaf] = first, -(-count // most)
            first += int(self.parts[leaf])
        return first

    def reachable(self, unit: np.ndarray, floor: np.ndarray, relax: float) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with rows, each with the queries that may have a neighbour in it."""
        reach = reach_of(floor)
        waiting = [(self.root, np.arange(len(unit)))]
        while waiting:
            node, who = waiting.pop()
            if not len(who):
                continue
            if node.vantage is None:
                if self.parts[node.leaf]:
                    least = _angles(unit[who], self.centres[node.leaf]) - self.radius[node.leaf]
                    yield node.leaf, who[relax * np.maximum(least, 0) <= reach[who]]
                continue
            beyond = _angles(unit[who], node.vantage) - node.cut
            waiting.append((node.near, who[relax * np.maximum(beyond, 0) <= reach[who]]))
            waiting.append((node.far, who[relax * np.maximum(-beyond, 0) <= reach[who]]))


def _angles(unit: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ to, -1, 1))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _runs(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal keys."""
    if not len(keys[0]):
        return
    changes = np.zeros(len(keys[0]) - 1, bool)
    for key in keys:
        changes |= key[1:] != key[:-1]
    cuts = np.r_[0, np.flatnonzero(changes) + 1, len(keys[0])]
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist())


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and every component finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class Layout:
    """Rows placed in shards, the queries among them, and the trees above the shards."""

    placed: DataFrame
    queries: DataFrame
    trees: dict[int, ShardTree]
    shards: int


def lay_out(
    vectors: DataFrame,
    is_query: Column,
    shard_rows: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> Layout:
    """Place every usable row in a shard by the trees, and write the rows down.

    Shards hold ``SHARD_BYTES`` of vectors at most, fewer rows where the session
    has more cores than shards, or ``shard_rows`` if given.  The trees are fitted on
    at most ``2 * sample_rows`` rows (about ``LEAF_SAMPLE`` per shard); rows of a
    width that the sample has not met form one shard per width.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[vector_column]
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast(kind if kind == "array<float>" else "array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    counted = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("widest")).first()
    if shard_rows is None:
        cores = spark.sparkContext.defaultParallelism
        most = max(1, SHARD_BYTES // (8 * max(1, counted["widest"] or 0)))
        shard_rows = min(most, max(SHARD_ROWS, counted["n"] // (2 * cores)))
    wanted = min(sample_rows, LEAF_SAMPLE * -(-counted["n"] // shard_rows))
    grain = 1 << 30
    share = grain if wanted >= counted["n"] else grain * wanted // counted["n"] + 1
    sampled = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(grain)) < share).select("vector").limit(2 * sample_rows)
    by_width: dict[int, list] = {}
    for r in sampled.toLocalIterator():
        by_width.setdefault(len(r["vector"]), []).append(r["vector"])
    trees, leaf_from = {}, 0
    total = sum(map(len, by_width.values()))
    for width, own in sorted(by_width.items()):
        leaves = -(-counted["n"] * len(own) // (total * shard_rows))
        trees[width] = ShardTree(np.array(own, np.float64), min(leaves, -(-len(own) // 4)), leaf_from)
        leaf_from += len(trees[width].centres)

    placed = materialize(_placed(rows, trees), "vantage-rows")
    found = placed.where("leaf >= 0").groupBy("leaf").agg(F.count("*").alias("n"), F.max("apart").alias("radius"))
    sizes = {r["leaf"]: (r["n"], r["radius"]) for r in found.collect()}
    shards = 0
    for tree in trees.values():
        shards = tree.settle(sizes, shard_rows, shards)
    numbers = [
        (tree.leaf_from + leaf, int(tree.first[leaf]), int(tree.parts[leaf]))
        for tree in trees.values()
        for leaf in range(len(tree.centres))
        if tree.parts[leaf]
    ]
    numbered = spark.createDataFrame(numbers, "leaf long, first long, parts long")
    # at most one row per leaf of the trees, and these have at most a leaf per four sampled rows
    placed = placed.join(F.broadcast(numbered), "leaf", "left")
    spare = shards + F.pmod(F.xxhash64("width"), F.lit(SPARE))
    # hashed, since equal vectors may come at regular distances
    dealt = F.col("first") + F.pmod(F.xxhash64("deal", "vec_id"), F.col("parts"))
    placed = placed.withColumn("shard", F.coalesce(dealt, spare).cast("int"))
    asked = placed.where("asks").groupBy("vec_id", "width").agg(F.min(F.struct("vector", "shard")).alias("own"))
    queries = asked.select("vec_id", "width", "own.vector", "own.shard")
    return Layout(placed.select("width", "shard", "vec_id", "vector"), queries, trees, shards)


def _placed(rows: DataFrame, trees: dict[int, ShardTree]) -> DataFrame:
    """Rows with their width, leaf (-1 without a tree), angle to its centre and a running number."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            widths = batch.column("width").to_numpy()
            leaf, apart = np.full(len(widths), -1, np.int64), np.zeros(len(widths))
            for width in np.unique(widths):
                tree = shared.value.get(int(width))
                if tree is None:
                    continue
                at = np.flatnonzero(widths == width)
                own = _matrix(batch.column("vector").take(pa.array(at)))
                leaf[at], apart[at] = tree.place(own / np.linalg.norm(own, axis=1, keepdims=True))
                leaf[at] += tree.leaf_from
            deal = np.arange(seen, seen + len(widths))
            seen += len(widths)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf), pa.array(apart), pa.array(deal)],
                [*batch.schema.names, "leaf", "apart", "deal"],
            )

    rows = rows.withColumn("width", F.size("vector"))
    vector = dict(rows.dtypes)["vector"]
    return rows.mapInArrow(
        run, f"vec_id long, vector {vector}, asks boolean, width int, leaf long, apart double, deal long"
    )


def _searched(layout: Layout, asked: DataFrame, k: int, relax: float) -> DataFrame:
    """(query_id, width, vec_id, score): at most k rows of every shard that a query is sent to."""
    columns = ["width", "shard", "kind", "vec_id", "vector", "floor"]
    minus = F.lit(float("-inf"))
    indexed = layout.placed.withColumn("kind", F.lit(0)).withColumn("floor", minus).select(columns)
    dealt = indexed.union(asked.withColumn("kind", F.lit(1)).select(columns))
    dealt = dealt.repartitionById(layout.shards + SPARE, F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", "width", "kind", "vec_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, tree = None, [], None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("shard", "width", "kind")]
            for start, stop in _runs(*keys):
                shard, width, kind = (int(key[start]) for key in keys)
                if (shard, width) != here:
                    here, parts, tree = (shard, width), [], None
                piece = batch.slice(start, stop - start)
                ids, own = piece.column("vec_id").to_numpy(), _matrix(piece.column("vector"))
                if kind == 0:
                    parts.append((ids, own))
                    continue
                if tree is None:
                    if not parts:
                        continue
                    tree = VantageTree(*(np.concatenate(x) for x in zip(*parts)))
                    parts = []
                floor = piece.column("floor").to_numpy()
                for at in range(0, len(ids), QUERY_ROWS):
                    block = slice(at, at + QUERY_ROWS)
                    asking = ids[block]
                    who, found, score = tree.search(asking, own[block], k, relax, floor[block])
                    wide = np.full(len(who), width, np.int32)
                    names = ["query_id", "width", "vec_id", "score"]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (asking[who], wide, found, score))], names)

    return dealt.mapInArrow(search, "query_id long, width int, vec_id long, score double")


def sent_on(layout: Layout, bounded: DataFrame, relax: float = 1.0) -> DataFrame:
    """Queries (vec_id, width, vector, shard, floor) once per further shard that may hold a neighbour."""
    shared = bounded.sparkSession.sparkContext.broadcast(layout.trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths, homes = batch.column("width").to_numpy(), batch.column("shard").to_numpy()
            floor = batch.column("floor").to_numpy()
            for width in np.unique(widths):
                tree = shared.value.get(int(width))
                if tree is None:
                    continue
                at = np.flatnonzero(widths == width)
                own = _matrix(batch.column("vector").take(pa.array(at)))
                unit = own / np.linalg.norm(own, axis=1, keepdims=True)
                for leaf, who in tree.reachable(unit, floor[at], relax):
                    for shard in range(tree.first[leaf], tree.first[leaf] + tree.parts[leaf]):
                        rows = at[who[homes[at[who]] != shard]]
                        if len(rows):
                            piece = batch.take(pa.array(rows))
                            place = piece.schema.get_field_index("shard")
                            yield piece.set_column(place, "shard", pa.array(np.full(len(rows), shard, np.int32)))

    columns = ["vec_id", "width", "vector", "shard", "floor"]
    kinds = dict(bounded.dtypes)
    return bounded.select(columns).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))


def with_floor(queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Queries with the score of their k-th best row so far, minus infinity without k rows."""
    worst = found.groupBy(F.col("query_id").alias("vec_id"), "width").agg(
        F.when(F.count("*") == k, F.min("score")).alias("floor")
    )
    nothing = F.lit(float("-inf"))
    return queries.join(worst, ["vec_id", "width"], "left").withColumn("floor", F.coalesce("floor", nothing))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    relax: float = 1.0,
    shard_rows: int | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each query, ties to smaller ids.

    Every usable row is indexed.  A query asks its home shard, then the shards of
    its number of components that the bound found there does not rule out; each
    answers with k rows at most.  Rows with the query's id are never its
    neighbours; other repeated rows count each.  Of repeated query rows the
    smallest vector is taken.  Rows with a null id take no part.
    """
    layout = lay_out(vectors, is_query, shard_rows, id_column=id_column, vector_column=vector_column)
    unbounded = layout.queries.withColumn("floor", F.lit(float("-inf")))
    at_home = materialize(_searched(layout, unbounded, k, relax), "vantage-home")
    further = sent_on(layout, with_floor(layout.queries, at_home, k), relax)
    found = at_home.union(_searched(layout, further, k, relax))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

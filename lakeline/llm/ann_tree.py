"""Nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted to a bounded sample; every vector is then put into its leaf. A query walks
the tree through a priority queue of nodes, the most promising first, and visits as many
leaves as a calibration against exact search asked for. Equal vectors are one entry with their
smallest ids, as no others of them can be among the nearest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeline.llm.arrow import per_array, quoted, ship_package, stored

#: Children of a node, rounds of k-means, and vectors that a leaf should hold.
BRANCHES, ROUNDS, LEAF_ROWS = 8, 8, 256
#: The sample that the tree is fitted to and its leaves, whatever the size of the table.
SAMPLE_ROWS, SAMPLE_BYTES, MAX_LEAVES = 65_536, 64_000_000, 16_384
#: Queries of the calibration, the recall it asks for (of 0.9 wanted).
CALIBRATION_QUERIES, RECALL = 256, 0.95
#: Vectors and queries that meet in one task's group.
GROUP_ROWS = 4096
#: Leaves whose results give a query the score that those of its other leaves must reach.
FIRST_LEAVES = 4


class Tree:
    """Nodes in the order they were made: centre, spread, children (none: a leaf)."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int = 7):
        self.dimension = sample.shape[1]
        draw = np.random.default_rng(seed)
        limit = max(1, -(-len(sample) // max(1, leaves)))
        centres, spreads, self.children = [], [], []
        work = [sample]
        parents: list[int] = [-1]
        for number in range(len(sample) * 2 + 1):
            if number >= len(work):
                break
            points = work[number]
            work[number] = None
            centre = points.mean(0) if len(points) else np.zeros(self.dimension)
            centres.append(centre)
            spreads.append(np.sqrt(((points - centre) ** 2).sum(1).mean()) if len(points) else 0)
            self.children.append([])
            if parents[number] >= 0:
                self.children[parents[number]].append(number)
            if len(points) > limit:
                part = _kmeans(points, min(BRANCHES, -(-len(points) // limit)), draw)
                if part.max() > 0:
                    for k in range(part.max() + 1):
                        work.append(points[part == k])
                        parents.append(number)
        self.centres, self.spreads = np.asarray(centres), np.asarray(spreads)
        self.leaves = [i for i, c in enumerate(self.children) if not c]
        self.leaf_number = {node: i for i, node in enumerate(self.leaves)}

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child, level by level."""
        node = np.zeros(len(vectors), np.int64)
        live = np.arange(len(vectors)) if self.children[0] else np.zeros(0, np.int64)
        while len(live):
            for at in np.unique(node[live]):
                mine = live[node[live] == at]
                below = self.children[at]
                node[mine] = np.asarray(below)[_nearest(vectors[mine], self.centres[below])]
            live = live[[bool(self.children[n]) for n in node[live].tolist()]]
        return np.asarray([self.leaf_number[n] for n in node.tolist()], np.int32)

    def promise(self, queries: np.ndarray) -> np.ndarray:
        """What each query may find in each node: its product with the centre and twice the
        deviation that the node's spread gives it."""
        norm = np.sqrt((queries ** 2).sum(1))[:, None]
        return queries @ self.centres.T + 2 * norm * self.spreads / np.sqrt(self.dimension)

    def best_first(self, promise: list[float]) -> Iterator[int]:
        """Leaves, the most promising reachable node always next."""
        queue = [(-promise[0], 0)]
        while queue:
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                yield self.leaf_number[node]
            for child in below:
                heapq.heappush(queue, (-promise[child], child))


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(1) - 2 * points @ centres.T).argmin(1)


def _kmeans(points: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """Numbers of the parts, gapless from 0; fewer than ``k`` if points coincide."""
    centres = points[draw.choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        part = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, part, points)
        n = np.bincount(part, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return np.unique(_nearest(points, centres), return_inverse=True)[1]


def _matrix(column: pa.Array) -> np.ndarray:
    """Packed vectors as rows of doubles."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def packed_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): one row per id, the vector as little-endian doubles.

    No part take null ids and vectors that are null, zero, hold a null or non-finite component
    or have another length than most (of equally frequent lengths, the larger). Of different
    vectors with one id the smallest packed one counts; repeated rows are one.
    """
    ship_package(table.sparkSession)
    rows = table.where(quoted(key).isNotNull() & quoted(vector).isNotNull()).select(
        quoted(key).cast("bigint").alias("vec_id"), quoted(vector).cast("array<double>").alias("v"))
    usual = (rows.groupBy(F.size("v").alias("n")).count()
             .orderBy(F.desc("count"), F.desc("n")).first())
    length = usual["n"] if usual else 0

    def make():
        def pack(lists: pa.Array) -> pa.Array:
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(-1, length)
            good = np.isfinite(flat).all(1) & (flat != 0).any(1)
            raw = (flat + 0.0).tobytes()  # no negative zeros: equal vectors have equal bytes
            size = 8 * length
            return pa.array([raw[i * size:i * size + size] if ok else None
                             for i, ok in enumerate(good.tolist())], pa.binary())

        return pack

    some = rows.where(F.size("v") == length) if length else rows.where(F.lit(False))
    return (some.select("vec_id", per_array("binary", make)("v").alias("v"))
            .where("v IS NOT NULL").groupBy("vec_id").agg(F.min("v").alias("v")))


def fit_tree(vectors: DataFrame, rows: int) -> Tree | None:
    """A tree on a sample by hash of about ``SAMPLE_ROWS`` of the ``rows`` packed vectors, fewer
    if they are long."""
    first = vectors.select("v").first()
    if first is None:
        return None
    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // len(first["v"])))
    dice = F.pmod(F.xxhash64("v", F.lit("sample")), F.lit(1 << 30))
    sample = vectors.where(dice < min(1.0, wanted / rows) * (1 << 30)).select("v").toArrow()
    found = _matrix(sample.column(0).combine_chunks()) if len(sample) else _matrix(
        pa.array([first["v"]], pa.binary()))
    return Tree(found, min(MAX_LEAVES, -(-rows // LEAF_ROWS)))


def _top(query: np.ndarray, floor: np.ndarray, vector: np.ndarray, ids: list[list[int]], k: int):
    """(query row, id, score) of the best ``k`` ids for every query that are not below its floor,
    ties to smaller ids.

    One matrix product gives every query a bound: its ``k``-th best product or its floor, less
    what rounding may change. All vectors that reach it, however many tie there, are then
    summed one by one, so that a score does not depend on what else was in the group.
    """
    product = query @ vector.T
    norms = np.sqrt((query ** 2).sum(1)) * np.sqrt((vector ** 2).sum(1).max())
    rounding = 4 * query.shape[1] * np.finfo(np.float64).eps * norms
    bound = floor - rounding
    rows = np.flatnonzero(~(product.max(1) < bound))
    if len(vector) > k:
        reached = product[rows]
        reached.partition(len(vector) - k, axis=1)
        bound[rows] = np.maximum(bound[rows], reached[:, len(vector) - k] - rounding[rows])
    smallest = np.asarray([i[0] for i in ids])
    for row in rows.tolist():
        columns = np.flatnonzero(~(product[row] < bound[row]))
        exact = (query[row] * vector[columns]).sum(1)
        # No id of an entry behind the first k entries can be among the best k.
        ahead = np.lexsort((smallest[columns], -exact))[:k]
        best = sorted((-s, i) for s, c in zip(exact[ahead].tolist(), columns[ahead].tolist())
                      for i in ids[c])
        for score, number in best[:k]:
            yield row, number, -score


def _calibrated(tree: Tree, entries: DataFrame, queries: DataFrame, k: int, recall: float) -> int:
    """Leaves to visit so that a sample of queries finds ``recall`` of its true nearest."""
    shared = entries.sparkSession.sparkContext.broadcast(
        _matrix(pa.array([bytes(r["v"]) for r in queries.orderBy(F.xxhash64("v"), "v")
                          .limit(CALIBRATION_QUERIES).collect()], pa.binary())))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, ids = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            held = dict(zip(ids, leaf))
            none = np.full(len(shared.value), -np.inf)
            best = list(_top(shared.value, none, _matrix(batch.column(1)), [[i] for i in ids], k)
                        ) if ids else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([row for row, _, _ in best], pa.int64()),
                 pa.array([held[i] for _, i, _ in best], pa.int64()),
                 pa.array([i for _, i, _ in best], pa.int64()),
                 pa.array([score for _, _, score in best], pa.float64())],
                ["q", "leaf", "id", "score"])

    by = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    true = (entries.select("leaf", "v", F.col("ids")[0].alias("id"))
            .mapInArrow(exact, "q bigint, leaf bigint, id bigint, score double")
            .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).toArrow())
    promise = tree.promise(shared.value)
    place = np.empty((len(promise), len(tree.leaves)), np.int64)
    for row, one in enumerate(promise.tolist()):
        place[row, list(tree.best_first(one))] = np.arange(len(tree.leaves))
    needed = np.sort(place[true["q"].to_numpy(), true["leaf"].to_numpy()])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


def _visits(tree: Tree, counts: np.ndarray, visits: int, k: int):
    """(q, v) rows to (leaf, first, q, v) rows: the leaves a query visits, at least ``visits``
    and as many more as it takes to meet ``k`` vectors; and which of them come first."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                rows, leaves, first = [], [], []
                for row, one in enumerate(tree.promise(_matrix(batch.column(1))).tolist()):
                    met = 0
                    for number, leaf in enumerate(tree.best_first(one)):
                        if number >= visits and met >= k:
                            break
                        if counts[leaf]:
                            first.append(number < FIRST_LEAVES or met < k)
                            met += counts[leaf]
                            rows.append(row)
                            leaves.append(leaf)
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaves, pa.int32()), pa.array(first, pa.bool_()),
                     batch.column(0).take(take), batch.column(1).take(take)],
                    ["leaf", "first", "q", "v"])

    return walk


def _split(df: DataFrame, by: str, mine: dict[int, int], theirs: dict[int, int],
           names: tuple[str, str]) -> DataFrame:
    """Cut each leaf's rows into parts by a hash of ``by``, and give each row to every part of
    the other side. The numbers of parts are a table of at most ``MAX_LEAVES`` rows or so."""
    parts = df.sparkSession.createDataFrame(
        [(i, mine.get(i, 1), theirs.get(i, 1)) for i in sorted({*mine, *theirs})],
        "leaf int, mine int, theirs int")
    return (df.join(F.broadcast(parts), "leaf")
            .withColumn(names[0], F.pmod(F.xxhash64(by), F.col("mine")).cast("int"))
            .withColumn(names[1], F.explode(F.sequence(F.lit(0), F.col("theirs") - 1)))
            .drop("mine", "theirs"))


def _scored(walks: DataFrame, entries: DataFrame, sizes: dict[int, int], k: int) -> DataFrame:
    """(q, vec_id, score): the best ``k`` of each leaf part for the queries that visit it, as
    far as they reach the query's floor."""
    met = {r["leaf"]: r["count"] for r in walks.groupBy("leaf").count().collect()}
    groups = lambda n: {i: -(-c // GROUP_ROWS) for i, c in n.items()}
    left = _split(walks, "q", groups(met), groups(sizes), ("a", "b"))
    right = _split(entries, "v", groups(sizes), groups(met), ("b", "a"))

    def score(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = []
        if len(asked) and len(held):
            names = asked["q"].to_pylist()
            found = [(names[row], number, value) for row, number, value in _top(
                _matrix(asked["v"].combine_chunks()), asked["floor"].to_numpy(),
                _matrix(held["v"].combine_chunks()), held["ids"].to_pylist(), k)]
        columns = list(zip(*found)) or [[], [], []]
        return pa.table({"q": pa.array(columns[0], pa.int64()),
                         "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    on = ["leaf", "a", "b"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(
        score, "q bigint, vec_id bigint, score double")


def nearest(table: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 20,
            query_every: int = 20, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best found for every id that ``query_every``
    divides, by inner product in doubles, ties to smaller ids; all other rows if they are fewer.

    A row is no candidate of its own id. See ``packed_vectors`` for rows that take no part. An
    empty table gives an empty result.
    """
    spark = table.sparkSession
    rows = stored(packed_vectors(table, key, vector), "vectors")
    order = Window.partitionBy("v").orderBy("vec_id")
    # One more than asked for, as a query's own id does not count.
    entries = (rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
               .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    entries = stored(entries, "entries")
    tree = fit_tree(entries, entries.count())
    if tree is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    shared = spark.sparkContext.broadcast(tree)
    leaf = per_array("int", lambda: lambda packed: pa.array(shared.value.assign(_matrix(packed))))
    entries = stored(entries.select(leaf("v").alias("leaf"), "v", "ids"), "leaves")
    asking = rows.where(F.col("vec_id") % query_every == 0)
    queries = stored(asking.groupBy("v").agg(F.min("vec_id").alias("q")).select("q", "v"), "asked")
    if queries.first() is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sizes = {r["leaf"]: r["count"] for r in entries.groupBy("leaf").count().collect()}
    visits = _calibrated(tree, entries, queries, k, recall)
    counts = np.asarray([sizes.get(i, 0) for i in range(len(tree.leaves))])
    walks = stored(queries.mapInArrow(_visits(tree, counts, visits, k + 1),
                                      "leaf int, first boolean, q bigint, v binary"), "walks")
    by = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = lambda df: df.withColumn("n", F.row_number().over(by)).where(
        F.col("n") <= k + 1)
    none = F.lit(float("-inf"))
    first = walks.where("first").select("leaf", "q", "v", none.alias("floor"))
    found = stored(ranked(_scored(first, entries, sizes, k + 1)).drop("n"), "first-found")
    # What is below the last of a query's first finds can't be among its best.
    floors = found.groupBy("q").agg(
        F.when(F.count("*") > k, F.min("score")).otherwise(none).alias("floor"))
    others = walks.where(~F.col("first")).join(floors, "q", "left").select(
        "leaf", "q", "v", F.coalesce("floor", none).alias("floor"))
    found = found.union(_scored(others, entries, sizes, k + 1))
    best = (ranked(found)
            .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score")))
                              .alias("best")))
    own = asking.join(queries, "v").select(F.col("vec_id").alias("query_id"), "q")
    mine = own.join(best, "q").select("query_id", F.slice(F.filter(
        "best", lambda b: b["vec_id"] != F.col("query_id")), 1, k).alias("best"))
    return mine.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "b.vec_id", "b.score")


def exact_nearest(vectors: dict[int, np.ndarray], k: int, query_every: int):
    """The same by comparing all, for measuring recall on small tables."""
    ids = np.asarray(sorted(vectors))
    matrix = np.asarray([vectors[i] for i in ids.tolist()], np.float64)
    out = {}
    for i in ids[ids % query_every == 0].tolist():
        scores = matrix @ vectors[i].astype(np.float64)
        order = np.lexsort((ids, -scores))
        out[i] = [int(ids[j]) for j in order if ids[j] != i][:k]
    return out

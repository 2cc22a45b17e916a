"""Nearest neighbours by a forest of random-projection trees (operator 3).

Each tree halves a sample again and again between two of its points.  Every vector goes
to one leaf of each tree.  A query walks all trees through one priority queue, whose order is
the sum of the squared margins by which it misses a node, and stops when the leaves it has
opened hold enough vectors: a power of their number below one, so a share that falls as they
grow.  Those are ranked by their exact inner products.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laurel.llm.common import bounded_sample, stage

TREES = 6
#: Vectors that the trees' cuts are fitted on, at most; all vectors are indexed.
SAMPLE = 16_384
#: A query opens leaves until they hold FACTOR * n ** POWER of n vectors, each tree's counted.
FACTOR, POWER = 4.0, 0.85
CUT = 32  # points of a sample that a leaf of the deepest trees gets
BLOCK, ASKED = 4_096, 16_384  # vectors of a leaf, and queries, in one group at most
ROWS = 256  # queries whose products are held at once


def levels(n: int, sample: int = SAMPLE) -> int:
    """Cuts on the way to a leaf: leaves of some 4 * sqrt(n) vectors, as long as the sample can tell them apart."""
    return max(0, min(round(np.log2(max(n, 1)) / 2 - 2), int(np.log2(max(sample // CUT, 1)))))


def reach(n: int) -> float:
    """Vectors in the leaves that a query opens."""
    return FACTOR * n**POWER


class Forest:
    """Trees of equal depth; node k has the children 2k + 1 and 2k + 2."""

    def __init__(self, sample: np.ndarray, trees=TREES, depth=5, seed=1):
        rng = np.random.default_rng(seed)
        self.depth, self.inner = depth, 2**depth - 1
        size = sample.shape[1] if sample.size else 0
        self.normal = np.zeros((trees, self.inner, size))
        self.cut = np.zeros((trees, self.inner))
        for t in range(trees):
            members = {0: np.arange(len(sample))}
            for node in range(self.inner):
                rows = members.pop(node)
                if len(rows) > 1:
                    a, b = sample[rng.choice(rows, 2, replace=False)]
                    self.normal[t, node] = a - b
                    # halves, so that leaves are of like size
                    self.cut[t, node] = np.median(sample[rows] @ self.normal[t, node])
                side = sample[rows] @ self.normal[t, node] > self.cut[t, node]
                members[2 * node + 1], members[2 * node + 2] = rows[~side], rows[side]

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        """Signed distances to all cuts: vector, tree, node."""
        length = np.linalg.norm(self.normal, axis=2)
        flat = vectors @ self.normal.reshape(-1, self.normal.shape[2]).T
        return (flat.reshape(len(vectors), *self.cut.shape) - self.cut) / np.where(length > 0, length, 1)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        side = self.margins(vectors) > 0
        at = np.zeros(side.shape[:2], np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + np.take_along_axis(side, at[:, :, None], 2)[:, :, 0]
        return at - self.inner

    def search(self, margins: np.ndarray, sizes: np.ndarray, enough: float) -> list[tuple[int, int]]:
        """The leaves that one query opens, best first; ``sizes`` by tree and leaf."""
        queue = [(0.0, t, 0) for t in range(len(margins))]
        opened, held = [], 0
        while queue and held < enough:
            missed, tree, node = heapq.heappop(queue)
            if node >= self.inner:
                leaf = node - self.inner
                if sizes[tree, leaf]:
                    opened.append((tree, leaf))
                    held += sizes[tree, leaf]
                continue
            m = margins[tree, node]
            heapq.heappush(queue, (missed + max(m, 0.0) ** 2, tree, 2 * node + 1))
            heapq.heappush(queue, (missed + min(m, 0.0) ** 2, tree, 2 * node + 2))
        return opened


def usable(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """``vec_id, v`` of rows with an id and a finite, non-zero vector of the commonest length."""
    rows = vectors.select(F.col(id_).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    top = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (top.n if top else 0))


def nearest(vectors: DataFrame, queries, k: int = 20, id_: str = "vec_id", vector: str = "embedding",
            enough: float | None = None, trees: int = TREES, depth: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each row where ``queries`` holds.

    ``queries`` is a condition on ``vec_id``; ``enough`` and ``depth`` are ``reach`` and
    ``levels`` of the number of vectors if not given.  A query is no candidate of its own.  Scores are
    inner products in double precision; ties go to the smaller id.  Vectors that are null,
    zero, of another length than most, or that hold null or non-finite components take no
    part, nor do null ids; rows that repeat an id and a vector are one.  Fewer than ``k``
    candidates give as many rows; other columns play no part.

    Equal vectors are one candidate with its ``k + 1`` smallest ids: no other id of theirs can
    be among the ``k`` nearest.  Equal query vectors are searched once.
    """
    spark = vectors.sparkSession
    rows = stage(usable(vectors, id_, vector).distinct(), "vectors")
    first = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    points = few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = stage(points.withColumn("point", F.col("ids")[0]), "points")
    n = points.count()
    enough = reach(n) if enough is None else enough
    depth = levels(n, sample) if depth is None else depth
    some = bounded_sample(points.select("point", "v"), sample, n, "point").select("v").collect()
    forest = Forest(np.array([r.v for r in some], float) if some else np.empty((0, 0)), trees, depth)
    sent = spark.sparkContext.broadcast(forest)

    def file(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("v").values.to_numpy().reshape(batch.num_rows, -1)
            leaf = sent.value.leaves(v)
            for t in range(leaf.shape[1]):
                tree = pa.array(np.full(len(leaf), t, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [tree, pa.array(leaf[:, t].astype(np.int32)), batch.column("ids"), batch.column("v")],
                    ["tree", "leaf", "ids", "v"],
                )

    filed = points.select("ids", "v").mapInArrow(file, "tree int, leaf int, ids array<long>, v array<double>")
    counts = filed.groupBy("tree", "leaf").count().collect()  # trees times leaves, a fixed number
    sizes = np.zeros((trees, 2**depth), np.int64)
    for r in counts:
        sizes[r.tree, r["leaf"]] = r["count"]
    parts = -(-sizes // BLOCK)
    asked = rows.where(queries)
    blocks = max(1, -(-asked.count() // ASKED))
    wanted = asked.groupBy("v").agg(F.min("vec_id").alias("query"))

    def route(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                v = np.array(batch.column("v").to_pylist(), float)
                margins = sent.value.margins(v)
                at, tree, leaf, part = [], [], [], []
                for i in range(len(v)):
                    for t, x in sent.value.search(margins[i], sizes, enough):
                        for b in range(parts[t, x]):
                            at.append(i)
                            tree.append(t)
                            leaf.append(x)
                            part.append(b)
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()), pa.array(part, pa.int32()),
                     batch.column("query").take(at), batch.column("v").take(at)], ["tree", "leaf", "part", "query", "v"],
                )

    routed = wanted.select("query", "v").mapInArrow(route, "tree int, leaf int, part int, query long, v array<double>")
    routed = routed.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    leaf_parts = spark.createDataFrame(
        [(t, x, int(parts[t, x])) for t in range(trees) for x in range(2**depth)], "tree int, leaf int, parts int"
    )
    placed = filed.join(F.broadcast(leaf_parts), ["tree", "leaf"]).withColumn(
        "part", F.pmod(F.xxhash64(F.col("ids")[0]), F.greatest("parts", F.lit(1))).cast("int")
    ).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def components(rows: pa.Table) -> np.ndarray:
        return rows.column("v").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)

    def rerank(_, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            asked_for, ids = left.column("query").to_pylist(), right.column("ids").to_pylist()
            q, c = components(left), components(right)
            keep = min(k + 8, len(c))  # equal products of unequal vectors may differ in the last bit here
            for start in range(0, len(q), ROWS):
                rough = q[start : start + ROWS] @ c.T
                best = np.argpartition(-rough, keep - 1, axis=1)[:, :keep]
                for i, near in enumerate(best, start):
                    exact = (c[near] * q[i]).sum(axis=1)
                    some = sorted((-s, v) for s, j in zip(exact.tolist(), near.tolist()) for v in ids[j])[: k + 1]
                    out["query"] += [asked_for[i]] * len(some)
                    out["vec_id"] += [v for _, v in some]
                    out["score"] += [-s for s, _ in some]
        return pa.table({"query": pa.array(out["query"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    keys = ["tree", "leaf", "part", "block"]
    ranked = routed.groupBy(*keys).cogroup(placed.select(*keys, "ids", "v").groupBy(*keys)).applyInArrow(
        rerank, "query long, vec_id long, score double"
    )
    order = [F.desc("score"), F.col("vec_id")]
    by_query = Window.partitionBy("query").orderBy(*order)
    found = ranked.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    found = found.withColumn("r", F.row_number().over(by_query)).where(F.col("r") <= k + 1)
    lists = found.groupBy("query").agg(F.collect_list(F.struct("vec_id", "score")).alias("near"))
    lists = lists.join(wanted.select("query", F.col("v").alias("query_v")), "query").select("query_v", "near")
    mine = asked.join(lists, F.col("v") == F.col("query_v")).select(F.col("vec_id").alias("query_id"), F.explode("near").alias("p"))
    mine = mine.select("query_id", F.col("p.vec_id").alias("vec_id"), F.col("p.score").alias("score")).where("vec_id <> query_id")
    final = mine.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return final.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

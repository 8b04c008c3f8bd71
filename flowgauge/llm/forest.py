"""Nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample and index every vector.  A query goes through
all trees with one priority queue: whichever open branch, of any tree, is nearest to the
query comes next, until its leaves hold enough candidates.  Candidates are ranked by
their exact distance where they lie, leaf by leaf.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import col, cut, ship
from flowgauge.llm.vectors import SAMPLE, matrix, sample, usable

ship(__name__)

TREES, DEPTH = 10, 6
#: Candidates that a query's leaves hold together, as a multiple of all vectors; a vector counts in each tree.
SEARCH = 1.0
#: Up to so many vectors a query goes through all leaves.
WHOLE = 500
#: Vectors of a leaf that are ranked in one place; larger leaves are split.
LEAF_ROWS = 20_000


def plant(points: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Planes (trees x nodes x dims) and offsets; nodes lie as in a heap, from 1.

    A node's direction joins two random points of its part, its offset is the median.
    """
    rng = np.random.default_rng(seed)
    planes, offsets = np.zeros((trees, 1 << depth, points.shape[1])), np.zeros((trees, 1 << depth))
    for t in range(trees):
        parts = {1: np.arange(len(points))}
        for node in range(1, 1 << depth):
            part = parts.pop(node)
            if len(part) > 1:
                a, b = points[rng.choice(part, 2, replace=False)]
                way = a - b
            else:
                way = rng.standard_normal(points.shape[1])
            way /= max(float(np.linalg.norm(way)), 1e-12)
            at = points[part] @ way
            middle = float(np.median(at)) if len(part) else 0.0
            planes[t, node], offsets[t, node] = way, middle
            parts[2 * node], parts[2 * node + 1] = part[at <= middle], part[at > middle]
    return planes, offsets


def leaves(vectors: np.ndarray, forest) -> np.ndarray:
    """The leaf of every vector in every tree: trees x vectors."""
    planes, offsets = forest
    depth = planes.shape[1].bit_length() - 1
    out = np.empty((len(planes), len(vectors)), np.int32)
    for t in range(len(planes)):
        side = vectors @ planes[t].T > offsets[t]
        node = np.ones(len(vectors), np.int64)
        for _ in range(depth):
            node = 2 * node + side[np.arange(len(vectors)), node]
        out[t] = node - (1 << depth)
    return out


def probe(query: np.ndarray, forest, counts: dict[tuple[int, int], int], wanted: float) -> list[tuple[int, int]]:
    """Leaves (tree, leaf) in the order of the shared queue until they hold ``wanted`` vectors."""
    planes, offsets = forest
    margins = np.einsum("tnd,d->tn", planes, query) - offsets
    first = 1 << (planes.shape[1].bit_length() - 1)
    queue = [(-math.inf, t, 1) for t in range(len(planes))]
    found, held = [], 0
    while queue and held < wanted:
        near, t, node = heapq.heappop(queue)
        if node >= first:
            if n := counts.get((t, node - first), 0):
                found.append((t, node - first))
                held += n
            continue
        margin = float(margins[t, node])
        heapq.heappush(queue, (max(near, margin), t, 2 * node))
        heapq.heappush(queue, (max(near, -margin), t, 2 * node + 1))
    return found


def _rank(queries: pa.Table, leaf: pa.Table, k: int) -> pa.Table:
    """The ``k`` nearest vectors of one leaf for each query that reaches it."""
    ask, points = matrix(queries["qvec"]), matrix(leaf["vec"])
    out = {"query": [], "near": [], "distance": []}
    if len(ask) and len(points):
        names, ids = queries["query"].to_numpy(), leaf["node"].to_numpy()
        for name, q in zip(names, ask):
            away = points - q
            distance = np.sqrt((away * away).sum(1))
            some = min(k, len(ids))
            edge = np.partition(distance, some - 1)[some - 1]
            close = np.flatnonzero(distance <= edge)
            close = close[np.lexsort((ids[close], distance[close]))][:some]
            out["query"].append(np.full(some, name))
            out["near"].append(ids[close])
            out["distance"].append(distance[close])
    flat = {c: np.concatenate(v) if v else np.zeros(0, t) for (c, v), t in zip(out.items(), (np.int64, np.int64, float))}
    return pa.table(flat)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    trees: int = TREES,
    depth: int = DEPTH,
    search: float = SEARCH,
    sample_size: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found of every query, its own row apart.

    ``queries`` are rows with the same columns; they meet every row of ``vectors`` but
    that of their own id.  ``score`` is the Euclidean distance in double precision; ties
    go to the smaller id.  Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do those whose length is not the most frequent one.
    Of equal vectors the k + 1 smallest ids are candidates, which is all that can be
    among the k nearest.  Ids must be distinct longs; rows with a null id take no part.
    """
    spark = vectors.sparkSession
    narrow = lambda df: df.select(col(id).cast("long").alias("id"), col(vector).alias("vec")).where(
        F.col("id").isNotNull() & usable(F.col("vec"))
    )
    rows, asking = narrow(vectors), narrow(queries)
    points = sample(rows, size=sample_size)
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(points):
        return spark.createDataFrame([], schema).withColumnRenamed("vec_id", id)
    dims, forest = points.shape[1], plant(points, trees, depth)
    own = Window.partitionBy("vec").orderBy("id")
    # Equal vectors stand together under the smallest id; only k + 1 of them can matter.
    base = cut(
        rows.where(F.size("vec") == dims)
        .withColumn("turn", F.row_number().over(own))
        .where(F.col("turn") <= k + 1)
        .withColumn("node", F.min("id").over(Window.partitionBy("vec")))
    )
    heads = base.where("turn = 1").select("node", "vec")

    def place(batches):
        for batch in batches:
            at = leaves(matrix(batch.column(1)), forest)
            for t in range(len(at)):
                tree = pa.array(np.full(batch.num_rows, t, np.int32))
                yield pa.RecordBatch.from_arrays([tree, pa.array(at[t]), *batch.columns], ["tree", "leaf", "node", "vec"])

    kind = heads.schema["vec"].dataType.simpleString()
    index = heads.mapInArrow(place, f"tree int, leaf int, node long, vec {kind}")
    # One count per leaf: as many as the forest has leaves, whatever the input.
    counts = {(r.tree, r.leaf): r.n for r in index.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    held_in_all = sum(counts.values())
    wanted = held_in_all if held_in_all <= WHOLE * trees else search * held_in_all / trees
    parts = {place: -(-n // LEAF_ROWS) for place, n in counts.items()}
    most = max(parts.values())
    asked = (
        asking.where(F.size("vec") == dims)
        .groupBy("vec")
        .agg(F.min("id").alias("query"))
        .select("query", F.col("vec").alias("qvec"))
    )

    def search_all(batches):
        for batch in batches:
            names, ask = batch.column(0), batch.column(1)
            out = [
                (i, t, leaf, part)
                for i, q in enumerate(matrix(ask))
                for t, leaf in probe(q, forest, counts, wanted)
                for part in range(parts[t, leaf])
            ]
            at, tree, leaf, part = (pa.array([x[c] for x in out], pa.int32()) for c in range(4))
            yield pa.RecordBatch.from_arrays(
                [names.take(at), ask.take(at), tree, leaf, part], ["query", "qvec", "tree", "leaf", "part"]
            )

    probes = asked.mapInArrow(search_all, f"query long, qvec {kind}, tree int, leaf int, part int")
    split = F.lit(0) if most == 1 else F.pmod(F.xxhash64("node"), _parts_of(parts))
    held = index.withColumn("part", split.cast("int"))
    key = ["tree", "leaf", "part"]
    ranked = probes.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(
        lambda a, b: _rank(a, b, k + 1), "query long, near long, distance double"
    )
    # A vector counts once, whichever trees found it; then its ids stand for it.
    found = ranked.groupBy("query", "near").agg(F.min("distance").alias("distance"))
    best = Window.partitionBy("query").orderBy("distance", "near")
    heads_found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    ids = base.select(F.col("node").alias("near"), F.col("id").alias("found"))
    listed = heads_found.join(ids, "near").select("query", "found", "distance")
    order = Window.partitionBy("query").orderBy("distance", "found")
    short = listed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).drop("place")
    # The queries that share a vector share its list; each leaves out itself.
    of = asking.where(F.size("vec") == dims).join(asked.withColumnRenamed("qvec", "vec"), "vec").select("id", "query")
    lists = short.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("distance", "found"))).alias("all"))
    others = F.slice(F.filter("all", lambda x: x["found"] != F.col("id")), 1, k)
    return of.join(lists, "query").select("id", F.posexplode(others).alias("at", "near")).select(
        F.col("id").alias("query_id"),
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("near.found").alias(id),
        F.col("near.distance").alias("score"),
    )


def _parts_of(parts: dict[tuple[int, int], int]):
    """The number of parts of a row's leaf."""
    table = F.create_map(*[F.lit(x) for (t, leaf), n in parts.items() if n > 1 for x in (t << 20 | leaf, n)])
    return F.coalesce(F.element_at(table, F.col("tree") * (1 << 20) + F.col("leaf")), F.lit(1))

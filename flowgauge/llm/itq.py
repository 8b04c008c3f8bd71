"""Near-duplicate embeddings by iterative quantisation.

A rotation of the principal axes, learned on a bounded sample, gives every vector a
binary code of balanced bits.  Codes are looked up in several tables, each keyed by a
part of the code: close codes agree in some part up to a bit.  What is close in Hamming
distance is compared by the vectors themselves.

Many vectors that share a key (near copies of one another) do not come as pairs: they are
cut into blocks, blocks are compared block by block in matrices, and only each vector's
number of links and a tree of links leave the place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import col, cut, ship
from flowgauge.llm.graph import components
from flowgauge.llm.vectors import SAMPLE, matrix, sample, usable

ship(__name__)

BITS, TABLES = 64, 5
#: Hamming distance up to which vectors are compared.
REACH = 15
COSINE = 0.95
#: Vectors under one key beyond which they are compared in blocks, and the rows of a block.
HOT_KEY, BLOCK = 128, 512


def learn(points: np.ndarray, bits: int = BITS, rounds: int = 40, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dims x bits) of unit vectors; the code's bits are the signs.

    Principal axes of the sample, then rotations that bring the projected points near
    the corners of a cube, by turns with the corners they are nearest to.  Fewer
    dimensions than bits take several rotations.
    """
    rng = np.random.default_rng(seed)
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    mean = unit.mean(0)
    centred = unit - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, : min(bits, points.shape[1])]
    flat, parts = centred @ axes, []
    while sum(p.shape[1] for p in parts) < bits:
        turn, _ = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        parts.append(axes @ turn)
    return mean, np.concatenate(parts, 1)[:, :bits]


def codes(vectors: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Signed 64-bit codes."""
    mean, projection = model
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.packbits((unit - mean) @ projection >= 0, axis=1, bitorder="little").view("<i8").ravel()


def _parts(tables: int) -> list[tuple[int, int]]:
    """(first bit, width) of every table's part of the code."""
    cuts = [BITS * i // tables for i in range(tables + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _part(code: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1))


def _cosine(a: str, b: str) -> Column:
    def dot(x, y):
        product = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(product, F.lit(0.0), lambda s, p: s + p)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _compare(tile: pa.Table, tables: int, least: float) -> pa.Table:
    """Links within a tile: (node, links, root), the root being the smallest node linked within it.

    A pair counts under the first of the crowded keys that it shares, so once.
    """
    tile = tile.sort_by("node")
    table, i, j = (tile[c][0].as_py() for c in ("table", "i", "j"))
    node, block, copies = (tile[c].to_numpy() for c in ("node", "block", "copies"))
    points, code, hot = matrix(tile["vec"]), tile["code"].to_numpy(), tile["hot"].to_numpy()
    points = points / np.linalg.norm(points, axis=1, keepdims=True)
    linked = points @ points.T >= least
    if i != j:
        linked &= (block[:, None] == i) != (block[None, :] == i)
    np.fill_diagonal(linked, False)
    apart = code[:, None] ^ code[None, :]
    for t, (first, width) in enumerate(_parts(tables)[:table]):
        same = (apart >> np.int64(first)) & np.int64((1 << width) - 1) == 0
        linked &= ~(same & (hot[:, None] >> t & 1 == 1))
    links = linked @ copies
    root = np.arange(len(node))
    open_ = np.ones(len(node), bool)
    for start in range(len(node)):
        if not open_[start]:
            continue
        front = np.array([start])
        open_[start] = False
        while len(front):
            root[front] = start
            reached = linked[front].any(0) & open_
            open_ &= ~reached
            front = np.flatnonzero(reached)
    keep = links > 0
    return pa.table({"node": node[keep], "links": links[keep].astype(np.int64), "root": node[root[keep]]})


def near_vectors(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    least: float = COSINE,
    tables: int = TABLES,
    reach: int = REACH,
    sample_size: int = SAMPLE,
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Rows link if the cosine of their vectors, in double precision, is at least
    ``least`` and the index brings them together; none links below.  ``n_links`` counts
    the other rows linked directly, equal vectors included.  ``component_id`` is the
    smallest id that can be reached, ``kept`` whether that is the row's own.  Vectors
    that are null, zero, or hold null or non-finite components link with nothing, nor
    do vectors of different lengths.  Ids are longs and not null.
    """
    rows = vectors.select(col(id).cast("long").alias("id"), col(vector).alias("vec"))
    good = rows.where(usable(F.col("vec")))
    points = sample(good, size=sample_size)
    if not len(points):
        return _answer(rows, None, id)
    dims, model = points.shape[1], learn(points)
    same = good.where(F.size("vec") == dims).groupBy("vec").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    kind = rows.schema["vec"].dataType.simpleString()

    def coded(batches):
        for batch in batches:
            found = codes(matrix(batch.column(2)), model) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], ["node", "copies", "vec", "code"])

    heads = cut(
        same.select("node", "copies", "vec").mapInArrow(coded, f"node long, copies long, vec {kind}, code long")
    )
    cells = F.array(
        *[
            F.struct(F.lit(t).alias("table"), _part(F.col("code"), first, width).alias("key"))
            for t, (first, width) in enumerate(_parts(tables))
        ]
    )
    listed = heads.select("node", "code", F.explode(cells).alias("cell")).select("node", "code", "cell.*")
    crowded = cut(
        listed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_KEY)
    )
    in_crowd = listed.join(crowded, ["table", "key"]).select("node", "table", "key", "n")
    masks = in_crowd.groupBy("node").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("table"))).alias("hot"))
    marked = cut(heads.join(masks, "node", "left").withColumn("hot", F.coalesce("hot", F.lit(0))))

    tiles = _tiles(marked, in_crowd, tables, least)
    pairs = _pairs(marked.select("node", "code", "hot"), tables, reach)
    ends = marked.select("node", "copies", "vec")
    a, b = (ends.select(*[F.col(c).alias(f"{c}_{x}") for c in ends.columns]) for x in "ab")
    close = cut(
        pairs.join(a, "node_a").join(b, "node_b").where(_cosine("vec_a", "vec_b") >= least)
        .select("node_a", "copies_a", "node_b", "copies_b")
    )
    links = (
        close.select(F.col("node_a").alias("node"), F.col("copies_b").alias("links"))
        .unionByName(close.select(F.col("node_b").alias("node"), F.col("copies_a").alias("links")))
        .unionByName(tiles.select("node", "links"))
        .groupBy("node")
        .agg(F.sum("links").alias("links"))
    )
    edges = close.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).unionByName(
        tiles.select(F.col("node").alias("a"), F.col("root").alias("b"))
    )
    groups = components(edges)
    named = (
        heads.select("node", "copies", "vec")
        .join(links, "node", "left")
        .join(groups, "node", "left")
        .select("vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("c"))
    )
    return _answer(rows, named, id)


def _answer(rows: DataFrame, named: DataFrame | None, id: str) -> DataFrame:
    if named is None:
        named = rows.limit(0).select("vec", F.lit(0).cast("long").alias("n"), F.col("id").alias("c"))
    # Vectors out of the game stand for themselves and need no join.
    key = F.when(usable(F.col("vec")), F.col("vec"))
    found = rows.select("id", key.alias("key")).join(named, F.col("key") == F.col("vec"), "left")
    component = F.coalesce("c", "id")
    return found.select(
        F.col("id").alias(id),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (component == F.col("id")).alias("kept"),
    )


def _tiles(marked: DataFrame, in_crowd: DataFrame, tables: int, least: float) -> DataFrame:
    """Links of vectors that share a crowded key, from comparing blocks of them."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    member = in_crowd.select(
        "node", "table", "key", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block")
    )
    # Block b meets every block: as the later of the pairs (j, b), the earlier of (b, j).
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")),
    )
    spread = member.select("node", "table", "key", "block", F.explode(others).alias("tile")).select(
        "node", "table", "key", "block", "tile.*"
    )
    whole = spread.join(marked, "node").select("table", "key", "i", "j", "block", "node", "copies", "vec", "code", "hot")
    return cut(
        whole.groupBy("table", "key", "i", "j").applyInArrow(
            lambda tile: _compare(tile, tables, least), "node long, links long, root long"
        )
    )


def _pairs(marked: DataFrame, tables: int, reach: int) -> DataFrame:
    """(node_a, node_b), each once: codes that agree in a part up to a bit and are close as a whole."""
    parts = _parts(tables)

    def rows(probe: bool) -> DataFrame:
        cells = []
        for t, (first, width) in enumerate(parts):
            key = _part(F.col("code"), first, width)
            for flip in [0] + [1 << i for i in range(width)] * probe:
                cells.append(F.struct(F.lit(t).alias("table"), key.bitwiseXOR(F.lit(flip)).alias("key")))
        return marked.select("node", "code", "hot", F.explode(F.array(*cells)).alias("cell")).select(
            "node", "code", "hot", "cell.table", "cell.key"
        )

    a, b = rows(False).alias("a"), rows(True).alias("b")
    apart = F.col("a.code").bitwiseXOR(F.col("b.code"))
    first_table = F.lit(None).cast("int")
    within = (F.col("a.table") == F.col("b.table")) & (F.col("a.key") == F.col("b.key"))
    within &= (F.col("a.node") < F.col("b.node")) & (F.bit_count(apart) <= reach)
    for t, (first, width) in reversed(list(enumerate(parts))):
        differ = F.bit_count(_part(apart, first, width))
        first_table = F.when(differ <= 1, F.lit(t)).otherwise(first_table)
        # Pairs under one crowded key are compared in blocks.
        within &= ~((differ == 0) & (F.col("a.hot").bitwiseAND(F.lit(1 << t)) != 0))
    return a.join(b, within & (F.col("a.table") == first_table)).select(
        F.col("a.node").alias("node_a"), F.col("b.node").alias("node_b")
    )

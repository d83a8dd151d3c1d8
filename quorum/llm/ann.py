"""Approximate nearest neighbours by NN-descent (operator 6).

A graph links every vector with its nearest known neighbours.  It starts from
blocks of vectors that have a pivot (of a bounded sample) among their nearest
ones in common, and is improved by rounds of a Spark join: each vector's neighbours, in both directions, are brought
together with it and compared with each other (neighbours of neighbours) where
one of them is new to it, and every vector keeps the nearest it has met, until
a round changes few edges.  Queries walk the finished graph
greedily: expand the nearest candidates not expanded yet, until none of the
nearest ``BEAM`` is left.

Equal vectors are one node of the graph, so a very common vector is compared
once.  Nodes that many others link to are salted over blocks, dealt anew in
every round, so that a pair parted in one round meets in another.  Pivots are of
a bounded number; blocks that have grown too large for it are split by pivots of
their own, level by level, so that near vectors stay together at any size.

The graph and the walk measure the original components in double precision.
Blocks are measured by the expanded square around their median; pairs that it
leaves with too few sound bits, as inside a tight cluster, by their difference.

Defined results: vectors that are null, empty, zero, hold null or non-finite
components, or have another length than most vectors take no part, neither as
query nor as candidate; of rows that repeat an id the smallest vector counts;
rows with a null id are ignored; with k or fewer candidates all are returned;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorum.llm.common import runs, written

NEIGHBOURS = 24
#: Vectors per pivot, pivots at most, and pivots that a vector is assigned to.
BLOCK, MAX_PIVOTS, ASSIGNED = 256, 4096, 8
#: Rows of a block before it is split, pivots that split it, and levels before what is left is dealt by hash
#: (no random pivots of different vectors get there).
BLOCK_ROWS, SPLIT, LEVELS = 4096, 8, 40
#: Rounds go on until one changes no more than this share of the edges.
CHANGED = 0.001
#: Neighbours, of both directions, that are compared in one block.
JOIN_BLOCK = 64
BEAM = 96
#: Relative error of a squared distance above which the difference itself is measured, and pairs measured at a time.
SOUND, PAIRS = 1e-6, 65536


def stored(vectors: DataFrame, vector_col: str) -> str:
    """How components are stored without loss: as floats where they are floats, else as doubles."""
    return "<f4" if vectors.select(vector_col).schema[0].dataType.simpleString() == "array<float>" else "<f8"


def packed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): the usable vectors as little-endian numbers of the ``stored`` kind."""
    kind = stored(vectors, vector_col)
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & sound)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    one = rows.filter(F.size("v") == (sizes.d if sizes else 0)).groupBy("vec_id").agg(F.min("v").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [(np.array(x) + 0.0).astype(kind).tobytes() for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], ["vec_id", "v"])

    return one.mapInArrow(run, "vec_id long, v binary")


def _matrix(column, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def _edges(node: np.ndarray, near: np.ndarray, dist: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(near, pa.int64()), pa.array(dist, pa.float64())], ["node", "near", "dist"])


EDGES = "node long, near long, dist double"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    centre = np.median(b[:: max(1, len(b) // 256)], axis=0)
    x, y = a - centre, b - centre
    with np.errstate(over="ignore", invalid="ignore"):
        norms = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)
        d = norms - 2 * (x @ y.T)
        # What rounding can have changed at most is a share of the norms, not of the distance.
        i, j = np.nonzero(~(d * SOUND >= norms * (4 * (a.shape[1] + 4) * np.finfo(np.float64).eps)))
        for at in range(0, len(i), PAIRS):
            p, q = i[at : at + PAIRS], j[at : at + PAIRS]
            difference = a[p] - b[q]
            d[p, q] = (difference * difference).sum(axis=1)
    return d


def _own(d: np.ndarray, start: int = 0) -> np.ndarray:
    """``d`` with the distances of rows to themselves (row i is column start + i) infinite."""
    d[np.arange(len(d)), np.arange(len(d)) + start] = np.inf
    return d


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The nearest ``k`` of every node, ``new`` where no edge among those given is known already."""
    best = Window.partitionBy("node").orderBy("dist", "near")
    return (edges.groupBy("node", "near").agg(F.min("dist").alias("dist"), F.min("new").alias("new"))
            .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).drop("r"))


def _split(blocks: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """(block, node) with blocks of ``BLOCK_ROWS`` at most: larger ones are split by the nearest of their own pivots."""
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                x = _matrix(b.column("v"), kind)
                own = [(p + p[:1] * (SPLIT - len(p))) for p in b.column("pivots").to_pylist()]
                difference = np.frombuffer(b"".join(v for p in own for v in p), kind).reshape(len(x), SPLIT, -1) - x[:, None]
                part = (difference * difference).sum(axis=2).argmin(axis=1)
                names = [f"{k}/{i}" for k, i in zip(b.column("block").to_pylist(), part.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), b.column("node")], ["block", "node"])

    done = blocks.filter("false")
    for level in range(LEVELS + 1):
        sizes = written(blocks.groupBy("block").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK_ROWS), "large")
        if not sizes.limit(1).count():
            break
        done = done.unionByName(blocks.join(sizes, "block", "left_anti"))
        large = blocks.join(sizes, "block")
        order = F.xxhash64("node", "block", F.lit(level))
        if level == LEVELS:
            blocks = large.select(F.concat_ws("/", "block", F.pmod(order, F.ceil(F.col("n") / BLOCK_ROWS))).alias("block"), "node")
            break
        # About 4 * SPLIT rows of a block, of which SPLIT are its pivots.
        some = large.filter(F.pmod(order, "n") < 4 * SPLIT).withColumn("r", F.row_number().over(Window.partitionBy("block").orderBy(order)))
        pivots = (some.filter(F.col("r") <= SPLIT).select("block", "node").join(nodes, "node")
                  .groupBy("block").agg(F.collect_list("v").alias("pivots")))
        # A block without a sampled row, if there ever is one, waits for the next level.
        waits = large.join(pivots, "block", "left_anti").select("block", "node")
        split = large.join(nodes, "node").join(pivots, "block").select("block", "node", "v", "pivots").mapInArrow(chosen, "block string, node long")
        blocks = written(split.unionByName(waits), "blocks")
    return done.unionByName(blocks)


def _start(nodes: DataFrame, k: int, kind: str) -> DataFrame:
    """Neighbours inside blocks of vectors that are near the same pivot."""
    count = nodes.count()
    wanted = min(MAX_PIVOTS, -(-count // BLOCK))
    # A sample of documented size, chosen by a hash of the id.
    sample = nodes.select("node", "v").orderBy(F.xxhash64("node"), "node").limit(wanted).collect()
    if not sample:
        return nodes.sparkSession.createDataFrame([], EDGES)
    pivots = np.frombuffer(b"".join(r.v for r in sample), kind).reshape(len(sample), -1).astype(np.float64)
    assigned = min(ASSIGNED, len(pivots))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                near = np.argpartition(_distances(_matrix(b.column("v"), kind), pivots), assigned - 1, axis=1)[:, :assigned]
                for j in range(assigned):
                    yield pa.RecordBatch.from_arrays([pa.array(near[:, j]).cast(pa.string()), b.column("node")], ["block", "node"])

    blocks = _split(written(nodes.select("node", "v").mapInArrow(codes, "block string, node long"), "blocks"), nodes, kind).join(nodes, "node")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in runs(batches, "block"):
            ids, x = t.column("node").to_numpy(), _matrix(t.column("v"), kind)
            # Half of a node's neighbours from each of its blocks is enough to start from.
            best = min(max(k // 2, 1), len(ids) - 1)
            for at in range(0, len(ids) if best > 0 else 0, 512):
                d = _own(_distances(x[at : at + 512], x), at)
                top = np.argpartition(d, best - 1, axis=1)[:, :best]
                yield _edges(np.repeat(ids[at : at + 512], best), ids[top].ravel(), np.take_along_axis(d, top, axis=1).ravel())

    return blocks.select("block", "node", "v").repartition("block").sortWithinPartitions("block").mapInArrow(near, EDGES)


def _both_ways(graph: DataFrame) -> DataFrame:
    turned = {"node": "near", "near": "node"}
    return graph.unionByName(graph.select(*(F.col(turned.get(c, c)).alias(c) for c in graph.columns)))


def _improved(nodes: DataFrame, graph: DataFrame, k: int, kind: str, step: int) -> DataFrame:
    """Edges between neighbours of one node that beat what their ends know."""
    both = _both_ways(graph.select("node", "near", "new")).groupBy("node", "near").agg(F.max("new").alias("new"))
    # Two neighbours that the node knew before met in an earlier round, unless salts parted them.
    salts = (both.groupBy("node").agg(F.ceil(F.count("*") / JOIN_BLOCK).alias("salts"), F.max("new").alias("any"))
             .filter(F.col("any") | (F.col("salts") > 1)).drop("any"))
    worst = graph.groupBy("node").agg(F.max("dist").alias("worst"), F.count("*").alias("known"))
    carried = (nodes.select("node", "v").join(worst, "node", "left")
               .select(F.col("node").alias("near"), "v", F.when(F.col("known") >= k, F.col("worst")).otherwise(float("inf")).alias("worst")))
    blocks = (both.join(salts, "node")
              .select(F.concat_ws("/", "node", F.pmod(F.xxhash64("near", "node", F.lit(step)), "salts")).alias("block"),
                      "near", (F.col("new") | (F.col("salts") > 1)).alias("new"))
              .join(carried, "near").select("block", "near", "v", "worst", "new"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in runs(batches, "block"):
            new = np.array(t.column("new").to_pylist(), bool)
            ids, worst, x = t.column("near").to_numpy(), t.column("worst").to_numpy(), _matrix(t.column("v"), kind)
            d = _own(_distances(x, x))
            a, b = np.nonzero((d < worst[:, None]) & (new[:, None] | new))
            if len(a):
                yield _edges(ids[a], ids[b], d[a, b])

    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(compare, EDGES)


def graph_of(nodes: DataFrame, kind: str, k: int = NEIGHBOURS) -> DataFrame:
    """(node, near, dist, new): every node's nearest known neighbours, squared distances."""
    first = _both_ways(_start(nodes, k, kind)).withColumn("new", F.lit(True))
    graph, step = written(_nearest(first, k), "graph"), 0
    while True:
        known = _both_ways(graph.select("node", "near", "dist")).withColumn("new", F.lit(True))
        met = known.unionByName(_improved(nodes, graph, k, kind, step).withColumn("new", F.lit(True)))
        graph = written(_nearest(met.unionByName(graph.withColumn("new", F.lit(False))), k), "graph")
        edges, changed = graph.agg(F.count("*"), F.count(F.when(F.col("new"), 1))).first()
        step += 1
        if changed <= CHANGED * edges:
            return graph


def _measured(pairs: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """(q, node, dist): distances of pairs (q, node)."""
    with_both = (pairs.join(nodes.select("node", F.col("v").alias("nv")), "node")
                 .join(nodes.select(F.col("node").alias("q"), F.col("v").alias("qv")), "q"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = _matrix(b.column("nv"), kind) - _matrix(b.column("qv"), kind)
                yield pa.RecordBatch.from_arrays([b.column("q"), b.column("node"), pa.array(np.sqrt((d * d).sum(axis=1)))], ["q", "node", "dist"])

    return with_both.select("q", "node", "nv", "qv").mapInArrow(measure, "q long, node long, dist double")


def searched(queries: DataFrame, nodes: DataFrame, graph: DataFrame, kind: str, beam: int = BEAM) -> DataFrame:
    """(q, node, dist): the nearest ``beam`` nodes that a greedy walk from each node q finds, q included."""
    links = written(graph.select("node", "near").unionByName(graph.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct(), "walk_links")
    state = written(queries.select(F.col("node").alias("q"), "node", F.lit(0.0).alias("dist"), F.lit(False).alias("done"), F.lit(1).alias("r")), "walk")
    nearest = Window.partitionBy("q").orderBy("dist", "node")
    while state.filter(~F.col("done") & (F.col("r") <= beam)).limit(1).count():
        ahead = state.filter(~F.col("done") & (F.col("r") <= beam))
        met = (ahead.join(links, "node").select("q", F.col("near").alias("node")).distinct()
               .join(state.select("q", "node"), ["q", "node"], "left_anti"))
        known = state.select("q", "node", "dist", (F.col("done") | (F.col("r") <= beam)).alias("done"))
        every = known.unionByName(_measured(met, nodes, kind).withColumn("done", F.lit(False)))
        state = written(every.withColumn("r", F.row_number().over(nearest)), "walk")
    return state.filter(F.col("r") <= beam).select("q", "node", "dist")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``.
    """
    kind = stored(vectors, vector_col)
    rows = written(packed(vectors, id_col, vector_col), "vectors")
    nodes = written(rows.groupBy("v").agg(F.min("vec_id").alias("node")), "nodes")
    members = written(rows.join(nodes, "v").select("node", "vec_id"), "members")
    asked = members.filter(is_query)
    found = searched(asked.select("node").distinct(), nodes, graph_of(nodes, kind), kind, max(BEAM, k + 1))
    # Only a node's k + 1 smallest ids can be among the k nearest of a query.
    smallest = Window.partitionBy("node").orderBy("vec_id")
    first = members.withColumn("n", F.row_number().over(smallest)).filter(F.col("n") <= k + 1).select("node", "vec_id")
    best = Window.partitionBy("q").orderBy("dist", "vec_id")
    # k + 1 rows per query node hold the k nearest of each of its queries, which leave out themselves.
    near = found.join(first, "node").withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    rank = Window.partitionBy("query_id").orderBy("dist", "vec_id")
    return (
        near.join(asked.select(F.col("node").alias("q"), F.col("vec_id").alias("query_id")), "q").filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("dist").alias("score"))
    )

"""Approximate nearest neighbours by inner product: NN-descent builds a graph, queries search it greedily.

The graph starts from random hyperplane trees, whose leaves are compared exactly, and is refined by joining the
neighbours of neighbours: around each vector, all that know it or that it knows are compared with those of them that
are new there, until few pools gain members. The graph is built in single precision; queries search it in double precision.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tapwise.sources.folders import written_once

DEGREE = 40  # neighbours of a vector in the graph
REVERSE = 40  # vectors that know it, in the pool around it
TREES = 8
LEAF = 2048  # vectors compared exactly in a leaf
BEAM = 80  # vectors that a query keeps
CHANGED = 0.02  # share of the pools that may still have gained members when the descent ends
PLANES = 24  # hyperplanes that order the vectors of a tree


def _best(rows: DataFrame, key: str, other: str, count: int) -> DataFrame:
    """The `count` best of (key, other, sim), each pair once, with their place from 1."""
    return _nearest(rows.groupBy(key, other).agg(F.max("sim").alias("sim")), key, other, count)


def _nearest(rows: DataFrame, key: str, other: str, count: int) -> DataFrame:
    """The same of pairs that are distinct already; ranks are cut in the map tasks first."""
    order = Window.partitionBy(key).orderBy(F.desc("sim"), other)
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= count)


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """Packed vectors, all of one size, as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def clean_vectors(embeddings: DataFrame) -> DataFrame:
    """Distinct (vec_id, node, packed): finite, non-zero vectors; equal vectors are one node.

    Rows with a null id, vectors that are null, zero, or hold null or non-finite components take no part, nor do
    those of another length than most vectors have.
    """
    vector = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    sound = (
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(vector, lambda x: x != 0)
    )
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("vector") == (sizes["n"] if sizes else 0))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("vector")
            data = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1) + 0.0  # no minus zero
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([v.tobytes() for v in data], pa.binary())], ["vec_id", "packed"])

    found = rows.mapInArrow(packed, "vec_id long, packed binary")
    return found.select("vec_id", F.xxhash64("packed").alias("node"), "packed").distinct()


def _tree_links(vectors: DataFrame, count: int, size: int, degree: int, trees: int, leaf: int, seed: int) -> DataFrame:
    """Best links (node, other, sim) within leaves of random hyperplane trees.

    The path through a tree is a sort key; rows are range-sorted by it and cut into leaves of equal size, so
    copies and clusters of any size are cut as well. Vectors on one path are ordered along a direction of the tree's
    own, equal ones by a hash with the path, so each tree cuts a group of near copies in another way.
    """
    planes = np.random.default_rng(seed).standard_normal((size, trees, PLANES + 1)).astype(np.float32)

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(PLANES)[::-1]
        for batch in batches:
            data = _matrix(batch.column("single"), np.float32)
            sides = np.einsum("nd,dtp->ntp", data, planes, optimize=True)
            codes = (sides[:, :, :PLANES] > 0) @ weights
            for tree in range(trees):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[:, tree] + (tree << PLANES), pa.int64()), pa.array(sides[:, tree, PLANES]),
                     batch.column("node"), batch.column("single")], ["path", "along", "node", "single"])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def leaves(rows: pa.Table, last: bool) -> tuple[list, pa.Table]:
            out = []
            while rows.num_rows >= 2 * leaf or (last and rows.num_rows):
                take = rows.num_rows if rows.num_rows < 2 * leaf else leaf
                out.append(rows.slice(0, take))
                rows = rows.slice(take)
            return out, rows

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            full, rest = leaves(rest, False)
            yield from map(compare, full)
        if rest is not None:
            yield from map(compare, leaves(rest, True)[0])

    def compare(rows: pa.Table) -> pa.RecordBatch:
        # a leaf across the borders of small trees may hold a vector several times
        nodes, first = np.unique(rows.column("node").to_numpy(), return_index=True)
        data = _matrix(rows.column("single").combine_chunks().take(pa.array(first)), np.float32)
        keep, out = min(degree + 1, len(nodes)), []
        for begin in range(0, len(nodes), 512):
            sims = data[begin:begin + 512] @ data.T
            top = np.argpartition(-sims, keep - 1, axis=1)[:, :keep] if keep < len(nodes) else np.tile(
                np.arange(len(nodes)), (len(sims), 1))
            left = np.repeat(np.arange(begin, begin + len(sims)), keep)
            right = top.reshape(-1)
            differ = left != right
            out.append((nodes[left][differ], nodes[right][differ],
                        sims[left - begin, right][differ]))
        node, other, sim = (np.concatenate(c) for c in zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(other), pa.array(sim.astype(np.float32))], ["node", "other", "sim"])

    placed = vectors.select("node", "single").mapInArrow(paths, "path long, along float, node long, single binary")
    parts = max(1, count * trees // (4 * leaf))
    place = ["path", "along", F.xxhash64("path", "node")]
    ordered = placed.repartitionByRange(parts, *place).sortWithinPartitions(*place).drop("along")
    return _best(ordered.mapInArrow(links, "node long, other long, sim float"), "node", "other", degree)


def _pools(graph: DataFrame, vectors: DataFrame) -> DataFrame:
    """Rows (centre, members): each vector's neighbours and the nearest of those whose neighbour it is.

    A pool is bounded however many vectors know its centre.
    """
    known = graph.select(F.col("node").alias("centre"), F.col("other").alias("member"), "sim")
    knowing = _nearest(graph.select(F.col("other").alias("centre"), F.col("node").alias("member"), "sim"),
                       "centre", "member", REVERSE)
    itself = vectors.select(F.col("node").alias("centre"), F.col("node").alias("member"))
    pools = known.select("centre", "member").union(knowing.select("centre", "member")).union(itself)
    return pools.groupBy("centre").agg(F.collect_set("member").alias("members"))


def _descend(graph: DataFrame, pools: DataFrame, vectors: DataFrame, degree: int) -> DataFrame:
    """One round of the descent: the new members of each pool are compared with all its members.

    Only pairs nearer than the worst neighbour a vector has leave the task.
    """
    worst = graph.filter(F.col("place") == degree).select(F.col("node").alias("member"), F.col("sim").alias("least"))
    carried = vectors.select(F.col("node").alias("member"), "single").join(worst, "member", "left")
    members = pools.select("centre", F.explode(F.transform("members", lambda m: F.struct(
        m.alias("member"), F.array_contains("fresh", m).alias("new")))).alias("_m")).select("centre", "_m.*")
    gathered = members.join(carried, "member").groupBy("centre").agg(
        F.collect_list(F.struct("member", "single", "least", "new")).alias("pool"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("pool")
            offsets, flat = lists.offsets.to_numpy(), lists.values
            nodes = flat.field("member").to_numpy()
            least = flat.field("least").to_numpy(zero_copy_only=False)
            least = np.where(np.isnan(least), -np.inf, least)
            new = flat.field("new").to_numpy(zero_copy_only=False)
            data = _matrix(flat.field("single"), np.float32)
            for lo in range(0, batch.num_rows, 256):
                out = []
                for begin, end in zip(offsets[lo:lo + 256], offsets[lo + 1:lo + 257]):
                    part, known = data[begin:end], begin + np.flatnonzero(~new[begin:end])
                    fresh = begin + np.flatnonzero(new[begin:end])
                    sims = data[fresh] @ part.T
                    sims[np.arange(len(fresh)), fresh - begin] = -np.inf
                    left, right = np.nonzero(sims > least[fresh, None])
                    out.append((nodes[fresh[left]], nodes[begin + right], sims[left, right]))
                    back = sims[:, known - begin]
                    left, right = np.nonzero(back > least[known])
                    out.append((nodes[known[right]], nodes[fresh[left]], back[left, right]))
                node, other, sim = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(other), pa.array(sim)],
                                                 ["node", "other", "sim"])

    found = gathered.select("pool").mapInArrow(joined, "node long, other long, sim float")
    return _best(graph.select("node", "other", "sim").union(found), "node", "other", degree)


def neighbour_graph(vectors: DataFrame, size: int, degree: int = DEGREE, trees: int = TREES, leaf: int = LEAF,
                    seed: int = 11, changed_share: float = CHANGED) -> DataFrame:
    """Links (node, other, sim, place) of the (node, single) vectors of `size` components.

    The descent ends when at most `changed_share` of the pools have gained a member in a round, with 0 when none has.
    Pairs of members that stood in the pool before are not compared again: they have been offered, and the worst
    neighbour of a vector only gets nearer.
    """
    count = vectors.count()
    graph = written_once(_tree_links(vectors, count, size, degree, trees, leaf, seed), "graph")
    before = vectors.sparkSession.createDataFrame([], "centre long, seen array<long>")
    while True:
        fresh = F.array_except("members", F.coalesce("seen", F.array().cast("array<long>")))
        pools = written_once(_pools(graph, vectors).join(before, "centre", "left").select(
            "centre", "members", fresh.alias("fresh")), "pools")
        changed = pools.filter(F.size("fresh") > 0)
        if changed.count() <= changed_share * count:
            return graph
        graph = written_once(_descend(graph, changed, vectors, degree), "graph")
        before = pools.select("centre", F.col("members").alias("seen"))


def _search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, beam: int) -> DataFrame:
    """Greedy search: links (node, other, sim) of the query nodes, from their own neighbours outwards.

    Each round looks up the neighbours of all vectors kept and not looked up yet, and keeps the `beam` nearest by the
    inner product in double precision; it ends when no query has any left.
    """
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_matrix(batch.column(n), np.float64) for n in ("a", "b"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("other"), pa.array(np.einsum("nd,nd->n", left, right))],
                ["node", "other", "sim"])

    def measured(pairs: DataFrame) -> DataFrame:
        """The (node, other) pairs with their inner products, none of them looked up yet."""
        return (
            pairs.join(nodes.select(F.col("node").alias("other"), F.col("packed").alias("b")), "other")
            .join(nodes.withColumnRenamed("packed", "a"), "node").select("node", "other", "a", "b")
            .mapInArrow(scored, "node long, other long, sim double").withColumn("done", F.lit(False))
        )

    state = written_once(measured(graph.join(queries, "node", "left_semi").select("node", "other")), "search")
    while not state.filter(~F.col("done")).isEmpty():
        reached = (
            state.filter(~F.col("done")).select("node", "other")
            .join(graph.select(F.col("node").alias("other"), F.col("other").alias("next")), "other")
            .select("node", F.col("next").alias("other")).filter("node != other").distinct()
            .join(state, ["node", "other"], "left_anti")
        )
        kept = state.withColumn("done", F.lit(True)).union(measured(reached))
        state = written_once(_nearest(kept, "node", "other", beam).drop("place"), "search")
    return state.select("node", "other")


def nearest_neighbours(embeddings: DataFrame, query_step: int = 20, count: int = 20, **graph_options) -> DataFrame:
    """The `count` nearest rows of every row whose vec_id is divisible by `query_step`: query_id, rank, vec_id, score.

    Nearness is the inner product in double precision of the original vectors; ties go to the smaller vec_id. A
    query does not find itself. Equal vectors are one node of the graph and are all found with it, so copies never
    hide one another; rows equal in id and vector are one. See `clean_vectors` for those that take no part. With
    fewer candidates than `count`, all are returned.
    """
    rows = written_once(clean_vectors(embeddings), "vectors")
    first = rows.first()
    size = len(first["packed"]) // 8 if first else 1

    nodes = written_once(rows.dropDuplicates(["node"]).select("node", "packed"), "nodes")

    def greatest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                data = _matrix(batch.column("packed"), np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([float(np.abs(data).max())])], ["most"])

    # one power of two for all vectors leaves their order as it is and keeps single precision within its range
    most = nodes.select("packed").mapInArrow(greatest, "most double").agg(F.max("most")).first()[0] or 1.0
    shift = -int(np.frexp(most)[1])

    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small = np.ldexp(_matrix(batch.column("packed"), np.float64), shift).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([v.tobytes() for v in small], pa.binary())], ["node", "single"])

    vectors = written_once(nodes.mapInArrow(singles, "node long, single binary"), "single-vectors")
    graph = neighbour_graph(vectors, size, **graph_options)
    queries = rows.filter(F.pmod("vec_id", F.lit(query_step)) == 0).select("vec_id", "node")
    found = _search(queries.select("node").distinct(), graph, nodes, BEAM)
    own = queries.select("node", F.col("node").alias("other")).distinct()
    candidates = found.union(own)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_matrix(batch.column(n), np.float64) for n in ("a", "b"))
            score = np.einsum("nd,nd->n", left, right)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("other"), pa.array(score)], ["node", "other", "score"])

    scores = (
        candidates.join(nodes.withColumnRenamed("packed", "a"), "node")
        .join(nodes.select(F.col("node").alias("other"), F.col("packed").alias("b")), "other")
        .select("node", "other", "a", "b").mapInArrow(exact, "node long, other long, score double")
    )
    # of copies only the smallest ids can be among the nearest, one more because a query leaves itself out
    by_id = Window.partitionBy("node").orderBy("vec_id")
    copies = rows.select("node", "vec_id").withColumn("_copy", F.row_number().over(by_id)).filter(
        F.col("_copy") <= count + 1).select(F.col("node").alias("other"), "vec_id")
    # the nearest for a query vector are ranked once, then handed to all queries that have it
    order = Window.partitionBy("node").orderBy(F.desc("score"), "vec_id")
    ranked = scores.join(copies, "other").withColumn("_rank", F.row_number().over(order)).filter(
        F.col("_rank") <= count + 1).select("node", "vec_id", "score")
    answers = queries.select(F.col("vec_id").alias("query_id"), "node").join(ranked, "node").filter(
        F.col("vec_id") != F.col("query_id"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= count).select(
        "query_id", "rank", "vec_id", "score")

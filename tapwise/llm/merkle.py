"""Merkle manifest of a data set by incremental witnesses.

The leaves of a source, in the order of doc_id, are appended to a stream of complete nodes. An open subtree holds the
nodes of an unfinished run with the witnesses of the leaves below them; the append that completes the run extends
each of these witnesses by the siblings it just learned and puts one node in place of the run, a level higher.
Streams start at positions that are multiples of a power of the arity, so they are cut into blocks of leaves that
tasks append independently. The root of each block is then one append to the stream of the next pass, until a
tree has one node. The subtree roots of the sources are appended in the same way to the tree of the data set.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tapwise.operators.lookup import BROADCAST_LIMIT_BYTES, lookup_join
from tapwise.sources.folders import written_once

ARITY = 3  # fixed value: nodes of a run
BLOCK_LEVELS = 7  # a task appends blocks of ARITY ** BLOCK_LEVELS leaves
ROWS_PER_PART = 1_000_000  # nodes a task sorts
STEP_BYTES, ROW_BYTES = 256, 512  # upper bounds of a witness step and of the rest of a row in a broadcast

STEP = "struct<left string, right string>"  # siblings of one level, before and after, as hex digests


class WitnessStream:
    """One stream of appended nodes; `witnesses` holds what is known of each leaf's witness so far."""

    def __init__(self, arity: int = ARITY):
        self.arity = arity
        self.witnesses: list[list[tuple[str, str]]] = []
        self._open: list[list[tuple[str, int]]] = []  # by level: an unfinished run as digests and their first leaves

    def append(self, digest: str) -> None:
        """Add a leaf and complete every run that it ends."""
        self.witnesses.append([])
        self._add(0, digest, len(self.witnesses) - 1)

    def _add(self, level: int, digest: str, first: int) -> None:
        if level == len(self._open):
            self._open.append([])
        self._open[level].append((digest, first))
        if len(self._open[level]) == self.arity:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """Put one node in place of a run; nothing is open below it, so it reaches to the newest leaf."""
        run, self._open[level] = self._open[level], []
        digests = [digest for digest, _ in run]
        ends = [*[first for _, first in run[1:]], len(self.witnesses)]
        for at, ((_, first), end) in enumerate(zip(run, ends)):
            step = ("".join(digests[:at]), "".join(digests[at + 1:]))
            for leaf in range(first, end):
                self.witnesses[leaf].append(step)
        self._add(level + 1, hashlib.sha256("".join(digests).encode()).hexdigest(), run[0][1])

    def close(self, height: int) -> str:
        """Complete what is open, from the lowest level up, and return the node of `height`."""
        for level in range(height):
            if level < len(self._open) and self._open[level]:
                self._complete(level)
        return self._open[height][0][0]


def tree_height(leaves: int, arity: int = ARITY) -> int:
    """Levels above the leaves until one node is left."""
    height = 0
    while leaves > 1:
        height, leaves = height + 1, -(-leaves // arity)
    return height


class _Block:
    """The rows and the stream of one block, as long as a task appends to it."""

    def __init__(self, size: int, levels: int):
        self.rows: list[pa.RecordBatch] = []
        self.stream = WitnessStream()
        # a tree of one block ends with its own height, larger ones go on above their blocks
        self.height = tree_height(size) if size <= ARITY ** levels else levels

    def closed(self) -> pa.RecordBatch:
        top = self.stream.close(self.height)
        flat = [step for witness in self.stream.witnesses for step in witness]
        pairs = pa.StructArray.from_arrays(
            [pa.array([s[side] for s in flat], pa.string()) for side in (0, 1)], ["left", "right"])
        count = len(self.stream.witnesses)
        offsets = pa.array([k * self.height for k in range(count + 1)], pa.int32())
        rows = pa.Table.from_batches(self.rows).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays(
            [*rows.columns, pa.ListArray.from_arrays(offsets, pairs), pa.array([top] + [None] * (count - 1), pa.string())],
            [*rows.schema.names, "steps", "top"])


def _dealt(nodes: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by keys, into more partitions than the session's where they are too many for those."""
    parts = -(-nodes.count() // ROWS_PER_PART)
    return nodes.repartition(parts, *keys) if parts > _partitions(nodes) else nodes.repartition(*keys)


def _partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _append_blocks(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """Append the nodes (tree, at, size, digest and other columns) block by block.

    Returns the nodes with `block` and `steps`, each one's witness below the top of its block, and the tops as the
    nodes of the next pass. Blocks arrive one after another, so a task holds one of them.
    """
    width = ARITY ** levels

    def appended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, None
        for batch in batches:
            trees, numbers, sizes, digests = (
                batch.column(n).to_pylist() for n in ("tree", "block", "size", "digest"))
            begin = 0
            for at, name in enumerate(zip(trees, numbers)):
                if name != current:
                    if block is not None:
                        if at > begin:
                            block.rows.append(batch.slice(begin, at - begin))
                        yield block.closed()
                    current, block, begin = name, _Block(sizes[at], levels), at
                block.stream.append(digests[at])
            if batch.num_rows > begin:
                block.rows.append(batch.slice(begin))
        if block is not None:
            yield block.closed()

    dealt = nodes.withColumn("block", F.expr(f"at div {width}"))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in dealt.schema)}, steps array<{STEP}>, top string"
    found = written_once(
        _dealt(dealt, "tree", "block").sortWithinPartitions("tree", "at").mapInArrow(appended, schema), "merkle-blocks")
    tops = written_once(found.filter(F.col("top").isNotNull()).select(
        "tree", F.col("block").alias("at"), F.ceil(F.col("size") / width).cast("long").alias("size"),
        F.col("top").alias("digest")), "merkle-tops")
    return found.drop("top"), tops


def _above(tops: DataFrame, levels: int) -> DataFrame:
    """Witness of every node (tree, at) up to the root of its tree, as (tree, block, above, root)."""
    if tops.filter("size > 1").isEmpty():
        return tops.select("tree", F.col("at").alias("block"), F.array().cast(f"array<{STEP}>").alias("above"),
                           F.col("digest").alias("root"))
    nodes, higher = _append_blocks(tops, levels)
    return written_once(_extended(nodes, _above(higher, levels)).select(
        "tree", F.col("at").alias("block"), F.col("steps").alias("above"), "root"), "merkle-above")


def _extended(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Extend the witnesses of the nodes by those of their blocks; `above` has a row for ARITY ** levels of them.

    It is broadcast within the measured limit; beyond, a block's few rows all meet in one partition.
    """
    steps, rows = above.agg(F.coalesce(F.sum(F.size("above")), F.lit(0)), F.count(F.lit(1))).first()
    small = steps * STEP_BYTES + rows * ROW_BYTES <= BROADCAST_LIMIT_BYTES
    joined = nodes.join(F.broadcast(above) if small else above.hint("merge"), ["tree", "block"])
    others = [c for c in joined.columns if c not in ("block", "steps", "above")]
    return joined.select(*[F.col(f"`{c}`") for c in others], F.concat("steps", "above").alias("steps"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add `at` and `size`, the place of each row in its `tree` by `order` and the number of rows of the tree.

    Rows are sorted by ranges, so a tree with any share of them spans many tasks; places follow from the row counts
    of the ranges. Rows equal in all of `order` may come either way round, so they must be alike.
    """
    parts = max(_partitions(rows), -(-rows.count() // ROWS_PER_PART))
    placed = rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    placed = written_once(placed.withColumn("_slot", F.monotonically_increasing_id()), "merkle-order")
    # the slot is the partition number shifted by 33 bits plus the row number in the partition
    part = F.shiftright("_slot", 33)
    counts = placed.groupBy("tree", part.alias("_part")).agg(
        F.min("_slot").alias("_low"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written_once(counts.select(
        "tree", "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_low")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("tree")).alias("size")), "merkle-parts")
    return lookup_join(placed.withColumn("_part", part), starts, ["tree", "_part"]).select(
        *[F.col(f"`{c}`") for c in rows.columns], (F.col("_slot") + F.col("_shift")).alias("at"), "size")


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as `-` if null, else its UTF-8 byte count, `:` and the value as text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def tree_name(source: Column) -> Column:
    """A name for each source that is never null and sorts null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def merkle_manifest(documents: DataFrame, leaf: Column, levels: int = BLOCK_LEVELS, **carried: Column) -> DataFrame:
    """The manifest (doc_id, source, carried columns, leaf, subroot, root, witness) of a table of documents.

    `leaf` is the digest of a row, such as `leaf_digest` of its columns. Per source, leaves are ordered by doc_id;
    null ids come first, rows of equal id go by their digest, so equal rows are interchangeable. Every ARITY
    consecutive nodes of a level, the last run maybe fewer and even a single one, are hashed into a node of the next,
    until one remains: the subroot, for a lone leaf the leaf itself. Subroots by source, null first and then
    bytewise, are the leaves of the tree above it. `witness` lists the siblings of each level from the leaf to the
    root, as (left, right). No documents make no rows, and no root. Other columns are ignored, whatever their names.

    The text is read once; what follows carries digests. A source with any share of the documents is cut by place.
    """
    doc_id = documents["doc_id"].cast("long")
    rows = documents.select(
        doc_id.alias("doc_id"), tree_name(documents["source"]).alias("tree"), leaf.alias("digest"),
        *[c.alias(name) for name, c in carried.items()])
    leaves, tops = _append_blocks(numbered(written_once(rows, "merkle-leaves"), ["doc_id", "digest", *carried]), levels)
    above = _above(tops, levels)
    subroots = above.filter("block = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    sources, tops = _append_blocks(numbered(written_once(subroots, "merkle-subroots"), ["name"]), levels)
    of_source = _extended(sources, _above(tops, levels)).select(
        F.col("name").alias("tree"), F.col("steps").alias("_steps"), F.col("root").alias("_root"))
    above = written_once(above.join(of_source, "tree").select(
        "tree", "block", F.concat("above", "_steps").alias("above"), F.col("root").alias("subroot"),
        F.col("_root").alias("root")), "merkle-above")
    source = F.when(F.col("tree") != "", F.expr("substring(tree, 2)"))
    return _extended(leaves, above).select(
        "doc_id", source.alias("source"), *[F.col(f"`{c}`") for c in carried], F.col("digest").alias("leaf"),
        "subroot", "root", F.col("steps").alias("witness"))


def proof_digest(witness: Column) -> Column:
    """Digest of all siblings of a witness, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded_root(leaf: Column, witness: Column) -> Column:
    """The root that a leaf has under a witness; the manifest's own if neither was changed."""
    return F.aggregate(witness, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))

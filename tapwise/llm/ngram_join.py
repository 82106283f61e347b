"""Similarity join of documents by the Jaccard similarity of their word n-grams.

The join is the product of the sparse document by n-gram incidence matrix with its transpose, done in blocks that
a size bound proves sufficient. A pair of sets of sizes a and b at similarity t shares at least t / (1 + t) * (a + b)
n-grams, so in any fixed order of all n-grams the first (1 - t) * a + 1 of one set meet those of the other. Only
these leading columns are multiplied; pairs whose sizes or positions cannot reach the bound are discarded, and the
overlap of the rest is counted on the whole sets.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tapwise.llm.components import connected_components
from tapwise.llm.keys import KEY, key_columns, with_key
from tapwise.llm.shingles import mix, shingle_set
from tapwise.operators.lookup import lookup_join
from tapwise.sources.folders import run_folder, written_once

COMMON_NGRAMS = 1 << 16  # n-grams that are put last in the order; it only saves work
LOCAL_NGRAMS, LOCAL_COUNT = 2_000_000, 8  # n-grams counted at once, and the count that is reported
PIVOT_ROUNDS = 3


def _node(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def _sets(documents: DataFrame, words: int) -> DataFrame:
    """Members (doc_id, key, node, n_shingles) with, in some rows, the n-grams frequent among those counted together."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room, seen = [], 0, set()

        def common(force: bool) -> tuple[list, list]:
            nonlocal held, room, seen
            if not held or (room < LOCAL_NGRAMS and not force):
                return [], []
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            held, room, seen = [], 0, set()
            many = counts >= LOCAL_COUNT
            return grams[many].view(np.int64).tolist(), counts[many].tolist()

        def batch_of(ids, nodes, sizes, found) -> pa.RecordBatch:
            empty = [[]] * max(len(nodes) - 1, 0)
            return pa.RecordBatch.from_arrays([
                *ids, pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()),
                pa.array([found[0], *empty], pa.list_(pa.int64())),
                pa.array([found[1], *empty], pa.list_(pa.int64()))],
                ["doc_id", *KEY, "node", "n_shingles", "common", "counts"])

        for batch in batches:
            nodes, sizes, at = [], [], 0
            for text in batch.column("text"):
                grams, _ = shingle_set(text.as_py(), words)
                nodes.append(_node(grams) if len(grams) else None)
                sizes.append(len(grams))
                if len(grams) and nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    held.append(grams)
                    room += len(grams)
                if room >= LOCAL_NGRAMS:
                    ids = [batch.column(n).slice(at, len(nodes)) for n in ("doc_id", *KEY)]
                    yield batch_of(ids, nodes, sizes, common(False))
                    at, nodes, sizes = at + len(nodes), [], []
            if nodes:
                yield batch_of([batch.column(n).slice(at) for n in ("doc_id", *KEY)], nodes, sizes, ([], []))
        found = common(True)
        if found[0]:  # a row without document
            yield batch_of([pa.array([None], pa.int64())] * 3, [None], [-1], found)

    schema = "doc_id long, _key long, _text_key long, node binary, n_shingles long, common array<long>, counts array<long>"
    return documents.mapInArrow(rows, schema)


def _most_common(sets: DataFrame) -> list[int]:
    """The most frequent n-grams by the reported counts, the rarest first; at most COMMON_NGRAMS."""
    reported = sets.filter(F.size("common") > 0).select(F.explode(F.arrays_zip("common", "counts")).alias("r"))
    totals = reported.groupBy(F.col("r.common").alias("gram")).agg(F.sum("r.counts").alias("rows"))
    return [r["gram"] for r in totals.orderBy(F.desc("rows"), "gram").limit(COMMON_NGRAMS).collect()][::-1]


def _leading(documents: DataFrame, words: int, percent: int, common: list[int]) -> DataFrame:
    """Rows (node, n, grams): the first n-grams of each set in the global order.

    The order only has to be the same everywhere; rare n-grams first makes few pairs meet. The most frequent ones
    come last, the others go by falling length, since long word sequences are the rare ones.
    """
    last = np.array(common, np.int64).view(np.uint64)
    by_value = np.argsort(last)
    shared = documents.sparkSession.sparkContext.broadcast((last[by_value], by_value))  # at most COMMON_NGRAMS

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, ranks = shared.value
        for batch in batches:
            nodes, sizes, leading = [], [], []
            for text in batch.column("text"):
                grams, lengths = shingle_set(text.as_py(), words)
                if not len(grams):
                    continue
                place = np.zeros(len(grams), np.int64)
                if len(values):
                    at = np.minimum(np.searchsorted(values, grams), len(values) - 1)
                    place = np.where(values[at] == grams, ranks[at] + 1, 0)
                order = np.lexsort((mix(grams), -lengths, place))
                keep = len(grams) - -(-percent * len(grams) // 100) + 1
                nodes.append(_node(grams))
                sizes.append(len(grams))
                leading.append(grams[order[:keep]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(leading, pa.list_(pa.int64()))], ["node", "n", "grams"])

    return documents.select("text").mapInArrow(rows, "node binary, n long, grams array<long>")


def _needed(percent: int) -> Column:
    """N-grams that sets of a_n and b_n must share."""
    return F.ceil((F.col("a_n") + F.col("b_n")) * percent / (100 + percent) - 1e-9)


def _reachable(percent: int) -> Column:
    """Whether a shared n-gram at positions a_at and b_at, the first one shared, leaves enough for the bound."""
    a, b, needed = F.col("a_n"), F.col("b_n"), _needed(percent)
    sizes = (a * 100 >= b * percent) & (b * 100 >= a * percent)
    return sizes & (a - F.col("a_at") >= needed) & (b - F.col("b_at") >= needed)


def _overlapping(pairs: DataFrame, leading: DataFrame, percent: int) -> DataFrame:
    """The pairs whose leading n-grams overlap enough for the bound.

    Of the set whose leading part ends first in the order, all shared n-grams in that part are leading in the other
    set too. So the overlap is at most that of the leading parts and what comes after one of them.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    found = written_once(lookup_join(leading, nodes, "node"), "pair-leading")
    both = (
        pairs.join(found.select(*[F.col(c).alias(f"a_{c}") for c in ("node", "n", "grams")]), F.col("a") == F.col("a_node"))
        .join(found.select(*[F.col(c).alias(f"b_{c}") for c in ("node", "n", "grams")]), F.col("b") == F.col("b_node"))
    )
    rest = F.greatest(F.col("a_n") - F.size("a_grams"), F.col("b_n") - F.size("b_grams"))
    shared = F.size(F.array_intersect("a_grams", "b_grams"))
    return both.filter(shared + rest >= _needed(percent)).select("a", "b")


def _verified(pairs: DataFrame, columns: DataFrame, first: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets reach the similarity.

    Only the texts of documents in pairs are fetched, one for each node, and only their sets are moved.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), words)[0] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(g) for g in found], pa.binary()),
                 pa.array([g.tobytes() for g in found], pa.binary())], ["node", "grams"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column("a_set"), batch.column("b_set")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(n).filter(keep) for n in ("a", "b")], ["a", "b"])

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    keys = written_once(nodes.join(first, "node").select(*KEY), "pair-keys")
    texts = lookup_join(columns, keys, KEY).select("text")
    sets = written_once(texts.mapInArrow(whole, "node binary, grams binary").dropDuplicates(["node"]), "sets")
    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("a_set")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("b_set")), "b")
        .select("a", "b", "a_set", "b_set").mapInArrow(compared, "a binary, b binary")
    )


def _grouped(documents: DataFrame, words: int, percent: int, pivot_rounds: int) -> DataFrame:
    """Rows (doc_id, key, n_shingles, label, component_id) of all documents; see `link_components`.

    Equal sets are one node, so exact copies are never paired. In each pivot round the n-grams that still join
    different components compare one document, the one with most shared n-grams and later a hashed choice, with
    all others: a large group of near copies collapses in as many pairs as it has rows. The pairs that are then
    left between components are all compared, so no link that matters to a component is lost.
    """
    spark = documents.sparkSession
    columns = with_key(documents)
    sets = written_once(_sets(columns, words), "members")
    members = sets.filter("n_shingles >= 0").select("doc_id", *KEY, "node", "n_shingles")

    leading = _leading(columns, words, percent, _most_common(sets)).dropDuplicates(["node"])
    leading = written_once(leading, "leading")
    entries = leading.select("node", "n", F.posexplode("grams").alias("at", "gram"))
    shared = written_once(
        entries.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"), "shared-ngrams")
    postings = written_once(lookup_join(entries, shared, "gram"), "postings")
    weights = postings.groupBy("node").agg(F.count(F.lit(1)).alias("weight"))
    first = written_once(
        members.groupBy("node").agg(F.min(F.struct("doc_id", *KEY)).alias("f")).select("node", "f.*"), "first")

    labels = written_once(weights.select("node", F.col("node").alias("label"), "weight"), "labels")
    tested, folder = None, run_folder(spark, "pairs")
    for turn in range(pivot_rounds + 1):
        # the first pivot of an n-gram in two documents has met all there is to meet
        placed = postings.filter(F.col("rows") > (2 if turn else 1)).join(labels, "node")
        if turn < pivot_rounds:
            rank = F.struct("weight", "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)), "node")
            pivots = (
                placed.groupBy("gram")
                .agg(F.max_by(F.struct("node", "n", "at", "label"), rank).alias("p"),
                     F.min("label").alias("_low"), F.max("label").alias("_high"))
                .filter("_low < _high")
                .select("gram", F.col("p.node").alias("b"), F.col("p.n").alias("b_n"), F.col("p.at").alias("b_at"),
                        F.col("p.label").alias("b_label"))
            )
        else:
            pivots = placed.select("gram", F.col("node").alias("b"), F.col("n").alias("b_n"),
                                   F.col("at").alias("b_at"), F.col("label").alias("b_label"))
        left = placed.select("gram", F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("at").alias("a_at"),
                             F.col("label").alias("a_label"))
        met = left.join(pivots, "gram").filter((F.col("a_label") != F.col("b_label")) & _reachable(percent))
        if turn == pivot_rounds:
            met = met.filter("a < b")
        pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs.write.parquet(f"{folder}/turn={turn}")
        pairs = spark.read.schema(pairs.schema).parquet(f"{folder}/turn={turn}")
        tested = spark.read.schema("a binary, b binary").parquet(*[f"{folder}/turn={t}" for t in range(turn + 1)])

        close = written_once(_overlapping(pairs, leading, percent), "close-pairs")
        links = written_once(_verified(close, columns, first, words, percent), "links")
        between = (
            links.join(labels.select(F.col("node").alias("a"), F.col("label").alias("_a")), "a")
            .join(labels.select(F.col("node").alias("b"), F.col("label").alias("_b")), "b")
            .filter("_a != _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct()
        )
        merged = connected_components(between).select(F.col("node").alias("label"), F.col("label").alias("_merged"))
        labels = written_once(
            labels.join(merged, "label", "left")
            .select("node", F.coalesce("_merged", "label").alias("label"), "weight"), "labels")

    grouped = first.select("node", "doc_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_node = grouped.select("node", "label").join(smallest, "label")
    linked = members.filter(F.col("node").isNotNull()).join(by_node, "node")
    alone = members.filter(F.col("node").isNull()).withColumns({
        "label": F.lit(None).cast("binary"), "component_id": F.col("doc_id")})
    columns = ["doc_id", *KEY, "n_shingles", "label", "component_id"]
    return linked.select(*columns).union(alone.select(*columns))


def link_components(documents: DataFrame, words: int = 5, percent: int = 80,
                    pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """Component of every (doc_id, text) row under 100 * intersection >= percent * union of its n-gram sets.

    Returns doc_id, n_shingles and component_id, the smallest doc_id reachable by links. Words are runs of
    characters other than ASCII white space, A-Z lower-cased. A text with fewer words is one n-gram; null, empty
    and blank texts have none and link with nothing. Rows of equal doc_id are documents of their own; null ids
    stay null and take the smallest other id of their component, if any.
    """
    return _grouped(documents, words, percent, pivot_rounds).select("doc_id", "n_shingles", "component_id")


def keep_one_of_each(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component with all its columns: the one with the smallest doc_id (null ids last).

    Ties go by key, that is by text. Of rows equal in doc_id and text one stays. Documents without words are
    alone, so all different ones stay.
    """
    rows = _grouped(documents, words, percent, PIVOT_ROUNDS)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEY)
    chosen = rows.filter(F.col("label").isNotNull()).groupBy("label").agg(F.min(place).alias("p")).select("p.*")
    alone = rows.filter(F.col("label").isNull())
    keys = written_once(chosen.select(*KEY).union(alone.select(*KEY)).distinct(), "kept-keys")
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    return documents.select(row, *key_columns()).join(keys, KEY, "left_semi").dropDuplicates(KEY).select("_row.*")

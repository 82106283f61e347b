"""Packing along a space-filling curve: similar documents become neighbours in training sequences."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tapwise.llm.layout import part_starts
from tapwise.llm.token_files import with_end
from tapwise.llm.tokens import encoder
from tapwise.sources.folders import run_folder

BUCKETS = 512  # size of the hashed document vector
DIMENSIONS = 3
BITS = 10  # of each dimension; the curve has 2 ** (DIMENSIONS * BITS) cells

PIECE_SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
                "ids binary")


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (rows x dimensions), each coordinate below 2 ** bits.

    Works from the highest bit down: each step emits one bit per dimension of the Gray-coded cell and turns the
    remaining coordinates into the frame of that cell.
    """
    point = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, -1, -1):
        mask = 1 << level
        below = mask - 1
        for axis in range(len(point)):
            inside = (point[axis] & mask) != 0
            turned = (point[0] ^ point[axis]) & below
            point[0] = np.where(inside, point[0] ^ below, point[0] ^ turned)
            point[axis] = np.where(inside, point[axis], point[axis] ^ turned) if axis else point[0]
    for axis in range(1, len(point)):
        point[axis] ^= point[axis - 1]
    flip = np.zeros_like(point[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where(point[-1] & (1 << level), flip ^ ((1 << level) - 1), flip)
    point ^= flip
    key = np.zeros_like(point[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(len(point)):
            key = (key << 1) | ((point[axis] >> level) & 1)
    return key


def curve_projection(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))


def document_cell(ids: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Cell of a document: hashed id counts, damped and normalised, projected and squeezed into the grid."""
    hashed = (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(23)  # 9 bits: BUCKETS values
    counts = np.sqrt(np.bincount(hashed, minlength=BUCKETS))
    norm = np.sqrt(counts @ counts)
    place = (counts @ projection) / norm if norm else np.zeros(DIMENSIONS)
    return np.minimum(((np.tanh(place) + 1) * (1 << BITS - 1)).astype(np.int64), (1 << BITS) - 1)


def pack_along_curve(documents: DataFrame, tokenizer: str, sequence_tokens: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents in sequences of `sequence_tokens`, ordered along a Hilbert curve of their content.

    One row per piece: doc_id, `start` in the document, `length`, `doc_tokens`, `sequence_id`, `offset` in the
    sequence and `ids` (little-endian unsigned 32-bit). Other input columns are not read. The documents in curve order form one stream of ids which is cut every `sequence_tokens`, so all sequences but
    the last are full. A null or empty text is its end id alone. Equal keys are ordered by doc_id, then by row.

    Texts are encoded once, into a table in the shared folder. Only (key, doc_id, length) is range-sorted; a
    group of equal keys, however large, is cut by doc_id. Running totals go by sorted part. One join by row
    brings the ids to their places.
    """
    spark, folder = documents.sparkSession, run_folder(documents.sparkSession, "packing")
    projection = curve_projection()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = encoder(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            packed = [with_end(ids, known.type, end_id) for ids in known.encode_all(batch.column("text"))]
            arrays = [np.frombuffer(p, known.type) for p in packed]
            cells = np.array([document_cell(a, projection) for a in arrays]).reshape(-1, DIMENSIONS)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(row, row + len(packed)), pa.int64()), batch.column("doc_id"),
                pa.array(hilbert_key(cells, BITS), pa.int64()),
                pa.array([len(a) for a in arrays], pa.int64()), pa.array(packed, pa.binary()),
            ], ["row", "doc_id", "key", "doc_tokens", "packed"])
            row += len(packed)

    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "row long, doc_id long, key long, doc_tokens long, packed binary"
    columns.mapInArrow(encoded, schema).write.option("compression", "zstd").parquet(f"{folder}/ids")
    ids = spark.read.schema(schema).parquet(f"{folder}/ids")

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            ends = total + np.cumsum(batch.column("doc_tokens").to_numpy())
            sizes = batch.column("doc_tokens")
            begins = ends - sizes.to_numpy()
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.full(len(ends), part), pa.int32()),
                 pa.array(begins, pa.int64()), sizes], ["row", "part", "begin", "size"])

    sorted_schema = "row long, part int, begin long, size long"
    along = ids.select("row", "doc_tokens", "key", "doc_id").orderBy("key", "doc_id", "row").select("row", "doc_tokens")
    along.mapInArrow(running, sorted_schema).write.parquet(f"{folder}/order")
    order = spark.read.schema(sorted_schema).parquet(f"{folder}/order")
    places = (
        order.join(F.broadcast(part_starts(order, "part", "size")), "part")
        .select("row", (F.col("begin") + F.col("start")).alias("position"))
    )
    width = np.dtype(encoder(tokenizer).type).itemsize

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id",
                                                    "offset", "ids")}
            for doc_id, position, packed in zip(batch.column("doc_id").to_pylist(),
                                                batch.column("position").to_pylist(), batch.column("packed")):
                values = np.frombuffer(packed.as_buffer(), f"<u{width}").astype("<u4")
                first = sequence_tokens - position % sequence_tokens
                cuts = [0, *range(first, len(values), sequence_tokens), len(values)]
                for begin, end in zip(cuts, cuts[1:]):
                    sequence, offset = divmod(position + begin, sequence_tokens)
                    for name, value in zip(out, (doc_id, begin, end - begin, len(values), sequence, offset,
                                                 values[begin:end].tobytes())):
                        out[name].append(value)
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

    return ids.join(places, "row").select("doc_id", "position", "packed").mapInArrow(pieces, PIECE_SCHEMA)

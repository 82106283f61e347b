"""Token files: each document compressed by itself with one zstandard dictionary that all share.

The file format is a Parquet table with one row per shard:

* `part`, `shard`: order of the shard; `part` numbers the ranges of doc_id, `shard` the shards in a range;
* `dictionary`: xxhash64 of the dictionary, 0 where there is none; the bytes are in the table `dictionary`;
* `width`: bytes of an id;
* `doc_ids`, `starts`, `lengths`: id, first position within the part and number of ids of each document;
* `offsets`: first byte of each document's frame in `payload`, and the end of the last;
* `payload`: the frames one after another.

A reader cuts one frame out of the payload and decompresses it alone.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapwise.llm.layout import part_starts
from tapwise.llm.tokens import encoder

DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCUMENTS = 1_000  # bound of the documents that the dictionary is trained on
SAMPLE_CHARS = 16_384  # bound of the text that it is trained on of each of them
SHARD_BYTES = 4 << 20  # a shard ends after the document that reaches this size

SHARD_SCHEMA = ("part int, shard int, dictionary long, width int, doc_ids array<long>, starts array<long>, "
                "lengths array<long>, offsets array<long>, payload binary")
DOCUMENT_SCHEMA = "doc_id long, start long, n_tokens long, ids binary"


def with_end(ids: bytes, kind: str, end_id: int) -> bytes:
    return ids + np.array([end_id], kind).tobytes()


def train_dictionary(documents: DataFrame, tokenizer: str, end_id: int, size: int = DICTIONARY_BYTES,
                     sample: int = SAMPLE_DOCUMENTS) -> bytes:
    """A zstandard dictionary from the id arrays of `sample` documents chosen by a hash; empty for too few ids.

    A hash threshold thins the documents out before the limit is applied, so tasks send no more than they must.
    """
    count = documents.count()
    limit = min(1.0, 3.0 * sample / max(1, count))
    draw = documents.filter(F.length("text") > 0).select(
        F.substring("text", 1, SAMPLE_CHARS).alias("text"), F.xxhash64("doc_id", "text").alias("_draw"))
    drawn = draw.filter(F.pmod("_draw", F.lit(1 << 20)) < int(limit * (1 << 20)) + 1)
    rows = drawn.orderBy("_draw").limit(sample)
    known = encoder(tokenizer)
    arrays = [with_end(known.encode(r["text"]), known.type, end_id) for r in rows.collect()]
    total = sum(map(len, arrays))
    if total < 2 * size:
        return b""
    try:
        return zstandard.train_dictionary(size, arrays, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # arrays without anything in common, or too few
        return b""


def _codec(raw: bytes) -> tuple[int, zstandard.ZstdCompressionDict | None]:
    return (xxhash.xxh64_intdigest(raw) >> 1, zstandard.ZstdCompressionDict(raw)) if raw else (0, None)


def write_token_files(documents: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode every whole text, append `end_id`, and write shards in ascending doc_id order below `folder`.

    Null texts are empty and hold the end id alone; null ids come first; documents of equal id are ordered by
    text. The shuffle sorts by ranges of doc_id; each task writes shards of a bounded size as it goes.
    """
    spark = documents.sparkSession
    columns = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    raw = train_dictionary(columns, tokenizer, end_id)
    digest = _codec(raw)[0]
    spark.createDataFrame([(digest, bytearray(raw))], "dictionary long, content binary").coalesce(1).write.parquet(
        f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(raw)  # at most DICTIONARY_BYTES

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, position = TaskContext.get().partitionId(), 0, 0
        known, (dictionary, trained) = encoder(tokenizer), _codec(shared.value)
        compressor = zstandard.ZstdCompressor(dict_data=trained) if trained else zstandard.ZstdCompressor()
        width = np.dtype(known.type).itemsize
        ids, starts, lengths, offsets, frames, size = [], [], [], [0], [], 0

        def row() -> pa.RecordBatch:
            values = [part, number, dictionary, width, ids, starts, lengths, offsets, b"".join(frames)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.list_(pa.int64())] * 4, pa.binary()]
            names = ["part", "shard", "dictionary", "width", "doc_ids", "starts", "lengths", "offsets", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for doc_id, encoded in zip(batch.column(0).to_pylist(), known.encode_all(batch.column(1))):
                packed = with_end(encoded, known.type, end_id)
                frames.append(compressor.compress(packed))
                size += len(frames[-1])
                ids.append(doc_id)
                starts.append(position)
                lengths.append(len(packed) // width)
                offsets.append(size)
                position += lengths[-1]
                if size >= SHARD_BYTES:
                    yield row()
                    number, size = number + 1, 0
                    ids, starts, lengths, offsets, frames = [], [], [], [0], []
        if ids:
            yield row()

    ordered = columns.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(shards, SHARD_SCHEMA).write.option("compression", "none").parquet(f"{folder}/shards")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of token files as (doc_id, start, n_tokens, ids).

    `start` counts the ids of all documents before; `ids` are little-endian unsigned 32-bit integers. A shard
    whose dictionary hash is not that of the dictionary beside it ends the job.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards")
    raw = bytes(spark.read.parquet(f"{folder}/dictionary").first()["content"])
    shared = spark.sparkContext.broadcast(raw)
    sizes = shards.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("size"))
    starts = part_starts(sizes, "part", "size")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, trained = _codec(shared.value)
        reader = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
        for batch in batches:
            for shard in range(batch.num_rows):
                column = {n: batch.column(n)[shard] for n in batch.schema.names}
                if column["dictionary"].as_py() != digest:
                    raise ValueError("a shard names another dictionary than the one stored beside it")
                first, kind = column["start"].as_py(), f"<u{column['width'].as_py()}"
                offsets, payload = column["offsets"].as_py(), memoryview(column["payload"].as_buffer())
                frames = (reader.decompress(payload[a:b]) for a, b in zip(offsets, offsets[1:]))
                ids = [np.frombuffer(f, kind).astype("<u4").tobytes() for f in frames]
                starts = [first + s for s in column["starts"].as_py()]
                yield pa.RecordBatch.from_arrays(
                    [column["doc_ids"].values, pa.array(starts, pa.int64()), column["lengths"].values,
                     pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    placed = shards.join(F.broadcast(starts), "part").select(
        "dictionary", "width", "doc_ids", "starts", "lengths", "offsets", "payload", "start")
    return placed.mapInArrow(documents, DOCUMENT_SCHEMA)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with this id: only their frames leave the shards."""
    raw = bytes(spark.read.parquet(f"{folder}/dictionary").first()["content"])
    digest, trained = _codec(raw)
    reader = zstandard.ZstdDecompressor(dict_data=trained) if trained else zstandard.ZstdDecompressor()
    at = F.explode(F.sequence(F.lit(0), F.size("doc_ids") - 1)).alias("at")
    begin, end = F.get("offsets", F.col("at")), F.get("offsets", F.col("at") + 1)
    frames = (
        spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards")
        .filter(F.array_contains("doc_ids", F.lit(doc_id)))
        .select("*", at).filter(F.get("doc_ids", F.col("at")) == doc_id)
        .select("part", "shard", "at", "width", "dictionary",
                F.substring("payload", (begin + 1).cast("int"), (end - begin).cast("int")).alias("frame"))
    )
    found = []
    for row in sorted(frames.collect(), key=lambda r: (r["part"], r["shard"], r["at"])):
        if row["dictionary"] != digest:
            raise ValueError("a shard names another dictionary than the one stored beside it")
        found.append(np.frombuffer(reader.decompress(bytes(row["frame"])), f"<u{row['width']}").tolist())
    return found

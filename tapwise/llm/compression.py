"""Quality rules by compression: zstandard ratios of whole documents and of fixed chunks, with bands by length.

A ratio is the number of bytes over the number of compressed bytes. Prose has a narrow range of it that grows slowly
with the length, since a longer text gives the compressor more to refer to. Repeated lines, lists and templates lie
above it; encoded, encrypted or random text lies below. A document of ordinary ratio can still hide a stretch of
either, so each chunk is held against the band of its own length too.
"""

import bisect
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

LEVEL = 3
CHUNK_BYTES = 4096  # a last chunk of less than half of it belongs to the one before
BAD_CHUNKS = 0.25  # a document with at least this share of its bytes in chunks outside their band is rejected
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words that may lie in repeated three-word windows

SYMBOLS = b"#*$%&|<>"  # fixed value
SPACES = b" \t\n\r\x0b\x0c"  # fixed value


class Band(NamedTuple):
    """Ratios that are kept from a length in bytes on."""

    from_bytes: int
    lowest: float
    highest: float


# Ratios of prose at this level run from 1.3 to 2.0 below a kilobyte, from 1.6 to 2.8 at four and from 2.2 to 3.5
# beyond 64; base64 stays at 1.32 and random letters at 1.6 at any length. The limits leave a wide margin around prose.
BANDS = (Band(0, 0.0, 2.6), Band(256, 1.15, 2.8), Band(1024, 1.35, 3.2), Band(4096, 1.45, 3.8),
         Band(16384, 1.5, 4.5), Band(65536, 1.55, 5.5), Band(1048576, 1.55, 7.0))

MADE = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("ratio", pa.float64()), ("bad_share", pa.float64()),
        ("verdict", pa.string()), ("kept", pa.bool_())]
_SPARK_TYPES = {pa.int64(): LongType(), pa.bool_(): BooleanType(), pa.float64(): DoubleType(), pa.string(): StringType()}


def band_of(size: int, bands=BANDS) -> Band:
    return bands[bisect.bisect_right([b.from_bytes for b in bands], size) - 1]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which the text holds twice or more, the first one included."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[place] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:len(ids) - 2 + shift] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines))


def chunks(text: bytes, size: int = CHUNK_BYTES) -> list[bytes]:
    """The text in chunks of `size` bytes; an end of less than half of it stays with the last one."""
    ends = list(range(size, len(text) - size // 2 + 1, size)) if len(text) > size else []
    return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)])]


class RatioRules:
    """The compression verdict on one text after another, with one compressor."""

    def __init__(self, bands=BANDS, chunk_bytes: int = CHUNK_BYTES, bad_chunks: float = BAD_CHUNKS):
        self.bands, self.chunk_bytes, self.bad_chunks = bands, chunk_bytes, bad_chunks
        self._compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)

    def ratio(self, part: bytes) -> float:
        return len(part) / len(self._compressor.compress(part)) if part else 0.0

    def judge(self, text: bytes) -> tuple[float, float, str]:
        """Ratio of the text, share of its bytes in chunks outside their band, and the verdict."""
        if not text:
            return 0.0, 0.0, "empty"
        ratio, band, bad = self.ratio(text), band_of(len(text), self.bands), 0
        for part in chunks(text, self.chunk_bytes):
            limits = band_of(len(part), self.bands)
            if not limits.lowest <= (ratio if len(part) == len(text) else self.ratio(part)) <= limits.highest:
                bad += len(part)
        share = bad / len(text)
        if ratio > band.highest:
            return ratio, share, "repetitive"
        if ratio < band.lowest:
            return ratio, share, "incompressible"
        return ratio, share, "uneven" if share >= self.bad_chunks else "ordinary"


def _row(text: bytes, rules: RatioRules) -> tuple:
    words = text.split()  # bytes split at ASCII white space only
    chars = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)) if text else 0
    spaces = sum(text.count(s) for s in SPACES)
    repeated = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeated > MOST_REPEATED * len(words)
    ratio, share, verdict = rules.judge(text)
    return (len(words), chars - spaces, sum(text.count(s) for s in SYMBOLS), duplicate_lines(text), repeated, failed,
            ratio, share, verdict, not failed and verdict == "ordinary")


def compression_rules(documents: DataFrame, bands=BANDS, chunk_bytes: int = CHUNK_BYTES,
                      bad_chunks: float = BAD_CHUNKS) -> DataFrame:
    """The documents, all columns kept, with word counts, ratios and verdicts worked out from `text`.

    Added are `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`, `base_failed` (fewer than
    MIN_WORDS words, or more than MOST_REPEATED per cent of them in repeated windows), `ratio`, `bad_share` (bytes in
    chunks outside their band), `verdict` (ordinary, repetitive, incompressible, uneven or empty) and `kept`: ordinary
    and not failed. Columns of these names are replaced. A null text counts as empty; an empty text fails and is not
    kept. Each row is judged by itself and its whole text, so equal texts are judged alike wherever they are; a task
    holds one Arrow batch.
    """
    made = [name for name, _ in MADE]
    others = [c for c in documents.columns if c != "text" and c not in made]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = RatioRules(bands, chunk_bytes, bad_chunks)
        for batch in batches:
            rows = [_row(t.as_py() or b"", rules) for t in batch.column("text").cast(pa.binary())]
            columns = zip(*rows) if rows else [[] for _ in MADE]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, kind) for c, (_, kind) in zip(columns, MADE)]],
                [*batch.schema.names, *made])

    # the other columns travel in one struct, so their names may be anything
    rows = documents.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("_row"), "text")
    schema = StructType([*rows.schema.fields, *[StructField(name, _SPARK_TYPES[kind]) for name, kind in MADE]])
    found = rows.mapInArrow(judged, schema)
    return found.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in documents.columns if c not in made],
                        *made)

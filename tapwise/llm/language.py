"""Language identification by cross-parsing: the language whose labelled text needs the fewest phrases wins.

Each language has a suffix automaton of a bounded sample of its labelled text. A text is parsed greedily into
the longest phrases that occur in the sample; the number of phrases, times the bits that name a place in the
sample and a length, estimates the cross-entropy. Symbols are code points, so scripts never mix, and the automata
hold their transitions only. A language explains a text if the text needs few more phrases a symbol than text of that
language which was left out of the sample.
"""

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

SAMPLE_CHARS = 40_000  # bound of the labelled text learned of each language
SAMPLE_DOCUMENTS = 200  # bound of the labelled documents drawn for it
PIECE = 2_000  # characters drawn of a labelled document, from a place given by its hash
SEGMENT = 256  # symbols parsed in one lane; a phrase ends with its segment
ROWS = 1024  # texts whose symbols are held at a time
LANES = 8192  # segments that are parsed side by side
GAP = 0
POINT_BITS = 21  # bits of a code point
LENGTH_BITS = 8  # bits that a phrase costs besides those of its place
MARGIN = 1.5  # phrases a symbol that a text may need, as a multiple of what text left out of the sample needs
SLACK = 10  # phrases that a text may need beyond that, so short texts are not judged by a few words
SOFTNESS = 0.05  # share of the bits between two languages that counts as evidence in the score


class Automaton:
    """All substrings of a sample: transitions (state, symbol) to state; state 1 is the start, 0 is none.

    `keys` (state and symbol in one number) and `targets` are all that is shipped, fewer than three for each symbol
    of the sample; the hash table of a worker is made from them on first use.
    """

    def __init__(self, keys: np.ndarray, targets: np.ndarray):
        self.keys, self.targets = keys, targets
        self._slots = self._found = None

    def __getstate__(self):
        return {"keys": self.keys, "targets": self.targets, "_slots": None, "_found": None}

    def _at(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # 2**64 over the golden ratio
        return (spread >> np.uint64(64 - self._bits)).astype(np.int64)

    def _open(self) -> None:
        """Linear probing in a table that is a quarter full at most."""
        self._bits = max(4, (4 * len(self.keys)).bit_length())
        self._slots = np.full(1 << self._bits, -1, np.int64)
        self._found = np.zeros(1 << self._bits, np.int32)
        left, at = np.arange(len(self.keys)), self._at(self.keys)
        while len(left):
            free = self._slots[at] < 0
            self._slots[at[free]] = self.keys[left[free]]  # of several keys for a slot the last one stays
            placed = self._slots[at] == self.keys[left]
            self._found[at[placed]] = self.targets[left[placed]]
            left, at = left[~placed], (at[~placed] + 1) & (len(self._slots) - 1)

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states after one more symbol each, 0 where no substring goes on."""
        if self._slots is None:
            self._open()
        keys = (states << POINT_BITS) | symbols
        at = self._at(keys)
        seen = self._slots.take(at)
        hit = seen == keys
        after = np.where(hit, self._found.take(at), 0).astype(np.int64)
        left = np.flatnonzero(~hit & (seen >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self._slots) - 1)
            seen = self._slots.take(at)
            hit = seen == keys[left]
            after[left[hit]] = self._found.take(at[hit])
            on = ~hit & (seen >= 0)
            left, at = left[on], at[on]
        return after


def suffix_automaton(symbols: np.ndarray) -> Automaton:
    """The automaton of all substrings of the symbols."""
    link, length, edges = [0, 0], [0, 0], [{}, {}]
    last = 1
    for symbol in symbols.tolist():
        new = len(edges)
        edges.append({})
        link.append(1)
        length.append(length[last] + 1)
        state = last
        while state and symbol not in edges[state]:
            edges[state][symbol] = new
            state = link[state]
        if state:
            target = edges[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(edges)
                edges.append(dict(edges[target]))
                link.append(link[target])
                length.append(length[state] + 1)
                while state and edges[state].get(symbol) == target:
                    edges[state][symbol] = copy
                    state = link[state]
                link[target] = link[new] = copy
        last = new
    arcs = [((state << POINT_BITS) | symbol, target) for state, out in enumerate(edges) for symbol, target in out.items()]
    keys, targets = zip(*arcs) if arcs else ((), ())
    return Automaton(np.array(keys, np.int64), np.array(targets, np.int32))


class Symbols:
    """Maps text to symbols: code points of lower-case letters and marks, one gap for all between them."""

    def __init__(self):
        self._table = np.zeros(0x110000, np.int32)
        self._filled = np.zeros(0x1100, bool)

    def _fill(self, page: int) -> None:
        for point in range(page << 8, (page + 1) << 8):
            if unicodedata.category(chr(point))[0] in "LM":
                self._table[point] = point
        self._filled[page] = True

    def of(self, text: str) -> np.ndarray:
        """Symbols of the whole text, gaps run together."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        for page in np.unique(points >> 8):
            if not self._filled[page]:
                self._fill(int(page))
        symbols = self._table[points]
        keep = np.ones(len(symbols), bool)
        keep[1:] = (symbols[1:] != GAP) | (symbols[:-1] != GAP)
        return symbols[keep]


def phrase_counts(codes: list[np.ndarray], automaton: Automaton) -> np.ndarray:
    """Phrases of each text: segments of all texts are parsed side by side, one symbol of each at a time.

    LANES segments at a time are laid out, so memory does not follow the size of a batch or of a text.
    """
    lanes = [(owner, begin) for owner, code in enumerate(codes) for begin in range(0, len(code), SEGMENT)]
    counts = np.zeros(len(codes), np.int64)
    for first in range(0, len(lanes), LANES):
        # longest first, so those that still go on are the first ones
        some = sorted(lanes[first:first + LANES], key=lambda lane: lane[1] - len(codes[lane[0]]))
        grid = np.zeros((len(some), SEGMENT), np.int64)
        sizes = np.zeros(len(some), np.int64)
        for row, (owner, begin) in enumerate(some):
            part = codes[owner][begin:begin + SEGMENT]
            grid[row, :len(part)] = part
            sizes[row] = len(part)
        going = len(some) - np.searchsorted(sizes[::-1], np.arange(SEGMENT), "right")
        state, phrases = np.ones(len(some), np.int64), np.zeros(len(some), np.int64)
        for column, active in zip(np.ascontiguousarray(grid.T), going.tolist()):
            if not active:
                break
            symbols, states = column[:active], state[:active]
            following = automaton.step(states, symbols)
            failed = following == 0
            # a phrase begins at the start state or where the one before cannot go on
            phrases[:active] += failed | (states == 1)
            # a symbol that no phrase begins with is a phrase of its own
            again = np.flatnonzero(failed)
            following[again] = np.maximum(automaton.step(np.ones(len(again), np.int64), symbols[again]), 1)
            state[:active] = following
        np.add.at(counts, [owner for owner, _ in some], phrases)
    return counts


def usual_rate(code: np.ndarray) -> float | None:
    """Phrases a symbol that most text of the sample's language needs, by parsing each half with the other half.

    Of segments of SEGMENT symbols it is the rate that 95 % keep within; None for a sample too short to halve.
    """
    middle = len(code) // 2
    if middle < SEGMENT:
        return None
    rates = []
    for text, sample in ((code[:middle], code[middle:]), (code[middle:], code[:middle])):
        parts = [text[at:at + SEGMENT] for at in range(0, len(text) - SEGMENT + 1, SEGMENT)]
        rates.append(phrase_counts(parts, suffix_automaton(sample)) / SEGMENT)
    return float(np.quantile(np.concatenate(rates), 0.95))


def learn_languages(labelled: DataFrame) -> dict[str, str]:
    """Sample text by language from (doc_id, text, lang) rows with a label.

    Documents are drawn by hash, at most SAMPLE_DOCUMENTS a language and PIECE characters of each, and cut off at
    SAMPLE_CHARS in all. Only this bounded sample comes to the driver; the rank filter is applied before the shuffle, so
    a language that holds most rows costs no more than another.
    """
    draw = F.xxhash64(F.col("doc_id").cast("string"), "text")
    begin = F.pmod(draw, F.greatest(F.length("text") - PIECE, F.lit(0)).cast("long") + 1).cast("int") + 1
    ranked = (
        labelled.filter((F.length("text") > 0) & F.col("lang").isNotNull())
        .select("lang", F.substring(F.col("text"), begin, F.lit(PIECE)).alias("text"), draw.alias("_draw"))
        .withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("_draw", "text")))
        .filter(F.col("_rank") <= SAMPLE_DOCUMENTS)
    )
    samples: dict[str, str] = {}
    for row in sorted(ranked.collect(), key=lambda r: (r["lang"], r["_rank"])):
        known = samples.get(row["lang"], "")
        samples[row["lang"]] = (known + row["text"] + "\n")[:SAMPLE_CHARS]
    return samples


def identify_languages(documents: DataFrame, samples: dict[str, str], margin: float = MARGIN) -> DataFrame:
    """Add `lang_pred`, `score` (0 to 1), `phrase_rate` and `explained` to (doc_id, text) rows.

    Only text decides. Text that is null or has no letter is `und` with score 0, as is every text if nothing was
    learned. Equal costs go to the first language by name. The score is the winner's share when the bits that
    each language needs beyond the winner are taken as evidence. `phrase_rate` is the winner's phrases a symbol; a text
    is `explained` if its phrases are at most `margin` times the winner's usual rate, and SLACK more. Whole texts are
    parsed, in Arrow batches.
    """
    names = sorted(samples)
    symbols = Symbols()
    automata, bits, usual = [], [], []
    for name in names:
        code = symbols.of(samples[name])
        automata.append(suffix_automaton(code))
        bits.append(math.log2(len(code) + 1) + LENGTH_BITS)
        usual.append(usual_rate(code))
    # a language with hardly any sample is held to what the others need
    common = max((rate for rate in usual if rate is not None), default=1.0)
    limits = [margin * (common if rate is None else rate) for rate in usual]
    # fewer than 3 * SAMPLE_CHARS transitions of 12 bytes for each language
    shared = documents.sparkSession.sparkContext.broadcast((automata, bits, limits))
    kept = [n for n in documents.columns if n not in ("lang_pred", "score", "phrase_rate", "explained")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata, bits, limits = shared.value
        symbols = Symbols()
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            texts = [t.as_py() or "" for t in batch.column(batch.schema.get_field_index("text"))]
            spoken = np.array([any(map(str.isalpha, t)) for t in texts], bool)
            codes = [symbols.of(t if s else "") for t, s in zip(texts, spoken)]
            winners, scores = ["und"] * len(codes), np.zeros(len(codes))
            rates, explained = np.zeros(len(codes)), np.zeros(len(codes), bool)
            if automata and spoken.any():
                counts = np.array([phrase_counts(codes, a) for a in automata])
                cost = counts * np.array(bits)[:, None]
                best = cost.argmin(0)
                beyond = np.minimum((cost - cost.min(0)) * SOFTNESS, 700)
                scores = np.where(spoken, 1 / np.exp(-beyond).sum(0), 0.0)
                needed, sizes = counts[best, np.arange(len(codes))], np.array([len(c) for c in codes])
                rates = needed / np.maximum(sizes, 1)
                explained = spoken & (needed <= np.array(limits)[best] * sizes + SLACK)
                winners = [names[b] if s else "und" for b, s in zip(best, spoken)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(n)) for n in kept], pa.array(winners),
                 pa.array(scores), pa.array(rates), pa.array(explained)],
                [*kept, "lang_pred", "score", "phrase_rate", "explained"])

    schema = documents.select(*kept).schema.add("lang_pred", "string").add("score", "double").add(
        "phrase_rate", "double").add("explained", "boolean")
    return documents.select(*kept).mapInArrow(predict, schema)


def in_known_language(documents: DataFrame, samples: dict[str, str], margin: float = MARGIN) -> DataFrame:
    """The documents, all columns kept, that one of the learned languages explains.

    Rejected are `und` texts and those that need many more phrases than text of the best language does, such as text
    in a script that was not learned, or letters in no order.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "text"]).alias("_row")
    found = identify_languages(documents.select("text", others), samples, margin)
    return found.filter("explained").select(
        *[F.col(c) if c == "text" else F.col(f"_row.`{c}`") for c in documents.columns])

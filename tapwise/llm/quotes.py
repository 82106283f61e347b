"""Chat formatting by quotation: messages are linked to those they quote and ordered as replies, without quotes."""

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tapwise.sources.folders import written_once

SPAN = 4096  # turns in a stretch that one task orders

_quote = re.compile(r"[ \t]*((?:>[ \t]?)+)(.*)", re.DOTALL).fullmatch
_attribution = re.compile(r"(On\b.*\bwrote|.*\b(wrote|writes|schrieb|a écrit|escribió))[ \t]*:[ \t]*").fullmatch
_space = re.compile(r"\s+").sub

PARSED_SCHEMA = "content string, originals array<long>, quotes array<struct<level: int, passage: long>>"


def passage_hash(text: str) -> int | None:
    """Hash of a passage, lower-cased with single spaces; null for a blank one."""
    plain = _space(" ", text).strip().lower()
    digest = xxhash.xxh64_intdigest(plain)
    return (digest - (1 << 64) if digest >> 63 else digest) if plain else None


def parse_quotes(text: str | None) -> tuple[str | None, list[int], list[tuple[int, int]]]:
    """Own words of a message, hashes of its own passages, and (level, hash) of the passages it quotes.

    A line's level is the number of > signs before it. Lines of one level in a row are a passage, and each of
    them is one by itself, so a quoted part links too; own words also count by paragraph and as a whole. A line
    that attributes the quote behind it is dropped.
    """
    if text is None:
        return None, [], []
    lines: list[tuple[int, str]] = []
    for line in text.split("\n"):
        quoted = _quote(line)
        level = quoted[1].count(">") if quoted else 0
        if level and lines and not lines[-1][0] and _attribution(lines[-1][1]):
            lines.pop()
        lines.append((level, quoted[2] if quoted else line))
    own = "\n".join(words for level, words in lines if not level).strip()
    own = re.sub(r"\n{3,}", "\n\n", own)
    originals = {passage_hash(p) for p in [own, *own.split("\n"), *re.split(r"\n[ \t]*\n", own)]}
    quotes, begin = set(), 0
    for at in range(1, len(lines) + 1):
        if at == len(lines) or lines[at][0] != lines[begin][0]:
            level, block = lines[begin][0], [words for _, words in lines[begin:at]]
            if level:
                quotes |= {(level, passage_hash(p)) for p in [" ".join(block), *block]}
            begin = at
    return own, sorted(originals - {None}), sorted(q for q in quotes if q[1] is not None)


def _parsed(messages: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("level", pa.int32()), ("passage", pa.int64())]))
        for batch in batches:
            found = [parse_quotes(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(n) for n in ("conv_id", "turn", "role")], pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.list_(pa.int64())),
                pa.array([[{"level": a, "passage": b} for a, b in f[2]] for f in found], kind)],
                ["conv_id", "turn", "role", "content", "originals", "quotes"])

    columns = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                              F.col("role").cast("string").alias("role"), "text")
    return columns.mapInArrow(rows, "conv_id long, turn long, role string, " + PARSED_SCHEMA)


def _parents(parsed: DataFrame) -> DataFrame:
    """Links (conv_id, turn, parent): of the lowest level with a match, the message with most passages quoted.

    Each quoted passage means the latest earlier message with it. That is a running maximum by passage, not a join
    of all uses with all others; stretches of SPAN turns are ordered apart and joined by their maxima, so neither a
    long conversation nor a phrase everybody uses lands in one task.
    """
    quoted = parsed.select("conv_id", "turn", F.explode("quotes").alias("q")).select(
        "conv_id", "turn", F.col("q.passage").alias("passage"), F.col("q.level").alias("level")).distinct()
    quoted = quoted.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    wanted = quoted.select("conv_id", "passage").distinct()
    said = parsed.select("conv_id", "turn", F.explode("originals").alias("passage")).distinct()
    said = said.filter(F.col("turn").isNotNull()).join(wanted, ["conv_id", "passage"], "left_semi")
    uses = said.select("conv_id", "passage", "turn", F.lit(None).cast("int").alias("level")).unionByName(quoted)
    uses = uses.withColumn("_stretch", F.floor(F.col("turn") / SPAN))
    original = F.when(F.col("level").isNull(), F.col("turn"))
    group = ["conv_id", "passage"]
    earlier = Window.partitionBy(*group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = uses.groupBy(*group, "_stretch").agg(F.max(original).alias("_last")).select(
        *group, "_stretch", F.max("_last").over(earlier).alias("_before"))
    within = Window.partitionBy(*group, "_stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = (
        uses.withColumn("_within", F.max(original).over(within)).filter(F.col("level").isNotNull())
        .join(before, [*group, "_stretch"])
        .withColumn("parent", F.coalesce("_within", "_before")).filter(F.col("parent").isNotNull())
    )
    counted = found.groupBy("conv_id", "turn", "level", "parent").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("conv_id", "turn").agg(
        F.max_by("parent", F.struct(-F.col("level"), "n", "parent")).alias("parent"))


def _roots(links: DataFrame) -> DataFrame:
    """Links (conv_id, turn, parent, root, depth), by pointers that double their reach each round."""
    reach = written_once(links.select("*", F.col("parent").alias("root"), F.lit(1).alias("depth")), "replies")
    while True:
        above = reach.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("_root"),
                             F.col("depth").alias("_depth"))
        further = reach.join(above, ["conv_id", "root"], "left")
        further = written_once(further.select(
            "conv_id", "turn", "parent", F.coalesce("_root", "root").alias("root"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            F.col("_root").isNotNull().alias("_moved")), "replies")
        reach = further.drop("_moved")
        if not further.filter("_moved").limit(1).count():
            return reach


def order_replies(messages: DataFrame) -> DataFrame:
    """Every (conv_id, turn, role, text) message in reply order, without quotes.

    Returns conv_id, position (from 0 in its conversation), turn, role, content, parent_turn, root_turn, depth,
    n_quotes (passages quoted) and `answered`, whether a quote was found. A message that quotes an earlier message
    of its conversation follows the thread of that message; others begin threads. Threads go by the turn of their
    first message, messages in a thread by turn, so every reply stands behind what it answers.

    A null text has null content; a text of quotes only has an empty one. Messages of equal turn get the same
    links and are ordered by role and content. A null turn comes first and is not linked; rows of null conv_id
    form a conversation without links.
    """
    parsed = written_once(_parsed(messages), "messages")
    links = _roots(_parents(parsed))
    joined = parsed.join(links, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "content", F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.size("quotes").alias("n_quotes"), F.col("parent").isNotNull().alias("answered"))
    # null turns go first, into stretch -1
    placed = written_once(joined.withColumns({
        "_root": F.coalesce("root_turn", F.lit(-SPAN)), "_turns": F.floor(F.coalesce("turn", F.lit(-SPAN)) / SPAN),
        "_roots": F.floor(F.coalesce("root_turn", F.lit(-SPAN)) / SPAN)}), "placed-messages")

    def starts(within: list[str], of: list[str], name: str) -> DataFrame:
        """Rows before each value of `of` in its group `within`, from counts combined before the shuffle."""
        order = Window.partitionBy(*within).orderBy(*of).rowsBetween(Window.unboundedPreceding, -1)
        counts = placed.groupBy(*within, *of).agg(F.count(F.lit(1)).alias("_rows"))
        return counts.select(*[F.col(c).alias(f"{c}_") for c in within + of],
                             F.coalesce(F.sum("_rows").over(order), F.lit(0)).alias(name))

    def with_start(rows: DataFrame, within: list[str], of: list[str], name: str) -> DataFrame:
        found = starts(within, of, name)
        on = [rows[c].eqNullSafe(found[f"{c}_"]) for c in within + of]
        return rows.join(found, on).drop(*[f"{c}_" for c in within + of])

    rows = with_start(placed, ["conv_id"], ["_roots"], "_a")
    rows = with_start(rows, ["conv_id", "_roots"], ["_root", "_turns"], "_b")
    stretch = Window.partitionBy("conv_id", "_roots", "_root", "_turns").orderBy("turn", "role", "content")
    position = F.col("_a") + F.col("_b") + F.row_number().over(stretch) - 1
    return rows.select("conv_id", position.alias("position"), "turn", "role", "content", "parent_turn", "root_turn",
                       "depth", "n_quotes", "answered")

"""Benchmark decontamination by spaced seeds: word windows hashed through masks that ignore some positions."""

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tapwise.llm.keys import KEY, key_columns, with_key
from tapwise.operators.lookup import BROADCAST_LIMIT_BYTES, lookup_join
from tapwise.sources.folders import written_once

MASKS = ("11001111", "11101011")  # 1: the word counts; any two unequal words of WINDOW leave one of them a seed
WINDOW = 13  # words of the overlap that is verified
PERCENT = 80  # of the window's words that must be equal
LEAST_WORDS = 5  # shorter items stand in texts by chance; see `short_items`


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def masks_of(size: int) -> tuple[str, ...]:
    """The masks for items of `size` words; one of them meets any overlap in which PERCENT of the words are equal.

    MASKS slide over the items of WINDOW words and more. A shorter item is masked as a whole: with n words that may
    differ it is cut into n + 2 blocks, and each mask leaves out n of them.
    """
    if size >= WINDOW:
        return MASKS
    spare = size - -(-size * PERCENT // 100)
    blocks = spare + 2 if spare else 1
    cuts = [size * k // blocks for k in range(blocks + 1)]
    return tuple(
        "".join(("0" if k in left_out else "1") * (cuts[k + 1] - cuts[k]) for k in range(blocks))
        for left_out in combinations(range(blocks), spare))


def _seeds(hashes: Column, masks: tuple[str, ...]) -> Column:
    """Hashes of all windows through each mask, the masks of one window side by side."""
    span = len(masks[0])

    def masked(start: Column) -> Column:
        return F.array(*[
            F.xxhash64(F.lit(m), *[F.get(hashes, start + k) for k, c in enumerate(m) if c == "1"])
            for m in masks])

    starts = F.sequence(F.lit(0), F.size(hashes) - span)
    return F.when(F.size(hashes) >= span, F.flatten(F.transform(starts, masked)))


def _placed(rows: DataFrame, hashes: str, masks: tuple[str, ...], place: str) -> DataFrame:
    """The seeds of each row with their place, its other columns kept."""
    kept = [c for c in rows.columns if c != hashes]
    return rows.select(*kept, F.posexplode(_seeds(F.col(hashes), masks)).alias("_at", "seed")).select(
        *kept, "seed", F.expr(f"cast(_at div {len(masks)} as long)").alias(place))


def short_items(benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The items (item_id, text, n_words) of fewer words than are searched for, empty and null ones included."""
    counted = benchmark.select("item_id", "text", F.coalesce(F.size(words(F.col("text"))), F.lit(0)).alias("n_words"))
    return counted.withColumn("n_words", F.greatest("n_words", F.lit(0))).filter(F.col("n_words") < least_words)


def contaminated_keys(documents: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Rows (_key, _text_key, n_items, item_id, matched) of the documents that hold a benchmark passage.

    A passage is an overlap of WINDOW words (a shorter item: all of its words) on one alignment within the text, of
    which at least PERCENT per cent are equal; `item_id` is the item of the best overlap (ties: the smallest id, null
    last) and `matched` its equal words. Items of fewer than `least_words` words are not searched for, `short_items`
    reports them. An item may have no id; items equal in id and text are one. Null and empty texts have no words.
    Documents are keyed by content, see `keys`.
    Seeds start at every word, and every such overlap has one; documents are searched only with the masks of the
    item sizes that the benchmark has.

    Seeds of the documents stay in the map tasks where the benchmark's seeds fit the measured broadcast limit;
    beyond it AQE splits the partitions of frequent seeds. Hits are reduced to alignments before any text is
    fetched, so a passage that very many documents share costs a row for each of them.
    """
    item_id = F.col("item_id").cast("long")
    items = benchmark.select(item_id.alias("item_id"), F.xxhash64(item_id, "text").alias("item"),
                             _word_hashes(F.col("text")).alias("_item")).dropDuplicates(["item"])
    items = items.filter(F.size("_item") >= max(1, least_words)).withColumn("_window", F.least(F.lit(WINDOW), F.size("_item")))
    items = written_once(items, "benchmark-items")
    windows = sorted(r["_window"] for r in items.select("_window").distinct().collect()) or [WINDOW]
    seeds = reduce(DataFrame.union, [
        _placed(items.filter(F.col("_window") == n).select("item", "_item"), "_item", masks_of(n), "_item_at")
        for n in windows])
    seeds = written_once(seeds.select("seed", "item", "_item_at").distinct(), "benchmark-seeds")

    keyed = with_key(documents)
    hashed = keyed.select(*KEY, _word_hashes(F.col("text")).alias("_words"))
    placed = reduce(DataFrame.union, [_placed(hashed, "_words", masks_of(n), "_start") for n in windows])
    hits = lookup_join(placed, seeds, "seed").select(
        *KEY, "item", (F.col("_start") - F.col("_item_at")).alias("_shift")).distinct()
    hits = written_once(hits, "benchmark-hits")

    found = lookup_join(keyed.select(*KEY, "text"), hits.select(*KEY).distinct(), KEY).dropDuplicates(KEY)
    texts = found.select(*KEY, _word_hashes(F.col("text")).alias("_words"))
    measured = items.agg(F.coalesce(F.sum(F.size("_item") * 8 + 40), F.lit(0))).first()[0]
    small = measured <= BROADCAST_LIMIT_BYTES
    aligned = texts.join(hits, KEY).join(F.broadcast(items) if small else items.hint("merge"), "item")
    equal = F.transform(F.col("_item"), lambda w, at: F.coalesce(
        (F.get(F.col("_words"), (at + F.col("_shift")).cast("int")) == w).cast("int"), F.lit(0)))
    # windows that hang over an end of the text are no overlaps of their size
    first = F.greatest(F.lit(0).cast("long"), -F.col("_shift")).cast("int")
    last = F.least(F.size("_item").cast("long"), F.size("_words") - F.col("_shift")).cast("int") - F.col("_window")
    sums = F.transform(F.sequence("_first", "_last"), lambda at: F.aggregate(
        F.slice(F.col("_equal"), at + 1, F.col("_window")), F.lit(0), lambda a, b: a + b))
    best = (
        aligned.select(*KEY, "item", "item_id", equal.alias("_equal"), "_window", first.alias("_first"), last.alias("_last"))
        .filter(F.col("_first") <= F.col("_last"))
        .select(*KEY, "item", "item_id", "_window", F.array_max(sums).alias("matched"))
        .filter(F.col("matched") * 100 >= F.col("_window") * PERCENT)
        .groupBy(*KEY, "item").agg(F.max("matched").alias("matched"), F.first("item_id").alias("item_id"))
    )
    return best.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.max_by("item_id", F.struct("matched", -F.col("item_id"))).alias("item_id"),
        F.max("matched").alias("matched"))


def flag_contaminated(documents: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Every document with `contaminated`, `n_items`, `item_id` and `matched` (see `contaminated_keys`)."""
    flagged = written_once(contaminated_keys(documents, benchmark, least_words), "contaminated")
    return lookup_join(with_key(documents).drop("text"), flagged, KEY, "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id", "matched")


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns kept, that hold no benchmark passage."""
    flagged = written_once(contaminated_keys(documents, benchmark), "contaminated").select(
        *KEY, F.lit(True).alias("_flagged"))
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    return lookup_join(documents.select(row, *key_columns()), flagged, KEY, "left").filter(
        F.col("_flagged").isNull()).select("_row.*")

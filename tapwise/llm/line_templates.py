"""Line deduplication by a fixed-depth template tree over the lines of all documents.

A line goes down the tree by its number of tokens and its leading tokens. Tokens with a digit are variable fields
from the start. In each leaf that several documents reach, lines that agree in their most frequent tokens are
templates too, as many as the leaf has. Lines of a template that recurs across documents are dropped but for its first document.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tapwise.llm.keys import KEY, key_columns, with_key
from tapwise.operators.lookup import lookup_join
from tapwise.sources.folders import written_once

DEPTH = 3  # leading tokens that lead to a leaf
FIELD = "<*>"
MIN_TOKENS = 1  # any line that is not blank
MASKED_TOKENS = 4  # shorter lines of nothing but fields are judged by their own text
MIN_DOCUMENTS = 3  # documents a template recurs in
LONG_DOCUMENTS = 2  # documents a template of LONG_BYTES recurs in
LONG_BYTES = 40  # besides its fields
GENERALISED_DOCUMENTS = 3  # documents a generalised template recurs in
CONSTANT = 0.6  # share of its tokens that are constant in a generalised template


def _masked_lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add `_masked`, the lines of a text with single spaces and FIELD for tokens with a digit.

    Patterns run over whole texts, not line by line, and only where a plain search finds something to change. Each step
    is a projection of its own in generated code, so nothing is worked out twice.
    """
    uneven = reduce(or_, [F.contains(text, F.lit(s)) for s in ("  ", "\t", "\r")])
    edges = F.contains("_even", F.lit(" \n")) | F.contains("_even", F.lit("\n "))
    even = documents.withColumn("_even", F.when(uneven, F.regexp_replace(text, "[ \t\r]+", " ")).otherwise(F.col(text)))
    even = even.withColumn("_even", F.trim(F.when(edges, F.regexp_replace("_even", " ?\n ?", "\n")).otherwise(F.col("_even"))))
    fields = even.withColumn("_fields", F.when(
        F.col("_even").rlike("[0-9]"), F.regexp_replace("_even", "(?<!\\S)[^\\s0-9]*+[0-9]\\S*", FIELD)).otherwise(F.col("_even")))
    masks = [" ".join([FIELD] * n) for n in range(1, MASKED_TOKENS)]
    bare = F.col("_fields").rlike(f"(?md)^(?:{'|'.join(m.replace('*', '[*]') for m in masks)})$")
    split = fields.select(*documents.columns, "_even", "_fields", bare.alias("_bare"), F.split("_fields", "\n").alias("_split"))
    own = F.transform("_split", lambda m, at: F.when(m.isin(*masks), F.get(F.col("_own"), at)).otherwise(m))
    split = split.withColumn("_own", F.when(F.col("_bare"), F.split("_even", "\n")))
    return split.select(*documents.columns, F.when(F.col("_bare"), own).otherwise(F.col("_split")).alias("_masked"))


def _without_bytes(text: Column, part: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(part), F.lit("")))


def _template(masked: Column) -> Column:
    return F.xxhash64(F.lit("template"), masked)


def _lines(documents: DataFrame) -> DataFrame:
    """The different masked lines of each document that are not blank, with their tokens, template and leaf.

    `_place` is the order that finds the first document. A line of DEPTH tokens or less is its own leaf. The lines are
    written once; all later passes read the columns that they need.
    """
    rows = _masked_lines(with_key(documents).withColumn("_doc", F.coalesce("doc_id", F.lit((1 << 63) - 1))))
    lines = rows.select(*KEY, "_doc", F.explode(F.array_distinct("_masked")).alias("line")).filter(F.col("line") != "")
    lines = lines.select(*KEY, "_doc", "line", (_without_bytes(F.col("line"), " ") + 1).alias("length"),
                         _template(F.col("line")).alias("template"))
    leaf = F.when(F.col("length") <= DEPTH, F.col("template")).otherwise(
        F.xxhash64(F.lit("leaf"), "length", F.substring_index("line", " ", DEPTH)))
    written = written_once(lines.withColumn("leaf", leaf), "masked-lines")
    return written.withColumn("_place", F.struct(F.col("_doc").alias("doc"), F.col("_key").alias("key")))


def _frequent(lines: DataFrame) -> DataFrame:
    """Hashes of templates and leaves that different documents reach, with their lines and the first document.

    A document has a template once, so that is the number of its documents. Counts and minima are combined before the
    shuffle, so a line of a third of all documents costs a row per task.
    """
    hashes = F.when(F.col("leaf") == F.col("template"), F.array("template")).otherwise(F.array("template", "leaf"))
    return (
        lines.select("_place", F.explode(hashes).alias("hash"))
        .groupBy("hash").agg(F.count(F.lit(1)).alias("_documents"), F.min("_place").alias("_first"),
                             F.max("_place").alias("_last"))
        .filter(F.col("_first") != F.col("_last"))
        .select("hash", "_documents", F.col("_first.doc").alias("_doc"), F.col("_first.key").alias("_first_key"))
    )


def _generalised(lines: DataFrame) -> DataFrame:
    """Of (key, place, template, leaf, line) rows whose leaf recurs, those that fit one of the leaf's templates.

    A line's tokens are ranked by how many lines of the leaf have them in their position. Lines whose leading
    CONSTANT of the tokens agree are a template if they stand in GENERALISED_DOCUMENTS documents; a leaf has any
    number of them. Tokens too rare for that are dropped before lines are put together.
    """
    long = lines.filter(F.col("length") > DEPTH).distinct()
    tokens = long.select(*KEY, "_place", "template", "leaf", "length", F.posexplode(F.split("line", " ")).alias(
        "at", "token"))
    counted = tokens.groupBy("leaf", "at", "token").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= GENERALISED_DOCUMENTS)
    counted = written_once(counted, "leaf-tokens")
    ranked = lookup_join(tokens, counted, ["leaf", "at", "token"]).groupBy(
        *KEY, "_place", "template", "leaf", "length").agg(
            F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("order"), "at", "token"))).alias("ranked"))
    needed = F.ceil(F.col("length") * CONSTANT).cast("int")
    constants = F.transform(F.slice("ranked", 1, needed), lambda r: F.struct(r["at"], r["token"]))
    fitting = written_once(ranked.filter(F.size("ranked") >= needed).select(
        *KEY, "_place", "template", F.xxhash64("leaf", constants).alias("group")), "fitting-lines")
    firsts = fitting.groupBy("group").agg(
        F.min("_place").alias("_first"), F.count_distinct("_place").alias("_documents")
    ).filter(F.col("_documents") >= GENERALISED_DOCUMENTS).select("group", "_first")
    return fitting.join(firsts, "group").filter(F.col("_place") != F.col("_first")).select(*KEY, "template")


def recurring_lines(documents: DataFrame) -> DataFrame:
    """Rows (_key, _text_key, templates): the templates whose lines each document loses."""
    lines = _lines(documents)
    frequent = written_once(_frequent(lines), "frequent-lines")
    each = lines.drop("_doc")
    by_template = frequent.select(F.col("hash").alias("template"), "_documents", "_doc", "_first_key")
    by_leaf = frequent.select(F.col("hash").alias("leaf"), F.col("_documents").alias("_reached"))
    marked = lookup_join(lookup_join(each, by_leaf, "leaf"), by_template, "template", "left")
    repeated = F.col("_documents").isNotNull()
    # two documents are enough for a long line; a shorter one of two is still a line of its leaf
    long = F.octet_length(F.replace(F.col("line"), F.lit(FIELD), F.lit(""))) >= LONG_BYTES
    recurs = (F.col("_documents") >= MIN_DOCUMENTS) | long
    marked = marked.withColumn("_documents", F.when(recurs, F.col("_documents")))
    marked = marked.filter(repeated | (F.col("_reached") >= GENERALISED_DOCUMENTS))
    # a recurring template reaches its leaf as often, so all its lines are among these
    marked = written_once(marked.select(
        *KEY, "_place", "template", "leaf", "_documents", "_doc", "_first_key", "length",
        F.when(~repeated, F.col("line")).alias("line")), "marked-lines")
    first = (F.col("_place.doc") == F.col("_doc")) & (F.col("_place.key") == F.col("_first_key"))
    same = marked.filter(repeated & ~first).select(*KEY, "template")
    other = _generalised(marked.filter(~repeated).select(*KEY, "_place", "template", "leaf", "length", "line"))
    return same.union(other).groupBy(*KEY).agg(F.collect_set("template").alias("templates"))


def without_recurring_lines(documents: DataFrame) -> DataFrame:
    """The documents, all columns kept, without the lines of recurring templates, with n_lines and n_dropped.

    Lines are cut at newlines; blank ones stay. A template recurs in MIN_DOCUMENTS documents or
    more, one of LONG_BYTES in LONG_DOCUMENTS; its lines stay in the first of them, the one with the smallest doc_id (null ids last, then by key), and
    are dropped everywhere else. A line that a document repeats is judged once: all its copies stay or go. Rows
    equal in doc_id and text are treated alike. A null text stays null and has no lines; an empty text has one.
    Columns named n_lines or n_dropped are replaced; other names may be anything without a leading underscore.
    """
    drops = written_once(recurring_lines(documents), "dropped-lines")
    gone, has_drops = F.col("templates"), F.col("templates").isNotNull()
    count = F.when(F.col("text").isNull(), 0).otherwise(_without_bytes(F.col("text"), "\n") + 1)
    row = [c for c in documents.columns if c not in ("n_lines", "n_dropped")]
    others = F.struct(*[F.col(f"`{c}`") for c in row if c != "text"]).alias("_row")
    joined = documents.select(others, "text", *key_columns()).join(drops, KEY, "left")
    joined = _masked_lines(joined.withColumn("_judged", F.when(has_drops, F.col("text"))), "_judged")
    stays = F.transform("_masked", lambda m: ~F.array_contains(gone, _template(m)))
    joined = joined.select("_row", "text", count.alias("n_lines"), "_judged", stays.alias("_stays"))
    kept = F.filter(F.split("_judged", "\n"), lambda line, at: F.get(F.col("_stays"), at))
    joined = joined.select("_row", "text", "n_lines", kept.alias("_kept"))
    changed = F.struct(
        F.coalesce(F.array_join("_kept", "\n"), "text").alias("_text"), "n_lines",
        F.coalesce(F.col("n_lines") - F.size("_kept"), F.lit(0)).alias("n_dropped"))
    # made by a generator: a filter of the caller on these columns is not pushed through it, to work them out again
    made = joined.select("_row", F.inline(F.array(changed)))
    return made.select(*[F.col("_text").alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in row],
                       "n_lines", "n_dropped")


def drop_recurring_lines(documents: DataFrame) -> DataFrame:
    """Every document as (doc_id, text, n_lines, n_dropped); see `without_recurring_lines`."""
    return without_recurring_lines(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))

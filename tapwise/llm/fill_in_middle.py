"""Fill-in-the-middle rewriting by counted quantifiers.

A text is a run of units, words with the white space before them. `regexp_count` gives their number n; two hashed
draws from 0 to n cut it. A pattern made for the row then takes exactly that many units for the prefix and for the
middle, and the rest as the suffix, in a single match whose groups the replacement puts in their new order. The
quantifiers are possessive: each unit is taken once and never given back, so a text of any length needs constant
stack and one pass.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: the unit of a cut, the marks and the names of the forms
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

# prefix, middle and suffix of a cut text are groups 1, 2 and 3
_WRITTEN = {PSM: f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", SPM: f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}
_READ = {PSM: (f"(?s)\\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)\\z", "$1$3$2"),
         SPM: (f"(?s)\\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)\\z", "$2$3$1")}


def _draw(digest: Column, group: int) -> Column:
    """The `group`-th eight digits of a hex digest as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def _cut_pattern(before: Column, middle: Column) -> Column:
    """A pattern whose groups are the first `before` units, the next `middle` units and all that follows."""
    units = [F.concat(F.lit(f"((?:{UNIT}){{"), n.cast("string"), F.lit("}+)")) for n in (before, middle)]
    return F.concat(F.lit("(?s)\\A"), *units, F.lit("(.*)\\z"))


def restored_text(output: Column, form: Column) -> Column:
    """The text that an output of `fill_in_middle` was made from; it needs the output and its form only.

    No mark stands in a text that is cut, and none can arise where a piece meets a mark, as no end of a mark begins
    one. So the first of each mark is the one that was put in.
    """
    found = F.when(form == PLAIN, output)
    for kind, (pattern, order) in _READ.items():
        found = found.when(form == kind, F.regexp_replace(output, F.lit(pattern), F.lit(order)))
    return found


def fill_in_middle(documents: DataFrame, seed: int = 42, cut_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """Every (doc_id, text) row as (doc_id, n, form, prefix_chars, middle_chars, output).

    A text of n units gets two cuts between 0 and n, so that each of the three pieces may be empty. `cut_percent` of
    the texts are cut, of those `spm_percent` with the suffix first. Draws come from the sha256 of seed and doc_id,
    so a row computed again is the same. Texts that are null (they count as empty), empty or hold one of the marks
    stay plain: they are their own output, with null lengths. A null doc_id draws like an empty one; rows of equal
    id draw alike, equal rows are equal. Other columns are ignored, whatever their names.

    Each step is a projection of its own, which Spark does not merge where a costly column is used twice.
    """
    text = F.coalesce(documents["text"], F.lit(""))
    doc_id = documents["doc_id"].cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    rows = documents.select(doc_id.alias("doc_id"), text.alias("text"), digest.alias("_digest"))
    rows = rows.select("doc_id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
                       *[_draw(F.col("_digest"), k).alias(f"_h{k + 1}") for k in range(4)])
    first, second = F.col("_h1") % (F.col("n") + 1), F.col("_h2") % (F.col("n") + 1)
    marked = reduce(or_, [F.contains("text", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)])
    plain = (F.col("text") == "") | marked | (F.col("_h3") % 100 >= cut_percent)
    form = F.when(plain, PLAIN).when(F.col("_h4") % 100 < spm_percent, SPM).otherwise(PSM)
    rows = rows.select("doc_id", "text", "n", F.least(first, second).alias("_before"),
                       F.abs(first - second).alias("_inside"), form.alias("form"))
    order = F.when(F.col("form") == SPM, _WRITTEN[SPM]).otherwise(_WRITTEN[PSM])
    output = F.when(F.col("form") == PLAIN, F.col("text")).otherwise(
        F.regexp_replace("text", _cut_pattern(F.col("_before"), F.col("_inside")), order))
    rows = rows.select("doc_id", "n", "form", output.alias("output"))
    # where the pieces lie is read off the output, whose marks are unique
    marks = {m: F.locate(m, F.col("output")) for m in (PREFIX, SUFFIX, MIDDLE)}
    after_prefix = F.when(F.col("form") == PSM, marks[SUFFIX]).when(F.col("form") == SPM, marks[MIDDLE])
    prefix_chars = after_prefix - marks[PREFIX] - len(PREFIX)
    middle_chars = F.when(F.col("form") != PLAIN, F.length("output") - marks[MIDDLE] - len(MIDDLE) + 1)
    return rows.select("doc_id", "n", "form", prefix_chars.cast("long").alias("prefix_chars"),
                       middle_chars.cast("long").alias("middle_chars"), "output")

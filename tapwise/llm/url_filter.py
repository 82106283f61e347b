"""URL verdicts: host and path rules first, then a list of canonical URLs behind a blocked Bloom filter."""

from pyspark.sql import Column, DataFrame, functions as F

from tapwise.sources.folders import written_once

WORDS = 8  # 64-bit words of a block; a key sets one bit in each
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 16  # bounds the broadcast filter at MAX_BLOCKS rows of 72 bytes
TRACKING = "^(utm_.*|ref=.*)"  # query parameters that a canonical URL leaves out

Rule = tuple[str, str, str]  # host, path, verdict


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def url_host(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    host = F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without a leading www. or m., path without trailing slashes, sorted query without tracking; or null."""
    host = F.regexp_replace(url_host(url), "^(www|m)[.]", "")
    path = F.regexp_replace(url_path(url), "/+$", "")
    query = F.regexp_extract(_after_scheme(url), "^[^?#]*[?]([^#]*)", 1)
    fields = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    text = F.concat(host, path, F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&")))
                    .otherwise(F.lit("")))
    return F.when(F.instr(url, "://") > 0, text)


def _fits(rule: Rule) -> Column:
    host, path, _ = rule
    at_host = (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
    return at_host & F.startswith(F.col("path"), F.lit(path))


def _first_rule(rules: list[Rule], value) -> Column:
    longest_first = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))
    cases = None
    for rule in longest_first:
        cases = (F if cases is None else cases).when(_fits(rule), F.lit(value(rule)))
    return F.lit(None).cast("string") if cases is None else cases


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    second = F.xxhash64(url, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(second, 6 * w).bitwiseAND(63).cast("int")) for w in range(WORDS)]


def bloom_filter(urls: DataFrame, blocks: int) -> DataFrame:
    """Blocked Bloom filter of a column `url`: one row per used block with WORDS words.

    Bits are combined in the map tasks, so the shuffle moves one row per block and task.
    """
    words = [F.bit_or(m).alias(f"w{w}") for w, m in enumerate(_masks(F.col("url")))]
    return urls.groupBy(_block(F.col("url"), blocks).alias("block")).agg(*words)


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule]) -> DataFrame:
    """A verdict for every (page_id, url) row: page_id, host, path, rule, canonical, verdict.

    The longest rule whose host is the page's or a parent of it, and whose path begins the page's, decides (equal
    lengths: the longer host). Where none fits, a page is blocked if its canonical URL is in `listed` (a column
    `url` of canonical URLs; null ones list nothing), else allowed. A null url, or one without ://, has an empty
    host and path, no canonical URL, and is allowed. Repeated rows each get their verdict.

    The filter is broadcast: it has at most MAX_BLOCKS blocks however long the list grows, and a fuller filter
    only passes more pages on. Pages that it passes are joined exactly with the list, which removes the false
    ones; AQE splits the partition of a URL that very many pages share. Pages it rules out are not shuffled.
    """
    listed = listed.select("url").filter(F.col("url").isNotNull()).distinct()
    listed = written_once(listed, "listed-urls")
    keys = listed.count()
    blocks = min(MAX_BLOCKS, max(1, -(-keys * BITS_PER_KEY // (64 * WORDS))))
    judged = pages.select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
        canonical_url(F.col("url")).alias("canonical"))
    judged = judged.select("*", _first_rule(rules, lambda r: r[0] + r[1]).alias("rule"),
                           _first_rule(rules, lambda r: r[2]).alias("_by_rule"))
    kept = ["page_id", "host", "path", "rule", "canonical"]
    ruled = judged.filter(F.col("rule").isNotNull()).select(*kept, F.col("_by_rule").alias("verdict"))

    masks = _masks(F.col("canonical"))
    hit = F.lit(True)
    for w, mask in enumerate(masks):
        hit = hit & (F.col(f"w{w}").bitwiseAND(mask) == mask)
    probed = (
        judged.filter(F.col("rule").isNull())
        .withColumn("block", _block(F.col("canonical"), blocks))
        .join(F.broadcast(bloom_filter(listed, blocks)), "block", "left")
        .withColumn("_possible", F.coalesce(hit & F.col("canonical").isNotNull(), F.lit(False)))
    )
    missed = probed.filter(~F.col("_possible")).select(*kept, F.lit("allow").alias("verdict"))
    found = listed.select(F.col("url").alias("canonical"), F.lit("block").alias("_listed"))
    checked = (
        probed.filter("_possible").select(*kept).join(found.hint("merge"), "canonical", "left")
        .select(*kept, F.coalesce("_listed", F.lit("allow")).alias("verdict"))
    )
    return ruled.unionByName(missed).unionByName(checked)

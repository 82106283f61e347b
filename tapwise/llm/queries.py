"""The registered query of each operator: whole tables in, the digest columns of its contract out."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapwise.llm import (
    compression, decontaminate, fill_in_middle, language, line_templates, merkle, neighbours, ngram_join, packing, quality,
    quotes, token_files, url_filter,
)
from tapwise.sources.folders import run_folder

TOKENIZER_FILE = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# fixed values: the rules of the contract as host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]
LISTED_LABELS = ("cheap-pills", "spam-farm")  # host labels whose pages make the list of blocked URLs


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    host = url_filter.url_host(F.col("url"))
    on_list = F.arrays_overlap(F.split(host, "[.]"), F.array(*[F.lit(x) for x in LISTED_LABELS]))
    listed = pages.filter(on_list).select(url_filter.canonical_url(F.col("url")).alias("url"))
    return url_filter.judge_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def link_documents(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link_components(_table(spark, folder, "documents"), words=3, percent=90)


def score_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(_table(spark, folder, "documents"))


def order_replies(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.order_replies(_table(spark, folder, "conversations"))


def nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest_neighbours(_table(spark, folder, "embeddings"))


def drop_recurring_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_templates.drop_recurring_lines(_table(spark, folder, "documents"))


def flag_contaminated(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.flag_contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_along_curve(_table(spark, folder, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def token_file_digest(spark: SparkSession, folder: str) -> DataFrame:
    path = run_folder(spark, "token-files")
    token_files.write_token_files(_table(spark, folder, "documents"), path, tokenizer_path(), end_id=2)
    return token_files.read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def held_out(doc_id: str = "doc_id"):
    """One document in five by a checksum of its id; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    samples = language.learn_languages(documents.filter(~held_out()).select("doc_id", "text", "lang"))
    found = language.identify_languages(documents.select("doc_id", "text"), samples)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def fill_in_middle_digest(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_table(spark, folder, "documents"))
    restored = fill_in_middle.restored_text(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored, 256).alias("restored_sha256"))


def verify_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against the manifest's root, of every second one a copy without its newlines."""
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0
    copy = merkle.leaf_digest(*row, F.replace("text", F.lit("\n"), F.lit("")))
    manifest = merkle.merkle_manifest(
        _table(spark, folder, "documents"), merkle.leaf_digest(*row, F.col("text")), presented=F.when(tampered, copy))
    folded = manifest.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("witness")).alias("proof_sha256"),
        merkle.folded_root(F.coalesce("presented", "leaf"), F.col("witness")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def judge_compression(spark: SparkSession, folder: str) -> DataFrame:
    judged = compression.compression_rules(_table(spark, folder, "documents").select("doc_id", "text"))
    return judged.drop("text")


QUERIES = {
    "op1_url_filter": url_verdicts,
    "op3_quality": score_quality,
    "op4_ngram_join": link_documents,
    "op2_pack_curve": pack_documents,
    "op5_line_templates": drop_recurring_lines,
    "op6_decontaminate": flag_contaminated,
    "op7_reply_order": order_replies,
    "op8_token_files": token_file_digest,
    "op9_nn_descent": nearest_neighbours,
    "op10_language_id": language_id,
    "op11_fill_in_middle": fill_in_middle_digest,
    "op12_merkle_manifest": verify_manifest,
    "op13_compression_bands": judge_compression,
}

ORACLE = {
    "op1_url_filter": r"""
        WITH cut AS (
            SELECT page_id,
                   CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
            FROM pages),
        parts AS (
            SELECT page_id, rest,
                   coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
                   list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'),
                       lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_.*|ref=.*)'))) AS fields
            FROM cut),
        urls AS (
            SELECT page_id, host, path,
                   CASE WHEN rest IS NOT NULL THEN
                       regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '/+$', '')
                       || CASE WHEN len(fields) > 0 THEN '?' || array_to_string(fields, '&') ELSE '' END
                   END AS canonical,
                   CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net'))
                             AND starts_with(path, '/en/') THEN 'example.net/en/'
                        WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
                             AND starts_with(path, '/de/') THEN 'example.com/de/'
                        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
                   END AS rule
            FROM parts),
        listed AS (
            SELECT DISTINCT canonical FROM urls
            WHERE canonical IS NOT NULL
              AND list_has_any(string_split(host, '.'), ['cheap-pills', 'spam-farm']))
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                    WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
        FROM urls""",
    "op11_fill_in_middle": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                   regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
            FROM documents),
        draws AS (
            SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a,
                   CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
                        WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM texts),
        pieces AS (
            SELECT doc_id, t, n, form, array_to_string(u[1:least(a, b)], '') AS p,
                   array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
                   array_to_string(u[greatest(a, b) + 1:n], '') AS s
            FROM draws)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM pieces""",
    "op12_merkle_manifest": r"""
        WITH RECURSIVE fields AS (
            SELECT doc_id, source, text,
                   coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
                   || coalesce(octet_length(encode(source)) || ':' || source, '-')
                   || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
                   || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
                   coalesce(CAST(doc_id AS VARCHAR), '') AS id
            FROM documents),
        hashed AS (
            SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                   -- each byte is followed by its eight shifts; -1 is a shift, and the last inversion turns the parity
                   list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, length(id) + 1),
                       lambda k: [ascii(substr(id, k, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
                       lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                                         ELSE c >> 1 END) & 1 = 1 AS tampered,
                   sha256(head || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':'
                                           || replace(text, chr(10), ''), '-')) AS copy
            FROM fields),
        leaves AS (
            SELECT doc_id, source, leaf, CASE WHEN tampered THEN copy ELSE leaf END AS presented,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot
            FROM hashed),
        levels AS (
            SELECT source, 0 AS level, list(leaf ORDER BY spot) AS nodes FROM leaves GROUP BY source
            UNION ALL
            SELECT source, level + 1, list_transform(range(0, len(nodes), 3),
                lambda k: sha256(array_to_string(nodes[k + 1:k + 3], ''))) FROM levels WHERE len(nodes) > 1),
        subroots AS (
            SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
            FROM levels WHERE len(nodes) = 1),
        upper_levels AS (
            SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
            UNION ALL
            SELECT level + 1, list_transform(range(0, len(nodes), 3),
                lambda k: sha256(array_to_string(nodes[k + 1:k + 3], ''))) FROM upper_levels WHERE len(nodes) > 1),
        every_level AS (
            SELECT source, level, nodes FROM levels),
        steps AS (
            SELECT v.doc_id, v.leaf, 0 AS half, l.level, l.nodes, v.source, v.spot // CAST(3 ** l.level AS BIGINT) AS spot
            FROM leaves v JOIN every_level l ON v.source IS NOT DISTINCT FROM l.source WHERE len(l.nodes) > 1
            UNION ALL
            SELECT v.doc_id, v.leaf, 1, u.level, u.nodes, v.source, s.place // CAST(3 ** u.level AS BIGINT)
            FROM leaves v JOIN subroots s ON v.source IS NOT DISTINCT FROM s.source, upper_levels u
            WHERE len(u.nodes) > 1),
        proofs AS (
            SELECT doc_id, source, leaf,
                   list({'l': array_to_string(nodes[spot // 3 * 3 + 1:spot], ''),
                         'r': array_to_string(nodes[spot + 2:spot // 3 * 3 + 3], '')} ORDER BY half, level) AS steps
            FROM steps GROUP BY doc_id, source, leaf),
        folds AS (
            SELECT v.doc_id, v.source, v.leaf, v.spot, v.presented AS node, coalesce(p.steps, []) AS steps, 0 AS done
            FROM leaves v LEFT JOIN proofs p ON v.doc_id IS NOT DISTINCT FROM p.doc_id AND v.leaf = p.leaf
                 AND v.source IS NOT DISTINCT FROM p.source
            UNION ALL
            SELECT doc_id, source, leaf, spot, sha256(steps[done + 1].l || node || steps[done + 1].r), steps, done + 1
            FROM folds WHERE done < len(steps))
        SELECT f.doc_id, f.leaf, s.subroot, r.nodes[1] AS root,
               sha256(array_to_string(list_transform(f.steps, lambda x: x.l || x.r), '')) AS proof_sha256,
               f.node AS folded_root, f.node = r.nodes[1] AS verified
        FROM folds f JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source,
             (SELECT nodes FROM upper_levels WHERE len(nodes) = 1) r
        WHERE f.done = len(f.steps)""",
}

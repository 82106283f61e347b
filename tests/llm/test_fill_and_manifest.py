import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from tapwise.llm import compression, fill_in_middle, merkle
from tapwise.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: nulls in each column, empty and blank texts, repeated rows, an id used twice, marks, astral letters, long texts
ODD = [
    (None, "no id\nat all", "en", "s", 10), (None, None, None, None, None), (1, None, "en", "s", None), (2, "", "en", "", 0),
    (3, " \n\t \x0b ", None, "s", 5), (4, "word", "en", None, 4), (5, "same\nrow", "en", "s", 8), (5, "same\nrow", "en", "s", 8),
    (6, "first of six", "en", "s", 1), (6, "second\nof six", "de", "s", 1), (7, "a <P> mark", "en", "t", 10),
    (8, "<S>", "en", "t", 3), (9, "<\n<M", "en", "t", 4), (10, "𝔘nten ö 𝔵 y\x1cz \n", "é", "Ü", 9),
    (11, "wörd 𝔘\t" * 60_000, "en", "=s", 1), (12, " \n" * 80_000 + "x", "en", "=s", 1), (13, "$1 \\1 {2}+ (x)", "en", "Z", 1),
    (14, "trailing space \n\n", "en", "a", 3), (15, "-", "-", "-", 1)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    # names that the operators make, and one with a dot
    return spark.createDataFrame(ODD, DOCUMENTS).withColumns(
        {c: F.lit("clash") for c in ("n", "form", "output", "tree", "at", "block", "steps", "kept", "ratio", "a.b")}).repartition(4)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is not None, v) for v in r])


# --- fill in the middle ---

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def cut(doc_id, text, seed=42, cut_percent=50, spm_percent=80):
    text, units = text or "", UNITS.findall(text or "")
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= cut_percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("options", [{}, {"cut_percent": 100, "spm_percent": 50}, {"seed": 7, "cut_percent": 100}])
def test_cuts_equal_those_of_a_list_of_units(spark, docs, odd, options):
    for table in (docs, odd):
        made = fill_in_middle.fill_in_middle(table, **options)
        found = made.select("*", fill_in_middle.restored_text(F.col("output"), F.col("form")).alias("restored"))
        expected = [(r.doc_id, *cut(r.doc_id, r.text, **options), r.text or "") for r in table.collect()]
        assert ordered(found.collect()) == ordered(expected)


def test_pieces_around_marks_are_told_apart(spark):
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice(["<", "P", "S", "M", ">", " ", "a"]) for _ in range(rng.randrange(1, 25)))) for k in range(800)]
    made = fill_in_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), cut_percent=100)
    found = {r.doc_id: r for r in made.select("*", fill_in_middle.restored_text(
        F.col("output"), F.col("form")).alias("restored")).collect()}
    assert Counter(r.form for r in found.values()).keys() == {"plain", "psm", "spm"}
    for k, text in rows:
        assert tuple(found[k]) == (k, *cut(k, text, cut_percent=100), text)


def test_no_documents_make_no_cuts(spark):
    assert fill_in_middle.fill_in_middle(spark.createDataFrame([], DOCUMENTS)).collect() == []


# --- the Merkle manifest ---

def levels_of(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][k:k + 3])) for k in range(0, len(found[-1]), 3)])
    return found


def siblings(levels, at):
    found = []
    for nodes in levels[:-1]:
        run = at // 3 * 3
        found.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 3])))
        at //= 3
    return found


def leaf_of(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, digest of the proof, folded root, verified) of every row."""
    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append(((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        sources[name].sort(key=lambda x: x[0])
    trees = {n: levels_of([place[2] for place, _ in sources[n]]) for n in names}
    top = levels_of([trees[n][-1][0] for n in names])
    for k, name in enumerate(names):
        for at, ((*_, leaf), r) in enumerate(sources[name]):
            witness = siblings(trees[name], at) + siblings(top, k)
            even = zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 2 == 0
            node = leaf_of(r, r.text.replace("\n", "") if even and r.text else r.text)
            for left, right in witness:
                node = sha(left + node + right)
            yield (r.doc_id, leaf, trees[name][-1][0], top[-1][0], sha("".join(a + b for a, b in witness)), node,
                   node == top[-1][0])


def test_manifest_query_equals_a_whole_tree(spark, docs):
    found = QUERIES["op12_merkle_manifest"](spark, DATA).collect()
    assert ordered(found) == ordered(brute_manifest(docs.collect()))
    assert {r.verified for r in found} == {True, False}


@pytest.mark.parametrize("levels", [1, 2])
def test_blocks_of_any_height_make_the_same_tree(spark, odd, levels):
    rng = random.Random(levels)
    many = [(rng.choice([None, *range(300)]), rng.choice(["a\nb", None, "", "x"]), None, rng.choice(["hot"] * 6 + [None, "", "é", "z"]), 3)
            for _ in range(200)]
    for table in (odd, spark.createDataFrame(many, DOCUMENTS).repartition(7)):
        leaf = merkle.leaf_digest(*map(F.col, ("doc_id", "source", "lang", "n_chars", "text")))
        made = merkle.merkle_manifest(table, leaf, levels)
        found = made.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("witness")),
                            merkle.folded_root(F.col("leaf"), F.col("witness"))).collect()
        expected = [(*r[:5], r[3]) for r in brute_manifest(table.collect())]  # unchanged leaves fold to the root
        assert ordered(found) == ordered(expected)


@pytest.mark.parametrize("leaves", [1, 2, 3, 4, 8, 9, 10, 27, 28, 80])
def test_a_stream_knows_each_witness_when_it_closes(leaves):
    digests = [sha(str(k)) for k in range(leaves)]
    stream = merkle.WitnessStream()
    for digest in digests:
        stream.append(digest)
    levels = levels_of(digests)
    assert merkle.tree_height(leaves) == len(levels) - 1
    assert stream.close(merkle.tree_height(leaves)) == levels[-1][0]
    assert stream.witnesses == [siblings(levels, k) for k in range(leaves)]


def test_witnesses_grow_with_the_stream():
    stream = merkle.WitnessStream()
    grown = []
    for k in range(9):
        stream.append(sha(str(k)))
        grown.append(len(stream.witnesses[0]))
    assert grown == [0, 0, 1, 1, 1, 1, 1, 1, 2]


def test_manifests_of_one_and_of_no_document(spark):
    leaf = merkle.leaf_digest(F.col("doc_id"), F.col("text"))
    assert merkle.merkle_manifest(spark.createDataFrame([], DOCUMENTS), leaf).collect() == []
    (row,) = merkle.merkle_manifest(spark.createDataFrame([(1, "t", None, None, None)], DOCUMENTS), leaf).collect()
    assert row.leaf == row.subroot == row.root == sha("1:11:t") and row.witness == [] and row.source is None


# --- compression bands ---

def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    duplicates = sum(x in lines[:k] for k, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_equal_plain_ones(spark, docs, odd):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice("ab \n\t#|é ") for _ in range(rng.randrange(120))), None, None, None) for k in range(500)]
    few = docs.filter("n_chars < 20000")
    for table in (few, odd.filter("length(text) < 1000 or text is null"), spark.createDataFrame(rows, DOCUMENTS)):
        found = compression.compression_rules(table).select("doc_id", *COUNTS).collect()
        assert ordered(found) == ordered((r.doc_id, *brute_counts(r.text)) for r in table.collect())


def test_ratios_and_verdicts_follow_the_bands(spark, docs):
    for r in compression.compression_rules(docs).collect():
        data = r.text.encode()
        ratio = len(data) / len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(data))
        assert r.ratio == pytest.approx(ratio, abs=1e-12)
        band = [b for b in compression.BANDS if b.from_bytes <= len(data)][-1]
        outside = "repetitive" if ratio > band.highest else "incompressible" if ratio < band.lowest else None
        assert outside is None or r.verdict == outside
        assert r.kept == (not r.base_failed and r.verdict == "ordinary")


def prose(rng, count):
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(4000)]
    return " ".join(rng.choice(vocabulary) for _ in range(count))


def test_noise_repetition_and_hidden_stretches_are_rejected(spark):
    rng = random.Random(6)
    noise = base64.b64encode(rng.randbytes(30_000)).decode()
    noise = " ".join(noise[k:k + 60] for k in range(0, len(noise), 60))
    texts = {
        "ordinary": [prose(rng, 60), prose(rng, 800), prose(rng, 60_000)],
        "incompressible": [noise, noise[:6000]],
        "repetitive": ["\n".join(f"item {k} was not found" for k in range(900)), prose(rng, 20) * 50],
        "uneven": [prose(rng, 3000) + "\n" + noise[:9000]],
        "empty": ["", None]}
    rows = [(k, text, verdict) for verdict, some in texts.items() for k, text in enumerate(some)]
    judged = compression.compression_rules(spark.createDataFrame(rows, "doc_id long, text string, expected string"))
    for r in judged.collect():
        assert r.verdict == r.expected, (r.expected, r.doc_id, r.ratio, r.bad_share)
        assert r.kept == (r.verdict == "ordinary")
    assert all(r.bad_share == 1.0 for r in judged.filter("verdict = 'repetitive'").collect())


def test_chunks_hold_every_byte():
    for size in (0, 1, 4095, 4096, 4097, 6143, 6144, 8192, 10_239, 10_240, 50_001):
        parts = compression.chunks(b"x" * size)
        assert sum(map(len, parts)) == size and all(2048 <= len(p) < 6144 for p in parts[1:] or [b"x" * 2048])


def test_other_columns_stay_and_made_ones_are_replaced(spark, odd):
    judged = compression.compression_rules(odd)
    made = [name for name, _ in compression.MADE]
    assert judged.columns == [c for c in odd.columns if c not in made] + made
    assert judged.count() == len(ODD) and {r["a.b"] for r in judged.collect()} == {"clash"}
    assert compression.compression_rules(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_compression_query_judges_every_document(spark, docs):
    rows = QUERIES["op13_compression_bands"](spark, DATA).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert not any(r.kept and r.base_failed for r in rows) and any(r.kept for r in rows)

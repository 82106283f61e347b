import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tapwise.llm import decontaminate, language, line_templates, ngram_join, packing, quality, shingles, token_files, tokens
from tapwise.llm.keys import with_key
from tapwise.llm.queries import QUERIES, held_out, tokenizer_path
from tapwise.llm.tokens import PieceEncoder, encoder

DATA = "/root/testdata/sf0.001"
EMPTY = "doc_id long, text string"
#: nulls in each column, empty, blank, one word, a repeated row, an id used twice, no letters, long words
ODD = [(None, "lonely text without any id at all"), (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "12 34 -- !!"),
       (6, "same row here twice"), (6, "same row here twice"), (7, "first of the id seven"), (7, "second text, same id"),
       (8, "x" * 5000 + " " + "y" * 5000), (9, "tab\tand\x1cother spaces  \n\n here ")]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(tokenizer_path())
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 1.0) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double").repartition(3)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# --- tokens ---

def test_pieces_encode_like_whole_texts(tokenizer):
    rng = random.Random(3)
    letters = "\t\x1c\xa0\r \n.,'aÉz9!ß-sé中"
    known = PieceEncoder(tokenizer_path(), memory=50)  # small enough to be emptied
    texts = ["", " a", "it's 12,5.a .b", "<|endoftext|> x", "a\n\n b"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(known.encode(text), "<u2").tolist() == ids_of(tokenizer, text), repr(text)


def test_added_tokens_are_encoded_as_the_loaded_tokenizer_does():
    untouched = Tokenizer.from_file(tokenizer_path())
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "a <|endoftext| > b", "it's 12,5"):
        ids = np.frombuffer(encoder(tokenizer_path()).encode(text), "<u2").tolist()
        assert ids == ids_of(untouched, text), text


def test_texts_are_encoded_together_as_one_by_one(monkeypatch):
    """Any mix of white space, signs, digits and added tokens, in slices of a few bytes and after the memory was emptied."""
    rng = random.Random(5)
    untouched = Tokenizer.from_file(tokenizer_path())
    parts = [" ", "  ", "   ", "\n", "\n\n", " \n", "\t", "\x1c", "\x1e", "\xa0", "\u3000", ".", ",", "...", "'", "'s", "'ll", "%%", "(", ")",
             "a", "It", "word", "\u00e9t\u00e9", "\u4e2d", "e\u0301", "\u00b2", "7", "2024", "\x00", "\U0001f600", "<|endoftext|>"]
    texts = [None, "", " ", "  ", "\n", "\n\n", "a  ", "  a", "a \n", "a\n\n\n b", "x" * 500 + " y", "it's 12,5.a .b", "\x1e", " \x1e\n"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    known = PieceEncoder(tokenizer_path(), memory=50, added_tokens=True)
    expected = [untouched.encode(t or "", add_special_tokens=False).ids for t in texts]
    for size in (1, 64, 1 << 20):
        monkeypatch.setattr(tokens, "SLICE_BYTES", size)
        assert [np.frombuffer(ids, "<u2").tolist() for ids in known.encode_all(pa.array(texts, pa.string()))] == expected
    assert [*known.encode_all(pa.array(["of another batch", "of this"])[1:])] == [known.encode("of this")]
    assert [*known.encode_all(pa.array([], pa.string()))] == []


def test_words_of_a_batch_are_looked_up_once(monkeypatch):
    """The cost of words goes by distinct ones: neither white space around a word nor signs behind it make it another."""
    asked = []
    monkeypatch.setattr(PieceEncoder, "__getitem__", lambda self, piece: asked.append(piece) or dict.__getitem__(self, piece),
                        raising=False)
    known = encoder(tokenizer_path())
    texts = [f"start one two, one two. one (two) {'one two; ' * 50}one\none\ntwo" for _ in range(200)]
    for mixed in (texts, [f"{t}\n\n\n    one\n    two  " for t in texts]):  # runs of white space take no other way
        asked.clear()
        assert len([*known.encode_all(pa.array(mixed))]) == 200
        assert len(asked) < len(texts)


def test_token_file_query(spark, docs, tokenizer):
    rows = {r.doc_id: r for r in QUERIES["op8_token_files"](spark, DATA).collect()}
    start = 0
    for r in docs.orderBy("doc_id").collect():
        ids = ids_of(tokenizer, r.text) + [2]
        assert (rows[r.doc_id].start, rows[r.doc_id].n_tokens, rows[r.doc_id].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(rows) == docs.count()


def test_token_files_of_odd_rows_and_single_reads(spark, odd, tokenizer, tmp_path):
    token_files.write_token_files(odd, str(tmp_path / "f"), tokenizer_path(), 2)
    found = token_files.read_token_files(spark, str(tmp_path / "f")).collect()
    expected = sorted(((i is not None, i or 0, t or ""), ids_of(tokenizer, t) + [2]) for i, t in ODD)
    assert len(found) == len(ODD)
    by_start = sorted(found, key=lambda r: r.start)
    assert [np.frombuffer(bytes(r.ids), "<u4").tolist() for r in by_start] == [ids for _, ids in expected]
    assert token_files.read_document(spark, str(tmp_path / "f"), 7) == [
        ids for (_, i, _), ids in expected if i == 7]


def test_token_files_of_no_documents(spark, tmp_path):
    token_files.write_token_files(spark.createDataFrame([], EMPTY), str(tmp_path / "f"), tokenizer_path(), 2)
    assert token_files.read_token_files(spark, str(tmp_path / "f")).collect() == []


def test_shared_dictionary_is_used(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    token_files.write_token_files(docs, str(tmp_path / "f"), tokenizer_path(), 2)
    used = spark.read.parquet(str(tmp_path / "f" / "shards")).select("dictionary").distinct().collect()
    assert len(used) == 1 and used[0][0] != 0


# --- packing ---

def test_hilbert_curve_visits_neighbours():
    for dimensions, bits in ((2, 4), (3, 3)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dimensions)).reshape(dimensions, -1).T
        keys = packing.hilbert_key(cells, bits)
        assert sorted(keys) == list(range(len(keys)))
        assert set(np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)) == {1}


@pytest.mark.parametrize("which", ["docs", "odd", "empty"])
def test_pieces_cover_each_document_once(spark, docs, odd, tokenizer, which):
    source = {"docs": docs, "odd": odd, "empty": spark.createDataFrame([], EMPTY)}[which]
    pieces = packing.pack_along_curve(source, tokenizer_path()).collect()
    texts = Counter((r.doc_id, tuple(ids_of(tokenizer, r.text) + [1])) for r in source.collect())
    by_place = sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    expected = 0
    for piece in by_place:  # gapless: every sequence but the last is full
        assert piece.sequence_id * 2048 + piece.offset == expected and piece.offset + piece.length <= 2048
        expected += piece.length
    assert expected == sum(len(ids) * n for (_, ids), n in texts.items())
    whole, found = defaultdict(list), Counter()
    for piece in by_place:  # the pieces of a document follow one another
        assert (piece.start == 0) == (not whole[piece.doc_id])
        whole[piece.doc_id] += np.frombuffer(bytes(piece.ids), "<u4").tolist()
        if len(whole[piece.doc_id]) == piece.doc_tokens:
            found[(piece.doc_id, tuple(whole.pop(piece.doc_id)))] += 1
    assert found == texts


# --- language ---

def phrases(text, sample):
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


def text_of(code):
    return "".join(map(chr, code.tolist()))


def test_phrase_counts_against_brute_force():
    rng = random.Random(1)
    symbols = language.Symbols()
    sample = "".join(rng.choice("abc ") for _ in range(400))
    table = language.suffix_automaton(symbols.of(sample))
    texts = ["".join(rng.choice("abcdж ") for _ in range(rng.randrange(0, 250))) for _ in range(60)]
    codes = [symbols.of(t) for t in texts]
    coded = text_of(symbols.of(sample))
    assert language.phrase_counts(codes, table).tolist() == [phrases(text_of(c), coded) for c in codes]


def test_languages_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op10_language_id"](spark, folder).join(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    tested = [r for r in found if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in tested]) >= 0.98 and all(0 <= r.score <= 1 for r in found)


def test_languages_of_odd_rows(spark, odd, docs):
    samples = language.learn_languages(docs)
    rows = language.identify_languages(odd, samples).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3, 5}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.lang_pred for r in language.identify_languages(odd, {}).collect()} == {"und"}
    assert language.identify_languages(spark.createDataFrame([], EMPTY), samples).count() == 0
    assert language.learn_languages(spark.createDataFrame([], EMPTY + ", lang string")) == {}
    kept = language.in_known_language(odd, samples)
    assert kept.columns == odd.columns and {r.lang_pred for r in kept.collect()} == {"clash"}


#: letters of six scripts, of which words are made; the fixed values only have to differ between scripts
SCRIPTS = {"latin": (0x61, 26), "cyrillic": (0x430, 32), "greek": (0x3B1, 24), "georgian": (0x10D0, 33),
           "hebrew": (0x5D0, 27), "han": (0x4E00, 3000)}


def words_in(script, rng, count, known):
    """Words of a vocabulary of 150 made by the script's own generator, the frequent ones first."""
    first, letters = SCRIPTS[script]
    own = random.Random(script)
    words = ["".join(chr(first + own.randrange(letters)) for _ in range(own.randrange(2, 8))) for _ in range(150)]
    return " ".join(words[min(int(rng.expovariate(0.03)), known - 1)] for _ in range(count))


def test_scripts_are_told_apart_and_others_rejected(spark):
    rng = random.Random(5)
    learned = [s for s in SCRIPTS if s != "georgian"]
    rows = [(n, words_in(s, rng, 300, 150), s) for s in learned for n in range(30)]
    # a label of one document, and one that stands on very long documents only
    rows += [(900, words_in("georgian", rng, 250, 150).upper().lower(), "rare"),
             (901, " ".join(["bdf", "gkm", "ztr", "pvw"][rng.randrange(4)] for _ in range(20_000)), "long")]
    samples = language.learn_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(samples) == {*learned, "rare", "long"} and 1_000 < len(samples["long"]) <= language.PIECE + 1
    texts = [(s, words_in(s, rng, 80, 150)) for s in [*learned, "georgian"] for _ in range(6)]
    texts += [("long", "ztr bdf pvw gkm " * 30)]
    strange = [("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + " " * (rng.random() < 0.2) for _ in range(900))),
               "".join(chr(0xF40 + rng.randrange(40)) + " " * (rng.random() < 0.2) for _ in range(900))]
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], EMPTY)
    found = {r.doc_id: r for r in language.identify_languages(frame, samples).collect()}
    expected = ["rare" if s == "georgian" else s for s, _ in texts]
    assert [found[i].lang_pred for i in range(len(texts))] == expected
    assert all(found[i].explained for i, name in enumerate(expected))
    odd = spark.createDataFrame(list(enumerate(strange)), EMPTY)
    assert language.in_known_language(odd, samples).count() == 0


# --- n-gram join ---

def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def gram_set(text, n):
    words = words_of(text)
    return frozenset(zip(*[words[k:] for k in range(n)])) or (frozenset([tuple(words)]) if words else frozenset())


def brute_components(rows, n, percent):
    sets = [gram_set(t, n) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    smallest = defaultdict(list)
    for at, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(at)].append(doc_id)
    return Counter((i, len(s), min(smallest[root(at)], default=None)) for at, ((i, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("n,percent,pivots", [(3, 90, 0), (3, 90, 3), (5, 80, 1)])
def test_components_against_brute_force(spark, docs, n, percent, pivots):
    rng = random.Random(4)
    base = [f"w{rng.randrange(60)}" for _ in range(90)]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(i and i + 10_000, t) for i, t in ODD]
    for k in range(60):  # one large group of near copies that chain
        near = list(base)
        for _ in range(rng.randrange(3)):
            near[rng.randrange(90)] = f"v{rng.randrange(200)}"
        rows.append((20_000 + k, " ".join(near)))
    df = spark.createDataFrame(rows, EMPTY).repartition(5)
    found = ngram_join.link_components(df, n, percent, pivots).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows, n, percent)


def test_one_of_each_component_stays(spark, odd):
    copies = [(100 + k, "a b c d e f g h i j" + (" k" if k == 3 else "")) for k in range(5)]
    df = odd.union(spark.createDataFrame([(i, t, "clash", 1.0) for i, t in copies], odd.schema))
    kept = ngram_join.keep_one_of_each(df, 5, 80)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        (i is not None, i or 0, t or "") for i, t in {*ODD, copies[0]})


def test_no_documents_no_components(spark):
    empty = spark.createDataFrame([], EMPTY)
    assert ngram_join.link_components(empty).count() == 0 and ngram_join.keep_one_of_each(empty).count() == 0


def test_word_hashes_tell_words_apart():
    words = [f"{a}{b}" for a in "abcdeé" for b in range(500)]
    found, lengths = shingles.word_hashes(" ".join(words) + "\n" + " ".join(words).upper().replace("É", "é"))
    assert len(set(found.tolist())) == len(words) and found[:len(words)].tolist() == found[len(words):].tolist()
    assert lengths[0] == 2


# --- decontamination ---

def brute_contaminated(text, items):
    words = [w for w in re.split(r"[^\w]+|_+", (text or "").lower()) if w]
    for item in items:
        size = min(decontaminate.WINDOW, len(item))
        for a in range(len(item) - size + 1):
            for b in range(len(words) - size + 1):
                if 100 * sum(x == y for x, y in zip(item[a:a + size], words[b:b + size])) >= 80 * size:
                    return True
    return False


def test_contamination_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(k, [word() for _ in range(40)]) for k in range(6)]
    rows = []
    for k in range(60):
        filler = [word() for _ in range(rng.randrange(10, 80))]
        if k % 3 == 0:  # a passage with one word in ten replaced
            passage = list(items[k % 6][1])
            for at in range(k % 10, 40, 10):
                passage[at] = word()
            filler[5:5] = passage
        rows.append((k, ", ".join(filler).title()))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(None, None), (9, "too short")],
                                      "item_id long, text string")
    df = spark.createDataFrame(rows + ODD, EMPTY).repartition(4)
    found = decontaminate.flag_contaminated(df, benchmark).collect()
    assert len(found) == len(rows) + len(ODD)
    expected = {i for i, t in rows if brute_contaminated(t, [w for _, w in items])}
    assert {r.doc_id for r in found if r.contaminated} == expected and len(expected) == 20
    clean = decontaminate.without_contaminated(df.withColumn("seed", df.doc_id), benchmark)
    assert clean.columns == ["doc_id", "text", "seed"] and clean.count() == len(found) - 20


def test_masks_meet_every_overlap():
    for size in range(1, decontaminate.WINDOW + 1):
        masks = decontaminate.masks_of(size)
        for other in combinations(range(size), size - -(-size * decontaminate.PERCENT // 100)):
            assert any(all(c == "0" or at + k not in other for k, c in enumerate(m))
                       for m in masks for at in range(size - len(m) + 1)), (size, other)


def test_short_passages_at_every_place_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(k, [word() for _ in range(1 + k % 16)]) for k in range(64)]
    rows = []
    for k in range(640):  # both parities, up to a quarter of the words replaced
        passage = list(items[k % 64][1])
        for at in rng.sample(range(len(passage)), rng.randrange(len(passage) // 4 + 1)):
            passage[at] = word()
        filler = [word() for _ in range(30)]
        filler[5 + k // 64:5 + k // 64] = passage
        rows.append((k, " ".join(filler)))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = decontaminate.flag_contaminated(spark.createDataFrame(rows, EMPTY), benchmark, least_words=1).collect()
    expected = {i for i, t in rows if brute_contaminated(t, [w for _, w in items])}
    assert {r.doc_id for r in found if r.contaminated} == expected and 400 < len(expected) < 640
    found = decontaminate.flag_contaminated(spark.createDataFrame(rows, EMPTY), benchmark).collect()
    expected = {i for i, t in rows if brute_contaminated(t, [w for _, w in items if len(w) >= decontaminate.LEAST_WORDS])}
    assert {r.doc_id for r in found if r.contaminated} == expected and 300 < len(expected) < 520


def test_overlaps_lie_within_the_text(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(k, [word() for _ in range(20)]) for k in range(3)]
    filler = [word() for _ in range(30)]
    rows = []
    for left_out in range(14):  # what is left of an item at the very beginning and end of a text, or alone
        for at, text in enumerate(([*items[0][1][left_out:], *filler], [*filler, *items[1][1][:20 - left_out]],
                                   items[2][1][left_out:], items[2][1][:20 - left_out])):
            rows.append((left_out * 10 + at, " ".join(text)))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = decontaminate.flag_contaminated(spark.createDataFrame(rows, EMPTY), benchmark).collect()
    expected = {i for i, t in rows if brute_contaminated(t, [w for _, w in items])}
    assert {r.doc_id for r in found if r.contaminated} == expected
    assert {i for i in expected if i % 10 == 2} == {k * 10 + 2 for k in range(8)}  # 13 words or more


def test_items_without_id_and_of_equal_id_are_searched_for(spark):
    passages = [" ".join(f"w{k}x{j}" for j in range(20)) for k in range(3)]
    benchmark = spark.createDataFrame(
        [(None, passages[0]), (7, passages[1]), (7, passages[2]), (7, passages[2]), (8, "yes"), (9, None), (10, " ")],
        "item_id long, text string")
    rows = [(k, f"before {p} after yes") for k, p in enumerate(passages)] + [(3, "yes and nothing else")]
    found = {r.doc_id: (r.contaminated, r.n_items, r.item_id) for r in decontaminate.flag_contaminated(
        spark.createDataFrame(rows, EMPTY), benchmark).collect()}
    assert found == {0: (True, 1, None), 1: (True, 1, 7), 2: (True, 1, 7), 3: (False, 0, None)}
    short = decontaminate.short_items(benchmark)
    assert sorted((r.item_id, r.n_words) for r in short.collect()) == [(8, 1), (9, 0), (10, 0)]


def test_names_with_a_dot_go_through_the_pipeline_stages(spark):
    rows = spark.createDataFrame([(1, "some words that are only here", "x"), (2, None, "y")], EMPTY + ", `a.b` string")
    none = spark.createDataFrame([], "item_id long, text string")
    for kept in (ngram_join.keep_one_of_each(rows), decontaminate.without_contaminated(rows, none),
                 line_templates.without_recurring_lines(rows).drop("n_lines", "n_dropped"),
                 language.in_known_language(rows, {"en": "some words that are only here " * 9}, 99.0)):
        assert kept.columns == ["doc_id", "text", "a.b"]
        assert {r["a.b"] for r in kept.collect()} <= {"x", "y"} and kept.filter("doc_id = 1").first()["a.b"] == "x"


def test_long_pieces_are_not_remembered(tokenizer):
    known = PieceEncoder(tokenizer_path())
    text = "x" * 5000 + " " + "word " * 3 + "y" * 100
    assert np.frombuffer(known.encode(text), "<u2").tolist() == ids_of(tokenizer, text)
    assert max(map(len, known)) <= 64


def test_phrases_are_counted_alike_in_any_slices(monkeypatch):
    rng = np.random.default_rng(1)
    table = language.suffix_automaton(rng.integers(0, 9, 500).astype(np.int32))
    codes = [rng.integers(0, 12, n).astype(np.int32) for n in (0, 1, 255, 256, 257, 3000, 0, 9)]
    whole = language.phrase_counts(codes, table).tolist()
    monkeypatch.setattr(language, "LANES", 3)
    assert language.phrase_counts(codes, table).tolist() == whole


def test_nothing_to_decontaminate(spark, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.flag_contaminated(odd, none).filter("contaminated").count() == 0
    assert decontaminate.flag_contaminated(spark.createDataFrame([], EMPTY), none).count() == 0


# --- line templates ---

def brute_lines(rows):
    """Exact templates only, as none of the leaves below has a second one."""
    def mask(line):
        return " ".join("<*>" if re.search("[0-9]", t) else t for t in line.split())

    def is_template(line):
        return len(mask(line).split()) >= line_templates.MIN_TOKENS

    homes = defaultdict(set)
    for at, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if is_template(line):
                homes[mask(line)].add(at)
    order = lambda at: (rows[at][0] is None, rows[at][0] or 0)
    first = {m: min(h, key=order) for m, h in homes.items() if len(h) >= line_templates.MIN_DOCUMENTS}
    return Counter(
        (i, t and "\n".join(x for x in t.split("\n") if not is_template(x) or first.get(mask(x), at) == at))
        for at, (i, t) in enumerate(rows))


def test_recurring_lines_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(k, "\n".join([" ".join(f"{rng.choice('abc')}{rng.choice('xyz')}q{'' if rng.random() < .9 else 7}{c}"
                                    for c in "klmnop"[:rng.randrange(2, 7)]) for _ in range(4)]
                          + ["All pages are free here", f"Page {k} of 90 is next", "Thank you"][:rng.randrange(4)]))
            for k in range(40)]
    found = line_templates.drop_recurring_lines(spark.createDataFrame(rows + ODD, EMPTY).repartition(4)).collect()
    assert Counter((r.doc_id, r.text) for r in found) == brute_lines(rows + ODD)
    assert any(r.n_dropped for r in found)


def test_variable_fields_are_generalised(spark):
    names = ["anna", "bertil", "cesar", "david", "erik", "filip"]
    rows = [(k, f"some words of number {n} only\nThis page was made by {n} for all of us") for k, n in enumerate(names)]
    rows += [(50 + k, f"This page was never seen in {n} nor {n} before {n}") for k, n in enumerate("xyz")]
    found = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, EMPTY)).collect()}
    assert "made by anna" in found[0]  # the first document keeps it
    assert not any("made by" in found[k] for k in range(1, 6))
    assert line_templates.drop_recurring_lines(spark.createDataFrame([], EMPTY)).count() == 0


def test_short_lines_recur(spark):
    rows = [(k, f"own words of {k}{k}x\nAll rights reserved.\n\n今日は良い天気ですね\n{k}\n第{k}回です\nEnd") for k in range(4)]
    found = {r.doc_id: r.text.split("\n") for r in line_templates.drop_recurring_lines(
        spark.createDataFrame(rows, EMPTY)).collect()}
    assert found[0] == rows[0][1].split("\n")
    for k in range(1, 4):  # numbers, and lines without spaces that hold one, are no fields of one another
        assert not {"All rights reserved.", "今日は良い天気ですね", "End"} & set(found[k])
        assert {"", f"{k}", f"第{k}回です"} <= set(found[k])


def test_lines_of_two_documents_recur(spark):
    line = " ".join(f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz" * 2)
    rows = [(1, f"one\n{line}"), (2, f"two\n{line}\nmore"), (3, "a line with one field anna"), (4, "a line with one field bert")]
    found = line_templates.drop_recurring_lines(spark.createDataFrame(rows, EMPTY)).collect()
    assert {r.doc_id: r.text for r in found} == {**dict(rows), 2: "two\nmore"}


def test_several_templates_in_one_leaf(spark):
    names = ["anna", "bertil", "cesar", "david"]
    made = ["This page was made by {} for all of us", "This page was last seen in {} on a monday",
            "This page was lost when {} went home again today"]
    rows = [(10 * j + k, m.format(n)) for j, m in enumerate(made) for k, n in enumerate(names)]
    own = [(50 + k, "This page was " + " ".join(f"w{c}{'xyz'[k]}" for c in "abcdefg")) for k in range(3)]
    found = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(
        spark.createDataFrame(rows + own, EMPTY)).collect()}
    assert {i for i, t in found.items() if t} == {0, 10, 20, 50, 51, 52}


def test_other_columns_stay(spark, odd):
    df = odd.withColumn("n_lines", odd.score)
    kept = line_templates.without_recurring_lines(df)
    assert kept.columns == ["doc_id", "text", "lang_pred", "score", "n_lines", "n_dropped"]
    assert kept.count() == len(ODD) and kept.filter("lang_pred != 'clash'").count() == 0


# --- quality ---

def test_quality_against_hand_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op3_quality"](spark, folder).collect()]
    good = [r.keep for r in rows if labels.get(r.doc_id) == 1]
    bad = [r.keep for r in rows if labels.get(r.doc_id) == 0]
    assert len(rows) == 10_000 and np.mean(good) > 0.98 and np.mean(bad) < 0.3


def test_accuracies_are_recovered():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.85
    hit = np.array([0.9, 0.6, 0.5, 0.7, 0.4, 0.6, 0.8, 0.5])
    codes = Counter()
    for good in truth:
        vote = np.where(rng.random(8) < (0.97 if good else hit), 2 if good else 1, 1 if good else 2)
        codes[int(sum(int(v) * 3 ** j for j, v in enumerate(vote)))] += 1
    share, accuracy, _ = quality.estimate_accuracies(codes)
    assert share == pytest.approx(0.85, abs=0.02)
    assert accuracy[0] == pytest.approx(hit, abs=0.05) and accuracy[1] == pytest.approx(np.full(8, 0.97), abs=0.02)


def test_quality_of_odd_rows(spark, odd):
    rows = quality.score_quality(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ODD)
    assert all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 and len(r.votes) == len(quality.LABELLERS) for r in rows)
    assert quality.score_quality(spark.createDataFrame([], EMPTY)).count() == 0


def test_keys_do_not_depend_on_partitioning(spark, odd):
    one, other = (sorted(map(str, with_key(d).collect())) for d in (odd, odd.repartition(7)))
    assert one == other
    assert math.isclose(odd.filter(held_out()).count(), sum(zlib.crc32(str(i if i is not None else "").encode()) % 5 == 0
                                                           for i, _ in ODD))


def test_tokenizer_files_are_read_from_their_package():
    assert tokenizer_path() == public_tokenizers.path("byte_bpe_50k.json")

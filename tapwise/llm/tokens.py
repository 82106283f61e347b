"""Token ids of whole texts by a byte-level tokenizer, with a bounded memory of pieces already encoded."""

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

MEMORY_PIECES = 600_000
LONGEST_PIECE = 64  # characters of a piece that is remembered, so that the memory has a bound in bytes too
SLICE_BYTES = 8 << 20  # text that is split and looked up in one go

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# fixed values: the Unicode white space that tokenizers cut at; Python's own has four control characters more
_SPACE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SIGNS = "!-/:-@\\[-`{-~"  # ASCII without controls, white space, digits and letters
_pieces = re.compile(
    rf" ?(?:[{_LETTERS}]++|[0-9]++)(?=[\0-\x7f]|\Z)"
    rf"|(?!') ?[{_SIGNS}]++(?=[\t-\r 0-9A-Za-z]|\Z)"
    rf"|\n(?=[^{_SPACE}])|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+").findall
_one_word = re.compile(rf" ?[{_LETTERS}]+|[.,]+").fullmatch
# a space or newline amid white space, or behind some at the end: only there no cut may be made before it
_INNER_SPACE = rf"[{_SPACE}][ \n](?:[{_SPACE}]|\z)"
_CUT = "\x1e"  # marks the cuts; texts that hold it are not cut this way
_PROBE = "A sonda, été.\nZwei  Wörter\n\n 12,5! f(x)='it's' 2nd+x27 (a)"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself where it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in prints]
    return {b: chr(b) if b in prints else chr(256 + hidden.index(b)) for b in range(256)}


class PieceEncoder(dict):
    """Encodes texts piece by piece; the dict holds the packed ids of pieces met before.

    A byte-level tokenizer never joins a word to the white space behind it, nor letters, digits and signs of ASCII
    to one another but for an apostrophe before letters, so a text may be cut there and the pieces encoded apart.
    Words repeat, so at most `memory` pieces of LONGEST_PIECE characters or less are remembered. Null is the empty text.

    With `added_tokens` the ids are those of the tokenizer as it is loaded: the text of an added token, such as
    <|endoftext|>, is that token, and texts that hold one are encoded whole. Without, it is ordinary text.
    """

    def __init__(self, path: str, memory: int = MEMORY_PIECES, added_tokens: bool = False):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a worker per core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        self._added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.type = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.memory, self._letters, self._tokenize = memory, _byte_letters(), self.tokenizer.model.tokenize
        self._ids = [self._packed([i]) for i in range(self.tokenizer.get_vocab_size())]
        if self.encode(_PROBE) != self._whole(_PROBE):
            raise ValueError(f"{path} is no byte-level tokenizer whose words may be encoded apart")

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.type).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> bytes:
        if _one_word(piece):  # a single unit of the vocabulary: nothing is left to cut
            plain = piece.isascii()
            letters = piece.replace(" ", "\u0120") if plain else piece.encode().decode("latin-1").translate(self._letters)
            ids = b"".join([self._ids[t.id] for t in self._tokenize(letters)])
        elif len(parts := _pieces(piece)) > 1:
            ids = b"".join(map(self.__getitem__, parts))
        else:
            ids = self._whole(piece)
        if len(piece) <= LONGEST_PIECE:
            if len(self) >= self.memory:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as packed integers of `self.type`."""
        if not text:
            return b""
        if any(token in text for token in self._added):
            return self._whole(text)
        return b"".join(map(self.__getitem__, _pieces(text)))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as `encode` gives them, at a lower cost: SLICE_BYTES of text or one text at a time."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        begin, done = 0, 0
        while begin < len(texts):
            end = max(begin + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
            yield from self._encode_slice(pc.fill_null(texts[begin:end], ""))
            begin, done = end, ends[end - 1]

    def _encode_slice(self, texts: pa.Array) -> Iterator[bytes]:
        """Texts are cut before spaces, newlines and signs, and each word is looked up once; others go one by one."""
        alone = pc.match_substring(texts, _CUT)
        for token in self._added:
            alone = pc.or_(alone, pc.match_substring(texts, token))
        cut = pc.if_else(alone, "", texts)
        runs = pc.match_substring_regex(cut, _INNER_SPACE)
        plain, spread = pc.if_else(runs, "", cut), pc.if_else(runs, cut, "")
        for space in " \n":
            plain = pc.replace_substring(plain, space, _CUT + space)
        # of a run of white space the first is cut from the word before, and the last goes with the word behind
        for where in (f"([^{_SPACE}])([ \n])", f"([{_SPACE}])([ \n][^{_SPACE}])"):
            spread = pc.replace_substring_regex(spread, where, rf"\1{_CUT}\2")
        marked = pc.replace_substring_regex(
            pc.if_else(runs, spread, plain), f"([{_LETTERS}0-9])([{_SIGNS}])", rf"\1{_CUT}\2")
        words = pc.split_pattern(marked, _CUT)
        bounds, words = words.offsets.to_numpy(), words.values.dictionary_encode()
        known = [self[w] for w in words.dictionary.to_numpy(False).tolist()]
        _, offsets, packed = pa.array(known, pa.large_binary()).take(words.indices).buffers()
        cuts = np.frombuffer(offsets, np.int64)[bounds].tolist()
        packed = memoryview(packed or b"")
        for begin, end, text, apart in zip(cuts, cuts[1:], texts, alone.to_pylist()):
            yield self.encode(text.as_py()) if apart else bytes(packed[begin:end])


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of this Python process, whose memory serves all its tasks."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path, added_tokens=True)
    return _encoders[path]

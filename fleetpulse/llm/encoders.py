"""Whole-text encoding with a public tokenizer, piece by piece.

Both vocabularies used here split a text before any merge, and these places
are always such splits: a lone space or line feed between two non-space
characters, and the place between a letter or digit and a following ASCII
punctuation mark other than the apostrophe.  Pieces between those points are
encoded by the tokenizers library once and kept in a bounded cache; a text's
ids are its pieces' ids in order, which equals encoding the whole text (tests
compare the two on odd and random texts).
"""

from __future__ import annotations

import os
import re
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: RE2: white space other than lone spaces and line feeds inside the text, a
#: zero byte, or a full stop or comma that doesn't follow a letter or digit.
_ODD = (r"[\x{00}-\x{09}\x{0b}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
        r"|[ \n][ \n]|\A[ \n]|[ \n]\z|\A[.,]|[^\pL\pN][.,]")
#: The certain split points of any text.
_CUT = re.compile(r"(?<=\S)(?= \S)|(?<=[^\W_])(?=[.,!#$%&*|])")
#: A Latin word (with the space before it) and a run of marks after it.
_WORD_MARKS = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-į]+)([!#$%&*|.,]*)")
#: Bytes of text handled at once.
_BLOCK_BYTES = 4 << 20


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}


def _plain_pieces(texts: pa.Array) -> pa.ListArray:
    """Cut texts without odd places; a space stays with the piece after it."""
    for mark, cut in ((" ", "\x00 "), (",", "\x00,"), (".", "\x00."), ("\n", "\x00\n\x00")):
        texts = pc.replace_substring(texts, mark, cut)
    return pc.split_pattern(texts, "\x00")


class PieceEncoder:
    """Texts -> uint32 ids.

    ``cache_pieces`` bounds the cache's memory, not the result: a full cache
    is emptied and refilled.  A piece that is one Latin word goes straight to
    the tokenizer's merge model (no splitting is left to do); any other piece
    goes through the whole tokenizer.
    """

    def __init__(self, tokenizer_file: str, cache_pieces: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_file)
        self._tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self._model = self._tokenizer.model
        self._model._resize_cache(0)  # pieces are kept here instead
        normalizer = self._tokenizer.normalizer
        self._lower = normalizer is not None and normalizer.normalize_str("A") == "a"
        self._letters = byte_letters()
        self._cache: dict[str, bytes] = {}
        self._bound = cache_pieces

    @property
    def vocabulary(self) -> int:
        return self._tokenizer.get_vocab_size(with_added_tokens=True)

    def _one(self, piece: str) -> bytes:
        match = _WORD_MARKS.fullmatch(piece)
        if not match:
            return array("I", self._tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        word, marks = match.groups()
        word = word.strip(" ").lower() if self._lower else word
        if word.isascii():  # letters stand for themselves
            spelled = word.replace(" ", self._letters[32])
        else:
            spelled = word.encode().decode("latin-1").translate(self._letters)
        ids = [token.id for token in self._model.tokenize(spelled)]
        if marks:
            ids += self._tokenizer.encode(marks, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _codes(self, parts: list[str]) -> list[bytes]:
        cache = self._cache
        if len(cache) > self._bound:
            cache.clear()
        codes = []
        for piece in parts:
            code = cache.get(piece)
            if code is None:
                code = cache[piece] = self._one(piece)
            codes.append(code)
        return codes

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text of any shape."""
        return np.frombuffer(b"".join(self._codes(_CUT.split(text))) if text else b"", dtype="<u4")

    def _encode_plain(self, texts: pa.Array) -> list[np.ndarray]:
        cut = _plain_pieces(texts)
        coded = pc.dictionary_encode(cut.flatten())
        codes = self._codes(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        flat = np.frombuffer(b"".join(codes), dtype="<u4")
        begins = np.cumsum(lengths) - lengths
        which = coded.indices.to_numpy()
        each = lengths[which]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        shift = (begins[which] - (ends - each)).astype(np.int32)
        ids = flat.take(np.arange(total, dtype=np.int32) + np.repeat(shift, each))
        pieces_before = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        return np.split(ids, np.concatenate(([0], ends))[pieces_before[1:-1]])

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, in order, in blocks of bounded size."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.cumsum(np.maximum(pc.binary_length(texts).to_numpy(), 1))
        begin = 0
        while begin < len(texts):
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + _BLOCK_BYTES)))
            block = texts.slice(begin, end - begin)
            odd = pc.match_substring_regex(block, _ODD).to_numpy(zero_copy_only=False)
            odd |= pc.binary_length(block).to_numpy() == 0
            plain = iter(self._encode_plain(block.filter(pa.array(~odd))) if not odd.all() else [])
            for i, is_odd in enumerate(odd):
                yield self.encode(block[i].as_py()) if is_odd else next(plain)
            begin = end


def worker_encoder(tokenizer_file: str) -> PieceEncoder:
    """One encoder per Python worker and file; a worker runs many tasks."""
    kept = sys.modules.setdefault("_piece_encoders", types.ModuleType("_piece_encoders"))
    if tokenizer_file not in kept.__dict__:
        kept.__dict__[tokenizer_file] = PieceEncoder(tokenizer_file)
    return kept.__dict__[tokenizer_file]

"""Token ids of whole texts, many at a time, with a cache of the pieces that they are cut into.

The tokenizer's rules never join characters across white space (its normalizer turns runs of it into one space and its
pre-tokenizer drops it), nor letters, digits and signs with each other, but for an apostrophe and the letters after it; each digit
stands alone. So texts are cut there, bytes of ASCII and Latin-1 letters by a table of neighbours, and a text's ids are those
of its pieces, in order. The tokenizer lower-cases, so ASCII capitals are lowered first. A text that could hold a special token is
cut at white space only and keeps its capitals. Equal pieces of many texts are looked up once. A piece of one kind is one word
of the vocabulary's merges, and such words are merged many in a call; any other piece goes through the whole tokenizer.

The cache holds about CACHE bytes and the pieces of one call at most, and is emptied when larger and after each task; that changes
speed only. The path of the vocabulary file is a parameter and must exist on each worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE = 48 << 20
#: Bytes of texts that are encoded at once, or up to twice as many: more share their pieces, fewer need less memory (some 10 times as much).
TEXTS = 2 << 20
#: Words that are merged in one call.
WORDS = 500

_encoders: dict[str, Encoder] = {}


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_SPACE, _LETTER, _DIGIT, _SIGN, _APOSTROPHE, _OTHER = range(6)


def _kinds() -> np.ndarray:
    """The kind of each byte. Bytes of other characters than ASCII are _OTHER."""
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    kinds[33:127] = _SIGN
    kinds[list(b" \t\n\v\f\r")] = _SPACE
    kinds[[*range(65, 91), *range(97, 123)]] = _LETTER
    kinds[48:58] = _DIGIT
    kinds[39] = _APOSTROPHE
    return kinds


def _cuts() -> np.ndarray:
    """For the kinds of a byte and the next one (6 * kind + kind), whether a piece starts at the next one."""
    cut = np.zeros((6, 6), dtype=bool)
    cut[_LETTER, [_DIGIT, _SIGN, _APOSTROPHE]] = True
    cut[_DIGIT, [_LETTER, _DIGIT, _SIGN, _APOSTROPHE]] = True
    cut[_SIGN, [_LETTER, _DIGIT]] = True
    cut[_APOSTROPHE, _DIGIT] = True
    cut[_SPACE, _LETTER:] = True
    return cut.ravel()


_KINDS, _CUTS = _kinds(), _cuts()
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: Pieces that are one word of the merges: letters whose lower case and composed form are plain, a digit, or signs.
_WORD = r"^(?:[a-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+)$"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from U+0100 on. Spaces stay."""
    shown = [32, *range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b == 32 or b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(rest)} | {b: chr(b) for b in shown}


def _parts(values: pa.LargeBinaryArray | pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value starts and the last ends, and the bytes of all, for an array without nulls."""
    at = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", dtype=np.uint8)
    return at - at[0], data[at[0] : at[-1]]


def _made(kind: pa.DataType, at: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])


def cut(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The pieces of all texts, and where each text's pieces start and the last one's end. Null is empty."""
    bounds, data = _parts(pc.fill_null(texts.cast(pa.large_binary()), b""))
    kinds, low = _KINDS[data], _LOWER[data]
    latin = np.flatnonzero(data[:-1] == 0xC3)
    latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
    kinds[latin] = kinds[latin + 1] = _LETTER
    special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    for t in np.unique(np.searchsorted(bounds, special, side="right") - 1):  # else a capital or a cut could make or break a special token
        own = slice(bounds[t], bounds[t + 1])
        low[own] = data[own]
        kinds[own][kinds[own] != _SPACE] = _OTHER
    shown = kinds != _SPACE
    starts = np.zeros(len(data), dtype=bool)
    starts[1:] = _CUTS[6 * kinds[:-1] + kinds[1:]]
    first = bounds[:-1][bounds[:-1] < len(data)]
    starts[first] = shown[first]
    left = low[shown]
    at = np.append(np.flatnonzero(starts[shown]), len(left))
    return _made(pa.large_string(), at, left), np.searchsorted(np.flatnonzero(starts), bounds)


class Encoder:
    """encode_all() gives each text's ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = _byte_letters()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        """Empty the cache: at the end of a task, since idle workers keep their memory."""
        self.known, self.known_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def _merged(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are _WORD, and how many each has."""
        blocks = [" ".join(words.slice(k, WORDS).to_pylist()) for k in range(0, len(words), WORDS)]
        blocks = [b if b.isascii() else b.lower().encode().decode("latin-1").translate(self.letters) for b in blocks]
        ids = _ids(self.merges.encode_batch_fast(blocks, add_special_tokens=False))
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != len(words):
            raise ValueError("the vocabulary's words do not end in </w>")
        return ids, np.diff(ends, prepend=-1)

    def _look_up(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Where in the cache each of different pieces is; new ones are added."""
        if self.known.nbytes + self.known_ids.nbytes > CACHE:
            self.forget()
        found = pc.index_in(pieces, value_set=self.known)
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if not len(new):
            return at
        words = pieces.take(pa.array(new))
        ascii_, plain = (x.to_numpy(zero_copy_only=False) for x in (pc.string_is_ascii(words), pc.match_substring_regex(words, _WORD)))
        groups = [np.flatnonzero(plain & ascii_), np.flatnonzero(plain & ~ascii_), np.flatnonzero(~plain)]
        others = self.tokenizer.encode_batch_fast(words.take(pa.array(groups[2])).to_pylist(), add_special_tokens=False)
        made = [self._merged(words.take(pa.array(g))) for g in groups[:2]] + [(_ids(others), np.array([len(x.ids) for x in others], dtype=np.int64))]
        order = np.concatenate(groups)
        at[new[order]] = len(self.known) + np.arange(len(new))
        ends = 4 * np.cumsum(np.concatenate([[0], *(n for _, n in made)]))
        ids = _made(pa.large_binary(), ends, np.concatenate([i for i, _ in made]).view(np.uint8))
        self.known = pa.concat_arrays([self.known, words.take(pa.array(order))])
        self.known_ids = pa.concat_arrays([self.known_ids, ids])
        return at

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        pieces, first = cut(texts)
        coded = pieces.dictionary_encode()
        at = self._look_up(coded.dictionary)
        ends, ids = _parts(self.known_ids.take(pa.array(at[coded.indices.to_numpy()])))
        bounds, data = ends[first].tolist(), memoryview(ids)
        return [bytes(data[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text.encode("utf-8", "replace")], pa.binary()))[0]


def _ids(encoded: list[Any]) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype="<u4"), *(np.array(x.ids, dtype="<u4") for x in encoded)])


def encoder(path: str) -> Any:
    """This worker's encoder for path."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of batches, about TEXTS bytes at a time, with the ids of each one's text; the cache is emptied at the end."""
    enc = encoder(path)
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        step = max(1, batch.num_rows * TEXTS // max(1, batch.nbytes))
        for k in range(0, batch.num_rows, step):
            held.append(batch.slice(k, step))
            size += held[-1].nbytes
            if size >= TEXTS:
                rows, held, size = pa.concat_batches(held), [], 0
                yield rows, enc.encode_all(rows["text"])
    if held:
        rows = pa.concat_batches(held)
        yield rows, enc.encode_all(rows["text"])
    enc.forget()

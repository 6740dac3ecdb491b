"""Word forms of whole texts, and the token ids that a worker remembers for them.

A form begins at a text's start and at each single blank or line feed between
two characters that aren't white space. The tokenizers used here never join
characters across such a place, so each distinct form is encoded once: Arrow
finds the distinct forms of a batch, and those that the worker hasn't met go
through the library. Equal forms are equal bytes; nothing is hashed.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from polyscore.llm.common import buffers

#: Forms, and their bytes, that a worker remembers before it starts afresh (a memory bound only).
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 32 << 20
JOINED = 512
_GAP = np.zeros(256, bool)
_GAP[[32, 10]] = True
#: First bytes of characters some of which are white space.
_MAYBE = np.zeros(256, bool)
_MAYBE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_BEFORE = np.ones(256, bool)
_BEFORE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = False
_AFTER = _BEFORE & ~_MAYBE
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if b != 39 and not chr(b).isalnum()]] = True
#: Lower case of the ASCII letters.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ENCODERS: dict = {}


def form_starts(data: np.ndarray, off: np.ndarray, marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Where the forms of all texts begin, and the text of each form; an empty text has none.

    ``marks``: also before an ASCII mark other than an apostrophe that follows an
    ASCII letter, for tokenizers that part letters from marks first.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.zeros(len(data), bool)
    begin[1:-1] = _GAP[data[1:-1]] & _BEFORE[data[:-2]] & _AFTER[data[2:]]
    filled = off[1:] > off[:-1]
    begin[off[1:][filled] - 1] = False
    if (data >= 0x80).any():
        at = np.flatnonzero(begin[1:] & (data[:-1] >= 0x80)) + 1
        two, three = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
        begin[at[(two == 0xC2) | (_MAYBE[three] & (two >= 0x80))]] = False
    if marks:
        begin[1:] |= _MARK[data[1:]] & _LETTER[data[:-1]]
    begin[off[:-1][filled]] = True
    starts = np.flatnonzero(begin)
    return starts, np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(starts, off)))


class FormMemory:
    """The ids of the forms met so far; ``learn`` gives the ids of new ones, each as an array."""

    def __init__(self, learn: Callable[[list[bytes]], list[np.ndarray]], most: int = REMEMBERED):
        self.learn, self.most = learn, most
        self._forget()

    def _forget(self) -> None:
        self.at: dict[bytes, int] = {}
        self.held = 0
        self.pool = np.zeros(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def ids(self, forms: pa.DictionaryArray, distinct: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all forms, one after the other, and each form's number of ids; ``distinct``: its dictionary as a list."""
        distinct = forms.dictionary.to_pylist() if distinct is None else distinct
        if len(self.at) + len(distinct) > self.most or self.held > REMEMBERED_BYTES:
            self._forget()
        new = [f for f in distinct if f not in self.at]
        if new:
            got = self.learn(new)
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.held += sum(map(len, new))
            self.pool = np.concatenate([self.pool, *got]).astype(np.int32)
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum([len(g) for g in got]))
        place = np.fromiter(map(self.at.__getitem__, distinct), np.int64, len(distinct))
        place = place[forms.indices.to_numpy()]
        begin, count = self.ends[place], self.ends[place + 1] - self.ends[place]
        shift = np.repeat(begin - (np.cumsum(count) - count), count)
        return self.pool[shift + np.arange(len(shift))], count


def forms_of(data: np.ndarray, off: np.ndarray, marks: bool = False) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All forms in order, as codes of the distinct ones, and the text of each."""
    starts, row = form_starts(data, off, marks)
    ends = np.append(starts, len(data)).astype(np.int32)
    raw = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return raw.dictionary_encode(), row


class LibraryEncoder:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them; special strings are ordinary text.

    New forms go through the library many in one call, parted by a control
    character that no merge of the vocabulary holds; its id parts the ids.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.part = next(bytes([b]) for b in range(1, 9) if sum(chr(256 + b) in t for t in vocab) == sum(
            t in (chr(256 + b), chr(256 + b) + "</w>") for t in vocab))
        if "a</w>" in vocab:  # the last character of a word has its own token, so the control character stands alone
            self.part = b" " + self.part + b" "
        (self.part_id,) = self.tokenizer.encode(self.part.decode(), add_special_tokens=False).ids
        self.memory = FormMemory(self._learn)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(g.ids, np.int32) for g in self.tokenizer.encode_batch_fast(
            [t.decode() for t in texts], add_special_tokens=False)]

    def _learn(self, forms: list[bytes]) -> list[np.ndarray]:
        mark = self.part.strip(b" ")
        alone = [i for i, f in enumerate(forms) if mark in f or f[-1:].isspace() or f[-1] >= 0x80]
        out: list = [None] * len(forms)
        for i, ids in zip(alone, self._encode([forms[i] for i in alone])):
            out[i] = ids
        rest = [i for i, ids in enumerate(out) if ids is None]
        groups = [rest[i:i + JOINED] for i in range(0, len(rest), JOINED)]
        for group, ids in zip(groups, self._encode([self.part.join(forms[i] for i in g) for g in groups])):
            cuts = [-1, *np.flatnonzero(ids == self.part_id).tolist(), len(ids)]
            for i, a, b in zip(group, cuts[:-1], cuts[1:], strict=True):
                out[i] = ids[a + 1:b]
        return out


class LowerEncoder(LibraryEncoder):
    """The same for a tokenizer that lower-cases, and parts letters from marks, before its merges."""

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and each text's number of ids."""
        data, off = buffers(column)
        forms, row = forms_of(_LOWER[data], off, marks=True)
        if not len(row):
            return np.zeros(0, np.int32), np.zeros(len(column), np.int64)
        ids, count = self.memory.ids(forms)
        return ids, np.bincount(row, weights=count, minlength=len(column)).astype(np.int64)


class PieceEncoder:
    """Ids as sentencepiece gives them for a text whose first character is its own leading blank."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.memory = FormMemory(self._learn)

    def _learn(self, forms: list[bytes]) -> list[np.ndarray]:
        # The library puts a blank before each text. It stands for a form's own blank; before a line feed it is a piece of its own.
        blank = [f[:1] == b" " for f in forms]
        got = self.model.encode([(f[1:] if b else f).decode() for f, b in zip(forms, blank)], num_threads=1)
        # of a lone blank the library makes nothing
        blank_id = self.model.piece_to_id("▁")
        return [np.array((g or [blank_id]) if b else g[1:], np.int32) for g, b in zip(got, blank)]

    def token_bytes(self) -> list[bytes]:
        def one(i: int) -> bytes:
            piece = self.model.id_to_piece(i)
            return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
        return [one(i) for i in range(self.model.get_piece_size())]


def byte_level_bytes(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer; ids outside the vocabulary have none."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    value = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    vocab = tokenizer.get_vocab(with_added_tokens=False)
    out = [b""] * (max(vocab.values()) + 1)
    for token, at in vocab.items():
        out[at] = bytes(value.get(c, 63) for c in token)
    return out


def remembered(kind: type, path: str):
    """The worker's encoder of a file."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]

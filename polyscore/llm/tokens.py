"""Byte-level BPE ids of whole texts with the tokenizers library.

A corpus repeats its word forms, so a worker remembers the ids of the forms it
has met, in sorted numpy arrays. Texts are cut only between words parted by one
blank or line feed, where the tokenizer's pre-tokenizer always cuts; forms new
to the worker go through the library, many in one call; texts with other white
space go through it whole. The result equals
``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from polyscore.llm.common import buffers, mix, row_of, words

#: Word forms that a worker remembers before it starts afresh (a memory bound only).
REMEMBERED = 1_000_000
_JOINED = 512
#: White space other than single blanks and line feeds between words.
_ODD = re.compile(r"[^\S \n]|[ \n][ \n]|\A[ \n]|[ \n]\Z")
_LUT = np.arange(1, 257, dtype=np.uint16)
_LUT[[32, 10]] = 0
#: Bytes that may belong to other white space.
_DOUBT = np.zeros(256, bool)
_DOUBT[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        #: In the vocabulary each character stands for one byte.
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, at in vocab.items():
            self.width[at] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _form_ids(self, forms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the forms, one after the other, and each form's number of ids."""
        groups = [forms[i:i + _JOINED] for i in range(0, len(forms), _JOINED)]
        got = self.tokenizer.encode_batch_fast([b"".join(g).decode() for g in groups], add_special_tokens=False)
        ids, lengths = [], []
        for group, g in zip(groups, got):
            one = np.array(g.ids, np.uint32)
            ends = np.cumsum(np.fromiter(map(len, group), np.int64, len(group)))
            lengths.append(np.diff(np.searchsorted(np.cumsum(self.width[one]), ends, "left") + 1, prepend=0))
            ids.append(one)
        return np.concatenate(ids), np.concatenate(lengths)

    def _learn(self, keys: np.ndarray, begin: np.ndarray, end: np.ndarray, data: np.ndarray) -> None:
        """Add new forms, ``data[begin:end]`` with the blank or line feed before; keys are sorted."""
        blank = data[begin] == 32
        raw = data.tobytes()
        ids, lengths = [], np.zeros(len(keys), np.int64)
        for mask in (blank, ~blank):  # forms with a blank may follow any other form, so they can be joined
            at = np.flatnonzero(mask)
            forms = [raw[b:e] for b, e in zip(begin[at].tolist(), end[at].tolist())]
            if not forms:
                continue
            if mask is blank:
                got, lengths[at] = self._form_ids(forms)
            else:
                one = [np.array(g.ids, np.uint32) for g in self.tokenizer.encode_batch_fast(
                    [f.decode() for f in forms], add_special_tokens=False)]
                got, lengths[at] = np.concatenate(one), [len(o) for o in one]
            ids.append((at, got))
        start = np.zeros(len(keys), np.int64)
        base = len(self.pool)
        for at, got in ids:
            start[at] = base + np.concatenate(([0], np.cumsum(lengths[at])[:-1]))
            base += len(got)
        self.pool = np.concatenate([self.pool, *[got for _, got in ids]])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.start = np.insert(self.start, at, start)
        self.length = np.insert(self.length, at, lengths)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (unsigned 32 bit) of all texts, one after the other, and each text's number of ids."""
        data, off = buffers(column)
        n = len(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        gap = _LUT[data] == 0
        two = np.flatnonzero(gap[1:] & gap[:-1])
        ends = off[1:][off[1:] > off[:-1]] - 1
        begins = off[:-1][off[1:] > off[:-1]]
        uneven = np.concatenate([two, begins[gap[begins]], ends[gap[ends]]])
        uneven = np.unique(row_of(uneven, off))
        doubt = np.unique(row_of(np.flatnonzero(_DOUBT[data]), off))
        odd = np.zeros(n, bool)
        odd[uneven] = True
        raw = data.tobytes()
        text = lambda i: raw[off[i]:off[i + 1]].decode()
        for i in doubt[~odd[doubt]].tolist():
            odd[i] = bool(_ODD.search(text(i)))
        h, s, e = words(data, off, _LUT)
        row = row_of(s, off)
        if odd.any():
            keep = ~odd[row]
            h, s, e, row = h[keep], s[keep], e[keep], row[keep]
        first = s == off[row]
        before = np.where(first, 0, data[np.maximum(s - 1, 0)])
        begin = np.where(first, s, s - 1)
        with np.errstate(over="ignore"):
            key = mix(h + before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        uniq, at, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) + len(uniq) > REMEMBERED:
            self._forget()
        place = np.searchsorted(self.keys, uniq)
        known = np.zeros(len(uniq), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == uniq[inside]
        if not known.all():
            new = at[~known]
            self._learn(uniq[~known], begin[new], e[new], data)
            place = np.searchsorted(self.keys, uniq)
        place = place[inverse]
        length = self.length[place]
        counts = np.bincount(row, weights=length, minlength=n).astype(np.int64)
        total = int(length.sum())
        shift = np.repeat(self.start[place] - (np.cumsum(length) - length), length)
        ids = self.pool[shift + np.arange(total)]
        if not odd.any():
            return ids, counts
        whole = {i: np.array(self.tokenizer.encode(text(i), add_special_tokens=False).ids, np.uint32)
                 for i in np.flatnonzero(odd).tolist()}
        cuts = np.concatenate(([0], np.cumsum(counts)))
        parts = [whole[i] if odd[i] else ids[cuts[i]:cuts[i + 1]] for i in range(n)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text; second, the bounds of the texts."""
    bounds = np.concatenate(([0], np.cumsum(counts + 1)))
    out = np.full(bounds[-1], end_id, np.uint32)
    keep = np.ones(len(out), bool)
    keep[bounds[1:] - 1] = False
    out[keep] = ids
    return out, bounds


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")

"""Periodic runs of words: block convolution at dyadic scales.

A run is a longest stretch of words with smallest period q and a length of at
least ``max(24, 3 q)``. At scale L (8, 16, 32, ...) a text is cut into blocks of
L words. A run with L <= q < 2 L (L = 8: any q below 16) holds a whole block and
the block's copy q words on. So at each scale the distances from L on (from 1 at
the first) at which a block occurs again without a mismatch hold all its runs'
periods: the sums of squared differences of the block and the window after it,
at all distances at once, are found by a number-theoretic transform modulo
15 * 2**27 + 1, exactly in integers, for all blocks of many texts together. A
distance whose sum is zero seeds an extension by direct comparison both ways,
which is exact and also refutes a sum that is zero only modulo the prime.

Blocks that can't yield a new run aren't transformed: those with a word that
doesn't occur again within the window, and those whose window lies in a known run
with a period of at most L (there it occurs again at multiples of that period
only). A seed whose block and copy lie in a known stretch, at a multiple of its
period, would extend to that stretch again and is passed over. Distances ascend,
so a stretch is met with its smallest period first.

Words are told apart by a 64-bit hash. A null text and one without words have no
runs: nulls for the longest run and digests of the empty string. A null id is in
no fold, so its text stays as it is. Equal exponents are settled by start, then period; repeated
rows are texts of their own. A very long text is worked off alone, in memory
that is a fixed multiple of its length; periods up to 2**27 words are found. An
empty table gives an empty result. Columns other than doc_id and text are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import buffers, map_arrow, mix, row_of, slices, space_lut, texts_of, words

LEAST_LENGTH, LEAST_EXPONENT, FIRST_SCALE = 24, 3, 8
#: The prime 15 * 2**27 + 1 and a generator of its units.
PRIME, GENERATOR = 2013265921, 31
#: Elements that are transformed at a time (a memory bound only).
TRANSFORMED = 1 << 20
_P = np.uint64(PRIME)
_LUT = space_lut(False)
_NEVER = np.iinfo(np.int64).max
_ROW = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
        "collapsed_sha256 string")
_TWIDDLES: dict[tuple[int, bool], list[np.ndarray]] = {}


def _powers(root: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(root, len(out), PRIME))
        out = np.concatenate([out, out * step % _P])
    return out[:n]


def _twiddles(size: int, back: bool) -> list[np.ndarray]:
    if (size, back) not in _TWIDDLES:
        root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
        if back:
            root = pow(root, PRIME - 2, PRIME)
        levels, half = [], size // 2
        while half:
            levels.append(_powers(root, half))
            root, half = root * root % PRIME, half // 2
        _TWIDDLES[size, back] = levels
    return _TWIDDLES[size, back]


def transform(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long), in bit-reversed order."""
    rows, size = x.shape
    for w in _twiddles(size, False):
        pairs = x.reshape(rows, -1, 2, len(w))
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        x = np.stack([(a + b) % _P, (a + _P - b) * w % _P], 2)
    return x.reshape(rows, size)


def transform_back(x: np.ndarray) -> np.ndarray:
    """The inverse of ``transform``."""
    rows, size = x.shape
    for w in reversed(_twiddles(size, True)):
        pairs = x.reshape(rows, -1, 2, len(w))
        a, b = pairs[:, :, 0], pairs[:, :, 1] * w % _P
        x = np.stack([(a + b) % _P, (a + _P - b) % _P], 2)
    return x.reshape(rows, size) * np.uint64(pow(size, PRIME - 2, PRIME)) % _P


def mismatches(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo the prime, of each row's block and its window at every shift.

    Values lie below the prime. Shifts are those at which the block lies in the window.
    """
    length, wide = block.shape[1], window.shape[1]
    shifts = wide - length + 1
    size = 1 << (wide - 1).bit_length()
    # the block goes backwards, so that the product of the transforms is the correlation, from place length - 1 on
    ahead = np.zeros((len(block), size), np.uint64)
    ahead[:, :wide] = window
    back = np.zeros_like(ahead)
    back[:, 0] = block[:, 0]
    back[:, size - length + 1:] = block[:, :0:-1]
    product = transform_back(transform(ahead) * transform(back) % _P)[:, :shifts]
    square = np.zeros((len(block), wide + 1), np.uint64)
    square[:, 1:] = np.cumsum(window * window % _P, axis=1, dtype=np.uint64)
    of_window = (square[:, length:] - square[:, :shifts]) % _P
    of_block = (block * block % _P).sum(1, dtype=np.uint64)[:, None] % _P
    return (of_block + of_window + (_P - product) * np.uint64(2)) % _P


def next_places(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each word the distance to its next occurrence in its text."""
    with np.errstate(over="ignore"):
        key = h ^ mix(row.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.full(len(h), _NEVER)
    out[order[:-1][same]] = np.diff(order)[same]
    return out


def _reach(h: np.ndarray, at: int, d: int, stop: int, step: int) -> int:
    """How many words from ``at`` on, going by ``step`` and not to ``stop``, equal the word ``d`` on."""
    got, look = 0, 32
    room = (stop - at) * step
    while got < room:
        n = min(look, room - got)
        one = slice(at + got, at + got + n) if step > 0 else slice(at - got - n + 1, at - got + 1)
        differ = h[one] != h[one.start + d:one.stop + d]
        if differ.any():
            return got + int(np.argmax(differ if step > 0 else differ[::-1]))
        got, look = got + n, look * 2
    return got


class Stretches:
    """The periodic stretches of one text found so far; places are those of its words."""

    def __init__(self):
        self.start, self.end, self.period = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, start: int, end: int, period: int) -> None:
        self.start, self.end, self.period = (np.append(x, v) for x, v in (
            (self.start, start), (self.end, end), (self.period, period)))

    def runs(self) -> np.ndarray:
        """start, length, period of those long enough, by start and period."""
        length = self.end - self.start
        keep = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * self.period)
        out = np.stack([self.start, length, self.period], 1)[keep]
        return out[np.lexsort((out[:, 2], out[:, 0]))]

    def settles(self, start: np.ndarray, end: np.ndarray, scale: int) -> np.ndarray:
        """Whether a window lies in a run with a period of at most ``scale``."""
        out = np.zeros(len(start), bool)
        for s, n, q in self.runs().tolist():
            if q <= scale:
                out |= (start >= s) & (end <= s + n)
        return out


def extend(h: np.ndarray, found: Stretches, starts: np.ndarray, distances: np.ndarray, scale: int) -> None:
    """Add the stretches that the seeds of one text extend to; distances ascend."""
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    known = 0
    while len(starts):
        stay = np.ones(len(starts), bool)
        for s, e, q in zip(found.start[known:].tolist(), found.end[known:].tolist(), found.period[known:].tolist()):
            stay &= (starts < s) | (starts + distances + scale > e) | (distances % q != 0)
        known = len(found.start)
        starts, distances = starts[stay], distances[stay]
        if not len(starts):
            return
        s, d = int(starts[0]), int(distances[0])
        starts, distances = starts[1:], distances[1:]
        right = _reach(h, s, d, len(h) - d, 1)
        if right >= scale:  # else the sum was zero only modulo the prime
            found.add(s - _reach(h, s - 1, d, -1, -1), s + right + d, d)


def find_runs(h: np.ndarray, off: np.ndarray) -> dict[int, np.ndarray]:
    """The runs (start, length, period) of each text that has one; ``h`` are words, ``off`` the texts' bounds."""
    n = np.diff(off)
    row = np.repeat(np.arange(len(n)), n)
    again = next_places(h, row)
    value = h % _P
    found: dict[int, Stretches] = {}
    scale, most = FIRST_SCALE, int(n.max(initial=0))
    while scale + max(scale, LEAST_LENGTH - scale) <= most and scale <= most // 2:
        least = 1 if scale == FIRST_SCALE else scale
        per_text = n // scale
        text = np.repeat(np.arange(len(n)), per_text)
        at = (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)) * scale
        begin = off[:-1][text] + at
        # every word of the block must occur again within the window
        far = np.maximum.reduceat(again, np.stack([begin, begin + scale], 1).reshape(-1)[:-1])[::2] if len(begin) else begin
        if len(begin):
            far[-1] = again[begin[-1]:begin[-1] + scale].max()
        live = (far < 2 * scale) & (at + scale + least <= n[text])
        text, at, begin = text[live], at[live], begin[live]
        for t in np.unique(text).tolist():
            if t in found:
                mine = slice(*np.searchsorted(text, [t, t + 1]))
                drop = found[t].settles(at[mine], np.minimum(at[mine] + 3 * scale - 1, n[t]), scale)
                at[mine][drop] = -1
        text, begin, at = text[at >= 0], begin[at >= 0], at[at >= 0]
        wide = scale + 2 * scale - 1 - least
        step = max(1, TRANSFORMED // (4 * scale))
        seeds: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for i in range(0, len(begin), step):
            b, t = begin[i:i + step], text[i:i + step]
            place = b[:, None] + least + np.arange(wide)
            inside = place < off[1:][t][:, None]
            window = np.where(inside, value[np.minimum(place, len(h) - 1)], 0)
            block = value[b[:, None] + np.arange(scale)]
            zero = mismatches(block, window) == 0
            zero &= inside[:, scale - 1:]
            r, d = np.nonzero(zero)
            seeds.append((t[r], at[i:i + step][r], d + least))
        if seeds:
            text, at, d = (np.concatenate(x) for x in zip(*seeds))
            for t in np.unique(text).tolist():
                mine = slice(*np.searchsorted(text, [t, t + 1]))
                extend(h[off[t]:off[t + 1]], found.setdefault(t, Stretches()), at[mine], d[mine], scale)
        scale *= 2
    runs = {t: x.runs() for t, x in found.items()}
    return {t: r for t, r in runs.items() if len(r)}


def collapsed(runs: np.ndarray, n: int) -> np.ndarray:
    """Whether a word stays: no run contains it after the run's first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray:
    """The original place of every word: a tenth of the texts are made periodic from a place on."""
    at = np.arange(n)
    if doc_id is not None and n and (crc := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = crc // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def longest(runs: np.ndarray) -> np.ndarray:
    """The run with the greatest length per period, compared exactly; ties: smallest start, then period."""
    best = runs[0]
    for run in runs[1:]:
        if int(run[1]) * int(best[2]) > int(best[1]) * int(run[2]):
            best = run
    return best


def periodic_runs(docs: DataFrame) -> DataFrame:
    """n_runs, the longest run by exponent, and digests of all runs and of the kept words, per row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _part(part.column(0).to_pylist(), part.column(1))

    rows = texts_of(docs, "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(rows, work, _ROW)


def _part(doc_ids: list, column: pa.Array) -> pa.RecordBatch:
    data, off = buffers(column)
    h, starts, _ = words(data, off, _LUT)
    counts = np.bincount(row_of(starts, off), minlength=len(column))
    bounds = np.concatenate(([0], np.cumsum(counts)))
    places = {}
    for i, (doc_id, n) in enumerate(zip(doc_ids, counts.tolist())):
        if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
            places[i] = repeated_tail(doc_id, n)
            h[bounds[i]:bounds[i + 1]] = h[bounds[i] + places[i]]
    found = find_runs(h, bounds)
    raw = data.tobytes()
    out = []
    for i, doc_id in enumerate(doc_ids):
        text = raw[off[i]:off[i + 1]].split()  # parted at bytes 9 to 13 and 32
        runs = found.get(i)
        if i in places:
            text = [text[k] for k in places[i].tolist()]
        top, written = [None] * 4, ""
        if runs is not None:
            s, n, q = longest(runs).tolist()
            top = [s, n, q, 1000 * n // q]
            written = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
            text = [w for w, stays in zip(text, collapsed(runs, len(text)).tolist()) if stays]
        out.append((doc_id, 0 if runs is None else len(runs), *top, hashlib.sha256(written.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(text)).hexdigest()))
    columns = list(zip(*out))
    fields = [f.split() for f in _ROW.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.string() if kind == "string" else pa.int64()) for c, (_, kind) in zip(columns, fields)],
        [name for name, _ in fields])

"""Language-model scoring with Katz backoff.

Training counts n-grams of every order up to ``order`` (words in lower case, one
end token per text, start tokens before it). Counts up to ``MOST`` are
discounted by Good-Turing; what a context loses goes to the words not seen after
it, in proportion to the next lower order, with a weight that makes each
context's distribution sum to one exactly:

    p(w | h) = d(c(hw)) c(hw) / C(h)            if hw was seen
             = alpha(h) p(w | h without its first word)   otherwise

C(h) is the number of tokens seen after h, plus one where no count of h is
discounted, so some mass is always left. Words never seen share the mass that
single words leave. A context never seen passes straight to the lower order.

The corpus is cut into blocks of texts. A block asks for its distinct n-grams
only, once each, sorted and bucketed by key, with its own training counts; a
bucket adds the counts of all blocks up, writes its part of the model table
(order, bucket, keys, counts) and answers every block in the order it asked, with
the places of the keys in its part. C(h) is h's own count as an n-gram, so a
context is named by its place from then on. One block of those that hold an n-gram
owns it and adds its lower probability to its context's sum; an n-gram that was
seen was seen at every lower order too, so these sums need no weights, and only
contexts that some text leaves for the lower order get their weight back. No table
is joined to the tokens, a hot n-gram is one entry per block, and a task holds a
block or a bucket at a time. An n-gram is named by a hash of ``KEY_BITS`` bits
(about 18 pairs of 400 million n-grams share a name, 1 n-gram in 1,000 of 4 trillion), and a block's share of a
context's sum is rounded to 2**-40.

A null text is empty and scored as its end token. A null id is outside every
fold and trained on. Repeated rows are texts of their own. With no training text all
scores are 0. Columns other than doc_id and text are left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyscore.llm.common import buffers, map_arrow, mix, row_of, slices, space_lut, stage, words

ORDER = 2
#: Counts above this one aren't discounted.
MOST = 5
#: Text bytes of a block.
BLOCK = 16 << 20
KEY_BITS = 52
#: Bytes of a block's share of a context's sum, a fraction of 1.
_SHARE = 5
#: Tokens that a step over a block's tokens computes at once, and cell bytes of a batch handed to Spark.
PIECE, CELLS = 1 << 18, 1 << 20
#: Text bytes that are sorted by block at once, and that words are looked for in at once.
DEALT, READ = 8 << 20, 2 << 20
_LUT = space_lut(True)
_START, _END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557)
_COEF = mix(np.arange(101, 133, dtype=np.uint64)) | np.uint64(1)
_REPLY, _CONTEXT, _MODEL, _SUMS, _TEXT = 0, 1, 2, 3, 9
_ROW = "block int, kind int, ord int, bucket int, n int, keys binary, a binary, b binary, c binary"


_ZSTD = pa.Codec("zstd", compression_level=1)


def squeeze(cell: bytes | None) -> bytes | None:
    """A cell of requests, answers and tables as it is shuffled and stored: its length, then zstd."""
    return None if cell is None else len(cell).to_bytes(8, "little") + (_ZSTD.compress(cell, asbytes=True) if cell else b"")


def loosen(cell: bytes | None) -> bytes | None:
    size = int.from_bytes(cell[:8], "little") if cell is not None else 0
    return _ZSTD.decompress(cell[8:], size, asbytes=True) if size else None if cell is None else b""


def pack(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as the needed bytes of their differences."""
    if not len(keys):
        return b""
    step = np.diff(keys, prepend=np.uint64(0))
    step[0] = 0
    planes = step.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = max(1, -(-int(step.max()).bit_length() // 8))
    return bytes([used]) + keys[:1].astype("<u8").tobytes() + np.ascontiguousarray(planes[:used]).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    used = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=9).reshape(used, -1)
    step = np.zeros((planes.shape[1], 8), np.uint8)
    step[:, :used] = planes.T
    out = np.ascontiguousarray(step).view("<u8").reshape(-1).astype(np.uint64)
    out[0] = np.frombuffer(raw, "<u8", 1, offset=1)[0]
    return np.cumsum(out, dtype=np.uint64)


def pack_counts(n: np.ndarray) -> bytes:
    return np.minimum(n, 255).astype(np.uint8).tobytes() + n[n >= 255].astype("<i8").tobytes()


def unpack_counts(raw: bytes, size: int) -> np.ndarray:
    out = np.frombuffer(raw, np.uint8, size).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, "<i8", offset=size)
    return out


def gram_keys(tokens: np.ndarray, last: np.ndarray, m: int) -> np.ndarray:
    """Keys of the runs of ``m`` tokens that end at ``last``."""
    out = np.empty(len(last), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(last), PIECE):
            part = last[i:i + PIECE]
            h = np.full(len(part), m, np.uint64)
            for j in range(m):
                h += tokens[part - j] * _COEF[m - 1 - j]
            out[i:i + PIECE] = mix(h) >> np.uint64(64 - KEY_BITS)
    return out


def start_key(m: int) -> np.uint64:
    """Key of ``m`` start tokens, the context of a text's first token."""
    return gram_keys(np.full(m, _START, np.uint64), np.array([m - 1]), m)[0]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys (of ``KEY_BITS``) and the place of each key among them.

    A key's upper bits and its index are sorted as one number, which is much faster than an
    argsort; keys that agree in the upper bits only are put in order afterwards.
    """
    width = max(64 - KEY_BITS, len(keys).bit_length())
    cut = np.uint64(width + KEY_BITS - 64)
    packed = keys >> cut
    packed <<= np.uint64(width)
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= np.uint64((1 << width) - 1)
    order = packed.view(np.int64)
    ranked = keys[order]
    wrong = np.unique(ranked[np.flatnonzero(ranked[1:] < ranked[:-1])] >> cut)
    if len(wrong):  # keys outside such a run are in order, so its ends are found by bisection
        ends = np.searchsorted(ranked, np.stack([wrong, wrong + np.uint64(1)]) << cut)
        for a, b in ends.T.tolist():
            order[a:b] = order[a:b][np.argsort(ranked[a:b], kind="stable")]
            ranked[a:b] = keys[order[a:b]]
        if (ranked[1:] < ranked[:-1]).any():  # keys of more bits
            order = order[np.argsort(ranked, kind="stable")]
            ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return ranked[new], place


def pack_shares(x: np.ndarray) -> bytes:
    """Fractions of 1 in ``_SHARE`` bytes each, like bytes side by side."""
    whole = np.minimum(np.rint(x * 2.0 ** (8 * _SHARE)), 2.0 ** (8 * _SHARE) - 1).astype("<u8")
    return np.ascontiguousarray(whole.view(np.uint8).reshape(-1, 8).T[:_SHARE]).tobytes()


def unpack_shares(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(_SHARE, -1).astype(np.float64)
    return np.sum(planes * (2.0 ** (8 * np.arange(_SHARE) - 8 * _SHARE))[:, None], axis=0)


def discounts(of_count: np.ndarray, most: int = MOST) -> np.ndarray:
    """Good-Turing discount by count (0 to ``most``); ``of_count[r]`` n-grams have count r (up to ``most`` + 1).

    A count whose discount wouldn't lie in (0, 1] isn't discounted.
    """
    d = np.ones(most + 1)
    if of_count[1] <= 0:
        return d
    top = (most + 1) * of_count[most + 1] / of_count[1]
    if top >= 1:
        return d
    for r in range(1, most + 1):
        if of_count[r] and of_count[r + 1]:
            x = ((r + 1) * of_count[r + 1] / of_count[r] / r - top) / (1 - top)
            if 0 < x <= 1:
                d[r] = x
    return d


def discounted(r: np.ndarray, d: np.ndarray) -> np.ndarray:
    return r * d[np.where(r < len(d), r, 0)]  # d[0] is 1


class Model:
    """The few numbers of the model that every task needs."""

    def __init__(self, order: int, of_count: dict[int, np.ndarray], tokens: int, distinct: int):
        self.order, self.tokens, self.distinct = order, tokens, distinct
        self.d = {m: discounts(of_count.get(m, np.zeros(MOST + 2))) for m in range(1, order + 1)}
        one = of_count.get(1, np.zeros(MOST + 2))
        lost = sum((1 - self.d[1][r]) * r * one[r] for r in range(1, MOST + 1))
        self.total = tokens + (0 if lost > 0 else 1)
        self.unknown = (lost if lost > 0 else 1.0) / self.total

    def unigram(self, r: np.ndarray) -> np.ndarray:
        return np.where(r > 0, discounted(r, self.d[1]) / self.total, self.unknown)


class Block:
    """The tokens of a block's texts, and its distinct n-grams in key order."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], held: np.ndarray, order: int):
        count = np.concatenate([c for _, c in parts])
        size = count + order
        begin = np.cumsum(size) - size
        self.tokens = np.full(int(size.sum()), _START, np.uint64)
        predicted = np.ones(len(self.tokens), bool)
        for j in range(order - 1):
            predicted[begin + j] = False
        predicted[begin + size - 1] = False
        at = 0
        for h, c in parts:
            to = at + int(c.sum()) + order * len(c)
            self.tokens[at:to][predicted[at:to]] = h
            at = to
        self.tokens[begin + size - 1] = _END
        predicted[begin + size - 1] = True
        self.last = np.flatnonzero(predicted).astype(np.int32)
        self.row = np.repeat(np.arange(len(count), dtype=np.int32), count + 1)
        self.first = np.cumsum(count + 1) - count - 1
        self.n, self.order = len(count), order
        self.train, self.train_texts = ~held[self.row], int((~held).sum())
        self._known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def grams(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys, and the place among them of every token's n-gram and (last) of the start tokens."""
        if m not in self._known:
            self._known[m] = distinct(np.append(gram_keys(self.tokens, self.last, m), start_key(m)))
        return self._known[m]

    def counts(self, m: int) -> np.ndarray:
        """Training counts of the distinct n-grams; start tokens count once a text."""
        keys, place = self.grams(m)
        n = np.bincount(place[:-1][self.train], minlength=len(keys))
        n[place[-1]] += self.train_texts
        return n

    def contexts(self, m: int) -> np.ndarray:
        """Place of the context of every token's n-gram of ``m`` among the distinct n-grams of ``m`` - 1."""
        place = self.grams(m - 1)[1]
        out = np.empty(len(self.last), np.int32)
        out[1:] = place[:-2]
        out[self.first] = place[-1]
        return out


class Answers:
    """What the buckets said about a block's n-grams and contexts."""

    def __init__(self, x: Block, rows: dict[tuple[int, int], list[dict]]):
        self.x, self._rows = x, rows
        self._counts: dict[int, np.ndarray] = {}

    def _join(self, kind: int, m: int, read: Callable[[dict], np.ndarray], kind_of: type) -> np.ndarray:
        return np.concatenate([np.zeros(0, kind_of), *(read(r) for r in self._rows.get((kind, m), []))])

    def counts(self, m: int) -> np.ndarray:
        if m not in self._counts:
            self._counts[m] = self._join(_REPLY, m, lambda r: _short(unpack_counts(r["a"], r["n"])), np.int32)
        return self._counts[m]

    def owned(self, m: int) -> np.ndarray:
        return self._join(_REPLY, m, lambda r: _bits(r["b"], r["n"]), bool)

    def places(self, m: int) -> np.ndarray:
        """Places of the n-grams in their buckets' parts of the model; 0 for those not in it."""
        out = np.zeros(len(self.counts(m)), np.int64)
        out[self.counts(m) > 0] = self._join(_REPLY, m, lambda r: unpack(r["c"]), np.uint64)
        return out

    def asked(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Which n-grams of ``m`` - 1 are contexts seen in training, and which of these are left for the lower order."""
        context, seen = self.x.contexts(m), self.counts(m - 1) > 0
        here, left = np.zeros(len(seen), bool), np.zeros(len(seen), bool)
        here[context] = True
        left[context[self.counts(m)[self.x.grams(m)[1][:-1]] == 0]] = True
        return here & seen, left & seen

    def whole(self, m: int) -> np.ndarray:
        """Denominators of the contexts of n-grams of ``m``; 0 for a context never seen."""
        out = self.counts(m - 1).copy()
        out[self.asked(m)[0]] += self._join(_CONTEXT, m - 1, lambda r: _bits(r["a"], r["n"]), bool)
        return out

    def weights(self, m: int) -> np.ndarray:
        """Backoff weights of the contexts left for the lower order, 1 for all others."""
        out = np.ones(len(self.counts(m - 1)))
        out[self.asked(m)[1]] = self._join(_CONTEXT, m - 1, lambda r: np.frombuffer(r["b"]), np.float64)
        return out


def _short(n: np.ndarray) -> np.ndarray:
    """Counts in 32 bits where these, and one more, fit."""
    return n.astype(np.int32) if not len(n) or n.max() < 2 ** 31 - 1 else n


def _bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def _bucket_slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(KEY_BITS - bits)
    cuts = np.append(np.searchsorted(keys, edges), len(keys))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, int(cuts[b]), int(cuts[b + 1])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _ROW.split(", ")]
    kinds = [pa.int32()] * 5 + [pa.binary()] * 4
    rows = [(*r[:5], *map(squeeze, r[5:])) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``CELLS`` bytes, so that neither side holds all that a block or bucket says."""
    now, size = [], 0
    for r in rows:
        now.append(r)
        size += sum(len(c) for c in r[5:] if c is not None)
        if size >= CELLS:
            yield _batch(now)
            now, size = [], 0
    if now:
        yield _batch(now)


def _deal(texts: DataFrame) -> DataFrame:
    """Texts (block, doc_id, held, text) as they are shuffled: a row for the texts of a block in a part of a batch.

    Its cells are the texts, their lengths, ids and flags (1: held out, 2: without an id).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, DEALT):
                block = piece.column(0).to_numpy()
                order = np.argsort(block, kind="stable")
                block, piece = block[order], piece.take(pa.array(order))
                data, off = buffers(piece.column(3))
                ids = piece.column(1).fill_null(0).to_numpy().astype("<i8")
                flags = piece.column(2).to_numpy(zero_copy_only=False).astype(np.uint8) | (
                    piece.column(1).is_null().to_numpy(zero_copy_only=False).astype(np.uint8) << 1)
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)])).tolist()
                yield from _batches((int(block[a]), _TEXT, 0, 0, b - a, data[off[a]:off[b]].tobytes(), np.diff(off[a:b + 1]).astype("<i8").tobytes(),
                                     ids[a:b].tobytes(), flags[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:]))

    return map_arrow(texts, run, _ROW)


def _words(cells: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the cells' texts and the number of words of each text."""
    off = np.concatenate([[0], *(np.frombuffer(r["a"], "<i8") for r in cells)]).cumsum()
    h, s, _ = words(np.frombuffer(b"".join(r["keys"] for r in cells), np.uint8), off, _LUT)
    return h, np.bincount(row_of(s, off), minlength=len(off) - 1)


def _in_blocks(rows: DataFrame, parts: int, order: int,
               work: Callable[[int, Block, list, Answers], Iterator], schema: str) -> DataFrame:
    """``work`` on each block's texts and the answers it got (which come first in a block)."""
    ready = rows.repartition(parts, "block").sortWithinPartitions("block", "kind", "ord", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, answers, parts, ids, held, cells, waiting = None, {}, [], [], [], [], 0

        def finish() -> Iterator[pa.RecordBatch]:
            if cells:
                parts.append(_words(cells))
                cells.clear()
            if parts:
                mine = Block(parts, np.array(held, bool), order)
                parts.clear()
                yield from work(now, mine, ids, Answers(mine, answers))

        for batch in batches:
            block = batch.column(0).to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(block)]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b:
                    continue
                if int(block[a]) != now:
                    yield from finish()
                    now, answers, ids, held = int(block[a]), {}, [], []
                part = batch.slice(a, b - a)
                kind = part.column(1).to_numpy()
                texts = int(np.searchsorted(kind, _TEXT))
                for r in part.slice(0, texts).select(["kind", "ord", "n", "a", "b", "c"]).to_pylist():
                    answers.setdefault((r["kind"], r["ord"]), []).append(r | {c: loosen(r[c]) for c in "abc"})
                for i in range(texts, part.num_rows):
                    r = part.slice(i, 1).select(["keys", "a", "b", "c"]).to_pylist()[0]
                    cells.append({c: loosen(x) for c, x in r.items()})
                    flags = np.frombuffer(cells[-1]["c"], np.uint8).tolist()
                    ids += [None if f & 2 else x for f, x in zip(flags, np.frombuffer(cells[-1]["b"], "<i8").tolist())]
                    held += [bool(f & 1) for f in flags]
                    waiting += len(cells[-1]["keys"])
                    if waiting >= READ:
                        parts.append(_words(cells))
                        cells.clear()
                        waiting = 0
        yield from finish()

    return map_arrow(ready, run, schema)


def _in_buckets(rows: DataFrame, parts: int, settle: Callable[[int, int, list[dict]], Iterator[tuple]]) -> DataFrame:
    """``settle`` on the rows of each (order, bucket)."""
    ready = rows.repartition(parts, "ord", "bucket").sortWithinPartitions("ord", "bucket", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if (r["ord"], r["bucket"]) != now:
                    if held:
                        yield from _batches(settle(*now, held))
                    now, held = (r["ord"], r["bucket"]), []
                held.append(r | {c: loosen(r[c]) for c in ("keys", "a", "b", "c")})
        if held:
            yield from _batches(settle(*now, held))

    return map_arrow(ready, run, _ROW)


def _count_requests(bits: int, orders: list[int]):
    def work(block: int, x: Block, ids: list, answers: Answers) -> Iterator[pa.RecordBatch]:
        for m in orders:
            keys, n = x.grams(m)[0], x.counts(m)
            yield from _batches((block, _REPLY, m, b, j - i, pack(keys[i:j]), pack_counts(n[i:j]), None, None)
                                for b, i, j in _bucket_slices(keys, bits))
    return work


def _settle_counts(order: int):
    """Answers (total count, whether this block owns the n-gram, places of the known ones), the model's part, counts of counts."""
    def settle(m: int, bucket: int, rows: list[dict]) -> Iterator[tuple]:
        keys = np.concatenate([unpack(r["keys"]) for r in rows])
        n = np.concatenate([unpack_counts(r["a"], r["n"]) for r in rows])
        uniq, place = distinct(keys)
        total = np.bincount(place, weights=n, minlength=len(uniq)).astype(np.int64)
        seen = np.flatnonzero(n > 0)
        owner = np.zeros(len(keys), bool)
        first = np.full(len(uniq), -1, np.int64)
        first[place[seen][::-1]] = seen[::-1]
        owner[first[first >= 0]] = True
        start = uniq == start_key(m)
        owner[start[place]] = False
        known = (total > 0) & ~(start & (m == order))  # no context of the highest order
        rank = np.cumsum(known) - 1
        at = 0
        for r in rows:
            mine = place[at:at + r["n"]]
            yield (r["block"], _REPLY, m, bucket, r["n"], None, pack_counts(total[mine]),
                   np.packbits(owner[at:at + r["n"]]).tobytes(),
                   pack(rank[mine[known[mine]]].astype(np.uint64)) if m < order else None)
            at += r["n"]
        real = total[known & ~start]
        few = np.bincount(real[real <= MOST + 1], minlength=MOST + 2)
        yield (-1, _MODEL, m, bucket, int(known.sum()), pack(uniq[known]), pack_counts(total[known]),
               few.astype("<i8").tobytes(), np.array([real.sum(), len(real)], "<i8").tobytes())
    return settle


def _context_requests(bits: int, m: int, model):
    """A block's contexts of n-grams of ``m`` words and which weights it wants back; for contexts of n-grams that it owns,
    what these add: the lower order's mass and the number of each discounted count."""
    def work(block: int, x: Block, ids: list, answers: Answers) -> Iterator[pa.RecordBatch]:
        held = model.value
        keys, context, r = x.grams(m - 1)[0], x.contexts(m), answers.counts(m)
        place = x.grams(m)[1][:-1]
        token = np.zeros(len(r), np.int32)
        token[place] = np.arange(len(place), dtype=np.int32)
        own = np.flatnonzero(answers.owned(m))
        token, r = token[own], r[own]
        at = context[token]
        del own
        lower = np.bincount(at, weights=seen_probability(x, held, answers, m - 1, token), minlength=len(keys))
        del token
        few = [np.bincount(at[r == j], minlength=len(keys)).astype(np.int32) for j in range(1, MOST + 1)]
        adds = np.zeros(len(keys), bool)
        adds[at] = True
        here, left = answers.asked(m)
        where = answers.places(m - 1).astype(np.uint64)

        def rows() -> Iterator[tuple]:
            for b, i, j in _bucket_slices(keys, bits):
                some = i + np.flatnonzero(here[i:j])
                if len(some):
                    mine = some[adds[some]]
                    yield (block, _SUMS, m - 1, b, len(some), pack(where[some]), pack_shares(lower[mine]),
                           pack_counts(np.concatenate([n[mine] for n in few])),
                           np.packbits(adds[some]).tobytes() + np.packbits(left[some]).tobytes())

        yield from _batches(rows())
    return work


def _settle_contexts(m: int, model):
    """Answers (whether a denominator is one more than the count; the weights wanted) and the model's part."""
    def settle(k: int, bucket: int, rows: list[dict]) -> Iterator[tuple]:
        cost = np.arange(1, MOST + 1) * (1 - model.value.d[m][1:])
        tokens = unpack_counts(rows[0]["a"], rows[0]["n"])  # the model's part has block -1 and comes first
        lost, lower = np.zeros(len(tokens)), np.zeros(len(tokens))
        for r in rows[1:]:
            at = unpack(r["keys"]).astype(np.int64)[_bits(r["c"], r["n"])]
            lower[at] += unpack_shares(r["a"])
            lost[at] += cost @ unpack_counts(r["b"], MOST * len(at)).reshape(MOST, -1)
        more = lost <= 0
        alpha = np.where(more, 1.0, lost) / (tokens + more) / np.maximum(1 - lower, 1e-12)
        for r in rows[1:]:
            at = unpack(r["keys"]).astype(np.int64)
            yield (r["block"], _CONTEXT, k, bucket, r["n"], None, np.packbits(more[at]).tobytes(),
                   alpha[at[_bits(r["c"][-(-r["n"] // 8):], r["n"])]].tobytes(), None)
        yield (-1, _MODEL, k, bucket, len(tokens), None, np.where(lower > 0, alpha, 1).astype("<f4").tobytes(), None, None)
    return settle


def _settle(order: int, m: int, model):
    """Contexts of n-grams of ``m`` words, and counts of the next order."""
    contexts, counts = _settle_contexts(m, model), _settle_counts(order)
    return lambda k, bucket, rows: (contexts if k == m - 1 else counts)(k, bucket, rows)


def seen_probability(x: Block, model: Model, answers: Answers, m: int, token: np.ndarray) -> np.ndarray:
    """Probability, up to order ``m``, of tokens whose n-gram of ``m`` was seen in training."""
    counts, place = answers.counts(m), x.grams(m)[1]
    if m == 1:
        return model.unigram(counts)[place[token]]
    whole, contexts, out = answers.whole(m), x.contexts(m), np.empty(len(token))
    for i in range(0, len(token), PIECE):
        part = token[i:i + PIECE]
        out[i:i + PIECE] = discounted(counts[place[part]], model.d[m]) / whole[contexts[part]]
    return out


def log_probabilities(x: Block, model: Model, answers: Answers) -> np.ndarray:
    """log10 probability of every token, order by order."""
    lp = np.log10(model.unigram(answers.counts(1)))[x.grams(1)[1][:-1]]
    for m in range(2, model.order + 1):
        counts, place, contexts = answers.counts(m), x.grams(m)[1][:-1], x.contexts(m)
        weight, whole = np.log10(answers.weights(m)), answers.whole(m)
        for i in range(0, len(lp), PIECE):
            part, r, context = lp[i:i + PIECE], counts[place[i:i + PIECE]], contexts[i:i + PIECE]
            seen = r > 0
            part += weight[context]
            part[seen] = np.log10(discounted(r[seen], model.d[m]) / whole[context[seen]])
    return lp


def _scores(model):
    def work(block: int, x: Block, ids: list, answers: Answers) -> Iterator[pa.RecordBatch]:
        held = model.value
        c, place = answers.counts(1), x.grams(1)[1][:-1]
        add = lambda w: np.bincount(x.row, weights=w, minlength=x.n)
        base = add(np.log10((c + 0.1) / (held.tokens + 0.1 * (held.distinct + 1)))[place])
        known = np.bincount(x.row[(c > 0)[place]], minlength=x.n)
        lp = add(log_probabilities(x, held, answers))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(np.bincount(x.row, minlength=x.n)),
             pa.array(known), pa.array(base), pa.array(lp)],
            ["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return work


def katz_scores(docs: DataFrame, folds: int = 10, order: int = ORDER, block_bytes: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Scores per row (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) and the model table.

    The table has a row for each (ord, bucket): its n-grams' keys and counts, and their weights as contexts (32-bit floats),
    each cell as ``squeeze`` makes it.

    Rows with crc32(doc_id as text) mod ``folds`` = 0 are scored but not learned from.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    bits = max(1, math.ceil(math.log2(blocks)) if blocks > 1 else 1)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == 0, F.lit(False))
    null = F.lit(None).cast("binary")
    texts = _deal(docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")))

    def with_texts(*answers: DataFrame) -> DataFrame:
        out = texts
        for x in answers:
            out = out.unionByName(x)
        return out

    parts = max(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    def broadcast(counted: DataFrame):
        """The model's few numbers with those of newly counted orders, a few numbers per bucket."""
        nonlocal tokens, words_known
        for r in counted.where(F.col("kind") == _MODEL).select("ord", "b", "c").toLocalIterator():
            if r["b"] is not None:
                of_count[r["ord"]] = of_count.get(r["ord"], 0) + np.frombuffer(loosen(r["b"]), "<i8")
                if r["ord"] == 1:
                    tokens, words_known = (int(v) for v in np.frombuffer(loosen(r["c"]), "<i8") + (tokens, words_known))
        return spark.sparkContext.broadcast(Model(order, of_count, tokens, words_known))

    of_count: dict[int, np.ndarray] = {}
    tokens = words_known = 0
    asked = _in_blocks(texts, parts, order, _count_requests(bits, list(range(1, min(order, 2) + 1))), _ROW)
    settled = stage(_in_buckets(asked, 2 << bits, _settle_counts(order)), "ngrams", "zstd")
    known, weighed = [settled], []
    model = broadcast(settled)

    def of(kind: int, m: int, source: list[DataFrame], keep: str = "abc") -> DataFrame:
        """Rows of order ``m`` with the named cells; the keys aren't handed on."""
        cells = [(F.col(c) if c in keep else null).alias(c) for c in ("keys", "a", "b", "c")]
        return source[max(0, m - 2) if kind == _REPLY or source is known else m - 1].where(
            (F.col("kind") == kind) & (F.col("ord") == m)).select("block", "kind", "ord", "bucket", "n", *cells)

    for m in range(2, order + 1):  # weights of the contexts of m words' n-grams; counts of the next order
        answers = [of(_REPLY, k, known, "ab" if k == m else "ac" if k == m - 1 else "a") for k in range(1, m + 1)]
        answers += [of(_CONTEXT, k, weighed, "a") for k in range(1, m - 1)]
        sums = _context_requests(bits, m, model)
        more = _count_requests(bits, [m + 1] if m < order else [])
        asked = _in_blocks(with_texts(*answers), parts, order, lambda *x, f=(sums, more): (y for g in f for y in g(*x)), _ROW)
        settled = stage(_in_buckets(asked.unionByName(of(_MODEL, m - 1, known, "a")), 2 << bits, _settle(order, m, model)),
                        "ngrams", "zstd")
        weighed.append(settled)
        if m < order:
            known.append(settled)
            model = broadcast(settled)
    table = None
    for m in range(1, order + 1):
        part = of(_MODEL, m, known, "keys a").select("ord", "bucket", "n", "keys", F.col("a").alias("counts"))
        held_by = of(_MODEL, m, weighed, "a").select("bucket", F.col("a").alias("weights")) if m < order else None
        part = part.join(held_by, "bucket", "left").select("ord", "bucket", "n", "keys", "counts", "weights") if m < order \
            else part.withColumn("weights", null)
        table = part if table is None else table.unionByName(part)
    answers = [of(_REPLY, m, known, "a") for m in range(1, order + 1)] + [of(_CONTEXT, m, weighed, "ab") for m in range(1, order)]
    scored = _in_blocks(with_texts(*answers), parts, order, _scores(model),
                        "doc_id long, n_tokens long, n_known long, base_score double, score double")
    out = scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                        "base_score", "score")
    return out, table

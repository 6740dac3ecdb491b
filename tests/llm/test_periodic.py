"""Runs of words against a plain search of all periods."""

import hashlib
import random
import re
import zlib

import edge
import numpy as np
import pytest

from polyscore.llm import periodic
from polyscore.llm.common import mix


def plain_runs(x):
    """(start, length, period) of all runs, smallest period first for equal spans."""
    out = {}
    for q in range(1, len(x) // 3 + 1):
        same = [x[i] == x[i + q] for i in range(len(x) - q)] + [False]
        begin = None
        for i, s in enumerate(same):
            if s and begin is None:
                begin = i
            if not s and begin is not None:
                length = i - begin + q
                if length >= max(24, 3 * q):
                    out.setdefault((begin, length), q)
                begin = None
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = [None] * 4
    if runs:
        s, k, q = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = [s, k, q, 1000 * k // q]
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, digest("".join(f"{s},{k},{q}\n" for s, k, q in runs)),
            digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


def words_of(rng):
    n, k = rng.randint(0, 300), rng.choice([1, 2, 2, 3, 5, 50])
    if rng.random() < .3:
        return [rng.randrange(k) for _ in range(n)]
    out = []
    while len(out) < n:
        unit = [rng.randrange(k) for _ in range(rng.randint(1, rng.choice([3, 10, 40, 100])))]
        if rng.random() < .4:
            unit = unit * rng.randint(1, 4)
        out += (unit * rng.randint(1, 12))[:rng.randint(1, 400)]
        if rng.random() < .5:
            out += [rng.randrange(k) for _ in range(rng.randint(0, 6))]
        if rng.random() < .3:
            out[rng.randrange(len(out))] = rng.randrange(k)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_a_plain_search(seed):
    rng = random.Random(seed)
    for _ in range(15):
        texts = [words_of(rng) for _ in range(12)]
        off = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        h = mix(np.array([v for t in texts for v in t], np.uint64) + np.uint64(7))
        got = periodic.find_runs(h, off)
        assert {i: [tuple(r) for r in v.tolist()] for i, v in got.items()} == {
            i: r for i, t in enumerate(texts) if (r := plain_runs(t))}


def test_runs_on_the_edge_of_length_and_period():
    for q in (1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33):
        for n in (max(24, 3 * q) - 1, max(24, 3 * q), 3 * q + 40):
            for before in range(0, 20, 3):
                x = [1000 + i for i in range(before)] + [i % q for i in range(n)] + [-1]
                h = mix(np.array(x, np.int64).astype(np.uint64))
                got = periodic.find_runs(h, np.array([0, len(h)])).get(0, np.zeros((0, 3), int))
                assert [tuple(r) for r in got.tolist()] == plain_runs(x)


def test_the_transform_is_exact():
    rng = np.random.default_rng(0)
    block = rng.integers(0, periodic.PRIME, (5, 16)).astype(np.uint64)
    window = rng.integers(0, periodic.PRIME, (5, 31)).astype(np.uint64)
    window[2, 9:25] = block[2]
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(block[i], window[i, s:s + 16])) % periodic.PRIME for s in range(16)]
            for i in range(5)]
    got = periodic.mismatches(block, window)
    assert got.tolist() == want and got[2, 9] == 0
    assert np.array_equal(periodic.transform_back(periodic.transform(block.copy())), block)


def test_a_zero_modulo_the_prime_is_refuted(monkeypatch):
    x = np.arange(200, dtype=np.uint64) + np.uint64(3)
    monkeypatch.setattr(periodic, "mismatches", lambda b, w: np.zeros((len(b), w.shape[1] - b.shape[1] + 1), np.uint64))
    monkeypatch.setattr(periodic, "next_places", lambda h, row: np.ones(len(h), np.int64))
    assert periodic.find_runs(x, np.array([0, 200])) == {}


def test_a_long_text_of_one_word():
    h = np.full(200_000, 5, np.uint64)
    assert periodic.find_runs(h, np.array([0, len(h)]))[0].tolist() == [[0, 200_000, 1]]


def test_rows_equal_a_plain_loop(spark):
    rows = [(r[0], (r[1] or "")[:3000] if r[1] else r[1], *r[2:]) for r in edge.rows()]
    rows += [(100 + i, " ".join(f"w{j % 7}" for j in range(10 + 9 * i)), *[None] * 9) for i in range(40)]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(3)
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    got = sorted(map(key, periodic.periodic_runs(docs).collect()))
    assert got == sorted(key(plain_row(r[0], r[1])) for r in rows)
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)


def test_an_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], edge.SCHEMA)).collect() == []

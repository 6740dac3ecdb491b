"""Sum-of-squares packing against a plain loop, and the pieces against whole texts."""

import random
import zlib
from collections import defaultdict

import edge
import numpy as np
import pytest
from tokenizers import Tokenizer

from polyscore.llm import level_packing
from polyscore.llm.level_packing import LevelPacker, Piece, best_level, is_power, pack_levels

PATH = level_packing.default_path()


def plain_level(counts, length, capacity):
    """The level with the least sum of squares, by trying all; the fullest wins a tie."""
    best = None
    for level in range(capacity - length + 1):
        if level and not counts[level]:
            continue
        after = list(counts)
        if level:
            after[level] -= 1
        if level + length < capacity:
            after[level + length] += 1
        total = sum(n * n for n in after[1:capacity])
        if best is None or total <= best[0]:
            best = (total, level)
    return best[1]


@pytest.mark.parametrize("capacity", [16, 21, 64])
def test_levels_equal_a_plain_search(capacity):
    rng = random.Random(capacity)
    packer = LevelPacker(capacity)
    counts = [0] * (capacity + 1)
    for _ in range(600):
        length = min(capacity - 1, 1 + int(rng.expovariate(4 / capacity)))
        level = plain_level(counts, length, capacity)
        assert best_level(packer.counts, length, capacity) == level
        list(packer.add(Piece(0, 0, np.zeros(length, np.uint32), length)))
        if level:
            counts[level] -= 1
        if level + length < capacity:
            counts[level + length] += 1
        assert packer.counts.tolist() == counts
        assert [len(w) for w in packer.windows] == counts[:capacity]


def whole(rows, capacity):
    """Checks places and gives every text's ids by its pieces; ``rows`` from one table."""
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at == capacity or is_power(at) and at < capacity
    return places


@pytest.mark.parametrize("capacity,most_open", [(2048, 8192), (64, 8192), (64, 5)])
def test_every_id_has_one_place(spark, capacity, most_open):
    rows = edge.rows() + [(900, "İ ﬁ Å ① ÉCOLE don't X's <|endoftext|> a<|startoftext|>", *[None] * 9)]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(3)
    got = pack_levels(docs, PATH, capacity=capacity, most_open=most_open).collect()
    whole(got, capacity)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1])
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(want)
    for doc_id, texts in want.items():
        assert sum(p["length"] for p in pieces[doc_id]) == sum(map(len, texts))
        for p in pieces[doc_id]:
            assert any(len(ids) == p["doc_tokens"] and p["ids_crc32"] == zlib.crc32(
                np.array(ids[p["start"]:p["start"] + p["length"]], "<u4").tobytes()) for ids in texts)
        if len(texts) == 1:
            at = 0
            for p in sorted(pieces[doc_id], key=lambda p: p["start"]):
                assert p["start"] == at
                at += p["length"]
            assert at == len(texts[0])


def test_cuts_are_at_most_one_per_sequence(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = pack_levels(docs.coalesce(1), PATH).collect()
    places = whole(got, 2048)
    needed = sum(-(-r["doc_tokens"] // 2048) for r in got if r["start"] == 0)
    assert len(got) - needed <= len(places)


def test_texts_that_fill_windows_exactly():
    packer = LevelPacker(8)
    full = [p for n in (8, 16, 3, 5, 4, 4) for p in packer.add(Piece(n, 0, np.arange(n, dtype=np.uint32), n))]
    assert [[(p.doc_id, p.start, len(p.ids)) for p in x] for x in full] == [
        [(8, 0, 8)], [(16, 0, 8)], [(16, 8, 8)], [(3, 0, 3), (5, 0, 5)], [(4, 0, 4), (4, 0, 4)]]
    assert list(packer.close()) == []


def test_an_empty_table(spark):
    assert pack_levels(spark.createDataFrame([], edge.SCHEMA), PATH).collect() == []

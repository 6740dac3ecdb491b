"""The alignment of two tokenizers against a plain loop over the tokens of each text."""

import hashlib
import random
from collections import Counter, defaultdict

import edge
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from polyscore.llm import alignment
from polyscore.llm.forms import LibraryEncoder, PieceEncoder, byte_level_bytes, form_starts, forms_of

A, B = alignment.default_paths()
ODD = ["a  b", "\n a", "a\n\nb", "  x \n y\t z ", "café  x", "　a b", "a ́b c", " ", "\n", "x\n", "don't 's it's\n's",
       "<s> </s> <|endoftext|> a<|endoftext|>b", "ﬁ Å ① \U0001f600 z", "\x00 \x1c a\x85 b \x1d c", "▁a ▁ b", "a\r\nb c\rd \r e",
       "x \x01 y \x01\x02", "\x01", "日本 語", "z" * 3000]


def plain(texts):
    """Rows of align() for (doc_id, text)."""
    one, two = LibraryEncoder(A), PieceEncoder(B)
    bytes_a, bytes_b = byte_level_bytes(one.tokenizer), two.token_bytes()
    docs, count = [], Counter()
    for doc_id, text in texts:
        text = text or ""
        a = one.tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.model.encode(text) if text else []
        raw = (" " + text).encode()
        if not text or b"".join(bytes_a[i] for i in a) != raw or b"".join(bytes_b[i] for i in b) != raw:
            docs.append((doc_id, 0, 0, [], Counter()))
            continue
        ends = lambda ids, of: np.cumsum([len(of[i]) for i in ids]).tolist()
        ends_a, ends_b = ends(a, bytes_a), ends(b, bytes_b)
        groups, links, at, to = [], Counter(), 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append((a[at:i], b[to:j]))
            links.update((x, y) for x in a[at:i] for y in b[to:j])
            at, to = i, j
        count.update(links.keys())
        docs.append((doc_id, len(a), len(b), groups, links))
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    for doc_id, n_a, n_b, groups, links in docs:
        written = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        yield (doc_id, n_a, n_b, len(groups), sum(links.values()),
               sum(n for p, n in links.items() if count[p] == highest[p[0]]), sum(n * count[p] for p, n in links.items()),
               hashlib.sha256(written.encode()).hexdigest() if n_a else "")


def key(r):
    return tuple(-1 if x is None else x for x in r)


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK, 4000])
def test_rows_equal_a_plain_loop(spark, block_bytes, monkeypatch):
    rows = edge.rows() + [(1000 + i, t, *[None] * 9) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, edge.SCHEMA).repartition(3)
    got = alignment.align(docs, A, B, block_bytes).collect()
    want = list(plain([(r[0], r[1]) for r in rows]))
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert any(r[1] for r in want) and any(r[7] == "" and r[0] is not None for r in want)


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], edge.SCHEMA)
    assert alignment.align(docs, A, B).collect() == []


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert sorted(tuple(r) for r in alignment.align(docs, A, B).collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_links_of_a_long_group_are_counted():
    of = pa.array([b"a", b"b", b"abab" * 3], pa.binary())
    a = alignment.Tokens(np.array([0, 1] * 6, np.int32), np.zeros(12, np.int64), 1, of)
    b = alignment.Tokens(np.array([2], np.int32), np.zeros(1, np.int64), 1, of)
    last_a, last_b = alignment.shared_ends(a, b)
    links = alignment.linked(a, b, alignment.group_of(a, last_a), alignment.group_of(b, last_b))
    assert sorted(zip(links["pair"].to_pylist(), links["links_sum"].to_pylist())) == [(0 << 32 | 2, 6), (1 << 32 | 2, 6)]


def test_forms_give_the_ids_of_whole_texts():
    rng = random.Random(2)
    alpha = list("ab'1. \n\t 　é́▁中\x1c\x85\x01") + ["  ", "n't", "\U0001f600"]
    texts = ODD + ["".join(rng.choice(alpha) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    column = pc.binary_join_element_wise(pa.scalar(b" "), pa.array([t.encode() for t in texts]), b"")
    data, off = alignment.buffers(column)
    forms, row = forms_of(data, off)
    for encoder, whole in ((LibraryEncoder(A), lambda e, t: e.tokenizer.encode(" " + t, add_special_tokens=False).ids),
                           (PieceEncoder(B), lambda e, t: e.model.encode(t))):
        encoder.memory.most = 500  # the memory starts afresh on the way
        for _ in range(2):
            ids, count = encoder.memory.ids(forms)
            cuts = np.concatenate(([0], np.cumsum(np.bincount(row, weights=count, minlength=len(texts)).astype(int))))
            assert all(ids[a:b].tolist() == whole(encoder, t) for a, b, t in zip(cuts[:-1], cuts[1:], texts))


def test_forms_start_between_words_only():
    data = np.frombuffer("ab cd  e\nf é g  h".encode(), np.uint8)
    starts, row = form_starts(data, np.array([0, len(data), len(data)]))
    assert [data.tobytes()[s:s + 2] for s in starts.tolist()] == [b"ab", b" c", b"\nf", b" \xc3", b" g"]
    assert not row.any()

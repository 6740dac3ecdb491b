"""Every operator against brute force, exact round trips or held-out rows, on a table of odd rows and an empty one."""

import collections
import hashlib
import random
import re
import zlib

import edge
import numpy as np
import pytest
from pyspark.sql import functions as F

from polyscore.llm import (decontaminate, divergence, importance, katz, line_dedup, packing, partenum, queries, records, tag_paths,
                           tokens, toxicity)
from polyscore.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def docs(spark):
    return edge.documents(spark)


def keyed(df, *cols):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, *[r[c] for c in cols]) for r in df.collect()), key=repr)


def test_quality_base_counts(docs):
    got = keyed(divergence.quality(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for r in edge.rows():
        t = r[1] or ""
        w = WORD.findall(t)
        grams = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {i + j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want.append((r[0] is None, r[0] or 0, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)),
                     len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)))
    assert got == sorted(want, key=repr)


def test_js_distance():
    p = np.array([[1.0, 0.0], [0.5, 0.5]])
    assert np.allclose(divergence.js_distance(p, np.array([[0.0, 1.0]])), [1.0, np.sqrt(0.311278)], atol=1e-5)


def test_quality_rejects_marked_junk(spark, sf_small):
    got = divergence.quality(spark.read.parquet(f"{sf_small}/documents.parquet"))
    marked = got.join(spark.read.parquet(f"{sf_small}/labels.parquet"), "doc_id").where("not base_failed")
    good = marked.where("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.97


def _tongue(name, n, seed):
    rng = random.Random(seed)
    vocab = [f"{name}{i}" for i in range(400)]
    return [(" ".join(rng.choices(vocab, [1 / (i + 1) for i in range(400)], k=150)), name) for _ in range(n)]


def test_rare_language_has_its_own_reference(spark):
    rare, tiny, dominant = _tongue("ra", 10, 1), _tongue("ti", 3, 2), _tongue("en", 100, 3)
    junk = [(" ".join(f"junk{i}" for i in range(150)), "ra")]

    def judged(big):
        rows = [(i, *r) for i, r in enumerate(rare + tiny + junk + dominant * big)]
        got = divergence.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), least=1000)
        return {r["doc_id"]: r for r in got.where(f"doc_id < {len(rare + tiny + junk)}").collect()}

    few, many = judged(1), judged(120)
    assert few == many  # the rare language is below a thousandth of all words in the second
    assert all(many[i]["kept"] and many[i]["word_distance"] < 0.39 for i in range(10))
    assert all(many[i]["kept"] and many[i]["word_distance"] is None and many[i]["class_distance"] is None for i in range(10, 13))
    assert not many[13]["kept"] and not many[13]["base_failed"]


def test_many_languages(spark):
    rows = [(20 * i + j, text, name) for i in range(300) for j, (text, name) in enumerate(_tongue(f"l{i}x", 4, i))]
    got = divergence.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string"), least=500).collect()
    assert len(got) == 1200 and all(r["kept"] and r["word_distance"] < 0.39 for r in got)


def test_records_round_trip(docs, tmp_path):
    path = tokens.default_path()
    folder, index = records.write_records(docs, path)
    got = records.read_records(folder, index).collect()
    enc = tokens.encoder(path).tokenizer
    want = collections.Counter()
    for r in edge.rows():
        ids = enc.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want[r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)


def test_crc32c_and_broken_records():
    assert records.crc32c(np.frombuffer(b"\x00" * 32, "<u4"), [8])[0] == 0x8A9136AA  # published check values
    assert records.crc32c(np.frombuffer(b"\xff" * 32, "<u4"), [8])[0] == 0x62A8AB43
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 400, 50)
    words = rng.integers(0, 1 << 32, counts.sum(), dtype=np.uint64).astype(np.uint32)
    one = [records.crc32c(w, [len(w)])[0] for w in np.split(words, np.cumsum(counts)[:-1])]
    assert (records.crc32c(words, counts) == np.array(one)).all()
    raw, _ = records.frame([5, None], np.arange(7, dtype=np.uint32), np.array([0, 3, 7]), False)
    assert [(d, x.tolist()) for d, x in records.parse(raw)] == [(5, [0, 1, 2]), (None, [3, 4, 5, 6])]
    with pytest.raises(ValueError):
        list(records.parse(raw[:30] + bytes([raw[30] ^ 1]) + raw[31:]))


def test_encoder_equals_library():
    import pyarrow as pa
    rng = random.Random(2)
    alphabet = "ab é'’s.,!1 \n\t  中Ωд²—  don't I'll <|endoftext|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 3, 10, 60]))) for _ in range(800)]
    enc = tokens.Encoder(tokens.default_path())
    ids, n = enc.encode(pa.array([t.encode() for t in texts], pa.binary()))
    want = [x.ids for x in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [p.tolist() for p in np.split(ids, np.cumsum(n)[:-1])] == want


def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><nav><a href=/>Home</a></nav></header>
<div class="notice"><p>We use cookies, please accept them all, really, do accept.</p></div>
<div class="post"><h2>Title &amp; more</h2><p>First paragraph, with commas, and
 long enough to be <b>seen</b> as content.</p><p>Short.</p><p>Another long paragraph follows, with <a href=x>a link</a>, and more. x &lt; y</p></div>
<section class="comments"><p>I think, dear author, that this was a very long comment, not to be kept, at all.</p></section>
<form><p>Subscribe, now, to our newsletter, which is great.</p></form><script>var t = "</p>";</script><footer>(c)</footer></body></html>"""
    assert tag_paths.main_text(page) == ("Title & more\nFirst paragraph, with commas, and long enough to be seen as content.\nShort.\n"
                                         "Another long paragraph follows, with a link, and more. x < y")
    assert [tag_paths.main_text(x) for x in (None, "", "<div", "<!-- only -->")] == [""] * 4


_PARAGRAPH = "Some words, then more of them, and so on, to the end; " * 3 + "a plain sentence without any further marks " * 6


@pytest.mark.parametrize("part", ["<ul>" + "".join(f"<li>item number {i} of it</li>" for i in range(10)) + "</ul>",
                                  "<table><tr><th>a head of it</th></tr>" + "".join(f"<tr><td>cell {i}</td></tr>" for i in range(9)) + "</table>",
                                  "<pre>x = 1</pre>" * 9, "<blockquote><p>So it goes</p></blockquote>" * 9])
def test_main_text_keeps_parts_of_a_marked_article(part):
    body = "<h2>Over it</h2>".join([f"<p>{_PARAGRAPH}</p>" * 4, part, f"<p>{_PARAGRAPH}</p>" * 4])
    want = re.sub(r"\s*\n\s*", "\n", re.sub(r"<[^>]*>", "\n", body)).strip()
    assert tag_paths.main_text(f"<body><article>{body}</article><p>out, of, it</p></body>") == want
    links = "<ul>" + "<li><a href=x>another page to see</a></li>" * 9 + "</ul>"
    again = tag_paths.main_text(f"<body><article>{body.replace(part, part + '<h2>Over it</h2>' + links)}</article></body>")
    assert "another page" not in again and len(again) >= len(want)


def test_main_text_neighbours_need_text_of_their_own():
    page = lambda part: f"<body><div><p>{_PARAGRAPH}</p>{part}<p>{_PARAGRAPH}</p><p>{_PARAGRAPH}</p></div></body>"
    text = _PARAGRAPH.strip()
    assert tag_paths.main_text(page("<div class=x>5 min</div>" * 9)) == "\n".join([text] * 3)
    quote = "A quotation of some length, with marks, as long as a third of a paragraph, is content here, beside the rest of it."
    assert tag_paths.main_text(page(f"<blockquote>{quote}</blockquote>")) == "\n".join([text, quote, text, text])


def test_ratios_part_articles_from_the_rest(spark, sf_small):
    pages = [r[0] for r in spark.read.parquet(f"{sf_small}/pages.parquet").select("html").collect()]
    whole = [tag_paths.main_text(p) for p in pages]
    alone = [tag_paths.main_text(p, marks=False) for p in pages]
    neither = [tag_paths.main_text(p, marks=False, ratios=False) for p in pages]
    assert sum(a == w for a, w in zip(alone, whole)) >= .85 * len(pages)
    assert sum(n != w for n, w in zip(neither, whole)) >= .9 * len(pages)  # without the ratios the rest stays


def test_marks_are_a_prior_of_the_ratios():
    body = f"<p>{_PARAGRAPH}</p>" * 3
    text = "\n".join([_PARAGRAPH.strip()] * 3)
    other = f"<div class=comments>{f'<p>{_PARAGRAPH} They, too, say.</p>' * 9}</div><footer>A, b, c. All rights, reserved.</footer>"
    for page in (f"<body><article>{body}</article>{other}</body>", f"<body><div>{body}</div>{other}</body>",
                 f"<body>{other}<div>{body}</div></body>", f"<body><div class=social>{body}</div></body>"):  # the last is misnamed
        assert tag_paths.main_text(page) == text, page
    assert tag_paths.main_text(f"<body><article><h1>Only a head</h1></article>{'<footer>A, b, c.</footer>'}</body>") == "Only a head"
    assert tag_paths.main_text("<body><nav>Here, there.</nav><footer>A, b, c.</footer></body>") == ""


def test_extract_edge_cases(spark):
    assert tag_paths.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    long = "<p>" + "many words, and more. " * 200_000 + "</p>"
    got = tag_paths.extract(spark.createDataFrame([(1, "u", long, "x", 3)], "page_id long, url string, html string, text string, n_chars int"))
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.first()["n_chars"] == 200_000 * 22 - 1


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>One, two, three.</p>"), (1, "u", "<p>One, two, three.</p>"), (2, None, None), (None, "v", "")],
                                  "page_id long, url string, html string")
    got = sorted(map(tuple, tag_paths.extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "One, two, three.", 16)] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=repr)


def _brute_lines(rows, least):
    texts = {}
    for i, t in rows:
        texts.setdefault((i is None, i or 0, t or ""), None)
    seen, out = {}, {}
    for key in sorted(texts):
        x = [(z.strip(" \t\n\r\x0b\x0c"), len(z.encode().split())) for z in key[2].split("\n") if z.encode().split()]
        gone = set()
        for a in range(len(x)):
            for b in range(a, len(x)):
                if sum(c for _, c in x[a:b + 1]) >= least:
                    run = tuple(z for z, _ in x[a:b + 1])
                    if seen.setdefault(run, (key, a)) != (key, a):
                        gone.update(range(a, b + 1))
        out[key] = [z for i, (z, _) in enumerate(x) if i not in gone]
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(3)
    lines = ["a", "b c", "d e f", "g h i j", "k l m n o", "p q"]
    rows = [(i, "\n".join(rng.choice([*lines, "", "  "]) if rng.random() < .9 else f"x{rng.randrange(30)} y"
                          for _ in range(rng.choice([0, 2, 5, 9, 14])))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = _brute_lines(rows, 6)
    for r in line_dedup.dedup_lines(df, 6).collect():
        text = dict(rows)[r.doc_id]
        assert [x.strip() for x in r.text.split("\n") if x.split()] == want[False, r.doc_id, text], r


def test_line_dedup_over_common_lines(spark):
    """Selected lines that many texts hold apart from the passages: every text differs in the lines around them."""
    rng = random.Random(8)
    passages = [[f"p{i} a{j} b" for j in range(4)] for i in range(4)]
    rows = []
    for i in range(60):
        x = [f"own{i} {j} x y" if rng.random() < .5 else rng.choice(["common one", "the common two", "a common line three"])
             for j in range(12)]
        at = rng.randrange(12)
        rows.append((i, "\n".join(x[:at] + passages[rng.randrange(4)][:rng.randint(1, 4)] + x[at:])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = _brute_lines(rows, 9)
    got = {r.doc_id: [x.strip() for x in r.text.split("\n") if x.split()] for r in line_dedup.dedup_lines(df, 9).collect()}
    assert got == {i: want[False, i, t] for i, t in rows}


def test_fingerprints_select_window_minima(spark):
    rng = random.Random(5)
    hashes = np.array([rng.choice([3, 5, 7, 11, 13, 17]) for _ in range(200)], np.uint64)
    first, last = line_dedup.windows(hashes, np.array([rng.randint(1, 9) for _ in range(200)]), 20)
    selected, _ = line_dedup.fingerprints(hashes, first, last)
    for a, b, at in zip(first.tolist(), last.tolist(), selected.tolist()):
        run = hashes[a:b + 1].tolist()
        assert at == a + max(i for i, h in enumerate(run) if h == min(run))
    assert len(set(selected.tolist())) < len(first) / 2


def test_windows_of_lone_fingerprints_go_no_further(spark):
    lone = "\n".join(f"lone {i} a b" for i in range(30))
    shared = "\n".join(f"shared {i} a b" for i in range(30))
    df = spark.createDataFrame([(1, lone), (2, shared + "\nx"), (3, "y\n" + shared)], "doc_id long, text string")
    ids = {r.id for r in line_dedup.shared_windows(line_dedup._keyed(df), 50).collect()}
    assert ids == {2, 3}


def test_line_dedup_odd_rows(docs):
    got = line_dedup.dedup_lines(docs).collect()
    assert len(got) == len(edge.rows())
    assert sum(r.text is None for r in got) == sum(r[1] is None for r in edge.rows())
    passages = sorted(r.doc_id for r in got if r.doc_id in range(24, 28) and r.n_deleted)
    assert passages == [25, 26, 27]  # the first text keeps the passage


def test_packing(docs):
    path = tokens.default_path()
    got = packing.pack_documents(docs, path, capacity=256).collect()
    enc = tokens.encoder(path).tokenizer
    want = collections.Counter()
    for r in edge.rows():
        ids = enc.encode(r[1] or "", add_special_tokens=False).ids + [0]
        first = len(ids) - (-(-len(ids) // 256) - 1) * 256
        cuts = [0, *range(first, len(ids) + 1, 256)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))] and sum(n for _, n in b) <= 256


def test_two_fit_replaces_the_smallest():
    counts = np.zeros(11, int)
    for n in (7, 2, 2, 1):  # greedy fills 7 + 2 + 1; nothing better
        counts[n] += 1
    assert sum(t for _, t in packing.plan_bins(counts, 10)) == 2
    counts[:] = 0
    counts[[6, 3]] = 1
    counts[2] = 2  # 6 + 3 leaves 1; 6 + 2 + 2 is full
    assert packing.plan_bins(counts, 10)[0] == ({6: 1, 2: 2}, 1)
    rng = np.random.default_rng(0)
    counts = np.bincount(rng.integers(1, 200, 20_000), minlength=257)
    plan = packing.plan_bins(counts, 256)
    used = np.zeros(257, int)
    for b, times in plan:
        assert sum(n * k for n, k in b.items()) <= 256
        for n, k in b.items():
            used[n] += k * times
    assert (used == counts).all()
    assert sum(t for _, t in plan) <= 1.005 * (np.arange(257) * counts).sum() / 256 + 1


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 8])
def test_contamination_against_brute_force(spark, docs, block):
    item_words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    source = [r[1] for r in edge.rows() if r[1]]
    items = [(1, " ".join(source[5].split()[:12])), (2, " ".join(source[30].split()[20:45])), (2, source[0]), (3, "alpha"), (4, None),
             (5, ""), (None, " ".join(source[6].split()[:11])), (6, "nowhere to be found"), (7, "no id")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = item_words.findall(lower(t))
        for a in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[a:a + 10])].add(i)
    want = []
    for r in edge.rows():
        w = item_words.findall(lower(r[1]))
        hit, found = set(), set()
        for win, ids in windows.items():
            for a in range(len(w) - len(win) + 1):
                if tuple(w[a:a + len(win)]) == win:
                    hit.update(range(a, a + len(win)))
                    found |= ids
        names = sorted(str(i) for i in found if i is not None)
        want.append((r[0] is None, r[0] or 0, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    got = keyed(decontaminate.contamination(docs, bench, block=block), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == sorted(want, key=repr)
    assert decontaminate.clean_rows(docs, bench).columns == docs.columns


def _katz(rows, n):
    pad = lambda t: ["<s>"] * (n - 1) + [w for w in WORD.findall(lower(t))] + ["</s>"]
    count = {m: collections.Counter() for m in range(1, n + 1)}
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            x = pad(t)
            for p in range(n - 1, len(x)):
                for m in count:
                    count[m][tuple(x[p - m + 1:p + 1])] += 1
    d = {}
    for m in count:
        of = np.zeros(katz.MOST + 2)
        for r in count[m].values():
            if r <= katz.MOST + 1:
                of[r] += 1
        d[m] = katz.discounts(of)
    disc = lambda m, r: r * (d[m][r] if r <= katz.MOST else 1)
    after = {m: collections.defaultdict(list) for m in count}
    for m in count:
        for g, r in count[m].items():
            after[m][g[:-1]].append((g[-1], r))
    total = sum(count[1].values())
    lost = sum(r - disc(1, r) for r in count[1].values())
    whole, unknown = (total, lost / total) if lost > 1e-12 else (total + 1, 1 / (total + 1))

    def p(context, w):
        m = len(context) + 1
        r = count[m][(*context, w)]
        if m == 1:
            return disc(1, r) / whole if r else unknown
        seen = after[m].get(context)
        if not seen:
            return p(context[1:], w)
        lost = sum(r - disc(m, r) for _, r in seen)
        c = sum(r for _, r in seen) + (lost <= 0)
        if r:
            return disc(m, r) / c
        return (lost if lost > 0 else 1) / c / (1 - sum(p(context[1:], v) for v, _ in seen)) * p(context[1:], w)

    vocabulary = [g[0] for g in count[1]] + ["<unknown>"]
    for context in [("<s>",) * (n - 1), *list(after[n])[:5]]:
        assert abs(sum(p(context, w) for w in vocabulary) - 1) < 1e-9
    for i, t in rows:
        x = pad(t)
        yield (i is None, i or 0, len(x) - n + 1, sum(count[1][w,] > 0 for w in x[n - 1:]), total,
               sum(np.log10((count[1][w,] + .1) / (total + .1 * (len(count[1]) + 1))) for w in x[n - 1:]),
               sum(np.log10(p(tuple(x[q - n + 1:q]), x[q])) for q in range(n - 1, len(x))))


@pytest.mark.parametrize("order", [2, 3])
def test_katz_against_brute_force(spark, order):
    rng = random.Random(5)
    vocab = [*"abcdeFgh", *[f"w{i}" for i in range(120)]]
    rows = [(i, " ".join(vocab[min(int(rng.expovariate(.08)), 127)] for _ in range(rng.choice([0, 1, 5, 30, 80])))) for i in range(90)]
    rows += [(None, "a b"), (500, None), (500, None), (77, "zz  new\tword")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = keyed(katz.katz_scores(df, order=order, block_bytes=3000)[0], "n_tokens", "n_known", "train_tokens", "base_score", "score")
    want = sorted(_katz(rows, order), key=lambda r: r[:2])
    assert [g[:5] for g in got] == sorted([w[:5] for w in want], key=repr)
    ranked = lambda rows, c: sorted((r[0], r[1], round(r[c], 6)) for r in rows)
    for c in (5, 6):
        assert np.allclose([x[2] for x in ranked(got, c)], [x[2] for x in ranked(want, c)], atol=1e-5)


def test_registered_katz_has_two_words_of_context(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/documents.parquet")
    score = lambda x: dict(x.select("doc_id", "score").collect())
    got, want, less = score(queries.op7_katz(spark, sf_small)), score(katz.katz_scores(df, order=3)[0]), score(katz.katz_scores(df, order=2)[0])
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in want)
    assert not all(np.isclose(got[k], less[k]) for k in less)


def test_katz_packing_of_keys():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 999).astype(np.uint64) * np.uint64(2))
    assert (katz.unpack(katz.pack(keys)) == keys).all()
    n = np.array([0, 1, 254, 255, 70_000])
    assert (katz.unpack_counts(katz.pack_counts(n), 5) == n).all()


def test_katz_packing_of_shares():
    x = np.random.default_rng(4).random(999)
    assert np.allclose(katz.unpack_shares(katz.pack_shares(x)), x, rtol=0, atol=2.0 ** -41)
    assert [katz.loosen(katz.squeeze(c)) for c in (None, b"", b"a", b"ab" * 999)] == [None, b"", b"a", b"ab" * 999]
    keys, place = katz.distinct(np.array([5, 3, 5, 9, 3], np.uint64))
    assert keys.tolist() == [3, 5, 9] and place.tolist() == [1, 0, 1, 2, 0]
    given = np.random.default_rng(5).integers(0, 300, 3000).astype(np.uint64) * np.uint64((1 << 47) + 1) + np.uint64(7)
    keys, place = katz.distinct(given)  # many keys that agree in their upper bits
    assert (keys == np.unique(given)).all() and (keys[place] == given).all()
    given = (np.random.default_rng(6).integers(0, 300, 3000)).astype(np.uint64)
    keys, place = katz.distinct(given)
    assert (keys == np.unique(given)).all() and (keys[place] == given).all()


def test_katz_memory_of_a_block():
    """A token costs a task at most 75 bytes while n-grams are asked for."""
    import tracemalloc
    h = np.random.default_rng(7).integers(0, 1 << 62, 1_000_000).astype(np.uint64)
    tracemalloc.start()
    try:
        block = katz.Block([(h, np.full(1000, 1000))], np.arange(1000) % 10 == 0, 3)
        asked = sum(b.num_rows for b in katz._count_requests(4, [1, 2])(0, block, [], None))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert asked == 32 and peak < 75 * len(block.tokens)


def test_katz_texts_are_shuffled_by_block_and_compressed(spark):
    rows = [(i % 2, i if i else None, i % 3 == 0, b"some text like others " * (i % 5)) for i in range(400)]
    dealt = katz._deal(spark.createDataFrame(rows, "block int, doc_id long, held boolean, text binary").coalesce(1)).collect()
    assert [(r.block, r.kind, r.n) for r in dealt] == [(0, katz._TEXT, 200), (1, katz._TEXT, 200)]
    assert sum(len(r["keys"]) for r in dealt) * 10 < sum(len(r[3]) for r in rows)
    for r in dealt:
        off = np.concatenate([[0], np.frombuffer(katz.loosen(r.a), "<i8")]).cumsum().tolist()
        texts = [bytes(katz.loosen(r["keys"]))[i:j] for i, j in zip(off, off[1:])]
        got = zip(np.frombuffer(katz.loosen(r.b), "<i8").tolist(), np.frombuffer(katz.loosen(r.c), np.uint8).tolist(), texts)
        assert list(got) == [(i or 0, int(h) + 2 * (i is None), x) for b, i, h, x in rows if b == r.block]


def test_katz_model_table(spark):
    """Each order's table holds its n-grams (and the start tokens as a context), counts and one weight per context."""
    rows = [(1, "a b a"), (2, "a c"), (3, "b a b")]
    table = katz.katz_scores(spark.createDataFrame(rows, "doc_id long, text string"), folds=1 << 30, order=3, block_bytes=4)[1].collect()
    for m, held in ((1, {("a",): 4, ("b",): 3, ("c",): 1, ("</s>",): 3, ("<s>",): 3}),
                    (3, {("<s>", "<s>", "a"): 2, ("<s>", "<s>", "b"): 1, ("<s>", "a", "b"): 1, ("<s>", "a", "c"): 1, ("<s>", "b", "a"): 1,
                         ("a", "b", "a"): 1, ("b", "a", "</s>"): 1, ("a", "c", "</s>"): 1, ("b", "a", "b"): 1, ("a", "b", "</s>"): 1})):
        mine = [r for r in table if r.ord == m]
        keys = np.concatenate([katz.unpack(katz.loosen(r.keys)) for r in mine])
        assert sorted(np.concatenate([katz.unpack_counts(katz.loosen(r.counts), r.n) for r in mine])) == sorted(held.values())
        assert len(np.unique(keys)) == len(keys) == len(held)
        for r in mine:
            w = katz.loosen(r.weights)
            assert w is None if m == 3 else (np.frombuffer(w, "<f4") > 0).all() and len(w) == 4 * r.n


def test_kth_largest(spark):
    rng = random.Random(1)
    values = [rng.choice([rng.random(), 0.25, -3.0, 1e9]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "sample_key double")
    for k in (1, 2, 100, 250, 499, 500):
        assert importance.kth_largest(df, k, digits=8) == sorted(values, reverse=True)[k - 1]


def test_importance_on_held_out_labels(spark, sf_small):
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2))
    got = importance.quality_weights(docs, labels.where(fold == 1)).join(labels.where(fold == 0), "doc_id")
    mean = {r["quality"]: r["m"] for r in got.groupBy("quality").agg(F.avg("log_weight").alias("m")).collect()}
    assert mean[1] > mean[0]


def test_toxicity_model_finds_the_words():
    import pyarrow as pa
    rng = random.Random(6)
    texts, y = [], []
    for i in range(1200):
        t = [f"w{int(rng.expovariate(.02))}" for _ in range(60)]
        if i % 6 == 0:
            for w in rng.sample(["bada", "badb", "badc"], 2):
                t[rng.randrange(60)] = w
        texts.append(" ".join(t).encode())
        y.append(i % 6 == 0)
    place, row = toxicity.features(pa.array(texts, pa.binary()), 18)
    sets = [np.unique(place[row == i]) for i in range(len(texts))]
    at, w, bias = toxicity.train(sets[:900], np.array(y[:900], float), 18)
    weight = dict(zip(at.tolist(), w))
    score = [bias + sum(weight.get(p, 0) for p in s.tolist()) > 0 for s in sets[900:]]
    assert np.mean(np.array(score) == np.array(y[900:])) > 0.97
    assert len(at) < 2000  # sparse


def test_partenum_against_brute_force(spark, docs):
    sets = {}
    for i, r in enumerate(edge.rows()):
        w = WORD.findall(lower(r[1]))
        sets[i] = {tuple(w[a:a + 5]) for a in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    rng = random.Random(8)
    extra = []
    for g in range(12):  # groups of near copies of all sizes
        base = [f"v{rng.randrange(500)}" for _ in range(rng.choice([3, 5, 7, 9, 14, 40, 200]))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(9)}"
            extra.append((1000 + len(extra), " ".join(copy)))
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = [(r[0], r[1]) for r in edge.rows()] + extra
    for i, (_, t) in enumerate(rows):
        w = WORD.findall(lower(t))
        sets[i] = {tuple(w[a:a + 5]) for a in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    want = collections.Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))
    got = partenum.jaccard_components(df).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    kept = partenum.one_of_each(docs)
    assert kept.columns == docs.columns
    assert collections.Counter(r.doc_id for r in kept.collect())[3] == 1  # of repeated rows one


def test_partenum_signatures_never_miss():
    rng = np.random.default_rng(2)
    for n in [*range(1, 40), 64, 65, 127, 128, 200, 300]:
        for _ in range(12):
            x = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            cut = rng.integers(0, len(x) // 5 + 1)
            y = np.unique(np.concatenate([rng.permutation(x)[cut:], rng.integers(0, 1 << 62, rng.integers(0, len(x) // 4 + 1)).astype(np.uint64)]))
            common = np.sort(rng.permutation(x)[:len(x) // 3])
            if partenum.linked(x, y):
                assert np.isin(partenum.signatures(x, common), partenum.signatures(y, common)).any(), n


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, 50), (50, 70), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, 70: 50, 100: 50}


def test_empty_tables_and_row_counts(spark, docs):
    path = tokens.default_path()
    labels, bench = edge.labels(spark), spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")
    none = docs.where("false")
    n = len(edge.rows())
    for run in (lambda d: divergence.quality(d), lambda d: line_dedup.dedup_lines(d), lambda d: decontaminate.contamination(d, bench),
                lambda d: katz.katz_scores(d)[0], lambda d: importance.quality_weights(d, labels),
                lambda d: toxicity.toxicity(d, labels), lambda d: partenum.jaccard_components(d),
                lambda d: records.read_records(*records.write_records(d, path))):
        assert run(none).count() == 0
        assert run(docs).count() == n
    assert packing.pack_documents(none, path).count() == 0
    assert decontaminate.contamination(docs, bench.where("false")).where("contaminated").count() == 0
    assert importance.quality_weights(docs, labels.where("false")).where("not sampled").count() == 0
    assert importance.keep(docs, labels).columns == docs.columns
    assert toxicity.toxicity(docs, labels.where("false")).agg(F.max("score")).first()[0] < 1e-9

"""Corpus operators against brute force on small fixtures, with the edge cases their docstrings name."""

import collections
import math
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from cellarium.llm import chat, decontam, dedup, html, license, lm, packing, quality, shards, tokens

PIECES, WORDS = P.path("piece_bpe_32k.model"), P.path("word_bpe_49k.json")
KIND = "doc_id bigint, text string, lang string, source string, n_words string, shard int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(9000))
BASE = " ".join(f"tok{i}" for i in range(120))
ROWS = [
    (1, BASE), (2, BASE.replace("tok60", "other")), (3, BASE.upper()), (4, ""), (5, None), (6, "one two"), (7, "One  two"), (8, LONG), (9, "a b c d e " * 40),
    (10, "x\n\nx\nAll Rights reserved.\nReleased under the MIT License."), (11, BASE), (11, BASE), (None, BASE), (12, "Licensed under CC BY-NC 4.0. cc by"), (13, "ünï <|endoftext|> ▁ x\x1cy  日本"),
    (14, "### $$$ " * 60), (15, " \n\t "), (16, " ".join(f"z{i}" for i in range(200)) + " " + " ".join(f"tok{i}" for i in range(30, 70))),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None if i == 6 else "en", "hot" if (i or 0) % 2 else None, "clash", 7) for i, t in ROWS], KIND).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def words(t):
    return (t or "").encode().lower().split()


def grams(t):
    w = words(t)
    n = min(5, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()


def test_quality(docs, none):
    got = quality.quality_rules(docs).collect()
    assert len(got) == len(ROWS)
    want = collections.Counter()
    for i, t in ROWS:
        w = (t or "").encode().split()
        tri = collections.defaultdict(list)
        for k in range(len(w) - 2):
            tri[tuple(w[k : k + 3])].append(k)
        hit = {p for ks in tri.values() if len(ks) > 1 for k in ks for p in (k, k + 1, k + 2)}
        lines = [x for x in (t or "").split("\n") if x.encode().split()]
        want[(i, len(w), sum(len(x.decode()) for x in w), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))] += 1
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(not (r.kept and r.base_failed) for r in got)
    assert quality.quality_rules(none).count() == 0
    kept = quality.stage(docs.sparkSession, docs, "")
    assert kept.columns == docs.columns


def test_sketches_merge(docs):
    s = quality.sketches(quality.signals(docs))
    halves = quality.sketches(quality.signals(docs.filter("doc_id % 2 = 0"))).unionByName(quality.sketches(quality.signals(docs.filter("doc_id % 2 = 1 or doc_id is null"))))
    same = halves.groupBy("lang", "source", "signal", "bucket").agg(F.sum("n").alias("n"))
    assert s.exceptAll(same).isEmpty() and same.exceptAll(s).isEmpty()


def test_near_duplicates(docs, none):
    got = dedup.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    rows = {i: grams(t) for i, t in ROWS if i is not None}
    up = {i: i for i in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in rows:
        for b in rows:
            if a < b and rows[a] and rows[b] and 100 * len(rows[a] & rows[b]) >= 85 * len(rows[a] | rows[b]):
                up[max(top(a), top(b))] = min(top(a), top(b))
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(rows[r.doc_id]), top(r.doc_id), top(r.doc_id) == r.doc_id)
    assert dedup.near_duplicates(none).count() == 0
    assert dedup.stage(docs.sparkSession, docs, "").columns == docs.columns


@pytest.mark.parametrize("small", [dedup.SMALL, 3])
def test_large_groups_of_near_copies(spark, monkeypatch, small):
    """Chains and groups of many components; with a small SMALL, elimination goes through several rounds."""
    monkeypatch.setattr(dedup, "SMALL", small)
    rng = np.random.default_rng(3)
    rows, sets = [], []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(90)]
        for k in range(150):
            w = list(base)
            for p in rng.choice(90, rng.integers(0, 3), replace=False):
                w[p] = f"e{rng.integers(9)}"
            rows.append((1000 * g + k, " ".join(w)))
            sets.append(grams(rows[-1][1]))
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    got = {r.doc_id: r.component_id for r in dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {rows[k][0]: rows[top(k)][0] for k in range(len(rows))}


def test_one_id_with_several_texts_and_repeated_rows(spark):
    other = " ".join(f"b{i}" for i in range(120))
    rows = [(5, BASE, "x"), (5, other, "x"), (9, other + " end", "x"), (2**60 + 1, BASE, None), (None, other, "y"), (7, "of its own", "z"), (7, "of its own", "z"), (None, None, "z"), (None, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rid string").repartition(3)
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in dedup.near_duplicates(docs).collect())
    assert got == [(0, 0, True)] * 3 + [(5, 5, True), (5, 5, True), (7, 7, True), (7, 7, True), (9, 5, False), (2**60 + 1, 5, False)]
    left = dedup.stage(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:4]) for r in left.collect()) == [(0, ""), (0, ""), (5, "b0 b"), (5, "tok0"), (7, "of i")]


def test_stage_drops_copies_from_four_fifths(spark):
    """Pairs of similarity 0.80 to 0.85 go in the stage and stay in the query."""
    rows, want = [], {}
    for g in range(40):
        base = [f"g{g}w{i}" for i in range(104)]
        w = [*base[:70], "x", *base[71:]] + [f"y{g}z{i}" for i in range(g % 18)]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(w))]
        a, b = map(grams, (rows[-1][1], rows[-2][1]))
        want[g] = 100 * len(a & b) / len(a | b)
    assert sum(80 <= x < 85 for x in want.values()) > 10 and min(want.values()) < 80
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r.doc_id for r in dedup.stage(spark, docs, "").collect()}
    assert left == {2 * g + k for g, x in want.items() for k in (0, 1) if not k or x < 80}
    assert {r.doc_id for r in dedup.near_duplicates(docs).filter("kept").collect()} == {2 * g + k for g, x in want.items() for k in (0, 1) if not k or x < 85}


def test_bands_follow_the_threshold():
    assert dedup.layout(85) == (32, 6) and dedup.layout(80) == (38, 5)
    for percent in (50, 60, 70, 80, 85, 90, 95):
        n, size = dedup.layout(percent)
        assert n * size <= dedup.HASHES and (1 - (percent / 100) ** size) ** n <= dedup.MISS


def test_bayes_pruning_bounds():
    least = dedup.least_matches(0.85)
    assert least == sorted(least) and all(m < 0.85 * dedup.BATCH * k for k, m in enumerate(least) if k)


def test_packing(docs, none):
    got = packing.pack(docs, WORDS).collect()
    model = packing.WordIds(WORDS).model
    want = collections.Counter()
    for i, t in ROWS:
        ids = model.encode(t or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            want[(i, k, a, len(ids[a : a + 4096]), zlib.crc32(np.array(ids[a : a + 4096], "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 4096
    assert packing.pack(none, WORDS).count() == 0


def test_plan_places_every_length_once():
    rng = np.random.default_rng(1)
    h = collections.Counter(int(x) for x in np.minimum(4096, rng.lognormal(6, 1.2, 30000).astype(int) + 1))
    runs = packing.plan(dict(h))
    placed = collections.Counter()
    for n, held in runs:
        assert sum(k * m for k, m in held) <= 4096
        for k, m in held:
            placed[k] += n * m
    assert placed == h
    assert sum(n for n, _ in runs) <= 1.01 * math.ceil(sum(k * v for k, v in h.items()) / 4096)


def test_plan_of_few_lengths_is_exact():
    for h, want in (({2049: 40, 2047: 40}, 40), ({2731: 10, 1366: 10, 1365: 10}, 15), ({1638: 30, 1229: 60}, 30), ({4096: 3, 1: 5}, 4), ({1: 4096}, 1)):
        assert packing.sequences(packing.plan(h)) == want

    def fewest(items, capacity):
        best = [len(items)]

        def go(i, room):
            if len(room) >= best[0]:
                return
            if i == len(items):
                best[0] = len(room)
                return
            for j in {r: j for j, r in enumerate(room) if r >= items[i]}.values():
                go(i + 1, [*room[:j], room[j] - items[i], *room[j + 1 :]])
            go(i + 1, [*room, capacity - items[i]])

        go(0, [])
        return best[0]

    rng = np.random.default_rng(7)
    for _ in range(25):
        items = sorted(rng.choice(rng.integers(12, 70, rng.integers(2, 6)), rng.integers(6, 13)).tolist(), reverse=True)
        assert packing.sequences(packing.plan(dict(collections.Counter(items)), 100)) == fewest(items, 100)


def test_packing_keeps_large_ids_beside_nulls(spark):
    rows = [(2**60 + 1, "one two"), (2**60 + 3, "one two"), (None, "one two"), (None, "one two"), (7, "x" * 50_000), (7, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), WORDS).collect()
    assert collections.Counter(r.doc_id for r in got if r.doc_id != 7) == {2**60 + 1: 1, 2**60 + 3: 1, None: 2}
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)


def test_chat(spark):
    rows = [(1, 1, "user", "hi"), (1, 2, "assistant", "yo"), (1, 0, "system", "be"), (1, 2, "bob", None), (2, 0, "system", "x"), (None, 3, "user", "a<|im_end|>"), (None, 3, None, "b"), (3, None, "user", "q"), (3, None, "user", "q"), (4, 0, "bob\nassistant", "x"), (4, 1, "a\x85b\u2028c", "y")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.speaker): r for r in chat.rotate(df).collect()}
    assert set(got) == {(1, "user"), (1, "assistant"), (1, "bob"), (None, "user"), (None, "unknown"), (3, "user"), (4, "bob assistant"), (4, "a b c")}
    assert "user name=bob assistant\nx" in got[(4, "a b c")].text
    r = got[(1, "bob")]
    assert r.text.startswith("<|im_start|>system\nbe<|im_end|>\n<|im_start|>user name=user\nhi") and (r.n_turns, r.n_own) == (4, 1)
    for r in got.values():
        spans = [tuple(map(int, s.split(":"))) for s in r.mask.split(",")]
        assert len(spans) == r.n_own and all(r.text[:a].endswith("<|im_start|>assistant\n") and r.text[:b].endswith("<|im_end|>\n") for a, b in spans)
    assert chat.rotate(df.filter("false")).count() == 0


def test_html(spark):
    page = """<html><head><title>t</title></head><body><header><p>Site of the day</p></header><nav><ul><li><a href=x>A</a></li></ul></nav><div class="cookie-notice"><p>We use cookies and that is all that there is to it.</p></div>
    <div id=main><h1>Heading</h1><p>The house on the hill was the one that he had in his mind when he came to the town, and it was not for sale at the time.</p><p>Yes&nbsp;&amp;  no.<p>And so it was that he went back to the city that he had come from in the spring of the year before that one.</div>
    <div class=sidebar><p>Of the and in it is the one</p></div><section id="comments"><p>I was the one and it is the best of all that there is in the town.</p></section><script>var a = "</p>";</script><footer>&copy; x</footer></body></html>"""
    df = spark.createDataFrame([(1, "u", page), (2, "v", None), (3, None, ""), (None, "w", "<p>a"), (4, "x", "<article><p>Hi.<p><b>Yo<br>you</article><p>z")], "page_id bigint, url string, html string")
    got = {r.page_id: r for r in html.extract(df).collect()}
    t = got[1].text.split("\n\n")
    assert t[0] == "Heading" and t[2] == "Yes & no." and len(t) == 4
    assert got[2].text == got[3].text == "" and got[4].text == "Hi.\n\nYo you"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html.extract(df.filter("false")).count() == 0


def test_html_rules_hold_inside_articles():
    story = "<p>The house on the hill was the one that he had in his mind when he came to the town, and it was not for sale at the time that he was there with her.</p>"
    linked = "<p><a href=x>The town and the hill: all that you have to see when you are there in the spring, and what it is that they do not show to you at all</a></p>"
    advert = "<p>Buy AcmeTurbo 3000 blender today! Free express shipping, 50% discount, order online right now, limited stock, visit AcmeStore, download AcmeStore app</p>"
    got = html.main_text(f"<body><article><h1>Heading</h1>{story}<p>Yes.</p>{story}{linked}<p>More</p>{advert}{linked}{story}<p>No.</p></article></body>").split("\n\n")
    assert [x[:7] for x in got] == ["Heading", "The hou", "Yes.", "The hou", "The hou", "No."] and not any("Acme" in x or "spring" in x for x in got)
    names = "<p>Anna Berg, Carl Dahl, Emil Falk, Greta Holm, Ivar Jansson, Karin Lund, Maria Nilsson, Olof Palm</p>"
    assert html.main_text(f"<main>{names}</main>").startswith("Anna") and html.main_text(f"<main>{story}{names}{story}</main>").count("Anna") == 1


STORY = "The house on the hill was the one that he had in his mind when he came to the town, and it was not for sale at the time that he was there with her."
JAPANESE = "これは日本語の長い文章であり、この町の歴史について詳しく説明しているものです。彼はその丘の上の家を見て、とても美しいと思ったが、買うことはできなかった。"
RUSSIAN = "Дом на холме был тем самым, о котором он думал, когда приехал в город, но он тогда не продавался, и это было очень грустно для всей его большой семьи и соседей."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body><form id=aspnetForm><div><h1>Head line</h1><p>{STORY}</p><p>{STORY}</p></div><input type=text></form><footer>x</footer></body>", f"Head line\n\n{STORY}\n\n{STORY}"),
        (f"<body><form id=aspnetForm><article><p>{STORY}</p></article></form></body>", STORY),
        (f'<div class="layout has-sidebar"><article><p>{STORY}</p></article></div>', STORY),
        (f'<div class="single-post with-comments"><p>{STORY}</p><p>{STORY}</p></div>', f"{STORY}\n\n{STORY}"),
        (f'<body class="nav-open"><div class="nav-open"><p>{STORY}</p></div></body>', STORY),
        (f"<body><nav><a href=x>ホーム</a></nav><div><p>{JAPANESE}</p><p>{JAPANESE}</p></div></body>", f"{JAPANESE}\n\n{JAPANESE}"),
        (f"<body><nav><a href=x>Дом</a></nav><div><p>{RUSSIAN}</p><p>{RUSSIAN}</p></div></body>", f"{RUSSIAN}\n\n{RUSSIAN}"),
        (f"<article><p>{STORY} So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> it is.</p></article>", f"{STORY} So x=2 it is."),
        (f'<body><div><p>{STORY}</p></div><div id="comments"><p>{STORY}</p><p>{STORY}</p><p>{STORY}</p></div></body>', STORY),
        (f'<body><article><p>{STORY}</p></article><div id="comments"><article><p>{STORY}</p><p>{STORY}</p></article></div></body>', STORY),
        (f'<body><div class="overlay"><main><p>{STORY}</p></main></div></body>', STORY),
        (f'<body><article><p>{STORY}</p></article><form><p>{STORY}</p><p>{STORY}</p></form></body>', STORY),
    ],
)
def test_html_layouts(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("unit", ["<a ", '<a "', "<![CDATA[", "<!", "<script>", "</script", "<div>", "<span class=nav>", "<form>", '<div class="sidebar">x', "<a <b>", "</b>", "x" * 3])
def test_html_takes_linear_time(unit):
    began = time.perf_counter()
    html.main_text("<div>" * 20_000 + unit * (400_000 // len(unit)) + "</p></i>" * 20_000 + "'>")
    assert time.perf_counter() - began < 20


def test_html_second_pass_by_search():
    """Labels of random block lists against a search for the nearest decided neighbours."""
    rng = np.random.default_rng(9)
    kinds = {"good": (STORY, 0.0, False), "near": (STORY[:100], 0.0, False), "short": ("Yes.", 0.0, False), "bad": (STORY, 0.9, False), "menu": (STORY, 0.0, True)}
    for _ in range(300):
        names = rng.choice(list(kinds), rng.integers(1, 12)).tolist()
        got = html.labels([("p", *kinds[k], 0) for k in names])
        first = names if "good" in names else ["good" if k == "near" else k for k in names]
        for i, k in enumerate(first):
            if k in ("good", "bad", "menu"):
                assert got[i] == (k == "good")
                continue
            left = next(((d, first[i - d]) for d in range(1, i + 1) if first[i - d] in ("good", "bad")), None)
            right = next(((d, first[i + d]) for d in range(1, len(first) - i) if first[i + d] in ("good", "bad")), None)
            sides = [x for x in (left, right) if x]
            if len({x[1] for x in sides}) < 2:
                want = bool(sides) and sides[0][1] == "good" or k == "near" and not sides
            else:
                want = k == "near" or min(sides, key=lambda x: x[0])[1] == "good"  # a tie goes to the left
            assert got[i] == want, (names, i)


def test_html_hidden_is_an_attribute():
    text = "The house on the hill was the one that he had in his mind."
    for seen in ('style="overflow:hidden"', 'title="The hidden valley"', 'data-topic="hidden costs"', 'aria-label="Legal news"', 'class="overflow-hidden"', 'hidden="false"', "title='class=\"menu\"'"):
        assert html.main_text(f"<body><div {seen}><article><p>{text}</p></article></div></body>") == text, seen
        assert html.main_text(f"<body><article><div {seen}><p>{text}</p></div></article></body>") == text, seen
    for gone in ("hidden", 'hidden=""', 'style="color:red; display : none"', "style='visibility:hidden'", 'aria-hidden="true"', 'class="x hidden"', 'id="comments"', "role=navigation", 'itemprop="comment"'):
        assert html.main_text(f"<body><article><p>{text}</p><div {gone}><p>{text}</p></div></article></body>") == text, gone


def test_lattice_against_all_segmentations():
    v = lm.pieces(PIECES)
    lp = v.first_scores()
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    known = {m.id_to_piece(i): i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))}

    def brute(x):
        if not x:
            return 1.0
        out = sum(math.exp(lp[known[x[:j]]]) * brute(x[j:]) for j in range(1, len(x) + 1) if x[:j] in known)
        return out if x[0] in known else out + math.exp(sum(lp[v.byte[b]] for b in x[0].encode())) * brute(x[1:])

    ws = ["the", "öé", "日本", "x" * 9, "\U0001f600a", "ﷺ", ""]
    q, n = lm.lattice(v, ws, lp, np.ones(len(ws)))
    assert np.allclose(q, [math.log(brute("▁" + w)) for w in ws])
    assert (n >= 0).all() and n.sum() > len(ws)


def test_scores(docs, none):
    got = lm.score(docs, PIECES, head=3).collect()
    full = {(r.doc_id, r.n_tokens): r for r in lm.score(docs, PIECES).collect()}
    train = collections.Counter()
    for i, t in ROWS:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            train.update([*words(t), None])
    n, v = sum(train.values()), len(train)
    assert len(got) == len(ROWS)
    want = {}
    for i, t in ROWS:
        ws = [*words(t), None]
        want[(i, len(ws))] = (sum(math.log10((train.get(w, 0) + 1) / (n + v + 1)) for w in ws), sum(train.get(w, 0) > 0 for w in ws))
    for r in got:
        base, known = want[(r.doc_id, r.n_tokens)]
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.n_known == known and r.train_tokens == n
        assert math.isclose(r.score, full[(r.doc_id, r.n_tokens)].score, rel_tol=1e-9) and r.score < 0
        assert math.isclose(r.lattice_score, full[(r.doc_id, r.n_tokens)].lattice_score, rel_tol=1e-9) and r.lattice_score < 0
    assert lm.score(none, PIECES).count() == 0


def test_scores_by_hand(spark):
    """score and lattice_score from sums over all segmentations, written out."""
    import sentencepiece

    texts = [(1, "the cat the"), (2, "a bat"), (3, None), (4, "the bat bats at"), (5, "cat a")]
    train = [(i, t or "") for i, t in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    count = collections.Counter(w for _, t in train for w in t.split())
    c, v, n = sum(count.values()), len(count), sum(count.values()) + len(train)
    n1, n2 = (sum(x == k for x in count.values()) for k in (1, 2))
    d, e = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5, (len(train) + 1) / (n + 2)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    usable = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}

    def paths(x):
        """All segmentations of x into pieces."""
        return [[usable[x[:j]], *rest] for j in range(1, len(x) + 1) if x[:j] in usable for rest in paths(x[j:])] if x else [[]]

    pure = [1 / (i + 100) for i in range(model.get_piece_size())]
    pure = fitted = [x / sum(pure) for x in pure]
    chance = lambda p, path: math.prod(p[i] for i in path)
    for _ in range(lm.ROUNDS):
        found = [0.01] * len(pure)
        for w in count:
            ways = paths("▁" + w)
            total = sum(chance(fitted, x) for x in ways)
            for x in ways:
                for i in x:
                    found[i] += chance(fitted, x) / total
        fitted = [x / sum(found) for x in found]
    q = lambda p, w: sum(chance(p, x) for x in paths("▁" + w))
    for r in lm.score(spark.createDataFrame(texts, "doc_id bigint, text string"), PIECES).collect():
        ws = (dict(texts)[r.doc_id] or "").split()
        learnt = math.log10(e) + sum(math.log10((1 - e) * (max(count[w] - d, 0) / c + d * v / c * q(fitted, w))) for w in ws)
        assert math.isclose(r.score, learnt, rel_tol=1e-9)
        assert math.isclose(r.lattice_score, math.log10(e) + sum(math.log10((1 - e) * q(pure, w)) for w in ws), rel_tol=1e-9)


def test_leaks(spark, docs, none):
    items = [(1, " ".join(f"tok{i}" for i in range(30, 60))), (2, "one TWO"), (3, None), (4, ""), (5, " ".join(f"tok{i}" for i in range(100))), (5, "two"), (6, LONG), (7, "not there at all in any")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")

    def short(t, n):
        w = words(t)
        return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}

    want = collections.Counter()
    for i, t in ROWS:
        for k, q in items:
            g = grams(q)
            if g and len(g & (short(t, len(words(q))) if len(words(q)) < 5 else grams(t))) >= 0.8 * len(g):
                want[(i, k)] += 1
    assert collections.Counter((r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()) == want
    assert decontam.leaks(none, bench).count() == 0 and decontam.leaks(docs, bench.filter("false")).count() == 0


def test_small_items_are_found_without_a_miss():
    """Items of 5 to 12 words inside one long document, and the nearly whole ones among them."""
    rng = np.random.default_rng(11)
    ws = [f"v{x}" for x in rng.integers(0, 10**6, 30000)]
    items = [(k, " ".join(ws[13 * k : 13 * k + 5 + k % 8])) for k in range(2300)]
    got = decontam.Items(items).found(["other words", " ".join(ws)], 0.8)
    assert [(d, k) for d, k, _ in got] == [(1, k) for k in range(2300)]
    near = [(0, " ".join([*ws[:11], "x"])), (1, " ".join([*ws[:10], "x", "y"])), (2, " ".join([*ws[:5], "x"]))]  # 7 of 8, 6 of 8, 1 of 2
    assert decontam.Items(near).found([" ".join(ws)], 0.8) == [(0, 0, 7)]


def test_minima_of_long_items_are_of_the_whole_item():
    q = decontam.Items([(1, " ".join(f"w{k}" for k in range(decontam.STRIP + 9000)))])
    low = (q.sets[0] >> np.uint64(32)).astype(np.uint32)
    want = {(j << 32) | int((odd * low).min()) for j, odd in enumerate(decontam._odd)}
    assert set(q.index[max(q.index)][0].tolist()) == want


def test_licenses(docs, none):
    got = {r.doc_id: r for r in license.scan(docs).collect()}
    assert (got[10].n_base, got[10].first_word, got[10].base_labels, got[10].labels, got[10].score) == (1, 2, "reserved", "mit,reserved", 1.0)
    assert (got[12].n_base, got[12].first_word, got[12].last_word, got[12].base_labels, got[12].labels) == (2, 2, 7, "cc-by", "cc-by,cc-by-nc") and got[4].n_words == 0
    assert license.scan(docs).count() == len(ROWS) and license.scan(none).count() == 0


def test_wrapped_notices(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files"
    bsd = " * Redistribution and use in source and binary\r\n * forms, with or without\n *\n * modification, are permitted provided that\n * the following conditions are met:"
    filler = " ".join(f"word{k}" for k in range(300))
    far = mit.replace("\n", f"\n{filler}\n")
    rows = [(1, mit), (2, f"{filler}\n{bsd}\n{filler}"), (3, far), (4, mit.replace("granted, free", "given, free")), (5, "all\nrights\nreserved"), (6, "all rights\n" + filler + "\nreserved"), (7, mit.replace("\n", " ")), (8, f"{mit}\n{filler}\n{bsd}")]
    got = {r.doc_id: r for r in license.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {k: r.labels for k, r in got.items()} == {1: "mit", 2: "bsd", 3: "", 4: "mit", 5: "reserved", 6: "", 7: "mit", 8: "bsd,mit"}
    assert [got[k].score for k in (1, 2, 3, 5, 7)] == [1.0, 1.0, 0.0, 1.0, 1.0] and 0.9 <= got[4].score < 1


def test_scattered_words_are_no_notice(spark):
    rows = [(1, "the sun was released early under a mit roof while the license lapsed"), (2, "released under the mit license"), (3, "ALL RİGHTS RESERVED"), (4, "all rights\x1creserved"), (5, "this software is provided as is " * 3)]
    got = {r.doc_id: (r.labels, r.score) for r in license.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: ("", 0.0), 2: ("mit", 1.0), 3: ("", 0.0), 4: ("reserved", 1.0), 5: ("", 0.0)}


def test_set_join_is_exact(spark):
    """Every window of every template's span, counted one by one."""
    rng = np.random.default_rng(5)
    known = [(label, ws, a, license.span(license.TEMPLATES[i][1])) for i, label, ws, a in license.templates()]
    vocab = sorted({w for _, ws, _, _ in known for w in ws})
    texts = []
    for k in range(300):
        ws = license.TEMPLATES[k % len(known)][1].split()
        keep = [w for w in ws if rng.random() > 0.08]
        for _ in range(int(rng.integers(0, 4))):
            keep.insert(int(rng.integers(len(keep) + 1)), str(rng.choice(vocab)))
        if k % 3 == 0:
            keep = rng.permutation(keep).tolist()
        texts.append((k, " ".join([*rng.choice(vocab, 5), *keep, *rng.choice(vocab, 5)])))
    got = {r.doc_id: (r.labels, r.base_labels, round(r.score, 9)) for r in license.scan(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    for k, t in texts:
        w, hit = t.split(), []
        for label, ws, a, span in known:
            best = max(len(set(w[i : i + span]) & set(ws)) for i in range(len(w)))
            if best >= a:
                hit.append((label, best / len(ws)))
        labels, base, score = got[k]
        assert set(labels.split(",")) - {""} == {label for label, _ in hit} | set(base.split(",")) - {""}
        assert score == round(max((c for _, c in hit), default=0.0), 9)


def test_shards(docs, none, spark):
    for df, n in ((docs, 4), (docs, 40), (spark.range(3000).selectExpr("id doc_id", "repeat(cast(id % 700 as string), cast(id % 13 as int)) text"), 40)):
        got = shards.shard(df, n).collect()
        by = collections.defaultdict(list)
        for r in got:
            by[r.shard].append(r)
        assert set(by) <= set(range(n)) and all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
        assert len({(r.text_crc32, r.size) for r in got}) == sum(len({(r.text_crc32, r.size) for r in x}) for x in by.values())
        groups = [r["b"] for r in df.groupBy(F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("g")).agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 16).alias("b")).orderBy("g").collect()]
        least = np.cumsum(groups, dtype=float)  # of the first groups in one shard; one more shard each round, over all last cuts
        ends = np.concatenate([[0], least])
        for _ in range(n - 1):
            least = np.array([np.maximum(np.concatenate([[0], least])[: i + 1], ends[i + 1] - ends[: i + 1]).min() for i in range(len(groups))])
        assert max(sum(r.size for r in x) for x in by.values()) == least[-1]
    assert shards.shard(none).count() == 0


def test_token_counts(docs, none):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = tokens.token_counts(docs, PIECES, limit=50, tables=True).collect()
    assert len(got) == len(ROWS)
    by = dict(ROWS)
    c = tokens.counter(PIECES)
    for r in got:
        t = by[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(m.encode(t))) and r.counts[-1] == r.n_tokens and len(r.counts) == len(t) + 1
        assert r.fit_chars == max(at for at, n in enumerate(r.counts) if n <= 50)
        ends, counts = c.prefixes(t)
        for at in range(0, min(len(t), 90)):
            assert c.count(t, ends, counts, at) == r.counts[at] == len(m.encode(t[:at]))
    assert tokens.token_counts(none, PIECES, ends=True).count() == 0
    texts = collections.defaultdict(list)
    for i, t in ROWS:
        texts[i].append(t or "")
    for r in tokens.token_counts(docs, PIECES, ends=True).collect():  # the stored table answers for every prefix
        assert r.n_tokens == r.prefix_tokens[-1] and any(all(c.count(t, r.prefix_ends, r.prefix_tokens, k) == c.table(t)[k] for k in range(0, len(t) + 1, 1 + len(t) // 50)) for t in texts[r.doc_id] if len(t) == max(r.prefix_ends[-1], 0))


def test_every_prefix_of_random_texts():
    """The one pass against the library, prefix by prefix, with runs of spaces, line feeds and unknown characters."""
    c, rng = tokens.counter(PIECES), np.random.default_rng(4)
    for k in range(400):
        alphabet = ["ab c", "the in g ", "   ▁a\n", "\n\n a", "é日 ́😀", "  ﷺ€<s> x", " " * 20 + "a\t", "\x1c\x00 b"][k % 8]
        t = "".join(rng.choice(list(alphabet), rng.integers(0, 45)))
        want = [len(c.model.encode(t[:at])) for at in range(len(t) + 1)]
        ends, counts = c.prefixes(t)
        assert c.table(t) == want == [c.count(t, ends, counts, at) for at in range(len(t) + 1)]
        for budget in (0, 1, 2, 5, 13):
            assert c.longest(t, ends, counts, budget) == max(at for at, n in enumerate(want) if n <= budget)


def test_long_texts_without_spaces():
    c, rng = tokens.counter(PIECES), np.random.default_rng(5)
    for alphabet in ("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/", "天地玄黄宇宙洪荒日月盈昃", " "):
        t = "".join(rng.choice(list(alphabet), 1_000_000))
        ends, counts = c.prefixes(t)
        at = c.longest(t, ends, counts, 4096)
        assert counts[-1] == len(c.model.encode(t)) and len(c.model.encode(t[:at])) <= 4096 < min(len(c.model.encode(t[: at + k])) for k in range(1, 20))
    assert max(map(len, c.known)) <= tokens._LONGEST


def test_pipeline(spark):
    """The stages against plain Python on whole small documents."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    kept = {r.doc_id for r in quality.query(spark, sf).collect() if r.kept}
    docs = {r.doc_id: r.text for r in rows if r.doc_id in kept}
    sets = {i: grams(t) for i, t in docs.items()}
    gone, up = set(), {i: i for i in docs}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(docs)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = sorted((top(a), top(b)))
                up[q] = p
    items = [grams(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    gone = {i for i in ids if top(i) != i or any(q and len(q & sets[i]) >= 0.8 * len(q) for q in items)}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == set(ids) - gone


def test_pipeline_of_odd_and_empty_tables(spark, tmp_path):
    """Repeated rows, null ids and texts, one id with several texts; then nothing at all."""
    import corpus_pipeline

    plain = "the house on a hill was old and stood near to some town of ours".split()
    prose = [" ".join(f"{w}{'abcdef'[k]}{'vwxyz'[n]}" for n in range(5) for w in plain) for k in range(6)]
    rows = [(1, prose[0]), (1, prose[0]), (None, prose[0]), (2, prose[1]), (2, prose[2]), (None, prose[3]), (None, prose[3]), (7, None), (8, ""), (9, prose[4] + " end"), (10, prose[4]), (11, prose[5])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars int")
    bench = spark.createDataFrame([(1, " ".join(prose[5].split()[:30])), (2, None)], "item_id bigint, text string")
    docs.write.parquet(str(tmp_path / "a/documents.parquet"))
    bench.write.parquet(str(tmp_path / "a/benchmark.parquet"))
    passed = {r.text for r in quality.stage(spark, docs, "").collect()}
    want = collections.Counter(i for i, t in ((1, prose[0]), (2, prose[1]), (2, prose[2]), (None, prose[3]), (9, prose[4] + " end")) if t in passed)
    assert want and collections.Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path / "a")).collect()) == want
    docs.filter("false").write.parquet(str(tmp_path / "b/documents.parquet"))
    bench.filter("false").write.parquet(str(tmp_path / "b/benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).count() == 0

"""License scan of long texts and page layouts of main text."""

import random
import time

import pytest

from cellarium.llm import html, license

STORY = " ".join("This is the story of the house that was on the hill and it is told to all of us in the town by the sea." for _ in range(4))


def best_blocks(text):
    """Brute force: the best containment of every label over all blocks."""
    words, out = text.lower().split(), {}
    for i, label, ws, alpha in license.templates():
        size = license.span(license.TEMPLATES[i][1])
        for k in range(len(words)):
            n = len(set(words[k : k + size]) & set(ws))
            if n >= alpha:
                out[label] = max(out.get(label, 0), n / len(ws))
    return out


def test_blocks_against_all_windows(spark):
    rng = random.Random(4)
    notice = [w for _, w in license.TEMPLATES]
    pool = sorted({w for t in notice for w in t.split()})
    texts = []
    for k in range(150):
        words = []
        for _ in range(rng.randrange(1, 4)):
            t = rng.choice(notice).split()
            for _ in range(rng.randrange(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(pool)
            cut = rng.randrange(len(t))
            t[cut:cut] = rng.choices(pool, k=rng.choice([0, 0, 1, 3]))
            words += t + rng.choices(pool + ["x"] * 200, k=rng.randrange(0, 90))
        texts.append(" ".join(words))
    texts += ["mit " * 3000 + "released under the license", ("all rights " * 500) + "reserved", "released under the mit license " * 300]
    got = license.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    base = lambda t: {label for phrase, label in license.PHRASES.items() if phrase in t}
    for r in got:
        want = best_blocks(texts[r.doc_id])
        assert set(filter(None, r.labels.split(","))) == set(want) | base(texts[r.doc_id]), r.doc_id
        assert abs(r.score - max(want.values(), default=0.0)) < 1e-12


def test_license_scan_is_linear_in_the_text(spark):
    """10 MB of one notice word, and a notice repeated over 2 MB, beside short texts."""
    texts = ["mit " * 2_500_000, "released under the mit license " * 65_000, "Released under the MIT license", "none"]
    began = time.time()
    got = {r.doc_id: r for r in license.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert time.time() - began < 90
    assert (got[0].n_words, got[0].labels, got[1].labels, got[2].labels, got[3].labels) == (2_500_000, "", "mit", "mit", "")
    assert got[1].score == got[2].score == 1.0


WRAPS = [
    '<div class="content-sidebar-wrap"><main class="content"><article>{}</article></main></div>', '<div id="page" class="right-sidebar">{}</div>', '<div class="sidebar-right">{}</div>',
    '<div class="wrap menu-push">{}</div>', '<div class="navbar-page"><main>{}</main></div>', '<div class="content-sidebar-wrap"><div role="main">{}</div></div>',
    '<div class="post type-post category-navigation">{}</div>', "<label>{}</label>", '<div class="content-sidebar-wrap">{}</div>', '<div class="footer-widgets-on">{}</div>',
    '<form class="search-form"><article>{}</article></form>', '<div class="menu"><div class="sidebar"><main>{}</main></div></div>', "<nav><article>{}</article></nav>",
]


@pytest.mark.parametrize("wrap", WRAPS)
def test_no_name_drops_the_page(wrap):
    side = f'<div class="sidebar"><p>{STORY[:150]}</p></div><div class="comments"><article><p>{STORY}</p></article></div>'
    assert html.main_text("<body>" + wrap.format(f"<p>{STORY}</p><p>{STORY}</p>") + side + "</body>") == f"{STORY}\n\n{STORY}"


@pytest.mark.parametrize("part", ['<div class="comments">{}</div>', '<div hidden>{}</div>', '<div style="display:none">{}</div>', "<footer>{}</footer>", "<nav>{}</nav>", "<aside>{}</aside>"])
def test_comments_and_hidden_text_never_become_the_page(part):
    assert html.main_text(f"<body><p>{STORY}</p>{part.format(f'<p>{STORY}</p>' * 3)}</body>") == STORY


def test_parts_by_brute_force():
    """Random nested parts: a part is boilerplate unless most article text (or, without articles, most text) lies in it."""
    rng = random.Random(9)
    for _ in range(300):
        leaves, parts = [], []  # (text, parts around it, article or None), names

        def build(around, article, depth, leaves=leaves, parts=parts):
            out = []
            for _ in range(rng.randrange(1, 4)):
                kind = rng.choice(["p", "p", "div", "side", "comments", "article"]) if depth < 4 else "p"
                if kind == "p":
                    n = len(leaves)
                    leaves.append((f"leaf{n} " + STORY[: rng.choice([200, 300, 420])].strip(), around, article))
                    out.append(f"<p>{leaves[n][0]}</p>")
                elif kind in ("side", "comments"):
                    parts.append(kind)
                    out.append(f'<div class="{"sidebar" if kind == "side" else kind}">{build((*around, len(parts) - 1), article, depth + 1)}</div>')
                elif kind == "article" and article is None:
                    starts.append(around)
                    out.append(f"<article>{build(around, len(starts) - 1, depth + 1)}</article>")
                else:
                    out.append(f"<div>{build(around, article, depth + 1)}</div>")
            return "".join(out)

        starts = []
        page = f"<body>{build((), None, 0)}</body>"
        never = lambda around: any(parts[k] == "comments" for k in around)
        told = [sum(len(t) for t, _, a in leaves if a == k) for k in range(len(starts))]
        held = [sum(n for n, s in zip(told, starts, strict=True) if k in s and not never(s)) for k in range(len(parts))]
        whole, text = sum(n for n, s in zip(told, starts, strict=True) if not never(s)), sum(len(t) for t, _, _ in leaves)
        run = [sum(len(t) for t, around, _ in leaves if k in around) for k in range(len(parts))]
        bad = [parts[k] == "comments" or not (2 * held[k] > whole if whole else 2 * run[k] > text) for k in range(len(parts))]
        got = {t: is_bad for _, t, _, is_bad, _ in html.blocks(page)}
        assert got == {t: any(bad[k] for k in around) for t, around, _ in leaves}

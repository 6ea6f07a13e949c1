"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass: a block in a part that the markup itself calls
boilerplate (menu, header, footer, sidebar, notice, advert, form, comments, ...) is bad; otherwise its link
density, its length and its density of stop words decide between good, bad and two undecided kinds, short
and near-good. Second pass: undecided blocks take the label of the nearest neighbours that the rules decided
(what the markup calls boilerplate stands outside the text's flow and is passed over); where those
differ, a near-good block is good and a short one follows the nearer; in a page without good blocks the
near-good ones are good. Inside an <article> or <main> the
same signals and the same passes decide; the container is a prior only: its edges count as good neighbours, a
tie goes to good, and what would be bad for few stop words is near-good, for a link in a short block short.

Names in class, id and role are judged token by token; one that only tells of a state or a layout (``has-sidebar``,
``nav-open``) names nothing. A marked part around the articles (most running text of <article> and <main> lies in it), or on a
page without them around most of the page's running text, wraps the page and is no boilerplate, whatever it is
called; comments and what is hidden always are, and so are <nav>, <footer>, <aside> and <head> on a page without articles. Scripts without spaces are judged by function characters
instead of words, each character counting for more length; on a page that shows hardly any known stop word the language
is unknown, and length and links decide alone. Time is linear in the page, whatever its markup.

Edge cases: a short block as near to a good neighbour as to a bad one follows the one before it (inside an article it is good);
a null or empty page has no text; unclosed and stray tags are tolerated (a block-level tag ends
what was open inside it); repeated rows are extracted each on their own; null ids and urls stay; other columns
are ignored, whatever their names; pages of any length are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import collections
import html as entities
import operator
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Common function words of the four languages.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which will with you "
    "aber als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer es für hat ich ihr im in ist mit nach nicht noch nur oder sich sie sind so und vom von war was wie wir zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "al como con de del el ella en era es esta este fue ha la las lo los más mi no para pero por que se ser si sin sobre su sus un una y ya".split()
)
#: Common function characters of Japanese and Chinese.
STOP_CHARACTERS = frozenset("のはをにがとでたしもてい的一是了在不和有这為为之")
LENGTH_LOW, LENGTH_HIGH, STOP_LOW, STOP_HIGH, MAX_LINKS = 70, 140, 0.20, 0.30, 0.4
#: Scripts without spaces: one function character stands for so many stop words, one character for so much more length.
CHARACTER_STOPS, CHARACTER_LENGTH = 4, 1.5
#: Below this share of stop words on the whole page its language is unknown.
KNOWN_LANGUAGE = 0.05

_TEXT = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|"
_REST = r"|<[!?][^>]*>|[^<]+|<"
_TOKEN = re.compile(_TEXT + r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>" + _REST, re.S)
#: The same without regard to quotes, for the rest of a page with a quote that never ends.
_LOOSE = re.compile(_TEXT + r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>" + _REST, re.S)
_RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "object", "select", "title", "canvas", "audio", "video")
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in _RAW}
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
_BAD_TAG = frozenset("nav footer aside form head button menu dialog fieldset search label input".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NO_NEST = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMES = frozenset(("class", "id", "role", "itemprop", "data-role"))
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|adslot|adbox|adsense|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|nav\w*|menu\w*|breadcrumbs?|"
    r"site-?header|page-?header|top-?bar|masthead|header|footer|foot|side-?bar\w*|aside|rail|widgets?|share|sharing|social\w*|follow|related|recommend\w*|teaser|newsletter|subscri\w*|sign-?up|login|register|"
    r"search\w*|form|comments?|comment-?\w*|replies|reply|respond|disqus|discussion|reactions?|tags|pagination|pager|skip-?link\w*|toolbar|copyright|legal|disclaimer|complementary|contentinfo|navigation|hidden|print-?only)(?:$|[\s_-])",
    re.I,
)
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
#: Parts of a name that make it tell of a state or a layout instead of naming the element.
_MODIFIERS = frozenset("has with without no not is are show hide open opened closed active enabled disabled visible collapsed expanded layout fixed sticky".split())
#: Tags and names that stay boilerplate however much text they hold; the tags unless that is the page's articles.
_FIRM_TAG = frozenset("nav footer aside head".split())
_NEVER_NAME = re.compile(r"(?:^|[\s_-])(?:comments?|replies|reply|respond|disqus|discussion|hidden)(?:$|[\s_-])", re.I)
_WIDE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")


class _Block:
    __slots__ = ("inside", "linked", "parts", "root", "tag")

    def __init__(self, tag: str, root: int, inside: int):
        self.tag, self.root, self.inside, self.parts, self.linked = tag, root, inside, [], 0


def _named_bad(attributes: str) -> str:
    """Does a name in class, id or role mean boilerplate ("part"), or comments or a hidden element ("never")? Other values are free text."""
    out = ""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in _NAMES:
            for t in value.split():
                parts = set(re.split("[-_]+", t.lower()))
                if _BAD_NAME.search(t) and "overflow" not in parts and ("hidden" in parts or not parts & _MODIFIERS):
                    out = "never" if out == "never" or _NEVER_NAME.search(t) else "part"
        elif name == "style":
            if _UNSEEN.search(entities.unescape(value)):
                return "never"
        elif name == "hidden" and value.lower() != "false" or name == "aria-hidden" and value.lower() == "true":
            return "never"
    return out


def blocks(page: str) -> list[tuple[str, str, float, bool, int]]:
    """(tag, text, link density, in boilerplate, number of the article it is in or 0) of every block with text."""
    out: list[_Block] = []
    stack: list[tuple[str, int, int]] = []  # tag, innermost boilerplate part (a number, 0 for none), article
    opened: collections.Counter[str] = collections.Counter()  # how often each tag is on the stack
    parts: list[tuple[int, str]] = [(0, "")]  # of every boilerplate part: the one around it, and "part", "tag" or "never"
    homes: list[int] = []  # the boilerplate parts that articles begin in
    now = _Block("", 0, 0)
    links = articles = at = 0
    last, token = page.rfind(">"), _TOKEN

    def cut() -> None:
        nonlocal now
        if now.parts:
            out.append(now)
        now = _Block(*(stack[-1] if stack else ("", 0, 0)))

    def close(depth: int) -> None:
        for t, _, _ in stack[depth:]:
            opened[t] -= 1
        del stack[depth:]

    while at < len(page):
        if at > last:  # no tag ends from here on
            now.parts.append(page[at:])
            break
        m = token.match(page, at)
        if m[0] == "<" and token is _TOKEN and page[at + 1 : at + 2].isalpha():
            token = _LOOSE
            continue
        at = m.end()
        tag = m[2]
        if tag is None:
            s = m[0]
            if s[0] != "<" or s == "<":
                now.parts.append(s)
                if links and not s.isspace():
                    now.linked += len(s.strip())
            elif s.startswith("<![CDATA["):
                now.parts.append(s[9:].removesuffix("]]>"))
            continue
        tag, attributes = tag.lower(), m[3]
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in _BLOCK or opened[tag]:
                if opened[tag]:
                    close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))
                    if tag in _BLOCK:
                        links = 0
                if tag in _BLOCK:
                    cut()
            continue
        if tag in _RAW:
            if not attributes.endswith("/"):
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
            now.parts.append(" ")
            continue
        if tag == "br":
            now.parts.append(" ")
            continue
        if tag == "a":
            links += 1
            continue
        if tag in _VOID and tag != "hr":
            continue
        own = _named_bad(attributes)
        if tag in _BAD_TAG:
            own = own if own == "never" else "tag" if tag in _FIRM_TAG else "part"
        if tag not in _BLOCK and not own:
            continue
        if tag in _BLOCK:
            depth = len(stack)  # an open <p> ends where a block begins
            while depth and ((t := stack[depth - 1][0]) in _NO_NEST.get(tag, ()) or t == "p" or t not in _BLOCK and not stack[depth - 1][1]):
                depth -= 1
            close(depth)
            links = 0
        _, root, inside = stack[-1] if stack else ("", 0, 0)
        if tag == "header" and not inside:
            own = own or "part"
        if tag in ("article", "main") or 'role="main"' in attributes:
            own = "" if tag in ("article", "main") else own
            if not inside:
                articles += 1
                inside = articles
                homes.append(root)
        elif tag in ("html", "body"):
            own = ""
        if own:
            parts.append((root, own))
            root = len(parts) - 1
        stack.append((tag, root, inside))
        opened[tag] += 1
        cut()
    cut()
    found, running, told = [], [0] * len(parts), [0] * (articles + 1)
    for b in out:
        text = " ".join(entities.unescape("".join(b.parts)).split())
        if text:
            found.append((b.tag, text, min(1.0, b.linked / len(text)), b.root, b.inside))
            running[b.root] += max(0, len(text) - b.linked)
            told[b.inside] += max(0, len(text) - b.linked)
    never, held = [False], [0] * len(parts)  # held: running text of articles that begin in the part
    for around, own in parts[1:]:
        never.append(own == "never" or never[around])
    for home, size in zip(homes, told[1:], strict=True):
        held[home] += 0 if never[home] else size
    for k in range(len(parts) - 1, 0, -1):
        running[parts[k][0]] += running[k]
        held[parts[k][0]] += held[k]
    bad = [False]
    for k in range(1, len(parts)):
        around, own = parts[k]
        wraps = 2 * held[k] > held[0] if held[0] else own == "part" and 2 * running[k] > running[0]
        bad.append(bad[around] or never[k] or not wraps)
    return [(tag, text, links, bad[root], inside) for tag, text, links, root, inside in found]


def _stop_share(text: str) -> float:
    """Share of stop words, or of function characters where words are not separated."""
    if 2 * len(_WIDE.findall(text)) > len(text):
        return min(1.0, CHARACTER_STOPS * sum(c in STOP_CHARACTERS for c in text) / len(text))
    ws = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in ws) / len(ws)


def labels(found: list[tuple[str, str, float, bool, int]]) -> list[bool]:
    """Is each block main text?"""
    stops = [0.0 if bad or links > MAX_LINKS else _stop_share(text) for _, text, links, bad, _ in found]
    weights = [0 if bad or links > MAX_LINKS else len(text) for _, text, links, bad, _ in found]
    if sum(map(operator.mul, stops, weights)) < KNOWN_LANGUAGE * sum(weights):
        stops = [STOP_HIGH] * len(found)
    first = []
    for (_, text, links, bad, inside), stop in zip(found, stops, strict=True):
        size = len(text) + CHARACTER_LENGTH * len(_WIDE.findall(text))
        if bad or links > MAX_LINKS or "©" in text[:3] and not inside:
            first.append("bad")
        elif size < LENGTH_LOW:
            first.append("bad" if links > 0 and not inside else "short")
        elif stop >= STOP_HIGH:
            first.append("good" if size > LENGTH_HIGH else "near")
        else:
            first.append("near" if inside or stop >= STOP_LOW else "bad")
    if "good" not in first:  # a page of middling blocks only
        first = ["good" if x == "near" else x for x in first]
    n = len(found)
    before, after = [None] * n, [None] * n
    for order, near, step in ((range(n), before, 1), (range(n - 1, -1, -1), after, -1)):
        last, home = None, 0
        for i in order:
            inside = found[i][4]
            if inside != home:  # an article's edges count as good; outside it, what lies in it does not count
                last, home = (("good", i - step) if inside else None), inside
            near[i] = last
            if first[i] in ("good", "bad") and not found[i][3]:
                last = (first[i], i)
    out = []
    for i, kind in enumerate(first):
        if kind in ("good", "bad"):
            out.append(kind == "good")
            continue
        a, b = before[i], after[i]
        sides = {x[0] for x in (a, b) if x}
        if len(sides) < 2:
            out.append("good" in sides or kind == "near" and not sides)
        elif kind == "near":
            out.append(True)
        elif found[i][4] and i - a[1] == b[1] - i:
            out.append(True)
        else:
            nearer = a if i - a[1] <= b[1] - i else b
            out.append(nearer[0] == "good")
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n\n".join(b[1] for b, keep in zip(found, labels(found), strict=True) if keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=out)

    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))

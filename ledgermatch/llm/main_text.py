"""Main text of web pages, by block rules in two passes.

A page becomes blocks: the text between block-level tags, with what links hold of it and the containers around it.  The first pass decides blocks
by their containers (menus, forms, comments and the like are never main text), link density, length and stop-word density; short blocks, headings and blocks with
middling figures stay open.  In the second pass an open block takes the label of the nearest decided neighbour.

A page that marks its article (``article``, ``main`` or that role) has its main text there: blocks outside are decided against, and inside
only containers and runs of links count against a block, so an open block there has no boilerplate beyond the article's end to take a label from.

Defined results: null or empty html gives an empty text.  Comments, scripts, styles and other raw or hidden elements hold no text; an element that is never closed
ends with its parent or the page.  White space (any that Unicode counts as such) in a block and ``br`` become one space.  Broken references and tags that never
end are text as they stand.  Equal rows give equal results; pages of any length are taken whole, one at a time.  Other columns are not touched.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html"
    " legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
UNSEEN = frozenset("head noscript template svg math object audio video canvas map button select datalist".split())
NEVER = frozenset("nav aside form dialog menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A start tag that closes an open element of its kind, up to the nearest list, table or other container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}

# Parts of class names, ids and roles that mark what is not main text.
MARKS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice alert alertdialog"
    " popup modal overlay newsletter subscribe subscription signup login sidebar complementary menu menubar nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar"
    " comment comments disqus respond replies share sharing social related recommended recommendations footer contentinfo copyright search widget skip".split()
)
# The same within longer names, and at their ends.
STEMS = ("advert", "banner", "breadcrumb", "comments", "commentlist", "consent", "cookie", "footer", "navbar", "newsletter", "popup", "sidebar", "sponsor", "subscri")
ENDS = ("nav", "menu", "widget")
#: Of the names, those that wrappers of the article may have too, for the page's layout.
LAYOUT = ("banner", "complementary", "header", "masthead", "menu", "menubar", "nav", "navbar", "navigation", "search", "share", "sharing", "sidebar", "skip", "social", "toolbar", "widget")
#: These mark the page's head, but the title's place within an article.
HEADS = frozenset("header masthead".split())
#: Elements whose classes speak of the whole page, and the whole classes that mark an article as none of the page's own.
WHOLE = frozenset("html body main".split())
NOT_OWN = frozenset("ad ads advert advertisement comment promo promoted related reply sponsored teaser widget".split())

# Frequent function words.
STOP_WORDS = {
    "en": "a about after all also an and any are as at be been but by can could do for from had has have he her his how i if in into is it its more most my no not of on one only or other our out over she so some such than that"
    " the their them then there these they this to up was we were what when which who will with would you your",
    "fr": "à au aux avec ce ces cette comme d dans de des du elle en est et eux il ils je l la le les leur lui ma mais me même mes moi mon ne nos notre nous on ou où par pas plus pour qu que qui s sa se ses si son sont sur ta te tes toi"
    " ton tu un une vos votre vous y",
    "de": "aber alle als also am an auch auf aus bei bin bis das dass daß dein dem den denn der des die dies diese doch du durch ein eine einem einen einer er es euch für gegen hat hier ich ihm ihn ihr im in ist ja kann kein man mein mich"
    " mir mit nach nicht noch nur oder ohne schon sein sich sie sind so über um und uns unter vom von vor war was wenn wer wie wir wird zu zum zur",
    "es": "a al algo como con cuando de del desde donde e el ella ellos en entre era es esa ese eso esta este esto ha hasta hay la las le les lo los más me mi muy nada ni no nos o os otra otro para pero por porque que quien se ser si sin sobre"
    " son su sus también te tiene todo tu un una uno y ya yo",
}
_STOP = {lang: frozenset(words.split()) for lang, words in STOP_WORDS.items()}

#: Characters below which a block is short, and from which it is long.
SHORT, LONG = 70, 200
#: Share of stop words from which text is prose, and below which it is not.
PROSE, LISTS = 0.20, 0.10
#: Share of characters in links from which a block is links, and up to which it may be prose.
LINKS, FEW_LINKS = 0.5, 0.25
#: So many blocks of links in a row are a menu, wherever they stand.
MENU = 3

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTED = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"(?i)(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none")
_WORDS = re.compile(r"[^\W\d_]+")
_PARTS = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    """One block: ``text`` in one line, ``linked`` characters in links, ``never`` if a container rules it out, ``inside`` an article, ``heading``."""

    text: str
    linked: int
    never: bool
    inside: bool
    heading: bool
    label: bool | None = None


def _tag_end(page: str, at: int) -> int:
    """Where the tag that goes on at ``at`` has its closing bracket, -1 if nowhere.  Brackets in quoted values don't count."""
    while True:
        at = _QUOTED.match(page, at).end()
        if at >= len(page):
            return -1
        if page[at] == ">":
            return at
        quote = page.find(page[at], at + 1) if page[:at].endswith("=") or page[max(0, at - 20) : at].rstrip().endswith("=") else at
        if quote < 0:
            return page.find(">", at)
        at = quote + 1


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """The page as (kind, name, rest): text, start tags with their attributes, end tags.  Raw elements come as a start tag alone."""
    at, n = 0, len(page)
    while at < n:
        open_ = page.find("<", at)
        if open_ < 0:
            yield "text", "", page[at:]
            return
        if open_ > at:
            yield "text", "", page[at:open_]
        after = page[open_ + 1 : open_ + 2]
        if page.startswith("<!--", open_):
            end = page.find("-->", open_ + 4)
            at = n if end < 0 else end + 3
        elif page.startswith("<![CDATA[", open_):
            end = page.find("]]>", open_)
            at = n if end < 0 else end + 3
        elif after in ("!", "?"):
            end = page.find(">", open_)
            at = n if end < 0 else end + 1
        elif name := _NAME.match(page, open_ + 1 + (after == "/")):
            end = _tag_end(page, name.end())
            if end < 0:
                yield "text", "", page[open_:]
                return
            tag, at = name.group().lower(), end + 1
            if after == "/":
                yield "end", tag, ""
                continue
            yield "start", tag, page[name.end() : end]
            if tag in RAW and not page[:end].endswith("/"):
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                if not close:
                    return
                at = page.find(">", close.start()) + 1 or n
        else:
            yield "text", "", "<"
            at = open_ + 1


@lru_cache(maxsize=4096)
def _names(attributes: str) -> tuple[frozenset[str], frozenset[str]]:
    """The class names, id and role of an element, whole and in parts."""
    whole = {
        one for a in _ATTRIBUTE.finditer(attributes) if a[1].lower() in ("class", "id", "role") for one in (a[2] or a[3] or a[4] or "").lower().split() if not one.startswith(("no-", "has-", "with-"))
    }
    return frozenset(whole), frozenset(p for one in whole for p in _PARTS.findall(one))


def _against(tag: str, attributes: str, inside: bool) -> int:
    """Whether an element rules out what it holds: 2, 1 if it does so by names of layout alone, or 0."""
    if tag in NEVER or tag == "footer" or (tag == "header" and not inside):
        return 2
    if not attributes or tag in WHOLE:
        return 0
    whole, parts = _names(attributes)
    if tag == "article":
        return 0 if whole.isdisjoint(NOT_OWN) else 2
    marked = [p for p in parts if p in MARKS or p.endswith(ENDS) or any(stem in p for stem in STEMS) or (not inside and (p in HEADS or p.endswith("header")))]
    return 0 if not marked else 1 if all(p.endswith(LAYOUT) or "sidebar" in p for p in marked) else 2


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page that hold text, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, int, bool, bool]] = []  # element, ruled out, inside an article, unseen
    seen: set[str] = set()
    text: list[str] = []
    linked: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal text, linked
        line = " ".join(entities.unescape("".join(text)).split())
        if line:
            never, inside = (stack[-1][1] > 0, stack[-1][2]) if stack else (False, False)
            of_links = len(" ".join(entities.unescape("".join(linked)).split()))
            found.append(Block(line, of_links, never, inside, any(e[0] in HEADINGS for e in stack[-3:])))
        text, linked = [], []

    for kind, tag, rest in tokens(page):
        if kind == "text":
            if not (stack and stack[-1][3]):
                text.append(rest)
                if links:
                    linked.append(rest)
        elif kind == "start":
            if tag in RAW:
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag in BLOCKS:
                while stack and stack[-1][0] not in BLOCKS and stack[-1][0] not in UNSEEN:  # marked inline elements end where blocks begin
                    stack.pop()
                flush()
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p" or stack[k][0] in CLOSES.get(tag, ()):
                        del stack[k:]
                    elif stack[k][0] in BLOCKS:
                        break
            if tag in VOID or rest.endswith("/"):
                continue
            never, inside, unseen = stack[-1][1:] if stack else (0, False, False)
            if tag in BLOCKS or tag in UNSEEN:
                own = tag in ("article", "main") or ("role" in rest and re.search(r"role\s*=\s*[\"']?main\b", rest) is not None)
                inside = inside or own
                # names of wrappers may speak of the page's layout, which doesn't hold against its first article
                kind = "article" if tag == "article" else "main"
                never = max(0 if own and never == 1 and kind not in seen else never, _against(tag, rest, inside))
                if own and not never:
                    seen.add(kind)
                unseen = unseen or tag in UNSEEN or (bool(rest) and _HIDDEN.search(rest) is not None)
                stack.append((tag, never, inside, unseen))
            elif tag == "a":
                links += 1
            elif rest and _against(tag, rest, inside):
                stack.append((tag, never, inside, True))
        elif tag == "a":
            links = max(0, links - 1)
        elif stack and stack[-1][0] == tag and tag not in BLOCKS and tag not in UNSEEN:
            stack.pop()
        elif tag in BLOCKS or tag in UNSEEN:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    flush()
                    del stack[k:]
                    break
            else:
                if tag in ("p", "body", "html"):
                    flush()
            links = 0 if tag in BLOCKS else links
    flush()
    return found


def stop_density(text: str) -> float:
    """The largest share of stop words of any one language."""
    words = [w.lower() for w in _WORDS.findall(text)]
    return max((sum(w in stop for w in words) / len(words) for stop in _STOP.values()), default=0.0) if words else 0.0


def classify(found: list[Block]) -> None:
    """Labels each block: True is main text."""
    marked = any(b.inside and not b.never for b in found)
    links = [b.linked > LINKS * len(b.text) for b in found]
    run = [0] * len(found)
    for i, yes in enumerate(links):
        run[i] = run[i - 1] + 1 if yes and i else int(yes)
    for i in range(len(found) - 2, -1, -1):
        run[i] = max(run[i], run[i + 1]) if run[i] and run[i + 1] else run[i]
    for i, b in enumerate(found):
        if b.never or (marked and not b.inside) or (links[i] and (run[i] >= MENU or not marked)):
            b.label = False
        elif len(b.text) >= SHORT and not b.heading and b.linked <= FEW_LINKS * len(b.text):
            density = stop_density(b.text)
            if density >= PROSE or (len(b.text) >= LONG and density >= LISTS):
                b.label = True
            elif density < LISTS and not marked and (b.linked or len(b.text) < LONG):
                b.label = False
    if not any(b.label for b in found):  # no prose in a language of the lists: length and links alone decide
        for b in found:
            if b.label is None and len(b.text) >= LONG and not b.linked:
                b.label = True
    decided = [b.label for b in found]
    if marked:
        # the article's other parts say nothing about an open block in it: its neighbours are main text, or there are none
        for b in found:
            b.label = True if b.label is None else b.label
        return
    before: list[tuple[int, bool]] = []
    last = (-1, False)
    for i, label in enumerate(decided):
        last = (i, label) if label is not None else last
        before.append(last)
    last = (len(found), False)
    for i in range(len(found) - 1, -1, -1):
        if decided[i] is not None:
            last = (i, decided[i])
        else:
            back, ahead = i - before[i][0], last[0] - i
            found[i].label = last[1] if ahead < back or (ahead == back and found[i].heading) else before[i][1] if back < ahead else before[i][1] and last[1]


def main_text(page: str | None) -> tuple[str, int, int]:
    """The main text of a page, its number of blocks and of those kept."""
    found = blocks_of(page or "")
    classify(found)
    kept = [b.text for b in found if b.label]
    return "\n".join(kept), len(found), len(kept)


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """Per page: the columns ``keep``, text, n_chars (its code points), n_blocks and n_kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                rows = [main_text(page.as_py()) for page in part.column(len(keep))]
                texts, blocks, kept = zip(*rows, strict=True)
                made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(blocks, pa.int64()), pa.array(kept, pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *made], names=[*keep, "text", "n_chars", "n_blocks", "n_kept"])

    rows = pages.select(*keep, pages[html].cast("string").alias("__html"))
    kinds = ", ".join(f"`{c}` {kind}" for c, kind in rows.drop("__html").dtypes)
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long, n_blocks long, n_kept long")

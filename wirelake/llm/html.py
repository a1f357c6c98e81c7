"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into blocks of text at block-level tags. Each block is described by its own and its
neighbours' word counts and link densities, and by what encloses it: whether an element around it
is named as something beside the article (``aside``) or as the article (``main``). Such a name does
not count if the element holds the article itself; see ``_judged``. The tree is trained on the blocks
of a few labelled pages below.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wirelake.llm import blocks, common

#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW = frozenset("script style textarea title".split())
HIDDEN = frozenset("head noscript template svg math iframe object audio video canvas select option button textarea title".split())
#: Elements, and whole names in class, id and role, around text that is not the article.
ASIDE = frozenset("nav footer aside form menu dialog fieldset".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion cookie"
    " cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar"
    " navigation menu menus breadcrumb breadcrumbs sidebar aside widget widgets related recommended recommendations footer"
    " foot comment comments commentlist reply replies respond disqus discussion share sharing social search pagination pager"
    " copyright legal toolbar tags skip contentinfo complementary ad-container ad-slot ad-banner cookie-notice cookie-banner"
    " cookie-consent cookie-bar main-nav site-nav nav-menu main-menu site-footer page-footer sidebar-widget widget-area"
    " related-posts related-articles share-buttons social-share social-links post-tags comment-list comment-form"
    " comments-area comment-body newsletter-signup skip-link".split()
)
#: These are the article's own inside it, and the page's outside.
PAGE_HEAD, PAGE_HEAD_WORDS = frozenset({"header"}), frozenset("header masthead topbar banner site-header page-header".split())
MAIN, MAIN_WORDS = frozenset("article main".split()), frozenset(
    "article content post entry story main post-content post-body entry-content article-content article-body main-content"
    " page-content story-body".split()
)
#: An element named aside that holds most words is the page's wrapper, unless the article outside has a share of its words.
OUTSIDE = 20
#: Elements that an opening tag of the same kind ends, and where that search stops.
CLOSES_ITSELF = {"p": (), "li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    aside: bool  # something around it says that it is not the article
    main: bool  # something around it says that it is
    label: bool = False


@dataclass
class _Named:
    """An element whose name, class, id or role says what it holds."""

    parent: int
    aside: bool = False
    head: bool = False  # aside unless it is within the article
    main: bool = False
    article: bool = False  # an element made for the article
    words: int = 0  # that are no links, of its blocks; in the end with those of all within


@dataclass(frozen=True)
class _Open:
    name: str
    place: int  # of the innermost named element, 0 is the page
    hidden: bool
    link: bool
    label: bool


_ROOT = _Open("", 0, False, False, False)


def attributes_of(tag: str) -> dict[str, str]:
    """What stands behind a tag's name, as names and values; of equal names the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _hides(given: dict[str, str]) -> bool:
    shown = _DISPLAY.findall(given.get("style", ""))
    said = "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true"
    return said or bool(shown) and shown[-1].lower() == "none"


def _opened(name: str, attributes: str, parent: _Open, named: list[_Named]) -> _Open:
    given = attributes_of(attributes) if len(attributes) > 1 else {}
    place = parent.place
    if name not in ("html", "body"):
        said = {w for a in ("class", "id", "role") if a in given for w in given[a].lower().replace("_", "-").split()}
        article = name in MAIN or given.get("role", "").strip().lower() in MAIN
        aside = not article and (name in ASIDE or not said.isdisjoint(ASIDE_WORDS))
        head = not article and (name in PAGE_HEAD or not said.isdisjoint(PAGE_HEAD_WORDS))
        main = article or not said.isdisjoint(MAIN_WORDS)
        if aside or head or main:
            place = len(named)
            named.append(_Named(parent.place, aside, head, main, article))
    return _Open(
        name, place, parent.hidden or name in HIDDEN or _hides(given), parent.link or name == "a", parent.label or "data-main" in given
    )


def _judged(named: list[_Named]) -> list[tuple[bool, bool]]:
    """Of each named element, whether what stands in it is aside, and whether it is main.

    A name that says aside does not count for a wrapper: an element with most of the page's words
    (links apart), if what is main outside of all asides is small beside it. An article or main
    element is not aside for what lies around it, unless one outside of all asides has more words.
    """
    own = [n.words for n in named]
    for n in reversed(named[1:]):
        named[n.parent].words += n.words
    total = named[0].words

    def judge(outside: int, most: float) -> list[tuple[bool, bool, bool]]:
        out = [(False, False, False)]
        for n in named[1:]:
            aside, main, within = out[n.parent]
            if n.article:
                aside = aside and (within or n.words < most)
            elif n.aside or n.head and not main:
                aside = aside or not (2 * n.words > total and n.words > OUTSIDE * outside)
            out.append((aside, main or n.article or n.main and not aside, within or n.article))
        return out

    none = float("inf")
    outside = sum(w for w, (aside, main, _) in zip(own, judge(total, none)) if main and not aside)
    clear = judge(outside, none)
    most = max((n.words for n, (aside, _, _) in zip(named, clear) if n.article and not aside), default=0)
    return [(aside, main) for aside, main, _ in judge(outside, most)]


def page_blocks(page: str) -> list[Block]:
    """The page's visible text in flat blocks, in page order, with white space made single."""
    out: list[Block] = []
    stack: list[_Open] = [_ROOT]
    named: list[_Named] = [_Named(0)]
    places: list[int] = []  # of each block
    parts: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            top = stack[-1]
            links = len(entities.unescape(" ".join(linked)).split())
            out.append(Block(text, text.count(" ") + 1, links, False, False, top.label))
            places.append(top.place)
            named[top.place].words += max(0, out[-1].words - links)
        parts.clear()
        linked.clear()

    def add(text: str) -> None:
        top = stack[-1]
        if text and not top.hidden:
            parts.append(text)
            if top.link:
                linked.append(text)

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            add(page[at:])
            break
        add(page[at:mark])
        after = page[mark + 1 : mark + 2]
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = end + 3 if end >= 0 else size
            continue
        if after in ("!", "?"):
            end = page.find(">", mark)
            at = end + 1 if end >= 0 else size
            continue
        tag = _TAG.match(page, mark)
        if tag is None:
            add("<")
            at = mark + 1
            continue
        rest = _REST.match(page, tag.end())
        if rest is None:  # an open quote or a cut-off page
            end = page.find(">", tag.end())
            end = size if end < 0 else end + 1
        else:
            end = rest.end()
        name, attributes = tag[2].lower(), page[tag.end() : end]
        at = end
        if name not in INLINE:
            flush()
        elif name == "br":
            add(" ")
        if tag[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
            continue
        if name in VOID:
            continue
        if name in CLOSES_ITSELF:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in CLOSES_ITSELF[name] or stack[k].name not in INLINE and stack[k].name != name:
                    break
                if stack[k].name == name:
                    del stack[k:]
                    break
        if name in RAW:
            close = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = close.start() if close else size
            continue_raw = page.find(">", at)
            at = continue_raw + 1 if close and continue_raw >= 0 else size
            continue
        if not attributes.endswith("/>"):
            stack.append(_opened(name, attributes, stack[-1], named))
    flush()
    judged = _judged(named)
    for block, place in zip(out, places):
        block.aside, block.main = judged[place]
    return out


FEATURES = (
    "aside", "main", "words", "link density", "words before", "link density before", "words after", "link density after"
)


def features(found: list[Block]) -> list[tuple[float, ...]]:
    """Of each block, its own and its neighbours' word count and link density, and its place."""

    def of(i: int) -> tuple[float, float]:
        if 0 <= i < len(found):
            return float(found[i].words), min(1.0, found[i].link_words / found[i].words)
        return 0.0, 0.0

    return [(float(b.aside), float(b.main), *of(i), *of(i - 1), *of(i + 1)) for i, b in enumerate(found)]


#: The labelled table: pages whose main blocks are marked with data-main.
LABELLED = (
    """<html><body><header class="site-header"><a href=/>Daily</a> <span>News for you every day</span></header>
    <nav><ul><li><a href=1>Home</a><li><a href=2>World news</a><li><a href=3>Sport</a></ul></nav>
    <article><h1 data-main>Harvest ends early</h1><p data-main>The harvest ended two weeks early this year because the
    summer had been dry and the grain was ripe before anyone had expected it to be.</p><p data-main>Yes.</p>
    <h2 data-main>What comes next</h2><p data-main>Farmers <a href=x>say</a> that the next season depends on rain in the
    autumn, which has been scarce for years.</p><ul><li data-main>Wheat<li data-main>Barley and rye</ul>
    <p data-main><a href=q>Read the full report on this harvest</a></p>
    <div class="ad">Buy two tractors and get one plough for free, only this week in your town and online.</div>
    <p data-main>Prices are stable.</p></article>
    <section id="comments"><h3>Comments</h3><p>I do not think that this is right at all, we had lots of rain here in the
    north and my barn was nearly washed away last month.</p><p>Great article!</p></section>
    <aside><h4>Most read</h4><a href=5>Ten ways to cook a pumpkin</a></aside>
    <footer>&copy; Daily, all rights reserved, printed in the old town since 1890 by hand</footer></body></html>""",
    """<body><div id=menu><a href=1>Start</a> | <a href=2>Archive</a></div><div class="cookie-notice">We use cookies so
    that this site works as well as it can, please agree to all of them before you go on reading.</div>
    <div class="post-content"><h2 data-main>A walk in the hills</h2><div data-main>We left before dawn and had reached the
    first hut when the sun came up behind the ridge and lit the whole valley.</div><div data-main>It was cold.</div>
    <blockquote data-main>Never walk alone, they told us.</blockquote></div>
    <form><p>Leave your address and we will send you a letter each month</p><label>Name</label></form>
    <div class="sidebar"><p>About me: I walk, write and take photographs of huts, hills and goats whenever I can.</p></div>
    <div id=footer>Powered by walking boots, all photographs by the author unless stated otherwise below</div></body>""",
    """<html><body><table><tr><td><a href=1>Index</a></td><td><a href=2>Next page</a></td><td><a href=3>Previous</a></td></tr>
    </table><p data-main>The engine was taken apart on Monday and every part of it was cleaned, measured and written down in
    the book that lies on the bench.</p><p data-main>On Tuesday the cylinders were bored and the new pistons fitted, which
    took the whole day and most of the evening as well.</p><p data-main>It ran on Friday without a fault for three hours,
    and nobody in the shop could find anything to complain about.</p><p><a href=4>Back to the top of this page</a></p>
    <p><a href=5>Other engines</a> <a href=6>Tools</a> <a href=7>Contact</a></p></body></html>""",
    """<body><main><h1 data-main>Minutes</h1><p data-main>Opened at nine.</p><p data-main>The treasurer reported that the
    roof had been paid for and that nothing was owed to anyone any more.</p><p data-main>Closed at ten.</p>
    <div class=related><a href=1>Minutes of the last meeting</a></div></main><div class=share><a href=s>Share</a></div>
    <div role=contentinfo>Village hall, open on weekdays from nine until noon, ring twice and wait</div></body>""",
    """<body><div class="ad">Better sleep from tonight.</div><p data-main>The lighthouse was built by three brothers who had
    never seen the sea before they came here, and who never left it again once they had finished, as the stones in the yard
    behind the church say to this day.</p><div class="notice">This page is being moved.</div><p data-main>Its lamp was lit
    with oil until the year in which the cable was laid, and then for another year, because the keeper did not trust the
    cable and told everyone so who climbed the stairs to see him.</p><div class="newsletter">Letters from the coast, each
    month.</div><p data-main>After him came his daughter, who trusted the cable but kept the oil, and of whom it is told that
    she read every ship's name aloud as it passed, whether anyone was there to hear it or not.</p><ul class="menu"><li>Tides
    <li>Charts</ul></body>""",
    """<body><header><p>The quarterly of the bird society, founded by friends of the heron, read in nine countries and free
    of charge for members</p></header><div class=promo>Join us.</div><h2 data-main>Counting swifts</h2><p data-main>We count
    them in the last week of June, at dusk, from the same four roofs each year, and we write down only those that fly below
    the tower, since the others cannot be told apart.</p><p data-main>There were sixty.</p><div class=comments><p>Sixty is
    not many, when I was a child there were hundreds of them around that tower and you could not hear the bells.</p><p>We
    had eleven here.</p></div><footer><p>Printed on paper that was made from paper, in a house that is heated with wood from
    our own hedge, by people who are paid</p></footer></body>""",
    """<body><nav><a href=1>Home</a></nav><article><h1 data-main>Cut off</h1><p data-main>This page ends where the wire
    broke, in the middle of a sentence that nobody has finished since, though many have tried to.</p><p data-main>The last
    words were</p>""",
    """<main><p data-main>Closed today.</p></main>""",
    """<p data-main>All that this page has to say is in this one paragraph, which is long enough to be read as such.</p>
    <p data-main>And in this one, which is the last, and after which there is nothing at all to be found.</p>""",
    """<body><div><a href=1>Books</a></div><div><a href=2>Films and series</a></div><div><a href=3>Music</a></div>
    <h1 data-main>On reading slowly</h1><p data-main>There is a way of reading that lets each sentence stand for a moment
    before the next one is allowed to come, and it is not for the impatient.</p><p data-main>I learned it late, from an old
    man who read one page a day and could say every page he had ever read by heart.</p>
    <p data-main>He is gone now, but the pages are still there for anyone who wants to take the time.</p>
    <div><a href=4>Terms</a></div><div><a href=5>Privacy and data</a></div><div>2021</div></body>""",
    """<body><form id=aspnetForm><div class="layout has-sidebar"><div><a href=1>Start</a></div><h1 data-main>The old bridge</h1>
    <p data-main>The bridge was closed in March after a lorry had broken two of the stones that carry the northern arch, and it
    will stay closed until masons have been found who still know how such stones are cut.</p><p data-main>The detour takes an
    hour, which the baker says is an hour in which nobody buys any bread from him at all.</p>
    <div class=sidebar>Bread of the day: rye with caraway.</div></div></form></body>""",
    """<body><div class=widget><div class="elementor-widget elementor-widget-text-editor"><p data-main>A kiln must be heated so
    slowly that the clay does not notice it, and cooled more slowly still, for it is in the cooling that most of the pots
    are lost.</p><p data-main>He who opens it a day too early will hear them sing, and then he will hear them break.</p></div></div>
    <div class=footer>Clay and glaze by post</div></body>""",
    """<body><p><a href=1>Parish</a></p><div class=notice><p data-main>The council gives notice that the lane between the mill and
    the upper ford will be dug up from the first of May, that carts and cars must go round by the church until the pipes are
    laid, and that whoever has a well within fifty steps of the lane should have its water looked at before and after the
    work, for which the council will pay if the bill is handed in by the end of the summer at the office in the school.
    The pipes that lie there now were laid by the grandfathers of those who will dig them up, of wood that was bored by hand,
    and where they are sound they will be kept and shown in the hall, so that the children can see how the water came to the
    village before there were pumps.</p></div>
    <div class=legal><p data-main>Whoever thinks that the digging harms a wall, a cellar or a tree has to say so in writing within
    four weeks, naming the place and the day on which the harm was seen, and the council will then send two people who know
    about such things, one of whom may be chosen by the owner, and what both of them agree upon shall be paid without a
    court and without delay.</p></div><div class=alert><p data-main>During the work the bell will not be rung before eight in
    the morning, since the men who dig sleep in the house beside the tower, and the market that is held on the lane each
    second Thursday moves to the yard of the inn, where there is room for all of the stalls but not for the animals, which
    have to be led in by the gate behind the stables and out again in the same way before the evening.</p></div></body>""",
    """<body><article><h1 data-main>Frost</h1><p data-main>The frost came on the last night of April and took the blossom of the
    plums, the early pears and half of the cherries.</p></article><div class=comments><p>We had no frost at all down here by the
    river, but my sister, who lives on the hill, lost everything, and she had even lit fires between the trees and sat up
    with them until the sun was over the wood.</p><p>Same here.</p></div></body>""",
    """<body><nav><a href=0>All about the old mills of the county</a> <a href=1>All about the old bridges of the county</a> <a
    href=2>All about the old wells of the county</a> <a href=3>All about the old barns of the county</a> <a href=4>All
    about the old locks of the county</a> <a href=5>All about the old weirs of the county</a> <a href=6>All about the
    old kilns of the county</a> <a href=7>All about the old towers of the county</a> <a href=8>All about the old gates
    of the county</a> <a href=9>All about the old walls of the county</a> <a href=10>All about the old lanes of the
    county</a> <a href=11>All about the old fords of the county</a> <a href=12>All about the old inns of the county</a>
    <a href=13>All about the old yards of the county</a> <a href=14>All about the old stables of the county</a> <a
    href=15>All about the old chapels of the county</a></nav><article><h1 data-main>Rain</h1><p data-main>Does it
    rain where you live?</p><p data-main>No.</p></article></body>""",
    """<body><main><h1 data-main>Opening hours</h1><p data-main>We are open on each day of the week but Monday, from nine in the
    morning until the lamp is lit in the evening, and on feast days after noon, and whoever comes late may knock at the door
    of the yard.</p></main><footer><p>All that is said here has been looked at with care, but nobody can promise that it is right, and
    whoever acts upon it does so at a risk of their own; for what stands on the pages of others to which these pages lead we
    do not answer, since we have no say in it and cannot read it each day, and marks and names belong to those who own
    them.</p></footer></body>""",
    """<body><nav><a href=1>River</a> <a href=2>Town</a></nav><div class=ad>Spoons, carved by hand.</div><article><p data-main>
    The ferry ran from the stone steps below the customs house to the reeds on the other bank, where a plank had
    been laid over the mud, and whoever wanted to cross rang the bell that hung in the willow and waited until the
    ferryman had finished his meal, his pipe or his talk, for he was never seen to hurry, not for the doctor, not
    for the bishop, and not for the bride who came too late for her own wedding because of it.</p><div class=ad>Boats for hire, with or without a hand to row them.</div><p data-main>
    When the bridge was opened he rowed across once more with an empty boat, tied it up on the far side and walked
    home over the new planks, which he said were good planks, and from that day on he never went near the river
    again but sat behind the house with his back to it, carving spoons that nobody needed, and when he died they
    found four hundred of them in the loft, each with a small fish cut into the handle, and no two alike.</p></article><aside>More about ferries, fords and the people who kept them, in our book for the
    winter</aside><footer>Written by the river</footer></body>""",
    """<body><div class=ad>Spoons for the whole winter.</div><article><p data-main>
    The ferry ran from the stone steps below the customs house to the reeds on the other bank, where a plank had
    been laid over the mud, and whoever wanted to cross rang the bell that hung in the willow and waited until the
    ferryman had finished his meal, his pipe or his talk, for he was never seen to hurry, not for the doctor, not
    for the bishop, and not for the bride who came too late for her own wedding because of it.
    When the bridge was opened he rowed across once more with an empty boat, tied it up on the far side and walked
    home over the new planks, which he said were good planks, and from that day on he never went near the river
    again but sat behind the house with his back to it, carving spoons that nobody needed, and when he died they
    found four hundred of them in the loft, each with a small fish cut into the handle, and no two alike.</p></article><div class=related><a href=0>What people told us of the mills by the river</a> <a href=1>What people told us of the weirs by the 
    river</a> <a href=2>What people told us of the locks by the river</a> <a href=3>What people told us of the eels by 
    the river</a> <a href=4>What people told us of the floods by the river</a> <a href=5>What people told us of the nets 
    by the river</a> <a href=6>What people told us of the rafts by the river</a> <a href=7>What people told us of the 
    wells by the river</a> <a href=8>What people told us of the fords by the river</a> <a href=9>What people told us of 
    the herons by the river</a></div>
    <footer>&copy; 2020 The Ferry, by the bridge</footer></body>""",
    """<body><div class=promo>Read on the river, too.</div><article><p data-main>
    The ferry ran from the stone steps below the customs house to the reeds on the other bank, where a plank had
    been laid over the mud, and whoever wanted to cross rang the bell that hung in the willow and waited until the
    ferryman had finished his meal, his pipe or his talk, for he was never seen to hurry, not for the doctor, not
    for the bishop, and not for the bride who came too late for her own wedding because of it.</p></article><section class=comments><p>My uncle had one of those spoons, with a pike on it, and he ate
    his soup with it until the end of his days.</p></section></body>""",
    """<body><div><a href=1>Start</a></div><div><p data-main>Who looks for the source of the brook must leave the path where the
    fence ends and go up through the ferns, keeping the water on the left.</p></div></body>""",
)


@dataclass(frozen=True)
class Node:
    label: bool
    feature: int = -1
    bound: float = 0.0
    low: Node | None = None
    high: Node | None = None

    def says(self, row: tuple[float, ...]) -> bool:
        node = self
        while node.feature >= 0:
            node = node.high if row[node.feature] > node.bound else node.low
        return node.label


def train(rows: list[tuple[float, ...]], labels: list[bool], depth: int = 6) -> Node:
    """A decision tree by Gini impurity; ties go to the feature named first."""
    good = sum(labels)
    label = 2 * good >= len(labels)
    if depth == 0 or good in (0, len(labels)):
        return Node(label)

    def impurity(n: int, k: int) -> float:
        return 2 * k * (n - k) / n if n else 0.0

    best = (impurity(len(labels), good) - 1e-9, -1, 0.0)
    for f in range(len(rows[0])):
        pairs = sorted(zip((r[f] for r in rows), labels))
        left = 0
        for i in range(1, len(pairs)):
            left += pairs[i - 1][1]
            if pairs[i][0] != pairs[i - 1][0]:
                cost = impurity(i, left) + impurity(len(pairs) - i, good - left)
                if cost < best[0] - 1e-9:
                    best = (cost, f, (pairs[i][0] + pairs[i - 1][0]) / 2)
    if best[1] < 0:
        return Node(label)
    _, f, bound = best
    sides = [[(r, y) for r, y in zip(rows, labels) if (r[f] > bound) == above] for above in (False, True)]
    low, high = (train([r for r, _ in side], [y for _, y in side], depth - 1) for side in sides)
    return Node(label, f, bound, low, high)


@lru_cache(maxsize=1)
def tree() -> Node:
    found = [page_blocks(page) for page in LABELLED]
    return train([row for page in found for row in features(page)], [b.label for page in found for b in page])


def main_text(page: str) -> str:
    """The blocks that the tree takes for the article, one per line."""
    found = page_blocks(page)
    judge = tree()
    return "\n".join(b.text for b, row in zip(found, features(found)) if judge.says(row))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page's main text.

    Null, empty and text-less pages give an empty text; cut-off pages what is there; repeated
    rows are extracted alike; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).to_pylist()
            for a, b in blocks.steps([b"" if v is None else v for v in values]):
                texts = [main_text(v or "") for v in values[a:b]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(run, schema)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))

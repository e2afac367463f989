"""The main text of web pages by tree scoring.

A page becomes a tree of elements and runs of text, each run a block between block-level tags. Elements that
never hold the article (scripts, menus, forms, ...) are left out with all below them, and so are those whose class or
id says so (adverts, comments, ...) unless they hold the page's article or most of its text. Every run
gives points for length and commas to its element and, halved and then thinned, to the elements above; an element's
points are discounted by its link density. The element with the most points, or the article element around it, and
those of its siblings that score well are kept with all their runs; beside an article further articles with few links are kept,
and beside a container that is no article headings and paragraphs with few links, and elements that hold a title or end a sentence.

Inside an article, names tell less: headings have none, an id of a paragraph or section is an anchor, and a header is the article's own.

Elements know their nearest block, open paragraph and article, and all sums go up the tree once, so a page of any length and depth takes
time in proportion to it.

Defined results: a NULL or empty page, or one without text, gives the empty text; a page cut off anywhere is read
as far as it goes; equal pages get equal texts; repeated rows stay repeated; an empty table gives no rows.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var img wbr br".split()
)
NEVER = RAW | set("head template nav footer aside form button select option datalist dialog menu svg canvas object audio video map".split())
HOLDS = {"article", "main", "body", "html"}
#: A start tag of the key closes an open element of the values, up to the nearest element that bounds it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
NOISE = re.compile(
    r"(?:^|[^a-z0-9])(?:ads?|adverts?|advertis\w*|adsense|sponsor\w*|promos?|promotion\w*|banners?|sidebars?|menus?|nav|navbar|navigation|"
    r"breadcrumbs?|footers?|headers?|masthead|comments?|commentlist|disqus|replies|reply|respond|cookies?|consent|notices?|gdpr|popups?|"
    r"modals?|overlay|newsletter|subscribe|subscription|shar(?:e|ing)|social|related|recommend\w*|widgets?|toolbar|login|signup|"
    r"pagination|pager|skip|search|disclaimer|alert)(?![a-z0-9])"
)
#: What others say about an article may be longer than it.
TALK = re.compile(r"(?:^|[^a-z0-9])(?:comments?|commentlist|disqus|replies|reply|respond)(?![a-z0-9])")
#: Elements that are kept beside the best container, and the share of their characters that may be links.
BESIDE, LINKED = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "blockquote", "pre"}, 0.25
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Names that an article's own parts may have.
OWN = re.compile(r"(?<![a-z0-9])(?:headers?|masthead)(?![a-z0-9])")
CITED = re.compile(r"(?<![a-z0-9])(?:ref(?:erence)?s?|bibliography|citations?|sources|footnotes|endnotes)(?![a-z0-9])")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "alertdialog"}
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z:_-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for tag in RAW}
SPACE = re.compile(r"\s+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


class Node:
    __slots__ = (
        "tag", "up", "depth", "never", "link", "index", "items", "noise", "talk", "muted", "cited", "block", "open_p", "inside",
        "chars", "links", "own", "here", "once", "twice", "far", "last", "titled",
    )

    def __init__(self, tag: str, up: Node | None, never: bool, link: bool, index: int, names: str = ""):
        self.tag, self.up, self.never, self.link, self.index = tag, up, never, link, index
        self.noise = tag not in HOLDS and bool(NOISE.search(names))
        self.talk, self.cited = bool(TALK.search(names)), bool(CITED.search(names))
        inline = tag in INLINE
        self.muted = inline and (self.noise or bool(up and up.muted))
        self.depth = up.depth + 1 if up else 0
        # the nearest element that is a block, paragraph that a block would end, and article
        self.block = up.block if inline else self
        self.open_p = self if tag == "p" else up.open_p if inline else None
        self.inside = self if tag in ("article", "main") else up.inside if up else None
        # sums over what is below: characters, those in links, those outside links, points by distance; the last run
        self.chars = self.links = self.own = self.items = 0
        self.here = self.once = self.twice = self.far = 0.0
        self.last, self.titled = -1, False

    @property
    def points(self) -> float:
        """Points of the runs: all of the own ones and of the children's, half of the next ones, then ever less."""
        return self.here + self.once + self.twice / 2 + self.far


def left_out(tag: str, attributes: str, up: Node) -> tuple[bool, str]:
    """Whether an element never holds the article, and its names."""
    if tag in NEVER:
        return True, ""
    if tag == "header" and not up.inside:
        return True, ""
    if not attributes.strip() or tag in HOLDS - {"article"}:
        return False, ""
    found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    if tag == "article":
        return False, CAMEL.sub("-", found.get("class", "")).lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES:
        return True, ""
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "").lower()):
        return True, ""
    kind, ident = (CAMEL.sub("-", found.get(key, "")).lower() for key in ("class", "id"))
    if up.inside:
        if tag in HEADINGS:
            return False, ""
        if tag in ("p", "section") and not TALK.search(ident):
            ident = ""
        kind, ident = OWN.sub(" ", kind), OWN.sub(" ", ident)
    return False, f"{kind} {ident}"


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """All elements in page order, and the runs of text: nearest block element, text, characters in links."""
    nodes = [Node("html", None, False, False, 0)]
    stack = [nodes[0]]
    places: dict[str, list[int]] = {}  # where a tag is open in the stack
    runs: list[tuple[Node, str, int]] = []
    held: list[tuple[str, bool]] = []

    def end_run():
        if held:
            text = SPACE.sub(" ", unescape("".join(t for t, _ in held))).strip()
            if text:
                links = min(len(text), sum(len(t.strip()) for t, link in held if link))
                runs.append((stack[-1].block, text, links))
            held.clear()

    def say(text: str):
        if text and not stack[-1].never and not stack[-1].muted:
            held.append((text, stack[-1].link))

    def cut(k: int):
        while len(stack) > k:
            places[stack.pop().tag].pop()

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        say(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            if tag == "br":
                say(" ")
            elif tag not in VOID:
                k = last((tag,))
                # the end of an inline element does not end the blocks inside it
                if k and not (tag in INLINE and stack[-1].block.depth > k):
                    if stack[-1].block.depth >= k:
                        end_run()
                    cut(k)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag == "html":
            continue
        if tag not in INLINE:
            end_run()
            if stack[-1].open_p:  # a block ends an open paragraph
                cut(stack[-1].open_p.depth)
            if tag in CLOSES:
                ends, bounds = CLOSES[tag]
                if last(ends) > last(bounds):
                    cut(last(ends))
        if tag in VOID:
            continue
        up = stack[-1]
        never, names = (True, "") if up.never else left_out(tag, found[3] or "", up)
        node = Node(tag, up, never, up.link or tag == "a", len(nodes), names)
        if tag == "li":
            up.items += 1
        nodes.append(node)
        if tag in RAW:
            close = CLOSE[tag].search(page, at)
            at = close.end() if close else end
        elif not (found[3] or "").rstrip().endswith("/") or tag not in ("svg", "path"):
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    end_run()
    return nodes, runs


def points(text: str) -> float:
    return (1.0 if len(text) >= 25 else 0.1) + text.count(",") + min(len(text) / 100, 3.0)


def downwards(nodes: list[Node], marked) -> list[bool]:
    """For each node whether it, or an element above it, is marked; parents come before their children."""
    found: list[bool] = []
    for n in nodes:
        found.append(marked(n) or (n.up is not None and found[n.up.index]))
    return found


def without_noise(nodes: list[Node], runs: list[tuple[Node, str, int]]) -> list[tuple[Node, str, int]]:
    """The runs outside elements with noise names.

    If all articles are inside such elements, those above the article with the most text, outside talk if any is, are none; nor are those
    that hold most of the page's text, unless it is talk or the article is elsewhere."""
    if not any(n.noise for n in nodes):
        return runs
    for block, text, links in runs:
        block.own += len(text) - links
    for n in reversed(nodes):
        if n.up:
            n.up.own += n.own
    noisy, talk = downwards(nodes, lambda n: n.noise), downwards(nodes, lambda n: n.talk)
    articles = [n for n in nodes if n.tag in ("article", "main") and n.own]
    clean = [n for n in articles if not noisy[n.index]]
    if articles and not clean:
        clean = [max(articles, key=lambda n: (not talk[n.index], n.own, n.depth, -n.index))]
        n = clean[0]
        while n:
            n.noise, n = False, n.up
    holders = {n.index for n in clean}
    held = downwards(nodes, lambda n: n.index in holders)
    for n in nodes:
        if n.noise and not n.talk and 2 * n.own > nodes[0].own:
            n.noise = bool(clean) and not held[n.index]
    noisy = downwards(nodes, lambda n: n.noise)
    return [run for run in runs if not noisy[run[0].index]]


def gather(nodes: list[Node], runs: list[tuple[Node, str, int]]) -> None:
    """Characters, links, points and the last run of every element, from its children up."""
    for k, (block, text, links) in enumerate(runs):
        block.chars += len(text)
        block.links += links
        block.here += points(text)
        block.last = k
    for n in reversed(nodes):
        n.titled = n.titled or (n.tag in ("h1", "h2") and n.chars > 0)
        if n.up:
            up = n.up
            up.chars += n.chars
            up.links += n.links
            up.last = max(up.last, n.last)
            up.titled = up.titled or n.titled
            up.once += n.here
            up.twice += n.once
            up.far += n.twice / 6 + n.far * 2 / 3


#: Elements that are paragraphs or parts of one; the element around them is the candidate.
PARTS = HEADINGS | {"p", "li", "pre", "blockquote", "td", "th", "dt", "dd", "tr", "ul", "ol"}


def main_text(page: str | None) -> str:
    nodes, runs = parse(page or "")
    runs = without_noise(nodes, runs)
    if not runs:
        return ""
    gather(nodes, runs)
    scores = {n.index: n.points * (1 - n.links / n.chars) for n in nodes if n.chars}
    choice = [n for n in nodes if n.chars and n.tag not in PARTS and n.tag not in INLINE] or [nodes[0]]
    best = max(choice, key=lambda n: (scores.get(n.index, 0.0), n.depth, -n.index))
    inside = best.inside
    best = inside or best
    least = max(10.0, 0.2 * scores.get(best.index, 0.0))

    def beside(n: Node) -> bool:
        if scores[n.index] >= least:
            return True
        if n.links > LINKED * n.chars:
            return False
        if inside:
            return n.tag == "article" and not n.talk
        return n.tag in BESIDE or n.tag in ("div", "section") and (n.titled or runs[n.last][1].endswith((".", "!", "?", "…")))

    kept = {n.index for n in nodes if n.up is best.up and n.up and n.tag not in INLINE and n.chars and beside(n)} | {best.index}
    good = downwards(nodes, lambda n: n.index in kept)
    listed = lambda n: n.tag == "ul" or n.tag == "ol" and not n.inside
    menus = downwards(nodes, lambda n: listed(n) and not n.cited and n.items >= 3 and n.links > 0.8 * n.chars > 0)
    return "\n".join(text for block, text, _ in runs if good[block.index] and not menus[block.index])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its length of every page."""

    @F.arrow_udf("string")
    def extracted(column: pa.Array) -> pa.Array:
        return pa.array([main_text(page) for page in column.to_pylist()], pa.string())

    return pages.select("page_id", "url", extracted("html").alias("text")).withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import html
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import extended, free_names, slices

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    """
    a about after all also an and any are as at be because been but by can could do for from had has have he her his how
    if in into is it its more most no not of on one or other our out she so some than that the their them then there these
    they this to up was we were what when which who will with would you your
    aber als am auch auf aus bei bis das dass dem den der des die doch durch ein eine einem einen einer er es für hat ich
    ihr im ist man mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn wie wir wird zu
    zum zur
    au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais même ne nous on ou par
    pas plus pour que qui sa sans se ses si son sont sur tout très un une vous
    al como con cuando del dos el ella entre era es esta este fue ha hay la las lo los más me muy no nos o para pero por
    porque se ser si sin sobre su sus también tiene todo un una y ya
    """.split()
)
# Elements that never hold the article, by kind.
SKIPPED = frozenset("script style noscript template iframe svg canvas object select textarea button head title audio video map".split())
OUTSIDE = frozenset("nav footer aside form menu dialog header".split())
ARTICLE = frozenset("article main".split())
# Of these, those in which an article is not the page's; a form may stand around the whole page.
BESIDE = frozenset("nav footer aside".split())
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that end an open paragraph or one of their own kind.
CLOSING = HEADINGS | frozenset("p li td th tr dt dd".split())
# Elements whose names say nothing about what they hold.
WHOLE = frozenset("html body main".split())
# Words of class and id names that mark what surrounds an article.
MARKS = frozenset(
    """
    ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie consent disqus footer
    masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo recommended related
    share sharing sidebar signup social sponsor sponsored subscribe toolbar widget
    """.split()
)
# Of these, those of text that is written like an article and is none.
FOREIGN = frozenset("comment comments consent cookie disqus".split())
# Words that make a name of several words with a mark (share-box, comment-list); with others it is none (has-sidebar).
BESIDES = frozenset(
    """
    area bar block body bottom box button buttons entry form group header icons inner item items left link links list main
    page post posts primary reply respond right secondary section site thread top wrap
    """.split()
)

#: Characters up to which a block is short, from which it is long; stop-word shares; largest share of linked text.
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.15, 0.25
LINKED = 0.4

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NAMES = frozenset("class id role".split())
PART = re.compile(r"[^\W\d_]+")
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    outside: bool
    article: int
    share: float = 0.0

    def free(self) -> bool:
        return self.linked <= LINKED * len(self.text)

    def prose(self) -> bool:
        """Long, dense and not linked: text of an article wherever it stands."""
        return len(self.text) >= LONG and self.share >= STOP_HIGH and self.free()


def stop_share(text: str) -> float:
    words = LETTERS.findall(text.lower())
    return sum(word in STOP_WORDS for word in words) / len(words) if words else 0.0


def marks(attributes: str) -> tuple[bool, bool]:
    """Whether a name of the class, id or role is a mark, and whether it is one of foreign text."""
    marked = foreign = False
    for found in ATTRIBUTE.finditer(attributes):
        if found[1].lower() in NAMES and found[2]:
            for name in found[2].strip("\"'").lower().split():
                words = set(PART.findall(name))
                if words & MARKS and words <= MARKS | BESIDES:
                    marked, foreign = True, foreign or bool(words & FOREIGN)
    return marked, foreign


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order, with linked characters and where they stand."""
    out: list[Block] = []
    # Name, number of the ring, number of the article, articles before it if those in it have no weight.
    stack: list[tuple[str, int, int, int | None]] = []
    # An element outside the article, or an article that ends those around it: ring around it, whether prose in it
    # cannot free it, number of the article.
    rings: list[tuple[int, bool, int]] = [(0, False, 0)]
    void: list[tuple[int, int]] = []  # ranges of articles that lie in a closed menu, aside or marked element
    around: list[int] = []
    parts: list[str] = []
    anchors: list[str] = []  # the parts that are linked
    links, heading, articles, breaks = False, False, 0, 0

    def plain(pieces: list[str]) -> str:
        return " ".join(html.unescape("".join(pieces)).split())

    def flush() -> None:
        nonlocal parts, anchors, heading, breaks
        text = plain(parts)
        if text:
            linked = len(plain(anchors))
            _, ring, article, _ = stack[-1] if stack else ("", 0, 0, None)
            out.append(Block(text, min(linked, len(text)), heading, False, article, stop_share(text)))
            around.append(ring)
        parts, anchors, breaks = [], [], 0

    place, size = 0, len(page)
    while place < size:
        found = TOKEN.search(page, place)
        text = page[place : found.start() if found else size]
        if text:
            parts.append(text)
            if not text.isspace():
                breaks = 0
            if links:
                anchors.append(text)
        if not found:
            break
        place = found.end()
        if not found["name"]:
            continue
        name, closing = found["name"].lower(), bool(found["close"])
        if name in SKIPPED and not closing:
            if name in ("head", "title") or not found["attributes"].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, place)
                body = re.compile(r"<body\b", re.IGNORECASE).search(page, place) if name == "head" else None
                if end and not (body and body.start() < end.start()):
                    place = end.end()
                elif body:
                    place = body.start()
                elif name in ("script", "style", "template"):
                    place = size
            parts.append(" ")
        elif name == "a":
            links = not closing and any(a[1].lower() == "href" for a in ATTRIBUTE.finditer(found["attributes"]))
        elif name == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                flush()
        elif name in BLOCKS:
            flush()
            links = False
            if closing:
                if any(entry[0] == name for entry in stack):
                    while (entry := stack.pop())[0] != name:
                        pass
                    if entry[3] is not None and articles > entry[3]:
                        void.append((entry[3], articles))
                heading = False
            else:
                if name in CLOSING:
                    while stack and stack[-1][0] in ("p", *HEADINGS, name):
                        stack.pop()
                _, ring, article, _ = stack[-1] if stack else ("", 0, 0, None)
                marked, foreign = marks(found["attributes"]) if found["attributes"] and name not in WHOLE else (False, False)
                if name in ARTICLE and not foreign:
                    if not article and not marked:
                        # Of an open menu that is never closed the end is lost; an article in a closed one has no weight.
                        articles += 1
                        article = articles
                        rings.append((ring, False, article))
                        ring = len(rings) - 1
                    marked = False
                elif marked or (name in OUTSIDE and not (name == "header" and article)):
                    rings.append((ring, foreign or name in BESIDE, 0))
                    ring = len(rings) - 1
                heading = name in HEADINGS
                if name not in VOID:
                    stack.append((name, ring, article, articles if marked or name in BESIDE else None))
        elif name in ("option", "label", "input"):
            parts.append(" ")
    flush()
    steps = [0] * (articles + 2)
    for low, high in void:
        steps[low + 1] += 1
        steps[high + 1] -= 1
    inside = list(itertools.accumulate(steps))
    # An article with weight stands outside no ring, one without is part of the ring around it.
    within, firm = [0], [False]
    for number, (ring, shut, article) in enumerate(rings[1:], 1):
        within.append(number if not article else within[ring] if inside[article] else 0)
        firm.append(firm[within[ring]] or shut)
    # Prose frees the marked elements that it stands in.
    freed = [True] + [False] * (len(rings) - 1)
    for block, ring in zip(out, around):
        ring = within[ring]
        if block.prose() and not firm[ring]:
            while not freed[ring]:
                freed[ring] = True
                ring = within[rings[ring][0]]
    for block, ring in zip(out, around):
        block.outside = not freed[within[ring]]
        if inside[block.article]:
            block.article = 0
    return out


def first_pass(block: Block, tagged: bool = False) -> bool | None:
    """True: article, False: not, None: undecided. ``tagged``: other text of the page lies in a marked article."""
    if block.outside:
        return False
    if len(block.text) < SHORT or block.heading:
        return None
    if not block.free():
        return False
    if tagged and not block.article:
        # Beside a marked article only what is long and dense speaks for itself.
        return True if block.prose() else None if block.share >= STOP_LOW else False
    if block.share >= STOP_HIGH:
        return True
    if block.share >= STOP_LOW and len(block.text) >= LONG:
        return True
    # Few function words: no verdict inside a marked article, where the language may be unknown.
    return None if block.article or block.share >= STOP_LOW else (False if len(block.text) < LONG else None)


def weighty(found: list[Block]) -> bool:
    """Whether the marked articles hold as much dense text as the rest of the page (all text if none is dense)."""
    dense, rest, plain = 0, 0, 0
    for block in found:
        verdict = first_pass(block)
        if block.article and not block.outside and block.free():
            dense += len(block.text) if verdict else 0
            plain += len(block.text)
        elif verdict:
            rest += len(block.text)
    return (dense or plain) >= max(rest, 1)


Neighbour = tuple[int, bool] | None


def neighbours(found: list[Block], labels: list[bool | None]) -> tuple[list[Neighbour], list[Neighbour]]:
    """The decided blocks (place, label) before and after each block, nearest in its article."""
    sides: list[list[Neighbour]] = []
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        side: list[Neighbour] = [None] * len(found)
        last: dict[int, tuple[int, bool]] = {}
        for place in order:
            block, label = found[place], labels[place]
            side[place] = last.get(block.article)
            # Marked parts in an article say nothing about the text between them.
            if label is not None and not (block.article and block.outside):
                last[block.article] = place, label
        sides.append(side)
    return sides[0], sides[1]


def nearest(place: int, left: tuple[int, bool], right: tuple[int, bool]) -> bool:
    """The label of the nearer one; of two at one distance both must be article."""
    if place - left[0] == right[0] - place:
        return left[1] and right[1]
    return left[1] if place - left[0] < right[0] - place else right[1]


def decide(found: list[Block]) -> list[bool]:
    """Both passes over all blocks; <article> and <main> are a weight, and none if the rest has more dense text."""
    tagged = weighty(found)
    if not tagged:
        found = [replace(block, article=0) for block in found]
    labels = [first_pass(block, tagged) for block in found]
    known = {block.article for block, label in zip(found, labels) if label}
    # Second pass: an undecided block takes the label of the nearest decided one of its article, and the page's
    # edges are none. A heading goes with what follows.
    before, after = neighbours(found, labels)
    decided = list(labels)
    # Short links first, the others see them decided. At the end of an article they need a heading: a list of sources.
    head = -1
    for place, block in enumerate(found):
        if block.heading or block.free():
            head = place if block.heading else -1
        elif labels[place] is None:
            left, right = before[place], after[place]
            if left and right:
                decided[place] = nearest(place, left, right)
            else:
                decided[place] = bool(block.article and left and left[1] and head > left[0])
    labels = list(decided)
    before, after = neighbours(found, labels)
    for place, block in enumerate(found):
        if labels[place] is not None:
            continue
        left, right = before[place], after[place]
        if block.article:
            # The article's weight: either neighbour or edge will do, and all will in a language without stop words.
            decided[place] = block.article not in known or not left or not right or left[1] or right[1]
        elif left is None and right is None:
            decided[place] = not tagged and len(block.text) >= SHORT
        elif block.heading:
            decided[place] = bool(right and right[1])
        elif left is None or right is None:
            decided[place] = False
        else:
            decided[place] = nearest(place, left, right)
    return [bool(label) for label in decided]


def main_text(page: str | None) -> str:
    """Blocks of the article joined by line feeds."""
    found = blocks(page or "")
    decided = decide(found)
    if not any(decided) and any(block.outside and block.prose() for block in found):
        # All prose of the page lies in menus, asides or marked elements: their names are wrong.
        decided = decide([replace(block, outside=False) for block in found])
    return "\n".join(block.text for block, keep in zip(found, decided) if keep)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """All columns but ``column``, with ``text`` (the article, empty if there is none) and ``n_chars``.

    A null or empty page has no text; a damaged one is read as far as its markup goes; columns of these names in
    the input are replaced; repeated rows give equal results.
    """
    clean = pages.drop(*[c for c in ("text", "n_chars") if c != column])
    rest = [c for c in clean.columns if c != column]
    [page] = free_names(clean, "page")
    frame = clean.select(*[f"`{name}`" for name in rest], F.col(f"`{column}`").alias(page))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, page):
            texts = [main_text(html) for html in batch.column(len(rest)).to_pylist()]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), sizes], [*rest, "text", "n_chars"])

    return frame.mapInArrow(run, extended(frame.drop(page), "text string, n_chars long"))


def op9(spark: SparkSession, folder: str) -> DataFrame:
    """The article of every page."""
    from tidemark.llm.common import table

    return extract(table(spark, folder, "pages").select("page_id", "url", "html"))

"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level tags.  The first pass decides a block by what it
stands in (menus, headers, footers, sidebars, notices, adverts, forms, comments), by the share
of its letters in links, and by its density of stop words, which running text has and labels
have not.  Short blocks that this leaves open inherit, in the second pass, the label of the
nearest decided block, headings that of the next one.  Where a page marks articles, that is a
hint for blocks the rules leave open: they inherit within the article, or outside of articles,
and are text in an article that has no decided block.

What the names of a class, an id or a role say about an element is evidence that the running
text in it is weighed against; see :class:`Suspect`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakwise.llm.worker import carried

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in is was for that on with as by at from it this be are or an not which "
    "der die das und ist von zu mit den im ein eine nicht sich des auf für als auch "
    "le la les de des un une et est en que qui dans pour pas sur du avec elle par "
    "el los las un una y es en que no se con por para del al lo como".split()
)

# Tags that begin and end a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu "
    "nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Tags whose content is not parsed.
RAW_TAGS = frozenset(
    "script style noscript template textarea title iframe svg math object canvas audio video "
    "select button noembed noframes xmp".split()
)
#: What is never main text, by tag; by role and by the words of class and id it is likely not.
AWAY_TAGS = frozenset("nav footer aside dialog menu".split())
AWAY_ROLES = frozenset(
    "navigation contentinfo complementary search dialog alertdialog alert menu menubar toolbar "
    "banner form".split()
)
AWAY_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored "
    "promo promotion sidebar nav navbar navigation menu breadcrumb breadcrumbs footer cookie "
    "cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations comment comments commentlist "
    "reply replies respond discussion disqus pager pagination widget copyright".split()
)
#: Words that leave the meaning of those beside them as it is: a comment list is comments.
FRAME_WORDS = frozenset(
    "area list section container wrapper wrap box block bar inner outer thread body item items "
    "site page global top bottom left right primary secondary posts links icons buttons button "
    "text message title slot unit group panel row col column header".split()
)
#: Words of names that tell a state of the page or what an element is beside something.
STATE_WORDS = frozenset("no not has with without is hide hidden show enabled disabled of".split())

#: Shares of linked letters from which a block is a menu, in general and in an article.
LINKED, LINKED_IN_ARTICLE = 0.4, 0.6
#: Letters under which a block is short, and the stop-word density of running text.
SHORT = 70
STOP_DENSITY = 0.08
#: Letters from which a block counts as text on a page without running text.
LONG = 120

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.DOTALL,
)
_UNCLOSED = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(
    r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
    re.IGNORECASE,
)
_WORD = re.compile(r"[^\W\d_]+")


# How sure it is that an element holds no main text.
NONE, WEAK, FORM, STRONG, SURE = range(5)


def _name_evidence(name: str, in_article: bool, heading: bool) -> int:
    """What one class or id says: strong if all its words mean the same, weak if one of several
    does, nothing if it tells a state."""
    words = [w for w in re.split(r"[^a-z]+", name) if w]
    header = "header" in words and not in_article and not heading
    if not (header or any(w in AWAY_WORDS for w in words)):
        return NONE
    if any(w in STATE_WORDS for w in words):
        return NONE
    return STRONG if all(w in AWAY_WORDS or w in FRAME_WORDS for w in words) else WEAK


def _evidence(tag: str, attributes: str, in_article: bool) -> int:
    """How sure it is from an element's tag and attributes that it holds no main text."""
    if tag in AWAY_TAGS or (tag == "header" and not in_article):
        return SURE
    hints = in_article or tag not in ("html", "body", "article", "main")
    found = FORM if tag == "form" else NONE
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return SURE
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return SURE
        if hints and name == "role" and value in AWAY_ROLES:
            found = max(found, FORM if value in ("form", "banner") else STRONG)
        if hints and name in ("class", "id"):
            for part in value.split():
                found = max(found, _name_evidence(part, in_article, tag in HEADINGS))
    return found


class Suspect:
    """An element that holds no main text if its names are right.

    Weak evidence stands only if there is no running text and no article in the element.  A
    form is away unless it holds most of the page's running text, and strong evidence stands
    unless articles in it, which no names speak against, do.
    """

    __slots__ = ("kind", "parent", "running", "in_articles", "away")

    def __init__(self, kind: int, parent: Suspect | None):
        self.kind, self.parent = kind, parent
        #: Letters of running text, and of those the ones in articles opened below.
        self.running = self.in_articles = 0
        self.away = False

    def judge(self, total: int) -> None:
        if self.kind == WEAK:
            own = not self.running
        elif self.kind == FORM:
            own = 2 * self.running <= total
        else:
            own = 2 * self.in_articles <= total
        self.away = own or bool(self.parent and self.parent.away)


class Block:
    __slots__ = ("text", "linked", "tag", "away", "article", "suspect", "density", "opened_in")

    def __init__(self, text: str, linked: int, tag: str, away: bool, article: int,
                 suspect: Suspect | None = None, opened_in: Suspect | None = None):
        self.text, self.linked, self.tag = text, linked, tag
        self.away, self.article, self.suspect = away, article, suspect
        #: Suspect around the article that the block is in.
        self.opened_in = opened_in
        words = _WORD.findall(text.lower())
        self.density = sum(w in STOP_WORDS for w in words) / max(1, len(words))

    @property
    def running(self) -> bool:
        """Whether a block reads like running text, whatever it stands in."""
        return (
            len(self.text) >= SHORT and self.density >= STOP_DENSITY
            and self.linked <= LINKED * len(self.text)
        )


def _judged(blocks: list[Block], suspects: list[Suspect]) -> list[Block]:
    """Blocks with ``away`` as the suspects around them have it; elements are in page order, so
    each stands behind those around it."""
    total = 0
    for b in blocks:
        if b.running and not b.away:
            total += len(b.text)
            if b.suspect:
                b.suspect.running += len(b.text)
            if b.article and b.opened_in:
                b.opened_in.in_articles += len(b.text)
    for s in reversed(suspects):
        if s.parent:
            s.parent.running += s.running
            s.parent.in_articles += s.in_articles
    for s in suspects:
        s.judge(total)
    for b in blocks:
        b.away = b.away or bool(b.suspect and b.suspect.away)
        if b.away:
            b.article = 0
    return blocks


def blocks_of(html: str) -> list[Block]:
    """Blocks with text in page order."""
    blocks: list[Block] = []
    pieces: list[str] = []
    linked: list[str] = []
    suspects: list[Suspect] = []
    # Open elements: tag, whether it or one around it is surely away, its article, links open
    # before, the nearest suspect, and that around the article.
    stack: list[tuple[str, bool, int, bool, Suspect | None, Suspect | None]] = []
    nothing = ("", False, 0, False, None, None)
    opened: dict[str, int] = {}
    articles = 0
    in_link = False

    def flush() -> None:
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            tag, away, article, _, suspect, around = stack[-1] if stack else nothing
            letters = len(" ".join(unescape("".join(linked)).split()))
            blocks.append(Block(text, letters, tag, away, article, suspect, around))
        pieces.clear()
        linked.clear()

    def close() -> None:
        nonlocal in_link
        tag, _, _, in_link, _, _ = stack.pop()
        opened[tag] -= 1

    def suspected(kind: int, suspect: Suspect | None) -> Suspect | None:
        if kind in (NONE, SURE):
            return suspect
        suspects.append(Suspect(kind, suspect))
        return suspects[-1]

    # Nothing after the last ">" is complete markup: text up to where markup begins.
    tail = html.rfind(">") + 1
    cut = _UNCLOSED.search(html, tail)
    at, end = 0, cut.start() if cut else len(html)
    while at < end:
        markup = _MARKUP.search(html, at, tail) if at < tail else None
        stop = markup.start() if markup else end
        if stop > at:
            pieces.append(html[at:stop])
            if in_link:
                linked.append(html[at:stop])
        if not markup:
            break
        at = markup.end()
        closing, tag, attributes = markup.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW_TAGS:
            if not closing and not attributes.endswith("/"):
                over = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(html, at)
                at = over.end() if over else end
            pieces.append(" ")
        elif tag == "a":
            in_link = not closing
        elif tag == "br":
            pieces.append(" ")
            if in_link:
                linked.append(" ")
        elif closing:
            if tag in BLOCK_TAGS:
                flush()
            if opened.get(tag):
                while stack[-1][0] != tag:
                    close()
                close()
        elif tag in BLOCK_TAGS:
            flush()
            if stack and (stack[-1][0] == "p" or stack[-1][0] in HEADINGS and tag in HEADINGS):
                close()
            if stack and stack[-1][0] == tag and tag in ("li", "td", "tr", "dt", "dd", "option"):
                close()
            if tag in VOID_TAGS or attributes.endswith("/"):
                continue
            _, away, article, _, suspect, around = stack[-1] if stack else nothing
            kind = _evidence(tag, attributes, article > 0)
            away = away or kind == SURE
            if tag in ("article", "main") and not article and not away:
                # An article that its own names speak against is none.
                if _evidence(tag, attributes, True) == NONE:
                    articles += 1
                    article, around = articles, suspect
                elif suspect:
                    kind = _evidence(tag, attributes, True)
            suspect = suspected(kind, suspect)
            stack.append((tag, away, article, in_link, suspect, around))
            opened[tag] = opened.get(tag, 0) + 1
        elif tag in ("span", "section", "ins", "label"):
            # Inline elements are followed only where they may hide or mark what they hold.
            kind = NONE
            if attributes and not attributes.endswith("/"):
                kind = _evidence(tag, attributes, True)
            if kind or opened.get(tag):
                if kind:
                    flush()
                _, away, article, _, suspect, around = stack[-1] if stack else nothing
                suspect = suspected(kind, suspect)
                stack.append((tag, away or kind == SURE, article, in_link, suspect, around))
                opened[tag] = opened.get(tag, 0) + 1
    flush()
    return _judged(blocks, suspects)


def _first_pass(block: Block, marked: bool) -> bool | None:
    """Whether a block is main text; None while it is open.  ``marked`` tells that the page has
    articles, so that a long block outside of them without stop words is none."""
    if block.away:
        return False
    share = block.linked / len(block.text)
    if block.article and share > LINKED_IN_ARTICLE:
        return False if block.tag in ("li", "ul", "ol", "td") else None
    if not block.article and share > LINKED:
        return False
    if block.tag in HEADINGS:
        return None
    if len(block.text) < SHORT:
        return False if block.linked and not block.article else None
    if block.density >= STOP_DENSITY:
        return True
    return False if marked and not block.article else None


def _second_pass(blocks: list[Block], labels: list[bool | None], whole: bool) -> list[bool]:
    """Open blocks inherit from the nearest decided block, headings from the next one; at equal
    distance one block of main text is enough."""
    n = len(blocks)
    lengths = [len(b.text) for b in blocks]
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    for order, found in ((range(n), before), (range(n - 1, -1, -1), after)):
        last, distance = None, 0
        for i in order:
            if labels[i] is not None:
                last, distance = labels[i], 0
            else:
                found[i] = None if last is None else (distance, last)
                distance += lengths[i]
    result = []
    for i, label in enumerate(labels):
        if label is None:
            if after[i] and (not before[i] or blocks[i].tag in HEADINGS):
                label = after[i][1]
            elif before[i] and (not after[i] or before[i][0] != after[i][0]):
                label = min(x for x in (before[i], after[i]) if x)[1]
            elif before[i]:
                label = before[i][1] or after[i][1]
            else:
                label = whole
        result.append(label)
    return result


def main_text(html: str | None) -> str:
    """Main text of a page, one line per block; empty for null."""
    blocks = blocks_of(html or "")
    marked = any(b.article for b in blocks)
    labels = [_first_pass(b, marked) for b in blocks]
    if not any(labels):
        labels = [
            True if label is not True and not b.away and b.tag not in HEADINGS
            and len(b.text) >= LONG and b.linked <= LINKED * len(b.text) else label
            for b, label in zip(blocks, labels)
        ]
    # What is outside an article says nothing about open blocks inside, nor the other way round.
    groups: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        if not (b.article and b.away):
            groups.setdefault(b.article, []).append(i)
    kept = set()
    for article, own in groups.items():
        chosen = _second_pass([blocks[i] for i in own], [labels[i] for i in own], article > 0)
        kept.update(i for i, keep in zip(own, chosen) if keep)
    return "\n".join(b.text for i, b in enumerate(blocks) if i in kept)


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the markup, with ``text`` and ``n_chars``, its code points.

    Null and empty pages, and pages without main text, have an empty text.  White space within
    a block, of any kind and from character references too, is one space.  Columns named like
    a result are replaced.
    """
    import pyarrow as pa

    packed, unpacked = carried(pages, html, "text", "n_chars")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string())],
                names=[*batch.schema.names[1:], "text"],
            )

    rows = pages.select(F.col(f"`{html}`").alias("__html"), *packed)
    schema = rows.drop("__html").schema.add("text", "string")
    return rows.mapInArrow(extract, schema).select(
        *unpacked, "text", F.char_length("text").cast("bigint").alias("n_chars")
    )

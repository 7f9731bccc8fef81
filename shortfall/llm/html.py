"""Main text of web pages by two passes over their blocks.

A page is cut into blocks of text. The first pass looks at each block alone:
where it stands, its length, link density and stop-word density decide good,
bad or short. The second pass gives every short block the label of its nearest
decided neighbours.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")
LINK = re.compile(r"<(/?)a(?=[\s>/])", re.I)
NAME_PART = re.compile(r"[a-z]+")

# Element names of HTML by role.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup"
    " option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
DROPPED = set("script style noscript template iframe object svg math canvas head select textarea button".split())
VERBATIM = set("script style noscript template iframe textarea title".split())
EMPTY = set("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = set("nav footer aside form menu dialog".split())
ARTICLE = set("article main".split())
# Words in class, id and role that name parts other than the article.
PARTS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " complementary contentinfo cookie cookies copyright disqus footer header masthead menu menubar modal nav navbar"
    " navigation newsletter notice pager pagination popup promo promoted related replies respond search"
    " share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# Those of them that an article element may be itself, rather than have beside it.
ITEMS = set(
    "ad ads advert adverts advertisement advertising comment comments promo promoted related replies sponsored".split()
)
MAIN_PARTS = set("article main content post entry story".split())
# Frequent function words of the languages read.
STOP_WORDS = set(
    "a an and are as at be by for from has have he her his i in is it its not of on or she that the their"
    " they this to was we were which will with you"
    " als am auch auf aus bei das dem den der des die du ein eine einen einer es für hat ich ihr im ist"
    " mit nicht oder sich sie sind und von war werden wir zu zum zur"
    " au aux avec ce ces cette dans de du elle en est et il ils je la le les leur mais ne ou par pas"
    " plus pour qu que qui sa se ses son sur un une vous"
    " al como con del el ella era esta este ha las lo los más me mi muy no nos para pero por se si sin"
    " su sus también una y ya".split()
)


@dataclass
class Block:
    text: str
    linked: int
    barred: bool
    inside: bool
    heading: bool
    label: str = ""


def marks(attributes: str) -> set[str]:
    """Parts of a page that class, id and role name; ``hidden`` for unseen elements."""
    found: set[str] = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        if name.lower() in ("class", "id", "role"):
            found.update(NAME_PART.findall(value))
        elif name.lower() == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            found.add("hidden")
        elif name.lower() == "aria-hidden" and value == "true":
            found.add("hidden")
    if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attributes):
        found.add("hidden")
    return found


def holders(page: str) -> set[int]:
    """Starts of the elements that hold every article, or every main, of a page.

    Articles that are a comment or a teaser by name don't count.
    """
    held: dict[str, set[int]] = {}
    stack: list[tuple[str, int]] = []
    at = 0
    while token := TOKEN.search(page, at):
        at = max(token.end(), token.start() + 1)
        if token[2] is None:
            continue
        name = token[2].lower()
        if token[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        elif name in VERBATIM:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name not in EMPTY:
            if name in ("p", "li", "dt", "dd", "option") and stack and stack[-1][0] == name:
                stack.pop()
            if name == "main" or (name == "article" and not marks(token[3] or "") & ITEMS):
                around = {start for _, start in stack}
                held[name] = held[name] & around if name in held else around
            stack.append((name, token.start()))
    return set().union(*held.values())


def blocks(page: str) -> list[Block]:
    """Blocks of text of a page in order, with the length of their links and where they stand.

    A link without end tag ends with its block. Names of parts don't bar html,
    body and main, nor what holds the page's article.
    """
    out: list[Block] = []
    holding: set[int] | None = None
    stack: list[tuple[str, bool, bool, bool]] = []  # name, dropped, barred, inside an article
    parts: list[str] = []
    linked: list[str] = []
    links = 0  # 1 in a link, 2 in one without end tag
    dropped = barred = inside = False
    heading = False

    def close() -> None:
        nonlocal parts, linked, links
        text = SPACE.sub(" ", entities.unescape("".join(parts))).strip() if parts else ""
        if text:
            in_links = SPACE.sub(" ", entities.unescape("".join(linked))).strip()
            out.append(Block(text, len(in_links), barred, inside, heading))
        parts, linked = [], []
        links = links % 2

    def add(text: str) -> None:
        if text and not dropped:
            parts.append(text)
            if links:
                linked.append(text)

    at = 0
    while True:
        token = TOKEN.search(page, at)
        if token is None:
            add(page[at:])
            break
        add(page[at : token.start()])
        at = max(token.end(), token.start() + 1)
        if token[2] is None:
            continue
        name, closing = token[2].lower(), bool(token[1])
        if name == "a":
            following = None if closing else LINK.search(page, at)
            links = 0 if closing else 1 if following and following[1] else 2
            continue
        if name == "br":
            add(" ")
            continue
        named = marks(token[3]) if token[3] and not closing else set()
        if name in BLOCKS or name in DROPPED:
            close()
        elif closing:
            if all(s[0] != name for s in stack):
                continue
        elif name in EMPTY or not (named & PARTS or "hidden" in named):
            continue  # an inline element: its text belongs to the block around it
        else:
            close()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close()
                    del stack[i:]
                    break
            dropped, barred, inside = stack[-1][1:] if stack else (False, False, False)
            heading = False
            continue
        if name in EMPTY:
            continue
        if name in ("p", "li", "dt", "dd", "option") and stack and stack[-1][0] == name:
            stack.pop()
            dropped, barred, inside = stack[-1][1:] if stack else (False, False, False)
        part = set() if name in ("html", "body", "main") else named & PARTS
        if name == "article":
            part = part & ({"comment", "comments"} if named & MAIN_PARTS else ITEMS)
        named_bad = name == "form" or bool(part) and name != "article"
        if named_bad:
            holding = holders(page) if holding is None else holding
            if token.start() in holding:
                part, named_bad = set(), False
        bad = name in BOILERPLATE - {"form"} or named_bad or (name == "header" and not inside) or "hidden" in named or bool(part)
        if name in VERBATIM:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append((name, dropped or name in DROPPED, barred or bad, inside or name in ARTICLE))
        dropped, barred, inside = stack[-1][1:]
        heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
    close()
    return out


def stop_share(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)


def first_pass(
    block: Block, most_linked: float = 0.35, short: int = 70, long: int = 200,
    some_stops: float = 0.2, many_stops: float = 0.3,
) -> str:
    """good, near (good if a neighbour is), short or bad."""
    if block.barred:
        return "bad"
    length = len(block.text)
    if block.linked > most_linked * length:
        return "bad"
    if "©" in block.text and length < long:
        return "bad"
    if block.inside:
        return "good" if length >= short and not block.heading else "short"
    if length < short:
        return "short"
    stops = stop_share(block.text)
    if stops >= many_stops:
        return "good" if length >= long else "near"
    if stops >= some_stops:
        return "near"
    return "good" if length >= 2 * long and stops > 0.1 else "bad"


def joined_runs(found: list[Block], labels: list[str], long: int = 200, many_stops: float = 0.3) -> list[str]:
    """``labels`` with runs of near blocks made good that are long and dense enough together.

    Only good and bad blocks end a run.
    """
    out = list(labels)
    run: list[int] = []
    for i, label in enumerate([*labels, "bad"]):
        if label == "near":
            run.append(i)
        elif label != "short" and run:
            length = sum(len(found[k].text) for k in run)
            stops = stop_share(" ".join(found[k].text for k in run))
            if length >= (long if stops >= many_stops else 2 * long):
                for k in run:
                    out[k] = "good"
            run = []
    return out


def second_pass(found: list[Block]) -> list[Block]:
    """Blocks of the main text: short ones inherit from their nearest decided neighbours.

    An undecided block is kept if both neighbours are good, or the nearer of
    two that differ (the one before on a tie). Inside an article element, bars
    are no neighbours and no decided neighbour means good; elsewhere it means bad.
    """
    labels = joined_runs(found, [first_pass(b) for b in found])
    decided = [None if x in ("short", "near") else x for x in labels]
    for i, block in enumerate(found):
        if block.inside and block.barred:
            decided[i] = "skip"
    before: list[tuple[str, int] | None] = []
    last = None
    for i, label in enumerate(decided):
        before.append(last)
        if label in ("good", "bad"):
            last = (label, i)
    after: list[tuple[str, int] | None] = [None] * len(found)
    last = None
    for i in range(len(found) - 1, -1, -1):
        after[i] = last
        if decided[i] in ("good", "bad"):
            last = (decided[i], i)
    kept = []
    for i, block in enumerate(found):
        label = decided[i]
        if label is None:
            near = [x for x in (before[i], after[i]) if x]
            if block.inside:
                # the element says article; only neighbours in it may say otherwise
                near = [x for x in near if found[x[1]].inside]
                label = "good" if not near else min(near, key=lambda x: abs(x[1] - i))[0]
            elif labels[i] == "near":
                label = "good" if any(x[0] == "good" for x in near) or not near else "bad"
            elif not near:
                label = "bad"
            elif len({x[0] for x in near}) == 1 and len(near) == 2:
                label = near[0][0]
            elif len(near) == 1:
                label = near[0][0] if block.heading or near[0][0] == "bad" else "good"
            else:
                label = (
                    after[i][0] if block.heading else min(near, key=lambda x: abs(x[1] - i))[0]
                )
        if label == "good":
            kept.append(block)
    return kept


def main_text(page: str | None) -> str:
    """The kept blocks in page order, joined by one space."""
    found = blocks(page or "")
    if any(b.inside and not b.barred for b in found):
        found = [b for b in found if b.inside]
    return " ".join(b.text for b in second_pass(found))


def extract(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one for each row of ``pages``.

    Null and empty pages, and pages without article text, give an empty text.
    Pages are read whole, however long or badly closed: an end tag without
    start is ignored, an element without end goes on to the end of its parent
    or of the page. If a page has an article or main element, only blocks in
    such elements are looked at. Repeated rows give equal results, no rows
    give no rows, other columns are ignored.
    """

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    return pages.select("page_id", "url", texts("html").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )

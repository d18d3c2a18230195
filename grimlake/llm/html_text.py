"""Main text of web pages by two-pass block rules.

Pass one decides blocks by stop-word density, length and link density; the
container that a block stands in is a prior. Navigation and the like is never
text. Inside an article text is presumed good unless it is links; where a page
has an article, blocks outside it must be good by their own text. Pass two gives
short and nearly good blocks the label of their nearest decided neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grimlake.llm.common import id_as_text, text_or_empty

# FIXED VALUES: element names of HTML, stop words, and thresholds.
SKIP = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object", "canvas",
        "select", "textarea", "button", "datalist"}
BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog"}
MAIN = {"article", "main"}
BLOCK = {"address", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "ol",
         "optgroup", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr",
         "ul"} | BOILERPLATE | MAIN
#: Elements that may stand in a head; any other start tag ends it.
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template",
           "title", "head", "html"}
#: Elements whose text is read up to their own end tag.
RAW = {"script", "style", "noscript", "template", "title", "noframes"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|"
    r"notices?|alert|popup|modal|overlay|sidebar|side|widget|menu|nav|navbar|navigation|breadcrumbs?|masthead|header|"
    r"footer|comments?|replies|disqus|respond|share|sharing|social|related|recommended|newsletter|subscribe|"
    r"signup|login|pagination|pager|toolbar|skip|copyright|legal)(?:$|[\s_-])", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
STOP = {
    "en": "the of and to a in is that it for was on are as with his they at be this from have or by one had not but "
          "what all were when we there can an your which their if will each about how up out them",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son "
          "aux cette ses mais comme on nous elle leur",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er "
          "hat dass sie nach wird bei einer um am sind noch wie einem über so zum war",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí "
          "porque esta entre cuando muy sin sobre también",
}
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.30, 0.32
LINKS_HIGH = 0.2
LIST_LINKS = 0.8
#: In an article, text with this share of links is no text.
MAIN_LINKS = 0.5

WORD = re.compile(r"[^\W\d_]+")
STOP_WORDS = frozenset(w for line in STOP.values() for w in line.split())


class Blocks(HTMLParser):
    """Splits a page into blocks: [text, linked characters, place, heading, item].

    ``place`` is "main", "bad" or "" for blocks of neither. Open containers
    are a stack; an end tag closes down to its own start, and end tags without
    a start do nothing, so unclosed markup only ends with its container.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[list] = []
        self.open: list[tuple[str, str]] = []
        self.skipped: list[str] = []
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.tag = ""

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append([text, min(self.linked, len(text)), self.place(), self.tag in HEADINGS, self.tag == "li"])
        self.parts, self.linked = [], 0

    def state(self) -> str:
        return self.open[-1][1] if self.open else ""

    def place(self) -> str:
        now = self.state()
        return "bad" if now.startswith("named") else now

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if "head" in self.skipped and tag not in IN_HEAD and not RAW & set(self.skipped):
                self.skipped.clear()
            if tag in BLOCK:
                self.flush()
            return
        # A head needs no end tag: the first element that it can't hold ends it.
        if "head" in self.skipped and tag not in IN_HEAD and not RAW & set(self.skipped):
            self.skipped.clear()
        if self.skipped or tag in SKIP:
            self.skipped.append(tag)
            return
        if tag == "a":
            self.links += 1
        if tag not in BLOCK:
            return
        self.flush()
        self.tag = tag
        if tag in {"p", "li", "dt", "dd", "body", "html"} | HEADINGS:
            return
        now = self.state()
        attrs = dict(attrs)
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        # Names only hint: an article inside a container with such a name starts
        # anew, unless it is inside the article that the container stands in.
        if now == "bad" or tag in BOILERPLATE or (attrs.get("role") or "").lower() in ROLES:
            now = "bad"
        elif tag in MAIN and now != "named in main" and not re.search("comment|repl", names, re.I):
            now = "main"
        elif now.startswith("named"):
            pass
        elif NAMED.search(names):
            now = "named in main" if now == "main" else "named"
        elif tag == "header" and now != "main":
            now = "named"
        self.open.append((tag, now))

    def handle_endtag(self, tag):
        if self.skipped:
            if tag in self.skipped:
                while self.skipped.pop() != tag:
                    pass
            elif tag in {"body", "html"} or any(tag == t for t, _ in self.open) and "head" not in self.skipped:
                self.skipped.clear()
            else:
                return
            return
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag not in BLOCK:
            return
        self.flush()
        self.tag = ""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if self.skipped:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def first_pass(block: list) -> str:
    """good, bad, near or short."""
    text, linked, place, heading, item = block
    density = linked / len(text)
    if place == "bad" or item and density >= LIST_LINKS:
        return "bad"
    if place == "main":
        if density <= LINKS_HIGH or heading or item:
            return "good"
        return "near" if density < MAIN_LINKS else "bad"
    if density > LINKS_HIGH or "©" in text:
        return "bad"
    if len(text) < SHORT:
        return "bad" if linked else "short"
    found = WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in found) / max(1, len(found))
    if stops >= STOP_HIGH:
        return "good" if len(text) > LONG else "near"
    return "near" if stops >= STOP_LOW else "bad"


def second_pass(labels: list[str], sizes: list[int], headings: list[bool]) -> list[bool]:
    """Short blocks become good between good neighbours; nearly good ones unless
    both neighbours are bad and the nearly good text between them is short; with one good and one bad neighbour a short block
    follows the nearer, the earlier of equals. Neighbours are the nearest
    decided blocks; the page's ends are bad. Headings right before good text
    are good."""
    n = len(labels)
    before, after = [(-1, "bad")] * n, [(n, "bad")] * n
    last = (-1, "bad")
    for i in range(n):
        before[i] = last
        if labels[i] in ("good", "bad"):
            last = (i, labels[i])
    last = (n, "bad")
    for i in range(n - 1, -1, -1):
        after[i] = last
        if labels[i] in ("good", "bad"):
            last = (i, labels[i])
    out = []
    nearly: dict[int, int] = {}  # characters of nearly good text since a decided block
    for i, label in enumerate(labels):
        if label == "near":
            nearly[before[i][0]] = nearly.get(before[i][0], 0) + sizes[i]
    for i, label in enumerate(labels):
        (a, left), (b, right) = before[i], after[i]
        if label in ("good", "bad"):
            out.append(label == "good")
        elif left == right:
            out.append(left == "good" or nearly.get(a, 0) > LONG)
        elif label == "near" or headings[i] and right == "good":
            out.append(True)
        else:
            out.append((left if i - a <= b - i else right) == "good")
    return out


def main_text(html: str) -> str:
    if not html:
        return ""
    page = Blocks()
    page.feed(html)
    page.close()
    page.flush()
    labels = [first_pass(b) for b in page.blocks]
    if "main" in {b[2] for b in page.blocks}:  # the page names an article: what is short elsewhere is none of it
        labels = ["bad" if label == "short" and b[2] != "main" else label for label, b in zip(labels, page.blocks)]
    keep = second_pass(labels, [len(b[0]) for b in page.blocks], [b[3] for b in page.blocks])
    return " ".join(b[0] for b, k in zip(page.blocks, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars (code points).

    Null html gives an empty text, as does a page without main text. Ids and
    urls are passed through, null and repeated ones too; an empty table gives
    an empty result. Whole pages are read, one at a time, without a shuffle.
    """
    page_id, kind = id_as_text(pages, id_col)
    rows = pages.select(page_id.alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        text_or_empty(html_col).alias("html"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in range(0, len(frame), 500):
                part = frame.iloc[a:a + 500]
                yield pd.DataFrame({"page_id": part["page_id"].to_numpy(), "url": part["url"].to_numpy(),
                                    "text": [main_text(h) for h in part["html"]]})

    out = rows.mapInPandas(run, "page_id string, url string, text string")
    return out.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("n_chars", F.char_length("text").cast("long"))

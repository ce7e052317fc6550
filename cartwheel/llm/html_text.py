"""Operator 10, main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass labels blocks on
their own: chrome (menus, headers, footers, sidebars, notices, adverts, forms,
reader comments) and link-dense blocks are bad, long blocks with enough stop
words are good, the rest stays open.  Where no list's stop words are frequent on
the page (another language, or hardly any prose), length and link density decide
alone; elsewhere long blocks with few stop words stay open, and paragraphs and
table rows among them are kept from ``LONG`` characters on.  Wide characters count
two.  The second pass gives open blocks the label of their nearest decided neighbours (at equal distance from a good and
a bad one, paragraphs are good).  Inside an explicit article or
main element the page itself vouches for the text, so a block there needs no
stop words and looks to neighbours inside that element only.

Defined cases: null or empty html gives an empty text; unclosed and stray tags
are tolerated; text cut off in the middle of a tag is dropped; repeated rows
each give a row; other columns are ignored."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import table
from cartwheel.llm.registry import query

MAX_LINK_DENSITY = 0.33
SHORT = 70        # characters below which a block can't decide by itself
LONG = 200        # characters above which stop words decide alone
STOP_LOW, STOP_HIGH = 0.12, 0.25

# fixed values: frequent function words of en, de, fr, es, it, pt, nl
STOP_LISTS = [frozenset(line.split()) for line in """
a an the of and to in is it that for on with as was at by be are this from or have not but they his her which you were had
der die das und in zu den von mit für ist im nicht ein eine auf sich dem des auch es an werden aus er hat dass sie nach wird bei
le la les de des du et en un une que qui dans pour pas sur avec est au ce il par plus ne se sont
el los las y que en un una por con no para es del se lo como más su al o
il di che e per non una sono con del della i gli
o os as do da em um uma não com para
het een van en dat op te zijn met voor niet aan
""".strip().splitlines()]
STOP_WORDS = frozenset().union(*STOP_LISTS)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "select", "textarea", "button", "title", "canvas")
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead
tr ul caption""".split())
CHROME_TAGS = frozenset("nav footer aside form fieldset menu dialog head search label".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
CHROME_NAMES = frozenset("""ad ads advert advertisement adverts advertising adbox adslot sponsor sponsored promo promotion banner
nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc sidebar sidebars widget widgets related recommended
share sharing social footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
subscribe subscription signup login search comment comments commentlist disqus replies reply respond""".split())
CONTENT_NAMES = frozenset("content main article post entry story body text page".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|([^<]+|<)", re.S | re.I)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
WORD = re.compile(r"\w+")
WIDE = re.compile("[\u1100-\u115f\u2e80-\ua4cf\uac00-\ud7a3\uf900-\ufaff\ufe30-\ufe6f\uff01-\uff60\uffe0-\uffe6\U00020000-\U0003fffd]")


@dataclass
class Block:
    text: str
    links: int
    chrome: bool
    inside: int            # number of the article or main element, 0 outside
    heading: bool
    paragraph: bool
    cell: bool             # in a table
    label: str = field(default="")


def _attributes(raw: str) -> dict[str, str]:
    if "=" not in raw and "hidden" not in raw:
        return {}
    out = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}
    if re.search(r"(?:^|\s)hidden(?:\s|/|$)", raw):
        out["hidden"] = ""
    return out


def _is_chrome(tag: str, attrs: dict[str, str], inside: int) -> bool:
    if tag in CHROME_TAGS or (tag == "header" and not inside):
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return "hidden" in attrs
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in CHROME_ROLES:
        return True
    if re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I):
        return True
    names = set(re.split(r"[\s_-]+", f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()))
    return bool(names & CHROME_NAMES) and not names & CONTENT_NAMES


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, with what the labelling needs."""
    out: list[Block] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, int, bool, bool]] = [("", False, 0, False, False)]  # tag, in chrome, number of the article, in a paragraph, in a table
    articles = linked = depth = 0
    heading = False

    def close():
        nonlocal linked, heading
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, linked, stack[-1][1], stack[-1][2], heading, stack[-1][3], stack[-1][4]))
        parts.clear()
        linked, heading = 0, False

    for m in TOKEN.finditer(page):
        if m[5] is not None:
            if m[5] == "<" and m.end() == len(page):
                continue
            parts.append(m[5])
            if depth:
                linked += len(m[5].strip())
            continue
        if m[3] is None:  # comment, declaration or raw element
            if m[1] and m[1].lower() not in ("title",):
                parts.append(" ")
            continue
        tag = m[3].lower()
        if tag == "br" or tag in ("td", "th"):
            parts.append(" ")
        if tag in BLOCK:
            close()
        if m[2]:
            if tag == "a":
                depth = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag == "a":
            depth = 1
        if tag in VOID or m[4].endswith("/"):
            continue
        _, chrome, inside, paragraph, cell = stack[-1]
        if tag in ("article", "main") and not inside:
            articles += 1
            inside = articles
        if tag in BLOCK or m[4]:
            chrome = chrome or _is_chrome(tag, _attributes(m[4]), inside)
        if tag in ("p", "li", "tr", "dt", "dd") and stack[-1][0] == tag:
            stack.pop()  # such an element ends where the next one begins
        paragraph = tag in ("p", "pre", "blockquote") or paragraph and tag not in BLOCK
        stack.append((tag, chrome, inside, paragraph, cell or tag == "table"))
        heading = heading or tag in ("h1", "h2", "h3", "h4", "h5", "h6")
    close()
    return out


def _size(text: str) -> int:
    return len(text) if text.isascii() else len(text) + len(WIDE.findall(text))


def _first_pass(b: Block) -> str:
    size = _size(b.text)
    if b.chrome or b.links > MAX_LINK_DENSITY * len(b.text) or "\N{COPYRIGHT SIGN}" in b.text and size < LONG and not b.inside:
        return "bad"
    if size < SHORT or b.heading:
        return ""
    if b.inside:
        return "good"
    words = WORD.findall(b.text.lower())
    stop = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if stop < STOP_LOW:
        return "few"
    return "good" if size >= LONG and stop >= STOP_HIGH else "near"


def _listed(found: list[Block], first: list[str]) -> bool:
    """Whether the stop words of one list are frequent in the page's text."""
    words = [w for b, x in zip(found, first) if x != "bad" for w in WORD.findall(b.text.lower())]
    return any(sum(w in stop for w in words) >= STOP_LOW * len(words) for stop in STOP_LISTS)


def label(found: list[Block]) -> None:
    """Both passes: leaves ``good`` or ``bad`` in every block."""
    first = [_first_pass(b) for b in found]
    if "few" in first:
        listed = _listed(found, first)
        for i, b in enumerate(found):
            if first[i] == "few":
                if not listed:
                    first[i] = "good"
                else:
                    first[i] = "near" if _size(b.text) >= LONG and (b.paragraph or b.cell) else ""
    vouched = any(x in ("good", "near") or b.inside for x, b in zip(first, found))

    # a run of open blocks shares its neighbours, so each direction is one sweep
    before, after = [("", 0)] * len(found), [("", 0)] * len(found)
    for order, into, step in ((range(len(found)), before, -1), (range(len(found) - 1, -1, -1), after, 1)):
        last: dict[int, tuple[str, int]] = {}
        for i in order:
            b = found[i]
            into[i] = last.get(b.inside, ("", -1))
            if first[i] in ("good", "bad") and not (b.inside and b.chrome):
                last[b.inside] = (first[i], i)
    for i, b in enumerate(found):
        if first[i] in ("good", "bad"):
            b.label = first[i]
            continue
        (x, p), (y, q) = before[i], after[i]
        if not x and not y:
            b.label = "good" if b.inside or first[i] == "near" or not vouched else "bad"
        elif x == y or not y:
            b.label = x if first[i] != "near" else "good"
        elif not x:
            b.label = y if first[i] != "near" else "good"
        elif first[i] == "near" or b.heading and y == "good":
            b.label = "good"
        else:
            b.label = x if i - p < q - i else y if q - i < i - p else "good" if b.paragraph else "bad"


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    label(found)
    return "\n\n".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole html added as column ``into``."""
    at = pages.columns.index(html_col)
    schema = T.StructType([*pages.schema.fields, T.StructField(into, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = pa.array([main_text(t) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=schema.names)

    return pages.mapInArrow(run, schema)


@query("op10_html_text")
def op10(spark, sf_dir):
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

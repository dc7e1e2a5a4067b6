"""Main text of web pages by templates deduced from pages of one host.

Tokens are elements, known by the path of elements they stand under, and text
nodes under their path. For each host, tokens that occur equally often on every
page (equal occurrence vectors, compared by an order-free digest over the
different pages) form an equivalence class. A class that covers most of the
host's pages and has several tokens is valid. The elements of valid classes nest
as their paths do and make up the host's template; its constant texts belong to
the elements they stand in. What is left between them are slots.

The text of a slot is what differs from page to page. From the root of the
template the main element is reached by going down, as long as one element that
stands once on each page holds most of the text of the slots inside the one
before; an article, and an element beside whose text a headline would be lost,
is not left. A page's text is what the slots of the main element hold. Constant
text in an article stays, as a repeated sentence is still the author's; in other
elements it is template. Parts inside that say they are menus, adverts, notices,
forms or comments are no slots of the article.

Hosts with too few different pages have no template, and pages without the main
element have another. There the article is taken by its tag if it holds at least
half of the text that is not in menus and the like, else all of that text.

The pages of a host are never brought together: tasks emit digests of their
pages' tokens, pre-aggregated; a host's tokens that stand on most of its pages
are as many as those of a page; and a template is a short list that joins the
pages by host. Null html counts as empty text; urls that are null or without
host share one host. Pages that repeat count once in the template and are
extracted each. Ties between elements go to the first of the page. An empty
table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices, staged

#: A valid class stands on at least so many different pages, and on this share of the host's.
LEAST_PAGES, LEAST_SHARE = 3, 0.8
#: Tokens of a valid class.
LEAST_TOKENS = 2
#: Share of the slots' text that leads down the template, and that makes an article the main part of a page without one.
MAIN_SHARE, ARTICLE_SHARE = 0.6, 0.5

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
ATTRIBUTES = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
#: Attributes behind a quote that is never closed.
PLAIN = re.compile(r"([^<>]*+)>")
RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in "script style noscript template textarea iframe svg select".split()}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
HEADLINES = frozenset(("h1", "h2", "h3"))
NOT_CONTENT = frozenset("head title nav header footer aside form button menu dialog object audio video canvas".split())
CONTENT = frozenset(("article", "main"))
#: Words of class, id and role that mark an element as no content, alone or as a part of a name.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|advertisement|sponsor\w*|navbar|navigation|breadcrumbs?|masthead|sidebar|side-bar|"
    r"cookies?|consent|popup|modal|newsletter|subscribe|login|comments?|replies|disqus|contentinfo)(?:$|[\s_-])",
    re.I,
)
#: Words that do so only as a whole name: parts of names such as related-work or search-results are no marks.
NAMES = re.compile(
    r"(?:^|\s)(?:promo|banner|nav|menu|header|footer|aside|widget|notices?|alert|reply|share|sharing|social|related|"
    r"recommended|complementary|search)(?:$|\s)",
    re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: An element of these closes an open one of the same kind, which authors leave open.
SELF_CLOSING = {"p": "p", "li": "li", "dt": "dt", "dd": "dd", "tr": "tr", "td": "td", "th": "th", "option": "option"}
#: Open elements that are searched for a paragraph to close.
NEAR = 100
WHITE = re.compile(r"\s+")

OPEN, CLOSE, TEXT = 0, 1, 2


def attributes(raw: str) -> tuple[str, bool]:
    """Class, id and role as one text, and whether the element is hidden."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)} if raw and not raw.isspace() else {}
    return " ".join(found[k] for k in ("class", "id", "role") if found.get(k)), "hidden" in found


def markup(source: str) -> Iterator[tuple[int, str, str]]:
    """(kind, tag or text, attributes) in order. Reads a page once, whatever is left open in it."""
    at, seen, n = 0, 0, len(source)
    quotes = True  # until a quote is found that nothing closes
    while (i := source.find("<", seen)) >= 0:
        follows = source[i + 1 : i + 2]
        if follows in ("!", "?") and follows:
            if i > at:
                yield TEXT, source[at:i], ""
            comment = source.startswith("<!--", i)
            end = source.find("-->" if comment else ">", i + 2)
            at = seen = n if end < 0 else end + (3 if comment else 1)
            continue
        m = NAME.match(source, i)
        rest = m and (ATTRIBUTES if quotes else PLAIN).match(source, m.end())
        if m and rest is None and quotes:
            quotes = False
            rest = PLAIN.match(source, m.end())
        if not rest:  # a lone sign
            seen = i + 1
            continue
        if i > at:
            yield TEXT, source[at:i], ""
        tag = m[2].lower()
        at = seen = rest.end()
        if m[1]:
            yield CLOSE, tag, ""
        elif tag in RAW:
            end = RAW[tag].search(source, at)
            at = seen = end.end() if end else n
        else:
            yield OPEN, tag, rest[1]
    if at < n:
        yield TEXT, source[at:], ""


def digest(path: int, name: str) -> int:
    """A child's path from its parent's, or a text's token."""
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass"), path) >> 1


class Page:
    """The elements and texts of a page, each with the digest of its path.

    ``nodes``: (kind, path, tag or text, inside an article, in a part that is no content).
    """

    def __init__(self, source: str | None):
        self.nodes: list[tuple[int, int, str, bool, bool]] = []
        #: tag, path, inside an article, no content, text inside so far
        stack: list[list] = []
        opened: dict[str, int] = {}
        #: path -> [parent's path, tag, how often, text inside]; text token -> [path, "", how often, its length]
        self.tokens: dict[int, list] = {}

        def close(to: int) -> None:
            while len(stack) > to:
                tag, path, inside, out, text = stack.pop()
                opened[tag] -= 1
                self.nodes.append((CLOSE, path, tag, inside, out))
                self.tokens[path][3] += text
                if stack:
                    stack[-1][4] += text

        def count(token: int, parent: int, tag: str, text: int) -> None:
            mine = self.tokens.setdefault(token, [parent, tag, 0, 0])
            mine[2] += 1
            mine[3] += text

        for kind, value, raw in markup(source or ""):
            if kind == TEXT:
                _, path, inside, out, _ = stack[-1] if stack else ("", 0, False, False, 0)
                self.nodes.append((TEXT, path, value, inside, out))
                if not out and not value.isspace():
                    said = value.strip()
                    count(digest(path, f"\0{said}"), path, "", len(said))
                    if stack:
                        stack[-1][4] += len(said)
            elif kind == CLOSE:
                if opened.get(value):
                    to = len(stack) - 1
                    while stack[to][0] != value:
                        to -= 1
                    close(to)
                elif value in BLOCKS and stack:
                    self.nodes.append((CLOSE, 0, value, stack[-1][2], stack[-1][3]))
            else:
                if value in SELF_CLOSING and stack and stack[-1][0] == value:
                    close(len(stack) - 1)
                elif value in BLOCKS and opened.get("p"):
                    # a block ends an open paragraph, and the inline elements open in it
                    for to in range(len(stack) - 1, max(len(stack) - NEAR, 0) - 1, -1):
                        if stack[to][0] == "p":
                            close(to)
                            break
                        if stack[to][0] in BLOCKS:
                            break
                name, hidden = attributes(raw)
                _, parent, inside, out, _ = stack[-1] if stack else ("", 0, False, False, 0)
                path = digest(parent, f"{value}.{name}" if name else value)
                marked = bool(name) and value not in ("body", "html") and bool(MARKS.search(name) or NAMES.search(name))
                out = out or hidden or value in NOT_CONTENT or marked
                inside = inside or (not out and (value in CONTENT or "main" in name.lower().split()))
                self.nodes.append((OPEN, path, value, inside, out))
                count(path, parent, value, 0)
                if value not in VOID:
                    stack.append([value, path, inside, out, 0])
                    opened[value] = opened.get(value, 0) + 1
        close(0)

    def text(self, main: int | None = None, constants: frozenset[int] = frozenset()) -> str:
        """The text in the slots of the element ``main``; without it, or where the page has none, the article's."""
        if main is not None and main in self.tokens:
            inside = 0
            chosen = []
            for node in self.nodes:
                kind, path, value, _, out = node
                if path == main and kind == OPEN:
                    inside += 1
                if inside and not out:
                    chosen.append(node)
                if path == main and kind == CLOSE:
                    inside -= 1
            return self._joined(chosen, constants)
        rest = [x for x in self.nodes if not x[4]]
        article, whole = (sum(len(x[2].strip()) for x in rest if x[0] == TEXT and (x[3] or every)) for every in (False, True))
        return self._joined([x for x in rest if x[3]] if article and article >= ARTICLE_SHARE * whole else rest, constants)

    @staticmethod
    def _joined(nodes: list[tuple[int, int, str, bool, bool]], constants: frozenset[int]) -> str:
        blocks: list[str] = []
        held: list[str] = []

        def end() -> None:
            block = WHITE.sub(" ", entities.unescape("".join(held))).strip()
            if block:
                blocks.append(block)
            held.clear()

        for kind, path, value, _, _ in nodes:
            if kind == TEXT:
                if not constants or digest(path, f"\0{value.strip()}") not in constants:
                    held.append(value)
            elif value in BLOCKS:
                end()
            elif value in ("br", "td", "th"):
                held.append(" ")
        end()
        return "\n".join(blocks)


def _host(pages: DataFrame):
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))


TOKENS = "host string, token bigint, parent bigint, tag string, place bigint, pages bigint, once bigint, vector bigint, chars bigint"


def occurrences(pages: DataFrame) -> DataFrame:
    """``TOKENS`` for each host and token, over the different pages of the host."""
    bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            held: dict[tuple[str, int], list] = {}
            for host, page, source in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html"))):
                for place, (token, (parent, tag, n, chars)) in enumerate(Page(source).tokens.items()):
                    mine = held.setdefault((host, token), [parent, tag, 0, 0, 0, 0, 0])
                    mine[2] += place
                    mine[3] += 1
                    mine[4] += n == 1
                    # pages differ, so no two of these cancel each other
                    mine[5] ^= xxhash.xxh3_64_intdigest(f"{page}:{n}") >> 1
                    mine[6] += chars
            cols = list(zip(*((h, t, *v) for (h, t), v in held.items()))) or [()] * 9
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[c.split()[0] for c in TOKENS.split(", ")])

    found = different(pages).mapInArrow(run, TOKENS)
    return found.groupBy("host", "token").agg(
        F.min("parent").alias("parent"), F.min("tag").alias("tag"), F.sum("place").alias("place"), F.sum("pages").alias("pages"),
        F.sum("once").alias("once"), F.expr("bit_xor(vector)").alias("vector"), F.sum("chars").alias("chars"),
    )


def different(pages: DataFrame) -> DataFrame:
    """``host, page, html`` of the different pages of each host; only pages that repeat are shuffled."""
    digests = F.concat_ws("-", F.xxhash64("html"), F.xxhash64(F.lit(1), "html"))
    rows = pages.where("html is not null").select(_host(pages).alias("host"), digests.alias("page"), "html")
    again = staged(rows.groupBy("host", "page").agg(F.count("*").alias("n")).where("n > 1").select("host", "page"), "repeated")
    once = rows.join(again, ["host", "page"], "left_anti")
    return once.unionByName(rows.join(again, ["host", "page"], "left_semi").dropDuplicates(["host", "page"]))


def deduced(host: pd.DataFrame) -> pd.DataFrame:
    """``host, main, constants`` of one host, from its tokens that stand on most pages (as many as a page's)."""
    valid = host.groupby("vector")["token"].transform("size") >= LEAST_TOKENS
    host = host.assign(valid=valid).sort_values(["place", "token"])
    elements = {t: (p, tag, once and v, chars) for t, p, tag, once, v, chars in zip(
        host["token"], host["parent"], host["tag"], host["once"] == host["pages"], host["valid"], host["chars"]) if tag}
    texts = host[(host["tag"] == "") & host["valid"]]
    slot = {t: e[3] for t, e in elements.items()}  # text inside that is not constant
    for parent, chars in zip(texts["parent"], texts["chars"]):
        while parent in elements:
            slot[parent] -= chars
            parent = elements[parent][0]
    children: dict[int, list[int]] = {}
    for t, (parent, _, _, _) in elements.items():
        children.setdefault(parent, []).append(t)
    main, options = None, children.get(0, [])
    while options:
        whole = slot[main] if main is not None else sum(slot[t] for t in options)
        single = [t for t in options if elements[t][2]]
        best = max(single, key=slot.get, default=None)
        if best is None or whole <= 0 or slot[best] < MAIN_SHARE * whole:
            break
        if main is not None and any(elements[t][1] in HEADLINES for t in options if t != best):
            break
        main, options = best, children.get(best, [])
        if elements[main][1] in CONTENT:
            break
    constants: list[int] = []
    if main is not None and elements[main][1] not in CONTENT:
        constants = texts["token"].tolist()
    return pd.DataFrame({"host": [host["host"].iloc[0]], "main": [main if main is not None else 0], "constants": [constants]})


def templates(pages: DataFrame) -> DataFrame:
    """Staged ``host, main, constants``: the path of each host's main element (0: none) and its template's texts."""
    tokens = occurrences(pages)
    # the root of a page stands on every page
    sizes = _sizes(pages)
    often = tokens.where(f"pages >= {LEAST_PAGES}").join(sizes, "host").where(F.col("pages") >= LEAST_SHARE * F.col("all"))
    return staged(
        often.groupBy("host").applyInPandas(deduced, "host string, main bigint, constants array<bigint>"), "templates"
    )


def _sizes(pages: DataFrame) -> DataFrame:
    """``host, all``: the number of different pages."""
    rows = pages.where("html is not null").select(_host(pages).alias("host"), F.xxhash64("html").alias("a"), F.xxhash64(F.lit(1), "html").alias("b"))
    return rows.distinct().groupBy("host").agg(F.count("*").alias("all"))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, by_template`` for each row of ``pages``."""
    known = templates(pages)
    rows = pages.select("page_id", "url", "html", _host(pages).alias("host")).join(known, "host", "left")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts, by = [], []
            held: tuple[list | None, frozenset[int]] = (None, frozenset())
            for source, main, constants in zip(*(batch.column(c).to_pylist() for c in ("html", "main", "constants"))):
                if constants != held[0]:
                    held = constants, frozenset(constants or ())
                page = Page(source)
                by.append(bool(main) and main in page.tokens)
                texts.append(page.text(main or None, held[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(by, pa.bool_())],
                names=["page_id", "url", "text", "by_template"],
            )

    return rows.select("page_id", "url", "html", "main", "constants").mapInArrow(
        run, f"page_id {kind}, url string, text string, by_template boolean"
    )


def report(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, by_template`` for each row of ``pages``."""
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "by_template")

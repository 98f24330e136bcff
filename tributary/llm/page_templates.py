"""Main text of web pages by template deduction.

The tokens of a page are its element paths and its blocks of text. Tokens of a
host that occur on the same pages, equally often, form an equivalence class.
Classes that occur on enough pages and nest in one another make up the host's
template; what the template leaves open are its slots. Slots that hold the
article are extracted, those of menus, headers, footers, notices and the like
are not, nor is text that itself belongs to the template.

The occurrence vector of a token is never held: a sum of hashes over its pages
stands for it, so that classes of hosts of any size are found by aggregation.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.staging import stage

#: Share of a host's pages, and least number, on which a class must occur.
SUPPORT, LEAST_PAGES = 0.5, 3
#: A slot outside an article whose text stands in links to this share is a menu.
MENU_SHARE = 0.5
#: Parts that a host's pages are dealt into when they meet its template.
PARTS = 16

# Elements by what they mean in a page.
BLOCKS = frozenset("address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary "
                   "table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object textarea select title noframes xmp".split())
APART = frozenset("head title nav aside form footer dialog menu search button select".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog form menu".split())
#: Words of class and id that mark parts beside the article.
APART_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
                        "menu breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent notice notices gdpr alert popup modal "
                        "overlay newsletter subscribe signup comment comments disqus respond reply replies share sharing social related "
                        "recommended widget pagination pager login search form toolbar".split())
_CLOSED_BY = {"p": frozenset(BLOCKS - {"body", "html", "head", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}),
              "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
              "tr": frozenset({"tr", "tbody", "tfoot"}), "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
              "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}), "head": frozenset({"body"})}

# A tag ends at the first > outside quotes or, if quotes are left open, at any; the last may be cut off with the page.
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))""",
                  re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)


def _mark(name: str, attributes: str) -> str:
    """An element as it stands in a path: its name, with a sign if it is beside the article."""
    apart = name in APART
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        words = set(re.split(r"[^a-z0-9]+", "".join(values).lower()))
        key = key.lower()
        apart |= key == "hidden" or key == "role" and bool(words & APART_ROLES) or key != "role" and bool(words & APART_WORDS)
    if name in ("html", "body", "article", "main"):  # a class of the whole page says nothing of a part
        apart = False
    return f"{name}!" if apart else name


def blocks_of(page: str) -> list[tuple[str, str, int]]:
    """(path, text, characters in links) of each block of text, in page order.

    White space in a block is one blank, character references are decoded; scripts, styles and the like have no text. A
    page may end anywhere.
    """
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    links = in_link = 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(("/".join(mark for _, mark in stack), text, min(links, len(text))))
            parts.clear()
        links = 0

    at = 0
    while at < len(page):
        found = _TAG.search(page, at)
        end = found.start() if found else len(page)
        if end > at:
            parts.append(page[at:end])
            links += (end - at) * bool(in_link)
        if not found:
            break
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if not found[3].endswith(">"):  # the page ends inside a tag
            break
        closing = bool(found[1])
        if name in RAW and not closing:
            if found[3].endswith("/>") and name in ("svg", "math"):
                continue
            ends = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = ends.end() if ends else len(page)
            parts.append(" ")
        elif name == "a":
            in_link = 0 if closing else 1
        elif name not in BLOCKS:
            if name in ("br", "img", "input", "button", "option", "label"):
                parts.append(" ")
        else:
            flush()
            if name in VOID:
                continue
            if closing:
                in_link = 0
                if any(name == open_name for open_name, _ in stack):
                    while stack.pop()[0] != name:
                        pass
            else:
                while stack and name in _CLOSED_BY.get(stack[-1][0], ()):
                    stack.pop()
                stack.append((name, _mark(name, found[3])))
    flush()
    return out


def _beside(path: str) -> bool:
    """Whether a path leads to a part beside the article. A header is one unless it belongs to the article."""
    steps = path.split("/")
    return any(s.endswith("!") for s in steps) or "header" in steps and not {"article", "main"} & set(steps[:steps.index("header")])


def _in_article(path: str) -> bool:
    return not {"article", "main"}.isdisjoint(path.split("/"))


def _hash(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value) - (1 << 63)


_TOKENS = "host string, path string, content long, times long, chars long, links long, mark decimal(20,0)"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each page with their number there: paths (no content) and texts at their path. An empty path is the page itself."""
    for batch in batches:
        rows = []
        for page_id, host, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "host", "html")), strict=True):
            times: dict[tuple[str, int | None], list[int]] = {("", None): [1, 0, 0]}
            for path, text, links in blocks_of(page or ""):
                for key in ((path, None), (path, _hash(text))):
                    entry = times.setdefault(key, [0, 0, 0])
                    entry[0] += 1
                    entry[1] += len(text)
                    entry[2] += links
            rows += [(host, path, content, n, chars, links, _hash(f"{page_id} {n}"))
                     for (path, content), (n, chars, links) in times.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 7
        types = [pa.string(), pa.string(), *[pa.int64()] * 5]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        arrays[6] = arrays[6].cast(pa.decimal128(20, 0))
        yield pa.RecordBatch.from_arrays(arrays, ["host", "path", "content", "times", "chars", "links", "mark"])


def host_templates(pages: DataFrame) -> DataFrame:
    """host, texts (hashes of path and text that belong to the template), menus (paths of slots that hold links).

    A class holds the tokens of a host with equal occurrence vectors, on at least half of its pages and three. It is
    valid if each of its paths continues a path of the template or a root, so that classes nest. Text of a valid class
    belongs to the template, unless it stands in an article; a path that is no such text is a slot.
    """
    found = pages.select("page_id", "host", "html").mapInArrow(_tokens, _TOKENS)
    tokens = stage(found.groupBy("host", "path", "content").agg(
        F.count("*").alias("pages"), F.sum("times").alias("times"), F.sum("chars").alias("chars"),
        F.sum("links").alias("links"), F.sum("mark").alias("vector")), "page-tokens")
    sizes = tokens.filter("path = ''").select("host", F.col("pages").alias("host_pages"))
    frequent = (tokens.filter(f"path <> '' AND pages >= {LEAST_PAGES}").join(sizes, "host")
                .filter(F.col("pages") >= F.col("host_pages") * SUPPORT))
    own = F.struct("path", "content", "times", "chars", "links")
    classes = frequent.groupBy("host", "pages", "times", "vector").agg(F.collect_list(own).alias("tokens"))
    # At most 1 / SUPPORT times the tokens of an average page.
    hosts = classes.groupBy("host").agg(F.collect_list(F.struct("pages", "tokens")).alias("classes"))

    def nest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, menus = [], []
            for classes in batch.column("classes").to_pylist():
                known: set[str] = set()
                own_texts, own_menus = [], []
                for entry in sorted(classes, key=lambda c: (-c["pages"], min(t["path"] for t in c["tokens"]))):
                    paths = sorted({t["path"] for t in entry["tokens"]})
                    roots = [p for p in paths if not any(p != q and p.startswith(q + "/") for q in paths)]
                    if known and not all(any(r == k or r.startswith(k.rpartition("/")[0] + "/") or k.startswith(r + "/")
                                             for k in known) for r in roots):
                        continue
                    known.update(paths)
                    for token in entry["tokens"]:
                        if _in_article(token["path"]):
                            continue
                        if token["content"] is not None:
                            own_texts.append(_hash(f"{token['path']} {token['content']}"))
                        elif token["links"] >= MENU_SHARE * max(1, token["chars"]):
                            own_menus.append(token["path"])
                texts.append(sorted(own_texts))
                menus.append(sorted(own_menus))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(texts, pa.list_(pa.int64())),
                                              pa.array(menus, pa.list_(pa.string()))], ["host", "texts", "menus"])

    return stage(hosts.mapInArrow(nest, "host string, texts array<long>, menus array<string>"), "templates")


def article_of(page: str, texts: frozenset[int] = frozenset(), menus: frozenset[str] = frozenset()) -> str:
    """The blocks of a page's article slots, joined by line breaks."""
    blocks = [b for b in blocks_of(page) if not _beside(b[0])]
    article = [b for b in blocks if _in_article(b[0])]
    if not article:  # without such an element all slots are left that are neither template text nor menus
        article = [(path, text, links) for path, text, links in blocks
                   if path not in menus and _hash(f"{path} {_hash(text)}") not in texts]
    return "\n".join(text for _, text, _ in article)


def extract_articles(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: the main text of each page, decoded, a line for each block; n_chars are code points.

    Null and empty pages have the empty text, as have pages without article. Pages without url are a host of their own;
    hosts of one or two pages have no template, so that the meaning of elements alone decides. Repeated rows give a row
    each. Broken markup is read as far as it goes.
    """
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host"))
    templates = host_templates(pages)
    # A host may have a third of all pages: its template goes to several parts, which share its pages.
    part = F.pmod(F.xxhash64("page_id", "url"), F.lit(PARTS))
    placed = templates.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    joined = pages.withColumn("part", part.cast("int")).join(placed, ["host", "part"], "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sets = None, (frozenset(), frozenset())
        for batch in batches:
            out = []
            for own, page, texts, menus in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "texts", "menus")), strict=True):
                if own != last:
                    last, sets = own, (frozenset(texts or ()), frozenset(menus or ()))
                out.append(article_of(page or "", *sets))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()),
                                              pa.array(np.array([len(t) for t in out], np.int64))], ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "host", "html", "texts", "menus").mapInArrow(
        extract, "page_id long, url string, text string, n_chars long")

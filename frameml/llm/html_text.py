"""Main text of web pages by consensus host paths.

A page is read into blocks of text, each inside a path of containers written as
generalised tag.class steps (digits removed).  Containers score by the text of
their blocks, less link text.  Every page gives its vote to its best container;
Spark adds the votes of a host, and all pages of the host are read again from
the winning path.  A page without that path uses its own best container.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameml.plans.lineage import cut_lineage, join_summary
from frameml.sources.tables import read_table

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
# Elements by what they mean for the text.
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "canvas",
                 "object", "audio", "video", "select", "datalist"))
LEFT_OUT = frozenset(("head", "nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "input", "label"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
CONTAINERS = frozenset(("html", "body", "main", "article", "section", "div", "header", "table", "tbody", "thead", "tr", "td",
                        "th", "ul", "ol", "dl", "blockquote", "figure", "details", "center"))
BLOCKS = CONTAINERS | LEFT_OUT | frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "figcaption",
                                            "caption", "summary", "address", "hr", "hgroup"))
_SIDE = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|masthead|site-?header|page-?header|top-?bar|footer|foot|sidebar|side|aside|"
    r"related|recommended|notice|cookies?|consent|banner|alert|popup|modal|overlay|newsletter|subscribe|paywall|ads?|adv|"
    r"advert\w*|sponsor\w*|promo\w*|comments?|disqus|replies|respond|share|sharing|social|breadcrumbs?|pagination|pager|"
    r"search|login|signup|form|widget|hidden)(?:$|[\s_-]|\d)", re.I)


def _attributes(raw: str) -> tuple[str, bool]:
    """(class names, whether the element is beside the main text)."""
    if not raw.strip():
        return "", False
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(raw)}
    beside = ("hidden" in found or found.get("aria-hidden") == "true"
              or found.get("role", "") in ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog")
              or bool(_SIDE.search(found.get("class", ""))) or bool(_SIDE.search(found.get("id", ""))))
    return found.get("class", ""), beside


def _step(tag: str, classes: str) -> str:
    names = sorted({re.sub(r"\d+", "", c.lower()) for c in classes.split()} - {""})
    return ".".join([tag, *names])


def blocks(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """(container path, text, characters of link text) in page order, without what lies beside the main text."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, str, bool]] = []  # tag, step, beside
    text: list[str] = []
    state = {"links": 0, "beside": 0, "in_link": 0}

    def flush() -> None:
        joined = " ".join(html.unescape("".join(text)).split())
        if joined and not state["beside"]:
            out.append((tuple(s for t, s, _ in stack if t in CONTAINERS), joined, state["links"]))
        text.clear()
        state["links"] = 0

    def close(upto: int) -> None:
        flush()
        while len(stack) > upto:
            state["beside"] -= stack.pop()[2]

    page, at = page or "", 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        piece = page[at:m.start() if m else len(page)]
        if piece and not state["beside"]:
            text.append(piece)
            if state["in_link"]:
                state["links"] += len(piece.strip())
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        closing, tag, raw = m[1], m[2].lower(), m[3]
        if tag in RAW:
            if not closing and not raw.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif tag == "a":
            state["in_link"] = 0 if closing else 1
        elif tag == "br":
            text.append(" ")
        elif tag in BLOCKS:
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
                else:
                    flush()
                continue
            flush()
            # An open paragraph or item ends where the next block or item begins.
            if stack and (stack[-1][0] == "p" or stack[-1][0] in ("li", "dt", "dd") and tag in ("li", "dt", "dd")):
                close(len(stack) - 1)
            if tag not in VOID and not raw.endswith("/"):
                classes, beside = _attributes(raw)
                beside = beside and tag not in ("html", "body", "article", "main") or tag in LEFT_OUT
                if tag == "header" and not any(t in ("article", "main") for t, _, _ in stack):
                    beside = True
                stack.append((tag, _step(tag, classes), beside))
                state["beside"] += beside
                state["in_link"] = 0
    close(0)
    return out


def scores(found: list) -> dict[tuple[str, ...], float]:
    """Text of a container's own blocks, and half of that of the containers just inside it."""
    out: dict[tuple[str, ...], float] = defaultdict(float)
    for path, text, links in found:
        worth = max(len(text) - 2 * links, 0)
        for up, factor in ((0, 1.0), (1, 0.5), (2, 0.25)):
            if len(path) > up:
                # Lists and table cells count for what holds them.
                out[path[:len(path) - up]] += worth * factor
        if any(s.split(".")[0] in ("article", "main") for s in path):
            k = max(i for i, s in enumerate(path) if s.split(".")[0] in ("article", "main"))
            out[path[:k + 1]] += worth
    return out


def best_path(found: list) -> tuple[str, ...]:
    ranked = scores(found)
    return max(ranked, key=lambda p: (ranked[p], -len(p), p)) if ranked else ()


def take(found: list, path: tuple[str, ...]) -> str:
    return "\n\n".join(t for p, t, _ in found if p[:len(path)] == path)


def _vote(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        paths = [list(best_path(blocks(h.as_py()))) for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.list_(pa.string()))], names=["host", "path"])


def _extract(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        texts = []
        for page, path in zip(batch.column("html"), batch.column("path")):
            found = blocks(page.as_py())
            texts.append((path.as_py() and take(found, tuple(path.as_py()))) or take(found, best_path(found)))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: (page_id, url, text, n_chars).

    Blocks are joined by two newlines, white space inside a block is one space,
    character references are decoded.  Null and empty pages, and pages without
    main text, have an empty text.  Pages without a host (null or odd urls) vote
    as one host.  Ties between paths go to the higher score, then to the greater
    path.  Repeated rows stay; other columns are ignored.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"), host.alias("host"))
    votes = rows.select("host", "html").mapInArrow(_vote, "host string, path array<string>").where("size(path) > 0")
    winner = cut_lineage(votes.groupBy("host", "path").count().groupBy("host")
                         .agg(F.max_by("path", F.struct("count", "path")).alias("path")))
    read = join_summary(rows, winner, "host", "left").select("page_id", "url", "html", "path")
    return read.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))


QUERIES = {"op7_html_text": op7_html_text}
SQL: dict[str, str] = {}

"""Main text of web pages through the templates of their hosts.

Pages become tokens: every block element with its path, and every block of text with
the path it stands under. Tokens of one host that occur equally often on each of its
pages form an equivalence class; two sums over pages, of page hashes times counts,
stand for the whole occurrence vector, so classes come from ordinary aggregates
whatever a host's size. Classes that are large and frequent, and whose tokens nest in
each other, make the host's template. Text that is part of it is boilerplate; the
remaining text lies in its slots, and what stands in the slots of menus, notices,
adverts and the like is left out. Where a page marks an article that holds at least
half of what is left, the slots outside it are left out too.

Exact copies of a page count once, so that copied articles do not pass for template.

Defined cases: null and empty pages have an empty text. Pages without a usable url
share one nameless host. Rows with equal or null ids are extracted one by one. Text
outside any block element is a block of its own. An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import chunks, salted_left_join, stored

# Elements of the markup language, and names that sites give to what is not their text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style noscript template title textarea svg iframe object select option button canvas math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = frozenset("nav footer aside form head dialog menu".split())
MAIN = frozenset("article main".split())
OTHER_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner sponsor sponsored promo cookie cookies consent notice notices alert "
    "popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
    "header masthead comment comments respond replies discussion share sharing social related recommended widget login "
    "signup search pagination pager toolbar skip disclaimer gdpr".split()
)
HEADINGS = frozenset("header masthead".split())  # within an article these hold its title
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)>|<[!?][^>]*>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
NAME_PART = re.compile(r"[a-z]+")

MIN_PAGES = 3
MIN_SHARE = 0.5
MIN_CLASS = 2


class Element:
    __slots__ = ("main", "name", "outside", "path")

    def __init__(self, name: str, attrs: str, parent: Element | None) -> None:
        found = {k.lower(): (a or b or c) for k, a, b, c in ATTRIBUTE.findall(attrs)} if attrs else {}
        names = f"{found.get('class', '')} {found.get('id', '')}".strip().lower()
        role = found.get("role", "").lower()
        inside = parent is not None and parent.main
        self.name = name
        self.path = f"{parent.path if parent else ''}/{name}.{names}"
        self.main = inside or name in MAIN or role == "main" or found.get("itemprop", "").lower() == "articlebody"
        other = (
            name in OUTSIDE
            or (name == "header" and not inside)
            or role in OTHER_ROLES
            or "hidden" in found
            or (name not in ("html", "body") and not (OTHER_NAMES - HEADINGS if inside else OTHER_NAMES).isdisjoint(NAME_PART.findall(names)))
        )
        self.outside = other or (parent is not None and parent.outside)


def blocks(page: str) -> Iterator[tuple[Element | None, str]]:
    """(innermost block element, text) of each block of a page in order; an empty text where an element opens."""
    stack: list[Element] = []
    text: list[str] = []
    at, skip = 0, None

    def flush():
        joined = " ".join(html.unescape("".join(text)).split())
        text.clear()
        return joined

    for tag in TAG.finditer(page):
        if tag.start() < at:
            continue
        if skip is None and tag.start() > at:
            text.append(page[at : tag.start()])
        at = tag.end()
        name = tag["name"]
        if name is None:
            continue
        name, closing = name.lower(), bool(tag["close"])
        if name in RAW:
            if not closing:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "br":
            text.append(" ")
        if name not in BLOCKS and name != "head" and name != "menu":
            continue
        if joined := flush():
            yield (stack[-1] if stack else None), joined
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
        elif name not in VOID:
            if stack and (stack[-1].name == "p" or (name == "li" and stack[-1].name == "li")):
                stack.pop()
            if name == "body":
                stack = [e for e in stack if e.name == "html"]
            stack.append(Element(name, tag["attrs"], stack[-1] if stack else None))
            yield stack[-1], ""
    if at < len(page):
        text.append(page[at:])
    if joined := flush():
        yield (stack[-1] if stack else None), joined


def number(value: str) -> int:
    return int.from_bytes(blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def token(element: Element | None, text: str) -> str:
    return f"{element.path if element else ''}\x00{text}"


def parent_path(element: Element | None, text: str) -> str:
    """The token that a token nests in."""
    path = element.path if element else ""
    return token_of_path(path if text else path.rpartition("/")[0])


def token_of_path(path: str) -> str:
    return f"{path}\x00"


def page_tokens(pages: DataFrame) -> DataFrame:
    """(host, page, tokens): each page's tokens with their parents and counts, by number."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks(frames, 500):
            out = []
            for host, page in zip(frame["host"], frame["html"], strict=True):
                seen = Counter((number(token(e, t)), number(parent_path(e, t))) for e, t in blocks(page))
                out.append((host, number(page), [{"token": a, "parent": b, "n": n} for (a, b), n in seen.items()]))
            if out:
                yield pd.DataFrame(out, columns=["host", "page", "tokens"])

    schema = "host string, page long, tokens array<struct<token: long, parent: long, n: int>>"
    return pages.select("host", "html").mapInPandas(run, schema)


def templates(tokens: DataFrame) -> DataFrame:
    """(host, template): the tokens of the valid classes of each host with at least MIN_PAGES different pages."""
    root = number(token_of_path(""))
    unique = tokens.groupBy("host", "page").agg(F.first("tokens").alias("tokens"))
    sizes = unique.groupBy("host").agg(F.count("*").alias("pages"))
    each = unique.select("host", "page", F.inline("tokens"))
    # Two 30-bit hashes of the page: sums of their products with counts stay far below 2**63.
    mix = [F.xxhash64("page", F.lit(i)).bitwiseAND((1 << 30) - 1) * F.col("n") for i in (1, 2)]
    vectors = each.groupBy("host", "token", "parent").agg(F.count("*").alias("support"), F.sum(mix[0]).alias("a"), F.sum(mix[1]).alias("b"))
    frequent = vectors.filter(F.col("support") >= MIN_PAGES).join(sizes, "host").filter(F.col("support") >= MIN_SHARE * F.col("pages"))
    # Each of these tokens is on half the pages, so a host has at most twice as many as a page.
    classes = frequent.groupBy("host", "support", "a", "b").agg(F.collect_list(F.struct("token", "parent")).alias("members"))
    large = classes.filter(F.size("members") >= MIN_CLASS)
    by_host = large.groupBy("host").agg(F.flatten(F.collect_list("members")).alias("members"))
    known = by_host.withColumn("known", F.array_append(F.col("members.token"), F.lit(root)))
    nested = F.filter("members", lambda m: F.array_contains("known", m["parent"]))
    return known.select("host", F.array_sort(F.array_distinct(F.transform(nested, lambda m: m["token"]))).alias("template"))


def main_text(page: str, template: frozenset[int] | set[int]) -> str:
    """The text in a page's slots, blocks parted by an empty line."""
    kept = [
        (element, text)
        for element, text in blocks(page)
        if text and not (element is not None and element.outside) and number(token(element, text)) not in template
    ]
    marked = [text for element, text in kept if element is not None and element.main]
    # A marked teaser beside the text proper does not stand for it.
    enough = marked and 2 * sum(map(len, marked)) >= sum(len(text) for _, text in kept)
    return "\n\n".join(marked if enough else [text for _, text in kept])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    host = F.coalesce(F.regexp_extract(url_col, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("html"), F.lower(host).alias("host")
    )
    known = templates(stored(page_tokens(rows), "page-tokens"))
    # A host may hold a third of all pages: its rows are dealt over several tasks.
    joined = salted_left_join(rows, known, ["host"])

    @F.pandas_udf("string")
    def extracted(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for page, template in frames:
            out = [main_text(p, frozenset() if t is None else frozenset(t.tolist())) for p, t in zip(page, template, strict=True)]
            yield pd.Series(out, dtype=object)

    texts = joined.select("id", "url", extracted("html", "template").alias("text"))
    return texts.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))

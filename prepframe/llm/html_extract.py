"""Main text of pages by templates deduced from equivalence classes of tokens.

Tokens of a page are its elements by path (names, classes and ids from the root) and its blocks of text by path. Over
the pages of a host, tokens with the same occurrence vector (as often as each other on every page) form a class. A
class is valid if it holds an element and has enough support; valid classes nest by their elements' paths and make up
the host's template. Its tokens are of two sorts: elements, between which the slots lie, and constant texts, which are
no content. The element of the template that holds the article gives the slots that are extracted: the article or main
element or else the deepest container, once on each page, that holds most of the text. What menus, headers, footers,
sidebars, notices, adverts, forms and comments hold is left out by the names, classes, ids and roles on a slot's path.
A wrapper that holds most of the page is no aside for a name like `has-sidebar`, nor for being a form.

Occurrence vectors are compared by two sums of hashes of (page, times), so that a host's pages are pre-aggregated where
they are read and no host's pages meet in one task. The template of a host is a few rows, whatever its number of pages.

Cases: null and empty pages, and pages without main text, give an empty text. Pages of a host without a template (few
pages, null or strange address) are cut by the names on their own paths: the article or main element, else the body.
Repeated rows give equal results. Texts whose pages all have the same longest block aren't constant: copies of one article.
"""

from __future__ import annotations

from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepframe.llm.frames import column, longs, map_columns, steps, strings
from prepframe.llm.html_parse import Page, parse
from prepframe.scratch import stored

#: Pages of a host that a class must occur on.
SUPPORT = 8
#: Part of a host's text that its container must hold.
CONTAINED = 0.6
CONTAINERS = frozenset("article main section div td body center".split())
#: Hosts' template rows up to which they are broadcast (about 60 bytes each); a join by shuffle beyond.
BROADCAST_ROWS = 200_000
#: Tokens a task holds before it hands its sums on.
HELD = 300_000

_MASK = (1 << 31) - 1


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text, seed) - (1 << 63)


TOKENS = "host string, token long, name string, depth int, is_text boolean, main boolean, pages long, times long, sum_a long, sum_b long, chars long, low long, high long"
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), *[pa.int64()] * 7]


def _tokens(url: str | None, html: str | None) -> tuple[str, int, dict[int, list]]:
    """The host, a hash of the longest block, and for each token: name, depth, whether text, whether main, times, characters."""
    page = parse(html)
    found: dict[int, list] = {}
    for e in page.elements:
        token = _hash(e.key)
        own = found.setdefault(token, [e.name, e.key.count("/"), False, e.main and not e.aside, 0, 0])
        own[4] += 1
    for b in page.blocks:
        if not b.path:
            continue
        if not b.path[-1].aside:
            for e in dict.fromkeys(x.key for x in b.path):
                if (own := found.get(_hash(e))) is not None:
                    own[5] += len(b.text)
            token = _hash(f"{b.path[-1].key}\0{b.text}")
            own = found.setdefault(token, ["", len(b.path), True, b.path[-1].main, 0, 0])
            own[4] += 1
    longest = max((b.text for b in page.blocks if b.path and not b.path[-1].aside), key=lambda t: (len(t), t), default="")
    return host_of(url), _hash(longest), found


def template_tokens(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Every token of every host with its occurrence sums."""

    def gather(batches):
        held: dict[tuple[str, int], list] = {}

        def told():
            rows = [[*k, *v] for k, v in held.items()]
            names = [x.split(" ")[0] for x in TOKENS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 13, _KINDS, strict=True)], names=names)

        for batch in steps(batches):
            for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not html:
                    continue
                host, article, found = _tokens(url, html)
                page = xxhash.xxh64_intdigest(html, 7)
                for token, (name, depth, is_text, main, times, chars) in found.items():
                    vector = xxhash.xxh64_intdigest(f"{page}:{times}")
                    own = held.get((host, token))
                    if own is None:
                        held[host, token] = [name, depth, is_text, main, 1, times, vector & _MASK, vector >> 33, chars, article, article]
                    else:
                        own[4] += 1
                        own[5] += times
                        own[6] += vector & _MASK
                        own[7] += vector >> 33
                        own[8] += chars
                        own[9] = min(own[9], article)
                        own[10] = max(own[10], article)
            if len(held) > HELD:
                yield told()
                held.clear()
        yield told()

    rows = pages.select(column(url_col).alias("url"), column(html_col).alias("html")).mapInArrow(gather, TOKENS)
    sums = [F.sum(c).alias(c) for c in ("pages", "times", "sum_a", "sum_b", "chars")]
    first = [F.max(c).alias(c) for c in ("name", "depth", "is_text", "main")]
    return rows.groupBy("host", "token").agg(*first, *sums, F.min("low").alias("low"), F.max("high").alias("high"))


def templates(tokens: DataFrame) -> DataFrame:
    """(host, token, main): for each host the element that holds the main text, and the constant texts (not main).

    Tokens of too little support are dropped before classes are formed; the others are written once for all that is
    asked of them.
    """
    tokens = stored(tokens.where(F.col("pages") >= SUPPORT), "tokens")
    key = ["host", "pages", "times", "sum_a", "sum_b"]
    valid = tokens.where("NOT is_text").groupBy(*key).agg(F.min("depth").alias("outer"))
    texts = tokens.where("is_text AND low <> high").join(valid, key).where("depth > outer")
    constants = texts.select("host", "token", F.lit(False).alias("main"))
    hosts = tokens.where("NOT is_text").groupBy("host").agg(F.max("pages").alias("all_pages"), F.max("chars").alias("all_chars"))
    once = tokens.where(F.col("name").isin(*sorted(CONTAINERS)) & (F.col("times") == F.col("pages")))
    able = once.join(hosts, "host").where((F.col("pages") * 2 > F.col("all_pages")) & (F.col("chars") >= CONTAINED * F.col("all_chars")))
    # An article or main element first, the outermost of them; else the deepest container.
    named = F.col("main") & F.col("name").isin("article", "main")
    order = F.struct(named.alias("named"), F.when(named, -F.col("depth")).otherwise(F.col("depth")).alias("depth"), "token")
    mains = able.groupBy("host").agg(F.max(order).alias("best")).select("host", F.col("best.token").alias("token"), F.lit(True).alias("main"))
    return mains.union(constants)


def main_text(page: Page, main: int | None = None, constants: frozenset[int] = frozenset()) -> str:
    """Blocks in the element (else in the page's article or main element, else in all), without asides and constants."""
    chosen = [b for b in page.blocks if not (b.path and b.path[-1].aside)]
    if main is not None and (inside := [b for b in chosen if any(_hash(e.key) == main for e in b.path)]):
        chosen = inside
    elif any(e.main and not e.aside for e in page.elements):
        chosen = [b for b in chosen if b.path and b.path[-1].main]
    if constants:
        chosen = [b for b in chosen if not b.path or _hash(f"{b.path[-1].key}\0{b.text}") not in constants]
    return "\n".join([b.text for b in chosen])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row for each page."""
    spark = pages.sparkSession
    source = pages.select(column(id_col).alias("page_id"), column(url_col).alias("url"), column(html_col).alias("html"))
    found = stored(templates(template_tokens(source)), "templates")
    each = found.groupBy("host").agg(F.max(F.when(F.col("main"), F.col("token"))).alias("main"), F.collect_set(F.when(~F.col("main"), F.col("token"))).alias("constants"))
    small = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    table = {r["host"]: (r["main"], frozenset(r["constants"])) for r in each.toLocalIterator()} if small else {}
    shared = spark.sparkContext.broadcast(table)

    def start():
        known = shared.value

        def apply(urls, htmls, mains=None, constants=None):
            texts = []
            for i, (url, html) in enumerate(zip(urls, htmls, strict=True)):
                main, own = known.get(host_of(url), (None, frozenset())) if mains is None else (mains[i], frozenset(constants[i] or ()))
                texts.append(main_text(parse(html), main, own))
            return [strings(urls), strings(texts), longs(list(map(len, texts)))]

        return apply

    fields = [T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    if small:
        return map_columns(source, ["page_id"], ["url", "html"], fields, start)
    named = map_columns(source, ["page_id", "url", "html"], ["url"], [T.StructField("host", T.StringType())], lambda: lambda urls: [strings([host_of(u) for u in urls])])
    # Rows of a hot host are split by adaptive execution; its template is one row.
    joined = named.join(each, "host", "left")
    return map_columns(joined, ["page_id"], ["url", "html", "main", "constants"], fields, start)
